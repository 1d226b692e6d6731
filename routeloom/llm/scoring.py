"""Language-model scores of documents by stupid backoff.

Counts of all words and word pairs of all documents are tables.  Words above a relative frequency
are broadcast with their counts, which is bounded; so are the counts of pairs of the most frequent
words, which are the only pairs that can be very frequent.  All other pairs are exploded and
partitioned: by the pair if both words are broadcast, else by the 64-bit hash of a rarer word, where
they also meet that word's own count.  There they are counted, and every occurrence gets its count.
Pairs of two rarer words meet the counts of both in turn.  The logarithms are summed per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeloom.llm.storage import blocks, stored, texts_of
from routeloom.llm.tokens import inside, words_of

#: Rarer words are not broadcast but joined; at most a million words can be as frequent as this.
SHARED = 1e-6
#: Pairs of this many most frequent words are counted in a dense table.
FREQUENT = 512
#: Factor for words whose pair is not in the table; fewest occurrences for a pair to be in it.
BACKOFF, LEAST = 0.4, 2
_BITS = 20
#: Kinds of exploded rows: pairs of broadcast words, pairs whose first or second word only is
#: rarer, and a rarer first word of a text.  A tag is the other word's id and the kind.
PAIR, FIRST, SECOND, ALONE = range(4)


def _row(id_col: str, text_col: str) -> Column:
    """One number for each id and text; rows that repeat both share it and their score."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_row")


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=size).astype(float)  # integers if empty


class Vocabulary:
    """Ids of words, 0 for all others and then by falling count; broadcast as arrays."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int):
        order = np.lexsort((hashes, -counts))
        spot = np.argsort(hashes[order])
        self.sorted, self.ids = hashes[order][spot], spot + 1
        self.counts = np.concatenate([[total - counts.sum()], counts[order]]).astype(np.int64)
        self.total = total

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.ids[at], 0)

    def single(self, word: np.ndarray) -> np.ndarray:
        """log10 of a word's share of all words."""
        return np.log10(self.counts[word] / self.total)

    def paired(self, before: np.ndarray, own: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log10 of a word's score, with the counts of the word before, its own and the pair's."""
        with np.errstate(divide="ignore"):
            seen, unseen = np.log10(n / before), np.log10(BACKOFF) + np.log10(own / self.total)
        return np.where(n >= LEAST, seen, unseen)

    def numbers(self) -> tuple:
        return self.sorted, self.ids, self.counts, self.total

    @classmethod
    def back(cls, numbers: tuple) -> Vocabulary:
        new = cls.__new__(cls)
        new.sorted, new.ids, new.counts, new.total = numbers
        return new


def score_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rare: float = 0.0
) -> DataFrame:
    """Per row: its id, ``n_words`` and ``score``, the mean log10 of its words' backoff scores.

    After a word ``v``, a word ``w`` scores ``count(v w) / count(v)`` if the pair occurs at least
    twice in all documents, else 0.4 times its share of all words; a text's first word scores its
    share.  Words are runs without blanks.  Every word is kept, unless ``rare`` is given: then those
    rarer than ``rare`` of all words are one unknown word.  Counts cover all documents.

    A text without words, or null, has no score (null).  Repeated rows and rows without an id are
    scored and counted like any others.  Other columns are left out.
    """
    if rare and not 1e-6 <= rare < 1:
        raise ValueError("rare must be 0, or at least 1e-6 and below 1")
    text = F.col(f"`{text_col}`").alias("_text")
    rows = docs.select(_row(id_col, text_col), text)
    context = docs.sparkSession.sparkContext

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            raw, offsets = texts_of(batch, "_text")
            for lo, hi in blocks(offsets):
                yield batch.slice(lo, hi - lo), words_of(raw, offsets[lo : hi + 1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in cut(batches):
            found, n = np.unique(words.hash, return_counts=True)
            if len(found):
                columns = [pa.array(found.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    counted = rows.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "word_counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = total * (rare or SHARED)
    known = counted.where(F.col("n") >= least).toArrow()  # a million rows at most
    words = Vocabulary(
        known.column("word").to_numpy().view(np.uint64), known.column("n").to_numpy(), total
    )
    shared = context.broadcast(words.numbers())
    rarer = counted.where(F.col("n") < least)  # joined; unused if these are one unknown word

    def pairs(words, vocabulary: Vocabulary):
        """Ids of all words and which are to be joined; starts of all pairs."""
        ids = vocabulary.of(words.hash)
        return ids, (ids == 0) & (not rare), inside(words.first, 2)

    def dense_pairs(ids: np.ndarray, lone: np.ndarray, at: np.ndarray) -> np.ndarray:
        short = (ids < FREQUENT) & ~lone
        return short[at] & short[at + 1]

    def count_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.back(shared.value)
        table = np.zeros(FREQUENT * FREQUENT, np.int64)
        for _, words in cut(batches):
            ids, lone, at = pairs(words, vocabulary)
            at = at[dense_pairs(ids, lone, at)]
            table += np.bincount(ids[at] * FREQUENT + ids[at + 1], minlength=len(table))
        at = np.flatnonzero(table)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["pair", "n"])

    dense = rows.mapInArrow(count_frequent, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    dense = dense.toArrow()  # FREQUENT * FREQUENT rows at most
    table = np.zeros(FREQUENT * FREQUENT, np.int64)
    table[dense.column("pair").to_numpy()] = dense.column("n").to_numpy()
    frequent = context.broadcast(table)

    def grouped(*columns: np.ndarray) -> tuple:
        """Distinct rows of columns, and how often each occurs."""
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        spot = np.flatnonzero(new)
        return *[c[spot] for c in columns], np.diff(np.concatenate([spot, [len(order)]]))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pair with a broadcast word of a text, and one (tag -1) with all else."""
        vocabulary, table = Vocabulary.back(shared.value), frequent.value
        for batch, words in cut(batches):
            n = batch.num_rows
            ids, lone, at = pairs(words, vocabulary)
            row, key = words.rows(), words.hash.view(np.int64)
            within = dense_pairs(ids, lone, at)
            a, b = ids[at[within]], ids[at[within] + 1]
            counts = vocabulary.counts
            logs = vocabulary.paired(counts[a], counts[b], table[a * FREQUENT + b])
            sums = _sums(row[at[within]], logs, n)
            begins = words.first[:-1][np.diff(words.first) > 0]
            alone, begins = begins[lone[begins]], begins[~lone[begins]]
            sums[row[begins]] += vocabulary.single(ids[begins])
            at = at[~within & ~(lone[at] & lone[at + 1])]
            first, second = lone[at], lone[at + 1]
            a, b = ids[at], ids[at + 1]
            keys = np.where(first, key[at], np.where(second, key[at + 1], a << _BITS | b))
            tags = np.where(first, b << 2 | FIRST, np.where(second, a << 2 | SECOND, PAIR))
            place, keys, tags, times = grouped(
                np.concatenate([row[at], row[alone]]),
                np.concatenate([keys, key[alone]]),
                np.concatenate([tags, np.full(len(alone), ALONE)]),
            )
            own = batch.column("_row").to_numpy()
            columns = [
                pa.array(np.concatenate([own, own[place]])),
                pa.array(np.concatenate([own, keys])),
                pa.array(np.concatenate([np.full(n, -1), tags])),
                pa.array(np.concatenate([np.diff(words.first), times]).astype(np.int64)),
                pa.array(np.concatenate([sums, np.zeros(len(place))])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "key", "tag", "times", "sum"])

    def explode_rarer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pair of two words that are not broadcast."""
        vocabulary = Vocabulary.back(shared.value)
        for batch, words in cut(batches):
            _, lone, at = pairs(words, vocabulary)
            at = at[lone[at] & lone[at + 1]]
            key = words.hash.view(np.int64)
            place, first, second, times = grouped(words.rows()[at], key[at], key[at + 1])
            own = batch.column("_row").to_numpy()[place]
            columns = [pa.array(c) for c in (own, first, second, times)]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "first", "second", "times"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.back(shared.value)
        counts = vocabulary.counts
        for batch in batches:
            key, tag, times, n = (batch.column(c).to_numpy() for c in ("key", "tag", "times", "n"))
            single = batch.column("single").to_numpy()
            before, own = single.copy(), single.copy()
            at = np.flatnonzero(tag == PAIR)
            before[at], own[at] = counts[key[at] >> _BITS], counts[key[at] & ((1 << _BITS) - 1)]
            at = np.flatnonzero((tag > 0) & (tag & 3 == FIRST))
            own[at] = counts[tag[at] >> 2]
            at = np.flatnonzero((tag > 0) & (tag & 3 == SECOND))
            before[at] = counts[tag[at] >> 2]
            logs, joint = np.zeros(len(tag)), (tag >= 0) & (tag != ALONE)
            logs[joint] = times[joint] * vocabulary.paired(before[joint], own[joint], n[joint])
            at = np.flatnonzero(tag == ALONE)
            logs[at] = times[at] * np.log10(own[at] / vocabulary.total)
            found, at = np.unique(batch.column("_row").to_numpy(), return_inverse=True)
            logs += batch.column("sum").to_numpy()
            size = _sums(at, np.where(tag < 0, times, 0), len(found)).astype(np.int64)
            columns = [pa.array(found), pa.array(_sums(at, logs, len(found))), pa.array(size)]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "sum", "n"])

    # each pair's occurrences meet in the partition of its key, with their count
    exploded = rows.mapInArrow(explode, "_row long, key long, tag long, times long, sum double")
    single = rarer.select(F.col("word").alias("key"), F.col("n").alias("single"))
    exploded = exploded.join(single, "key", "left").withColumns(
        {
            "single": F.coalesce("single", F.lit(0)),
            "n": F.sum("times").over(Window.partitionBy("key", "tag")),
        }
    )
    scored = exploded.mapInArrow(score, "_row long, sum double, n long")
    if not rare:
        first = rarer.select(F.col("word").alias("first"), F.col("n").alias("n_first"))
        second = rarer.select(F.col("word").alias("second"), F.col("n").alias("n_second"))
        more = rows.mapInArrow(explode_rarer, "_row long, first long, second long, times long")
        more = more.join(first, "first").withColumn(
            "n", F.sum("times").over(Window.partitionBy("first", "second"))
        )
        unseen = F.log10(F.lit(BACKOFF)) + F.log10(F.col("n_second") / F.lit(total))
        log = F.when(F.col("n") >= LEAST, F.log10(F.col("n") / F.col("n_first"))).otherwise(unseen)
        more = more.join(second, "second").select("_row", (F.col("times") * log).alias("sum"))
        scored = scored.unionByName(more.withColumn("n", F.lit(0).cast("long")))
    scores = scored.groupBy("_row").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    scores = scores.select("_row", F.when(F.col("n") > 0, F.col("sum") / F.col("n")).alias("score"))
    sizes = docs.select(F.col(f"`{id_col}`").alias("_id"), _row(id_col, text_col), text)
    split = F.array_remove(F.split(F.coalesce("_text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    sizes = sizes.select("_id", "_row", F.size(split).cast("long").alias("n_words"))
    return sizes.join(scores, "_row", "left").select(F.col("_id").alias(id_col), "n_words", "score")
