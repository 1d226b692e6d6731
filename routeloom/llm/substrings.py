"""Removal of passages that occur earlier in the documents.

Seed and extend.  Winnowing picks, in every window of ``least`` words, the run of ``seed_words``
words with the smallest hash, so equal windows have equal anchors.  Documents are joined on
anchors that occur again.  From a matched anchor the match is extended to both sides: the windows
around it are the ways to extend it to the length threshold, and each that begins earlier
elsewhere is a match.  Windows are grouped by content, not compared in pairs, so an anchor in very
many documents costs no more than its occurrences.  Matched windows that overlap or touch are one
maximal repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.storage import blocks, texts_of
from routeloom.llm.tokens import Words, inside, window_hashes, words_of

#: Words of an anchor.
SEED_WORDS = 5
_SPANS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end")]))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i:i + width]`` for each ``i``."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """Windows of ``least`` words of a block of texts: row, start in the row, anchor, hashes."""

    def __init__(self, words: Words, least: int, seed_words: int):
        seed_words = min(seed_words, least)
        start = inside(words.first, least)
        self.row = words.rows()[start]
        self.start = start - words.first[self.row]
        self.cuts = np.searchsorted(self.row, np.arange(len(words.first)))
        if not len(start):
            self.anchor = self.hash = np.zeros(0, np.uint64)
            self.more = np.zeros(0, np.int32)
            return
        seeds = window_hashes(words.hash, seed_words, 1)
        self.anchor = sliding_minimum(seeds, least - seed_words + 1)[start]
        self.hash = window_hashes(words.hash, least, 2)[start]
        # 32 further bits, so that even very many windows have different keys
        self.more = (window_hashes(words.hash, least, 3)[start] >> np.uint64(32)).astype(np.uint32)
        self.more = self.more.view(np.int32)

    def of(self, row: int) -> slice:
        return slice(self.cuts[row], self.cuts[row + 1])


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _listed(column: pa.Array, row: int) -> np.ndarray:
    """One row of a column of lists of longs, as unsigned numbers; null is empty."""
    value = column[row].values
    return np.zeros(0, np.uint64) if value is None else value.to_numpy().view(np.uint64)


def remove_repeats(
    docs: DataFrame,
    least: int = 20,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed_words: int = SEED_WORDS,
) -> DataFrame:
    """Remove words in windows of ``least`` words that begin earlier: smaller id, or same row before.

    Returns per row its id, the ``text`` of the kept words joined by one blank (null for a null
    text), ``n_words``, ``n_removed`` and the removed ``repeats`` as spans of words.  Windows are
    judged on the input, not on what is left.  Words are runs without blanks, unchanged.

    Rows that share an id count as one place: they do not remove each other's words.  Rows
    without an id lose nothing and remove nothing.  Other columns are left out.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    named = rows.where(F.col("_id").isNotNull())
    # the first of equal texts stands for all; the others lose every window
    first = (
        named.groupBy(F.md5(F.col("_text").cast("binary")).alias("_print"))
        .agg(F.min("_id").alias("_id"))
        .groupBy("_id")
        .agg(F.lit(True).alias("_first"))
    )
    texts = named.join(first, "_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            raw, offsets = texts_of(batch, "_text")
            for lo, hi in blocks(offsets):
                words = words_of(raw, offsets[lo : hi + 1])
                yield batch.slice(lo, hi - lo), words, Windows(words, least, seed_words)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct anchors of each row; 2 for one with a window that repeats in the row."""
        for batch, _, windows in cut(batches):
            at, anchors, times = [], [], []
            for row in range(batch.num_rows):
                here = windows.of(row)
                anchor, back = np.unique(windows.anchor[here], return_inverse=True)
                _, spot, n = np.unique(windows.hash[here], return_index=True, return_counts=True)
                count = np.ones(len(anchor), np.int64)
                count[back[spot[n > 1]]] = 2
                at.append(np.full(len(anchor), row))
                anchors.append(anchor)
                times.append(count)
            at = np.concatenate(at) if at else np.zeros(0, int)
            if len(at):
                ids = batch.column("_id").take(pa.array(at))
                columns = [_long(np.concatenate(anchors)), ids, pa.array(np.concatenate(times))]
                yield pa.RecordBatch.from_arrays(columns, names=["_seed", "_id", "_n"])

    def candidates(batch: pa.RecordBatch, windows: Windows, row: int) -> np.ndarray:
        here = windows.of(row)
        known = _listed(batch.column("_seeds"), row)
        if not len(known):
            return np.zeros(here.stop - here.start, bool)
        return np.isin(windows.anchor[here], known)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct windows of each row around matched anchors."""
        for batch, _, windows in cut(batches):
            at, spots = [], []
            for row in range(batch.num_rows):
                spot = np.flatnonzero(candidates(batch, windows, row)) + windows.cuts[row]
                _, keep = np.unique(windows.hash[spot], return_index=True)
                spots.append(spot[keep])
                at.append(np.full(len(keep), row))
            spot = np.concatenate(spots) if spots else np.zeros(0, int)
            if len(spot):
                ids = batch.column("_id").take(pa.array(np.concatenate(at)))
                columns = [_long(windows.hash[spot]), pa.array(windows.more[spot]), ids]
                yield pa.RecordBatch.from_arrays(columns, names=["_hash", "_more", "_id"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_id", "_text", "n_words", "n_removed", "repeats"]
        for batch, words, windows in cut(batches):
            sizes = np.diff(words.first)
            first = batch.column("_first").to_pylist()
            kept, removed, repeats = [], [], []
            for row, text in enumerate(batch.column("_text").to_pylist()):
                here, n = windows.of(row), int(sizes[row])
                if first[row]:
                    gone = candidates(batch, windows, row)
                    own, place = np.unique(windows.hash[here], return_index=True)
                    held = np.isin(own, _listed(batch.column("_holds"), row))
                    gone[place[held]] = False
                else:
                    gone = np.ones(here.stop - here.start, bool)
                starts = windows.start[here][gone]
                if not len(starts):
                    kept.append(None if text is None else b" ".join(text.encode().split()).decode())
                    removed.append(0)
                    repeats.append([])
                    continue
                edge = np.bincount(starts, minlength=n + 1) - np.bincount(
                    starts + least, minlength=n + 1
                )
                hit = np.cumsum(edge)[:n] > 0
                change = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
                kept.append(b" ".join(compress(text.encode().split(), (~hit).tolist())).decode())
                removed.append(int(hit.sum()))
                repeats.append(
                    [{"start": a, "end": b} for a, b in change.reshape(-1, 2).tolist()]
                )
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [
                batch.column("_id"),
                pa.array(kept, pa.string()),
                pa.array(sizes.astype(np.int64)),
                pa.array(removed, pa.int64()),
                pa.array(repeats, spans),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def schema(**fields: T.DataType) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])

    def untouched(part: DataFrame) -> DataFrame:
        lists = T.ArrayType(T.LongType())
        none = {c: F.lit(None).cast(lists) for c in ("_seeds", "_holds")}
        return part.select("_id", "_text", F.lit(True).alias("_first"), *[c.alias(n) for n, c in none.items()])

    result = schema(
        _id=id_type, _text=T.StringType(), n_words=T.LongType(), n_removed=T.LongType(), repeats=_SPANS
    )
    found = (
        texts.where("_first")
        .select("_id", "_text")
        .mapInArrow(seeds, schema(_seed=T.LongType(), _id=id_type, _n=T.LongType()))
    )
    again = found.groupBy("_seed").agg(F.sum("_n").alias("_n")).where("_n > 1").select("_seed")
    matched = (
        found.select("_seed", "_id")
        .join(again, "_seed", "left_semi")
        .groupBy("_id")
        .agg(F.collect_list("_seed").alias("_seeds"))
    )
    around = (
        texts.where("_first")
        .join(matched, "_id")
        .select("_id", "_text", "_seeds")
        .mapInArrow(extend, schema(_hash=T.LongType(), _more=T.IntegerType(), _id=id_type))
    )
    holders = (
        around.groupBy("_hash", "_more")
        .agg(F.min("_id").alias("_id"))
        .groupBy("_id")
        .agg(F.collect_list("_hash").alias("_holds"))
    )
    joined = texts.join(matched, "_id", "left").join(holders, "_id", "left")
    columns = ["_id", "_text", "_first", "_seeds", "_holds"]
    out = joined.select(*columns).mapInArrow(remove, result)
    rest = untouched(rows.where(F.col("_id").isNull())).mapInArrow(remove, result)
    return (
        out.unionByName(rest)
        .withColumnRenamed("_id", id_col)
        .withColumnRenamed("_text", text_col)
    )
