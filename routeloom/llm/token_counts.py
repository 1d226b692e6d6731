"""Token counts by rank-synchronous merging of ragged arrays.

Pre-tokens of many texts lie behind one another in one array of symbols.  In each round every
sequence applies its pair of lowest rank at all its places at once, until no sequence has a pair
that merges; then the surviving symbols are counted.  The counts equal those of the sentencepiece
library for byte-pair models with byte fallback.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.storage import replaced

#: Pre-tokens whose counts a worker remembers.
MEMORY_WORDS = 600_000
#: Characters merged at a time (or one pre-token).
BLOCK_CHARS = 1 << 20
#: Texts handled at a time.
TEXTS = 1000

#: Fixed values of the format: the blank's sign, types of pieces.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

_NONE = np.iinfo(np.int32).max


def _leftmost_first(n: int, sizes: set[int]) -> int:
    """Pieces left of ``n`` equal signs, where the leftmost pair of a known size always merges."""
    parts, at = [1] * n, 0
    while at + 1 < len(parts):
        if parts[at] + parts[at + 1] in sizes:
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            at = max(at - 1, 0)
        else:
            at += 1
    return len(parts)


class PieceCounter:
    """Counts tokens of strings as a sentencepiece byte-pair model gives them.

    Raises ValueError for models of another kind: without byte fallback, with a normaliser that
    changes characters or drops blanks, or with pieces defined by the user.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model

        spec = model.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        trainer, norm = spec.trainer_spec, spec.normalizer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback:
            raise ValueError("the model must be a byte-pair model with byte fallback")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("the model must leave characters and blanks as they are")
        if trainer.treat_whitespace_as_suffix or not norm.escape_whitespaces:
            raise ValueError("the model must write blanks as a sign before the word")
        if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in spec.pieces):
            raise ValueError("the model has pieces defined by the user or not in use")
        self.prefix = norm.add_dummy_prefix
        scores = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self._blank_runs(scores)
        self._tables(scores)
        self.newline = self._split_at_newlines(scores)
        self.known: dict[str, int] = {}

    def _blank_runs(self, scores: dict[str, float]) -> None:
        """Pieces of blanks alone that tie for the worst score are left to a formula.

        Leftmost pairs win ties, so a run of blanks that nothing else took fills the longest piece
        from the left, again and again.  Other models' runs of blanks merge like any piece.
        """
        runs = {p for p in scores if len(p) > 1 and set(p) == {BLANK}}
        sizes = {1, *map(len, runs)}
        others = [s for p, s in scores.items() if len(p) > 1 and p not in runs]
        mixed = any(BLANK * 2 in p for p in scores if p not in runs)
        worst = len({scores[p] for p in runs}) == 1 and all(scores[p] < s for p in runs for s in others)
        self.run, self.run_tokens = 1, np.zeros(0, np.int64)
        if mixed or not worst:
            return
        longest = max(sizes)
        tokens = [_leftmost_first(n, sizes) for n in range(4 * longest)]
        if all(b == a + 1 for a, b in zip(tokens, tokens[longest:], strict=False)):
            self.run, self.run_tokens = longest, np.array(tokens[:longest], np.int64)
            for p in runs:
                del scores[p]

    def _tables(self, scores: dict[str, float]) -> None:
        symbols = sorted({c for p in scores for c in p} | {BLANK})
        chars = {c: i for i, c in enumerate(symbols)}
        symbols += sorted(p for p in scores if len(p) > 1)
        number = {p: i for i, p in enumerate(symbols)}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.size = len(symbols)
        self.blank = number[BLANK]
        self.chars = np.array([ord(c) for c in chars], np.int64)
        self.weight = np.array([1 if s in scores else len(s.encode()) for s in symbols], np.int64)
        self.rank = np.array([order[scores[s]] if s in scores else -1 for s in symbols], np.int32)
        pairs, beside = {}, set()
        for piece in scores:
            beside.update(zip(piece, piece[1:], strict=False))
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = number[piece]
        if self.run > 1:
            beside.add((BLANK, BLANK))
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        self.beside = np.array(sorted(chars[a] * self.size + chars[b] for a, b in beside), np.int64)
        # a merge into one of these can make a pair that goes before the rest of its own rank
        self.risky = np.zeros(self.size, bool)
        for part in (self.keys // self.size, self.keys % self.size):
            self.risky[part[self.rank[self.made] <= self.rank[part]]] = True

    def _split_at_newlines(self, scores: dict[str, float]) -> int | None:
        """Tokens of a newline, where no piece holds one beside other characters."""
        return None if any("\n" in p for p in scores if len(p) > 1) else 1

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece made of each pair, or -1."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int32)
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], np.int32(-1))

    def _ranks(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], np.int32(_NONE))

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each string, without a sign before the first; blanks may be written as blanks."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        points[points == 0x20] = ord(BLANK)
        word = np.repeat(np.arange(len(words)), lengths)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        known = self.chars[at] == points
        # characters in no piece: their UTF-8 bytes
        other = points[~known]
        size = 1 + (other >= 0x80) + (other >= 0x800) + (other >= 0x10000)
        total = np.bincount(word[~known], size, len(words)).astype(np.int64)
        joined = np.zeros(len(points), bool)  # with the character before
        if len(points) > 1 and len(self.beside):
            key = at[:-1] * self.size + at[1:]
            place = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
            joined[1:] = (self.beside[place] == key) & known[:-1] & known[1:]
            joined[1:] &= word[:-1] == word[1:]
        sequence = np.cumsum(~joined)[known]
        self._merge(at[known].astype(np.int32), sequence, word[known], total)
        return total

    def _merge(
        self, symbols: np.ndarray, sequence: np.ndarray, word: np.ndarray, total: np.ndarray
    ) -> None:
        """Merge all sequences to the end and add their survivors to the words' totals."""
        made = np.full(len(symbols), -1, np.int32)  # of a symbol and the next one
        if len(symbols) > 1:
            made[:-1] = self._merged(symbols[:-1], symbols[1:])
            made[:-1][sequence[:-1] != sequence[1:]] = -1
        while len(symbols):
            rank = self._ranks(made)
            starts = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            live = lowest < _NONE
            if not live.all():
                self._survivors(symbols[~live], sequence[~live], word[~live], total)
                symbols, sequence, word = symbols[live], sequence[live], word[live]
                made, rank, lowest = made[live], rank[live], lowest[live]
                if not len(symbols):
                    return
            hits = self._first_of_runs(np.flatnonzero(rank == lowest))
            hits = self._safe(hits, symbols, sequence, made, rank)
            symbols[hits] = made[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            place = np.cumsum(keep) - 1
            symbols, sequence, word, made = symbols[keep], sequence[keep], word[keep], made[keep]
            self._renew(made, symbols, sequence, place[hits])

    @staticmethod
    def _first_of_runs(hits: np.ndarray) -> np.ndarray:
        """Every other place of adjacent ones, from the left, so that no symbol merges twice."""
        opens = np.r_[True, np.diff(hits) > 1]
        run = np.maximum.accumulate(np.where(opens, np.arange(len(hits)), 0))
        return hits[(np.arange(len(hits)) - run) % 2 == 0]

    def _safe(
        self,
        hits: np.ndarray,
        symbols: np.ndarray,
        sequence: np.ndarray,
        made: np.ndarray,
        rank: np.ndarray,
    ) -> np.ndarray:
        """The places up to the first whose merge makes a pair that would go next.

        The library merges one place after another.  All places of a rank may be merged at once
        only while no new pair, seen at that moment, has that rank or a lower one.
        """
        new = made[hits]
        doubt = np.flatnonzero(self.risky[new])
        if not len(doubt):
            return hits
        at, piece, mine = hits[doubt], new[doubt], rank[hits[doubt]]
        bad = np.zeros(len(hits), bool)
        after = np.minimum(at + 2, len(symbols) - 1)
        right = (at + 2 < len(symbols)) & (sequence[after] == sequence[at])
        found = self._ranks(self._merged(piece, symbols[after]))
        bad[doubt] = right & (found <= mine)
        before = np.maximum(at - 1, 0)
        left = (at > 0) & (sequence[before] == sequence[at])
        previous = np.maximum(doubt - 1, 0)
        adjacent = (doubt > 0) & (hits[previous] == at - 2)
        other = np.where(adjacent, new[previous], symbols[before])
        found = self._ranks(self._merged(other, piece))
        bad[doubt] |= left & (found <= mine)
        if not bad.any():
            return hits
        earlier = np.cumsum(bad) - bad
        opens = np.r_[True, sequence[hits][1:] != sequence[hits][:-1]]
        base = np.maximum.accumulate(np.where(opens, earlier, 0))
        return hits[earlier == base]

    def _renew(
        self, made: np.ndarray, symbols: np.ndarray, sequence: np.ndarray, at: np.ndarray
    ) -> None:
        """Look up the pairs before and behind the symbols at ``at``."""
        for left in (at[at > 0] - 1, at):
            right = np.minimum(left + 1, len(symbols) - 1)
            inside = (left + 1 < len(symbols)) & (sequence[left] == sequence[right])
            found = self._merged(symbols[left], symbols[right])
            made[left] = np.where(inside, found, np.int32(-1))

    def _survivors(
        self, symbols: np.ndarray, sequence: np.ndarray, word: np.ndarray, total: np.ndarray
    ) -> None:
        weight = self.weight[symbols]
        if self.run > 1:  # blanks in a row are one piece up to the longest
            blank = symbols == self.blank
            follows = np.zeros(len(symbols), bool)
            follows[1:] = blank[1:] & blank[:-1] & (sequence[1:] == sequence[:-1])
            first = np.flatnonzero(blank & ~follows)
            length = np.diff(np.r_[np.flatnonzero(~follows), len(symbols)])[blank[~follows]]
            weight = np.where(blank, 0, weight)
            weight[first] = length // self.run + self.run_tokens[length % self.run]
        np.add.at(total, word, weight)

    def _learn(self, words: list[str]) -> None:
        lo = held = 0
        for hi, w in enumerate(words, 1):
            held += len(w)
            if held >= BLOCK_CHARS or hi == len(words):
                part = words[lo:hi]
                self.known.update(zip(part, self.count(part).tolist(), strict=True))
                lo, held = hi, 0

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text: a word with the blanks before it; newlines are left out."""
        if self.prefix:
            text = " " + text
        if self.newline is None:
            return _RUNS.findall(text)
        if "  " in text or BLANK in text:
            return _LINES.findall(text)
        return text.replace(" ", "\n ").split("\n")

    def __call__(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [self.split(t) if t else [] for t in texts]
        words = set().union(*split) - self.known.keys()
        if len(self.known) + len(words) > MEMORY_WORDS:
            self.known = {}
            words = set().union(*split)
        self._learn(sorted(words))
        get = self.known.__getitem__
        lines = self.newline or 0
        return [
            sum(map(get, parts)) + lines * t.count("\n")
            for t, parts in zip(texts, split, strict=True)
        ]


#: Words with the blanks before them, or blanks alone.
_RUNS = re.compile(f"[ {BLANK}]*[^ {BLANK}]+|[ {BLANK}]+")
_LINES = re.compile(f"[ {BLANK}]*[^ {BLANK}\n]+|[ {BLANK}]+")


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 4096, *, text_col: str = "text"
) -> DataFrame:
    """All columns and ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``tokenizer`` is the path of a sentencepiece byte-pair model, which every executor reads.
    Counts are those of the library without begin and end tokens; strings of special tokens
    inside a text are ordinary text.  Rows stay where they are: nothing is shuffled, and a lost
    task is simply run again.

    A null or empty text has no bytes and no tokens.  Repeated rows are counted each; an input
    column with a new column's name is replaced.  An empty table gives no rows.
    """
    text = F.col(f"`{text_col}`")
    ready = replaced(
        docs,
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
            "n_tokens": F.lit(0).cast("long"),
            "over_limit": F.lit(False),
            "_count_this": text,  # last, as the text itself may have a new column's name
        },
    )
    fields = ready.schema.fields[:-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                texts = ["" if t is None else t for t in batch.column(len(fields)).to_pylist()]
                tokens = counter(texts)
                columns = batch.columns[: len(fields)]
                columns[-2] = pa.array(tokens, pa.int64())
                columns[-1] = pa.array([n > limit for n in tokens], pa.bool_())
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return ready.mapInArrow(count, T.StructType(fields))
