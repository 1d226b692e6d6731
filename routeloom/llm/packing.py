"""Packing of token sequences by minimum bin slack.

Documents are cut into full windows and a rest shorter than a window.  For each further window a
subset-sum over the multiset of remaining lengths, kept as the bits of one integer, finds the
selection that comes closest to the capacity; walking back through the stages gives the number
taken of each length.  The selection is repeated as long as the multiset allows.
"""

from __future__ import annotations

import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Tokens of rests that a task holds back to choose from.
POOL_TOKENS = 1 << 22
#: Words whose tokens a worker remembers.
MEMORY_WORDS = 600_000
#: Bytes of token ids per output batch.
_OUT_BYTES = 8 << 20


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many to take of each length so that their sum is as close to ``capacity`` as can be.

    ``counts`` has the number of pieces of each length.  The longest piece is always taken; ties
    go to selections with longer pieces.
    """
    lengths = sorted((x for x, n in counts.items() if n), reverse=True)
    top = lengths[0]
    room = capacity - top
    mask = (1 << room + 1) - 1
    stages, reach = [], 1
    for length in lengths:
        left = min(counts[length] - (length == top), room // length)
        if left <= 0:
            continue
        stages.append((length, left, reach))
        step = 1
        while left:  # 1, 2, 4, ... pieces at once
            take = min(step, left)
            reach |= reach << take * length & mask
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken = {top: 1}
    for length, _, before in reversed(stages):
        used = 0
        while not before >> total & 1:
            total -= length
            used += 1
        if used:
            taken[length] = taken.get(length, 0) + used
    return taken


class Packer:
    """Collects rests and fills windows; yields ``(piece, sequence, offset)``."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence, self.total = capacity, first_sequence, 0
        self.pool: dict[int, list] = defaultdict(list)

    def whole(self, piece: tuple) -> tuple:
        """A piece that fills a window by itself."""
        self.sequence += 1
        return piece, self.sequence - 1, 0

    def add(self, piece: tuple) -> None:
        self.pool[len(piece[2]) // 4].append(piece)
        self.total += len(piece[2]) // 4

    def fill(self, leave: int) -> Iterator[tuple]:
        """Fill windows while more than ``leave`` tokens are held; if none fits, a cut piece closes."""
        while self.total > leave and self.total >= self.capacity:
            counts = {x: len(p) for x, p in self.pool.items() if p}
            taken = best_fill(counts, self.capacity)
            filled = sum(x * n for x, n in taken.items())
            gap = self.capacity - filled  # all other pieces are longer, else one were taken
            for _ in range(1 if gap else min(counts[x] // n for x, n in taken.items())):
                at = 0
                for length, n in taken.items():
                    for _ in range(n):
                        yield self.pool[length].pop(), self.sequence, at
                        at += length
                self.total -= filled
                if gap:
                    length = max(x for x, p in self.pool.items() if p)
                    ref, start, ids = self.pool[length].pop()
                    self.total -= length
                    yield (ref, start, ids[: 4 * gap]), self.sequence, at
                    self.add((ref, start + gap, ids[4 * gap :]))
                self.sequence += 1
                if self.total <= leave:
                    break

    def finish(self) -> Iterator[tuple]:
        """Fill windows to the end; what fits nowhere is cut at window ends.

        The last tokens, fewer than a window, go to sequences whose lengths are powers of two,
        which need no padding.
        """
        yield from self.fill(0)
        rest, self.pool = [p for x in sorted(self.pool, reverse=True) for p in self.pool[x]], {}
        room = at = 0
        for ref, start, ids in rest:
            while ids:
                if not room:
                    at, room = 0, min(self.capacity, 1 << self.total.bit_length() - 1)
                    self.sequence += 1
                n = min(room, len(ids) // 4)
                yield (ref, start, ids[: 4 * n]), self.sequence - 1, at
                start, ids, at, room = start + n, ids[4 * n :], at + n, room - n
                self.total -= n


class WordTokens:
    """Token ids of texts as little-endian 32-bit numbers, remembered word by word.

    For tokenizers that drop white space and keep letters apart from other signs before they
    merge bytes: cutting at blanks and line ends, and between Latin letters and the ASCII signs
    that end a word, then keeps all ids.  Lower-case letters go straight to the merges, if probes
    show that this gives the same ids, in upper case too; everything else takes the tokenizer's
    whole way.
    """

    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!?;:|%&*#$]*)")
    PROBES = (
        "a of the word shening zqxjk internationalization \u00e9t\u00e9 \u00f1a\u00fffo \u00df "
        "A The WORD Hello World iPhone \u00c9t\u00e9 \u00d1A"
    ).split()

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.blank = [t.content for t in added if " " in t.content or "\n" in t.content]
        # byte-level vocabularies write blanks, controls and 0xAD as the characters from 256 on
        moved = [b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173]
        self.written = {b: 256 + i for i, b in enumerate(moved)}
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.straight = all(self._whole([w])[0] == self._letters(w.lower()) for w in self.PROBES)

    def _whole(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [_bytes(e.ids) for e in found]

    def _letters(self, word: str) -> bytes:
        written = word.encode().decode("latin-1").translate(self.written)
        return _bytes([t.id for t in self.model.tokenize(written)])

    def _learn(self, words: set[str]) -> None:
        if len(self.parts) > MEMORY_WORDS:
            self.parts = {}
        parts, cut, new = self.parts, {}, []
        for w in words:
            found = self.PLAIN.fullmatch(w) if self.straight else None
            if found is None:
                new.append(w)
                continue
            letters, signs = found[1].lower(), found[2]
            if letters not in parts:
                parts[letters] = self._letters(letters)
            if signs not in parts:
                parts[signs] = self._whole([signs])[0]
            cut[w] = parts[letters] + parts[signs]
        self.known.update(cut)
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            self.known.update(zip(part, self._whole(part), strict=True))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > MEMORY_WORDS // 2:
            self.known = {}
        get = self.known.__getitem__
        for text in texts:
            if any(s in text for s in self.blank):
                words = [text]  # cutting at blanks would break such a special token
            else:
                words = text.replace("\n", " ").split(" ")
            try:
                yield b"".join(map(get, words))
            except KeyError:  # most texts have no new words
                self._learn(set(words).difference(self.known))
                yield b"".join(map(get, words))


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """Tokenize all texts and pack them into sequences of at most ``capacity`` tokens.

    ``tokenizer`` is the path of a ``tokenizers`` file that drops white space; ``end_id`` ends
    every document.  ``capacity`` must be a power of two.  One row per piece: the id,
    ``start`` (its document's tokens before it), ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``.  Every partition is packed by
    itself, so nothing is shuffled and a lost task is simply run again; sequence ids hold the
    partition's number in their high bits.  Pieces of one document may be in several sequences.

    A null or empty text gives just the ending id.  Repeated rows and null ids are packed like
    any others; other columns are left out.  An empty table gives no rows.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    id_field = docs.schema[id_col]
    schema = T.StructType(
        [id_field]
        + [T.StructField(n, T.LongType()) for n in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        out: list[tuple] = []
        held = 0
        end = end_id.to_bytes(4, "little")
        width = 4 * capacity
        id_type = None

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        def put(placed: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal out, held
            for ((ref, n), start, ids), sequence, at in placed:
                out.append((ref, start, len(ids) // 4, ids, n, sequence, at))
                held += len(ids) + 64
                if held > _OUT_BYTES:
                    yield batch()
                    out, held = [], 0

        def pieces(part: pa.RecordBatch) -> Iterator[tuple]:
            refs = part.column(0).to_pylist()
            texts = ["" if x is None else x for x in part.column(1).to_pylist()]
            for ref, ids in zip(refs, tokens(texts), strict=True):
                ids += end
                n = len(ids) // 4
                full = len(ids) // width * width
                for at in range(0, full, width):
                    yield packer.whole(((ref, n), at // 4, ids[at : at + width]))
                if full < len(ids):
                    packer.add(((ref, n), full // 4, ids[full:]))
                if packer.total > pool_tokens:
                    yield from packer.fill(pool_tokens // 2)

        for whole in batches:
            id_type = whole.schema.field(0).type
            for at in range(0, whole.num_rows, 1000):
                yield from put(pieces(whole.slice(at, 1000)))
        yield from put(packer.finish())
        if out:
            yield batch()

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(pack, schema)
