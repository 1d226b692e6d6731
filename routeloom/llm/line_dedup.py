"""Removal of lines that occur in several documents.

Two Bloom filters, for line keys seen at least once and at least twice, are filled by every task
and merged.  Only lines that the second filter suspects are shuffled, as 128-bit digests, for the
exact count of documents and the choice of the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.storage import replaced

#: Bits per line, bits set per key, and the bound of a filter (32 MB), which is broadcast.
#: Beyond the bound more lines are suspected and shuffled; the result stays exact.
LINE_BITS, KEY_BITS, MAX_BITS = 8, 4, 1 << 28
#: Bytes of a merged piece of a filter.
_PIECE = 1 << 18
_EDGE = b" \t\n\x0b\x0c\r"


def line_keys(text: str, least: int) -> list[bytes | None]:
    """A key per line: stripped, A-Z in lower case; None if shorter than ``least`` characters."""
    keys: list[bytes | None] = []
    for line in text.encode().lower().split(b"\n"):
        key = line.strip(_EDGE)
        long = len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)
        keys.append(key if long else None)
    return keys


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key in a filter of ``bits`` bits, a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(KEY_BITS, dtype=np.uint64)
    return (hashes[:, None] + turns * step[:, None]) & np.uint64(bits - 1)


def _has(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    found = words[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & np.uint8(1)
    return found.astype(bool).all(axis=1)


def _put(words: np.ndarray, places: np.ndarray) -> None:
    bit = np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)
    np.bitwise_or.at(words, (places >> np.uint64(3)).ravel(), bit.ravel())


def twice_seen(docs: DataFrame, text_col: str, least: int, max_bits: int = MAX_BITS) -> bytes:
    """A Bloom filter with every key of two or more rows of ``docs``.

    Its size follows the number of lines up to ``max_bits``, so at most that many bits reach the
    driver.  Tasks are joined to a few per core, and each sends its filters once, compressed.
    """
    text = F.col(f"`{text_col}`")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    total = docs.agg(F.sum(lines)).first()[0] or 1
    bits = max(1 << 13, min(max_bits, 1 << int(LINE_BITS * total).bit_length()))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                hashes: list[int] = []
                for text in batch.column(0).slice(at, 1000).to_pylist():
                    keys = {k for k in line_keys(text or "", least) if k is not None}
                    hashes.extend(map(xxhash.xxh3_64_intdigest, keys))
                found, n = np.unique(np.array(hashes, np.uint64), return_counts=True)
                places = _places(found, bits)
                _put(twice, places[(n > 1) | _has(once, places)])
                _put(once, places)
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = [
            (i, pack(once[i : i + _PIECE].tobytes()), pack(twice[i : i + _PIECE].tobytes()))
            for i in range(0, bits // 8, _PIECE)
            if once[i : i + _PIECE].any()
        ]
        if rows:
            names, columns = ["piece", "once", "twice"], list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_pydict(dict(zip(names, columns, strict=True)))

    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Bits set in the first filters of two tasks count as seen twice."""
        unpack = zstandard.ZstdDecompressor().decompress
        once = twice = np.zeros(1, np.uint8)
        for part in parts:
            for a, b in zip(part["once"], part["twice"], strict=True):
                seen = np.frombuffer(unpack(a), np.uint8)
                twice = twice | np.frombuffer(unpack(b), np.uint8) | (once & seen)
                once = once | seen
        yield pd.DataFrame({"piece": [key[0]], "twice": [twice.tobytes()]})

    session = docs.sparkSession.sparkContext
    few = docs.select(text).coalesce(2 * session.defaultParallelism)
    filters = few.mapInArrow(fill, "piece long, once binary, twice binary")
    out = bytearray(bits // 8)
    for row in filters.groupBy("piece").applyInPandas(merge, "piece long, twice binary").collect():
        out[row["piece"] : row["piece"] + len(row["twice"])] = row["twice"]
    return bytes(out)


def drop_repeated_lines(
    docs: DataFrame,
    least: int = 10,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Keep lines found in several documents only in the document with the smallest id.

    A line's key is the line without blanks at both ends, A-Z in lower case; keys of at least
    ``least`` characters count.  All lines of a key stay in the first document.  Returns all
    columns, the text without the dropped lines, and ``n_lines`` (before) and ``n_dropped``;
    input columns of these names are replaced.

    A null text stays null and counts as one empty line.  Rows that share an id count as one
    document.  Rows without an id are returned whole and make no line repeated.  An empty table
    gives an empty result.
    """
    named = docs.where(F.col(f"`{id_col}`").isNotNull())
    words = twice_seen(named, text_col, least, max_bits)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def suspected(text: str) -> list[bytes | None]:
        """A digest for each line that may be repeated, None for the others."""
        keys = line_keys(text, least)
        at = [i for i, k in enumerate(keys) if k is not None]
        out: list[bytes | None] = [None] * len(keys)
        if at:
            hashes = np.array([xxhash.xxh3_64_intdigest(keys[i]) for i in at], np.uint64)
            bits = 8 * len(shared.value)
            hit = _has(np.frombuffer(shared.value, np.uint8), _places(hashes, bits))
            for i, yes in zip(at, hit, strict=True):
                if yes:
                    out[i] = xxhash.xxh3_128_digest(keys[i])
        return out

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, digests = [], []
                for key, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    found = {d for d in suspected(text or "") if d}
                    ids += [key] * len(found)
                    digests += found
                if ids:
                    columns = [pa.array(ids, part.schema.field(0).type), pa.array(digests)]
                    yield pa.RecordBatch.from_arrays(columns, names=["_id", "_digest"])

    two = named.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    pairs = T.StructType(
        [T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_digest", T.BinaryType())]
    )
    first = two.mapInArrow(emit, pairs).groupBy("_digest").agg(F.min("_id").alias("_first"))
    holds = first.groupBy("_first").agg(F.collect_list("_digest").alias("_keep"))
    joined = docs.join(holds, docs[f"`{id_col}`"] == holds["_first"], "left")
    new = replaced(
        joined.drop("_first"),
        {"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")},
    )
    order = [c for c in new.columns if c != "_keep"]
    schema = T.StructType([new.schema[c] for c in order])
    spot = order.index(text_col)
    owner = order.index(id_col)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = batch.select(order)
                texts, n_lines, n_dropped = [], [], []
                for key, text, keep in zip(
                    rows.column(owner).to_pylist(),
                    rows.column(spot).to_pylist(),
                    batch.column("_keep").to_pylist(),
                    strict=True,
                ):
                    lines, dropped = (text or "").split("\n"), 0
                    if text is not None and key is not None:
                        held = set(keep or ())
                        kept = [
                            line
                            for line, d in zip(lines, suspected(text), strict=True)
                            if d is None or d in held
                        ]
                        dropped = len(lines) - len(kept)
                        text = "\n".join(kept) if dropped else text
                    texts.append(text)
                    n_lines.append(len(lines))
                    n_dropped.append(dropped)
                arrays = rows.columns
                arrays[spot] = pa.array(texts, rows.schema.field(spot).type)
                arrays[-2:] = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=order)

    return new.mapInArrow(rewrite, schema)

