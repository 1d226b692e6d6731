"""Search for licence texts in documents.

Winnowed fingerprints of the templates form an inverted index.  A document's word runs that hit it
name a template and a diagonal; the words around that diagonal are aligned with the template in a
band, and the best local alignment tells how much of the template is there, and where.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.license_texts import LICENSE_TEXTS
from routeloom.llm.storage import blocks, texts_of
from routeloom.llm.tokens import window_hashes, words_of

#: Words of a fingerprint; of so many neighbours the smallest is kept, so every run of
#: GRAM + NEIGHBOURS - 1 words of a template that a document shares is a hit.
GRAM, NEIGHBOURS = 3, 3
#: Words of templates searched in one pass over the documents; more take further passes.
PASS_WORDS = 500_000
#: Bytes that end words: ASCII but for letters and digits.
_BREAKS = np.ones(256, bool)
_BREAKS[0x30:0x3A] = _BREAKS[0x41:0x5B] = _BREAKS[0x61:0x7B] = _BREAKS[0x80:] = False


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(raw, np.array([0, len(raw)]), _BREAKS, lower=True).hash


class Index:
    """Winnowed fingerprints of templates, sorted, with their templates and places."""

    def __init__(self, templates: list[np.ndarray]):
        self.templates = templates
        found = [
            (fingerprint, t, at)
            for t, words in enumerate(templates)
            for at, fingerprint in self.winnow(words)
        ]
        found.sort()
        self.fingerprint = np.array([f for f, _, _ in found], np.uint64)
        self.template = np.array([t for _, t, _ in found], np.int64)
        self.place = np.array([p for _, _, p in found], np.int64)

    @staticmethod
    def winnow(words: np.ndarray) -> list[tuple[int, int]]:
        if not len(words):
            return []
        grams = window_hashes(words, min(GRAM, len(words))).tolist()
        kept = set()
        for i in range(max(1, len(grams) - NEIGHBOURS + 1)):
            kept.add(min(range(i, min(len(grams), i + NEIGHBOURS)), key=lambda j: (grams[j], -j)))
        return [(at, grams[at]) for at in sorted(kept)]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``grams`` that are in the index, with templates and places there."""
        lo = np.searchsorted(self.fingerprint, grams, "left")
        hi = np.searchsorted(self.fingerprint, grams, "right")
        hit = np.flatnonzero(hi > lo)
        n = (hi - lo)[hit]
        entry = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(hit, n), self.template[entry], self.place[entry]


def band(words: int) -> int:
    """Shift that an alignment may make."""
    return 2 + words // 8


def align(template: list, words: list, low: int, high: int) -> tuple[int, int, int, int, int]:
    """Best local alignment on the diagonals ``low`` to ``high`` (place in words minus template).

    A match counts 1, a difference or gap -1.  Returns the matched words and the spans in the
    template and the words; of equal alignments the one with most matches, ending first.
    """
    nothing = (0, 0, 0, 0)
    best, span = (0, 0), (0, 0, 0, 0)
    before = [nothing] * (high - low + 3)
    for i, own in enumerate(template):
        row = [nothing] * (high - low + 3)
        for at in range(1, high - low + 2):
            j = i + low + at - 1
            if not 0 <= j < len(words):
                continue
            same = own == words[j]
            score, matched, i0, j0 = before[at]
            if not score:
                i0, j0 = i, j
            cell = (score + 1, matched + 1, i0, j0) if same else (score - 1, matched, i0, j0)
            for gap in (before[at + 1], row[at - 1]):
                if gap[0] - 1 > cell[0]:
                    cell = (gap[0] - 1, *gap[1:])
            if cell[0] <= 0:
                continue
            row[at] = cell
            if cell[:2] > best:
                best, span = cell[:2], (cell[2], i + 1, cell[3], j + 1)
        before = row
    return best[1], *span


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = LICENSE_TEXTS,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    coverage: float = 0.8,
) -> DataFrame:
    """A row for each place where at least ``coverage`` of a template's words are found in order.

    Columns: the id, ``license``, ``template`` (its number in the list), ``matched`` (words),
    ``coverage``, the span of words ``start`` to ``end``, and of UTF-8 bytes ``start_byte`` to
    ``end_byte``.  Words are runs of letters and digits, A-Z in lower case.  Of places that overlap,
    of any templates, the one with most matched words stays, then the shorter template.  Every document is searched whole, against all templates.

    Null and empty texts have no rows; repeated rows and rows without an id are searched like
    any others; other columns are left out.
    """
    names = [name for name, _ in templates]
    hashed = [_hashes(text) for _, text in templates]
    passes: list[list[int]] = [[]]
    for number, words in enumerate(hashed):
        if passes[-1] and sum(len(hashed[i]) for i in passes[-1]) + len(words) > PASS_WORDS:
            passes.append([])
        passes[-1].append(number)
    id_field = docs.schema[id_col]
    fields = [("license", T.StringType()), ("template", T.IntegerType()), ("matched", T.LongType())]
    fields += [("coverage", T.DoubleType())]
    fields += [(c, T.LongType()) for c in ("start", "end", "start_byte", "end_byte")]
    schema = T.StructType([id_field, *[T.StructField(n, t) for n, t in fields]])

    def search(numbers: list[int]):
        index = Index([hashed[i] for i in numbers])

        def places(row, words) -> list[tuple]:
            """Alignments in one text: ``(template, matched, start, end)``, best first."""
            first, last = words.first[row], words.first[row + 1]
            own = words.hash[first:last]
            at, template, place = index.hits(window_hashes(own, GRAM))
            if len(own) < GRAM and len(own):  # shorter than a fingerprint
                at, template, place = index.hits(window_hashes(own, len(own)))
            diagonal = at - place
            order = np.lexsort((diagonal, template))
            text = own.tolist()
            found, done = [], (-1, 0)
            for t, d in zip(template[order].tolist(), diagonal[order].tolist(), strict=True):
                if t == done[0] and d <= done[1]:
                    continue  # inside the band that was aligned
                width = band(len(index.templates[t]))
                done = (t, d + width)
                target = index.templates[t].tolist()
                low = max(0, d - width)
                part = text[low : d + len(target) + 2 * width]
                matched, _, _, a, b = align(target, part, d - width - low, d + 2 * width - low)
                if matched >= coverage * len(target) and matched:
                    found.append((t, matched, a + low, b + low))
            found.sort(key=lambda x: (-x[1], len(index.templates[x[0]]), *x[2:], x[0]))
            kept: list[tuple] = []
            for one in found:
                if not any(one[2] < k[3] and k[2] < one[3] for k in kept):
                    kept.append(one)
            return sorted(kept, key=lambda x: (x[2], x[0]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, offsets = texts_of(batch, text_col)
                out: list[tuple] = []
                for lo, hi in blocks(offsets):
                    words = words_of(raw, offsets[lo : hi + 1], _BREAKS, lower=True)
                    rows = words.rows()
                    likely, _, _ = index.hits(window_hashes(words.hash, GRAM))
                    likely = set(np.unique(rows[likely]).tolist())
                    short = np.diff(words.first)
                    likely |= set(np.flatnonzero((short > 0) & (short < GRAM)).tolist())
                    for row in sorted(likely):
                        base = words.first[row]
                        for t, matched, a, b in places(row, words):
                            number = numbers[t]
                            spot = [words.start[base + a], words.end[base + b - 1]]
                            x, y = (int(s - (offsets[lo + row] - offsets[lo])) for s in spot)
                            share = matched / len(hashed[number])
                            out.append((lo + row, names[number], number, matched, share, a, b, x, y))
                if out:
                    at, *columns = zip(*out, strict=True)
                    ids = batch.column(id_col).take(pa.array(at))
                    types = [pa.string(), pa.int32(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids, *arrays], names=schema.names)

        return run

    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias(text_col))
    found = [rows.mapInArrow(search(numbers), schema) for numbers in passes]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
