"""Quality classifier: naive Bayes support vectors.

Indicators of word and byte n-grams, hashed into a fixed number of buckets, are scaled by the
log-count ratio of the two classes; a linear model with hinge loss is fitted to them by dual
coordinate descent, and its margins become probabilities by a logistic curve fitted to rows that
the model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.storage import blocks, replaced, texts_of
from routeloom.llm.tokens import inside, mix, window_hashes, words_of

#: log2 of the number of feature buckets; a model is 2 MB for any input.
BITS = 18
#: Bound of the labelled rows that a model is fitted on, in one task.
TRAIN_ROWS = 10_000
#: One sampled row in so many calibrates the probabilities instead of fitting the weights.
CALIBRATE = 5


def indicators(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """Rows and buckets of the distinct n-grams of each text: words, word pairs, 3 bytes.

    One more indicator tells how much of a text repeats the word before, in powers of two.
    """
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    words = words_of(raw, offsets)
    rows = words.rows()
    mask = np.uint64((1 << bits) - 1)
    pairs = inside(words.first, 2)
    two = window_hashes(words.hash, 2)
    lengths = np.diff(offsets)
    at = inside(offsets, 3)
    data = raw.astype(np.uint64)
    three = data[at] << np.uint64(16) | data[at + 1] << np.uint64(8) | data[at + 2]
    letters = np.repeat(np.arange(len(lengths)), lengths)[at]
    same = np.bincount(
        rows[pairs], weights=words.hash[pairs] == words.hash[pairs + 1], minlength=len(lengths)
    )
    share = same / np.maximum(1, np.diff(words.first))
    level = np.where(share > 0, np.ceil(-np.log2(np.maximum(share, 2.0**-20))), 99).astype(np.uint64)
    found = [
        (rows, mix(words.hash + np.uint64(1))),
        (rows[pairs], two[pairs] if len(two) else two),
        (letters, mix(three)),
        (np.arange(len(lengths)), mix(level + (np.uint64(1) << np.uint64(40)))),
    ]
    keys = np.concatenate(
        [np.asarray(r).astype(np.int64) << bits | (h & mask).astype(np.int64) for r, h in found]
    )
    keys = np.unique(keys)
    return keys >> bits, keys & ((1 << bits) - 1)


@dataclass
class Model:
    """Log-count ratios, weights (the last is the bias) and the logistic curve of the margins."""

    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def margins(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        r = self.ratios[buckets]
        total = np.bincount(rows, weights=r * self.weights[buckets], minlength=n)
        length = np.sqrt(np.bincount(rows, weights=r * r, minlength=n))
        return total / np.maximum(length, 1e-9) + self.weights[-1]

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _descend(sets: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, cost: float, rounds: int):
    """Dual coordinate descent for the hinge loss; one coordinate, one document."""
    weights = np.zeros(len(ratios) + 1)
    values = []
    for s in sets:
        r = ratios[s]
        values.append(r / max(np.sqrt(r @ r), 1e-9))
    diagonal = np.array([v @ v + 1 for v in values])
    alpha = np.zeros(len(sets))
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(sets)):
            s, v = sets[i], values[i]
            slope = y[i] * (weights[s] @ v + weights[-1]) - 1
            new = min(max(alpha[i] - slope / diagonal[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                alpha[i] = new
                weights[s] += step * y[i] * v
                weights[-1] += step * y[i]
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weights


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Newton steps for the curve from margins to probabilities, with smoothed targets."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(
    sets: list[np.ndarray], labels: np.ndarray, bits: int, cost: float = 1.0, rounds: int = 30
) -> Model:
    """Fit to the bucket sets of labelled documents; with one class, its smoothed share."""
    n = 1 << bits
    labels = np.asarray(labels, float)
    check = np.arange(len(sets)) % CALIBRATE == CALIBRATE - 1
    use = np.flatnonzero(~check)
    if len(sets) == 0 or labels[use].min() == labels[use].max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(n), np.zeros(n + 1), 1.0, float(np.log(share / (1 - share))))
    counts = []
    for label in (1, 0):
        members = [sets[i] for i in use if labels[i] == label]
        counts.append(1 + np.bincount(np.concatenate(members), minlength=n))
    ratios = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    y = np.where(labels[use] > 0, 1.0, -1.0)
    weights = _descend([sets[i] for i in use], y, ratios, cost, rounds)
    model = Model(ratios, weights, 1.0, 0.0)
    seen = np.flatnonzero(check) if check.any() else use
    rows = np.repeat(np.arange(len(seen)), [len(sets[i]) for i in seen])
    margins = model.margins(rows, np.concatenate([sets[i] for i in seen]), len(seen))
    model.slope, model.shift = _logistic(margins, labels[seen])
    return model


def held_out(id_col: str):
    """True for the quarter of ids that never teach: crc32 of the id as text, modulo 4, is 2."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def fit_documents(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
    bits: int = BITS,
) -> Model:
    """Fit on labelled documents outside the held-out quarter, ``train_rows`` at most.

    The sample is taken by a hash of the id.  Rows without label or id teach nothing; of several
    labels of one id the smallest counts; each text of a repeated id teaches once.
    """
    label = F.col(f"`{label_col}`")
    marked = labels.where(label.isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col))
    sample = (
        marked.groupBy(F.col(f"`{id_col}`").alias("_id"))
        .agg(F.min(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(train_rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    rows = (
        texts.join(F.broadcast(sample), "_id")  # train_rows rows at most
        .groupBy("_id", "_label", F.xxhash64("_text").alias("_hash"))
        .agg(F.first("_text").alias("_text"))
        .orderBy(F.xxhash64("_id"), "_hash")
        .limit(train_rows)
        .select("_label", "_text")
    )

    def train(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        marks: list[int] = []
        for part in parts:
            raw, offsets = texts_of(part, "_text")
            for lo, hi in blocks(offsets):
                found, buckets = indicators(raw, offsets[lo : hi + 1], bits)
                cuts = np.searchsorted(found, np.arange(1, hi - lo))
                sets += [x.astype(np.int32) for x in np.split(buckets, cuts)]
            marks += part.column("_label").to_pylist()
        model = fit(sets, np.array(marks, float), bits)
        row = {
            "ratios": [model.ratios.astype(np.float32).tobytes()],
            "weights": [model.weights.astype(np.float32).tobytes()],
            "slope": [model.slope],
            "shift": [model.shift],
        }
        yield pa.RecordBatch.from_pydict(row)

    schema = "ratios binary, weights binary, slope double, shift double"
    found = rows.coalesce(1).mapInArrow(train, schema).first()
    if found is None:
        return fit([], np.zeros(0), bits)
    numbers = [np.frombuffer(bytes(found[c]), np.float32) for c in ("ratios", "weights")]
    return Model(*(x.astype(float) for x in numbers), found["slope"], found["shift"])


def score_documents(
    docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """All rows and columns with the probability of label 1, from the whole text alone.

    A null or empty text has no n-grams and gets the score of the bias.  An input column with the
    score's name is replaced.  An empty table gives an empty result.
    """
    bits = len(model.ratios).bit_length() - 1
    numbers = (model.ratios, model.weights, model.slope, model.shift)
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    rows = replaced(docs, {score_col: F.lit(0.0)})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            raw, offsets = texts_of(batch, text_col)
            for lo, hi in blocks(offsets):
                found, buckets = indicators(raw, offsets[lo : hi + 1], bits)
                part = batch.slice(lo, hi - lo)
                scores = known.scores(known.margins(found, buckets, hi - lo))
                arrays = [*part.columns[:-1], pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)

    return rows.mapInArrow(score, T.StructType(rows.schema.fields))
