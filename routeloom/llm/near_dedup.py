"""Groups of near-duplicate documents, by SetSketch registers.

Every shingle fires at random times at random registers; a register keeps the earliest time, on
an exponential scale.  Such truncated minima merge by taking the larger register, and two sets
agree in a register about as often as the sets overlap, so equal bands of registers name
candidates.  The registers and sizes of a candidate pair give a likelihood for each similarity;
pairs for which the threshold is out of the question are dropped, all others are verified on the
full sets.

Documents with equal sets are one node from the start.  In a bucket of equal bands, members are
first compared with one centre only.  In a bucket that still holds several components, each member
is then compared with its nearest one in another component, by the registers.  Last, the members
with any likely partner in another component, by finer registers too, meet again with their full
sets; only links that join components leave a bucket, so its rows do not grow with its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.storage import blocks, stored, texts_of
from routeloom.llm.tokens import inside, mix, window_hashes, words_of

REGISTERS, BAND = 128, 4
#: Base of the scale, and the rate that keeps registers of small sets above 0.
BASE, RATE = 1.001, 20.0
#: Expected times per register that are tried first; registers left empty are tried again.
_REACH = 10.0
#: Members of a bucket per block.
BLOCK = 1000
#: Shingles of a bucket's full sets per block.
SHINGLES = 1 << 19
#: Pairs whose likelihoods a task takes at a time.
PAIRS = 4096
#: A pair is dropped if the threshold is less likely than the best similarity by exp(-16).
UNLIKELY = 16.0
#: Registers of the finer sketches that tell apart the members of crowded buckets; of each its low
#: byte.
FINE = 1024


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct shingles of ``size`` words, A-Z in lower case, sorted.

    A text of fewer words, but not none, has its whole sequence as its one shingle.
    """
    words = words_of(raw, offsets, lower=True)
    n = np.diff(words.first)
    hashes = window_hashes(words.hash, size)
    rows, found = [], []
    start = inside(words.first, size)
    owner = words.rows()[start]
    cuts = np.searchsorted(owner, np.arange(len(n) + 1))
    for row in range(len(n)):
        if n[row] >= size:
            own = np.unique(hashes[start[cuts[row] : cuts[row + 1]]])
        elif n[row]:
            part = words.hash[words.first[row] : words.first[row + 1]]
            own = mix(window_hashes(part, int(n[row])) + np.uint64(n[row]))
        else:
            continue
        found.append(own)
        rows.append(np.full(len(own), row))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(found)


def sketch(rows: np.ndarray, hashes: np.ndarray, n_rows: int, m: int = REGISTERS) -> np.ndarray:
    """Registers (uint16) of each row's set; an empty set has zeros.

    A shingle's times are a Poisson process of rate ``m``, each time at a random register, so a
    register's first times are exponential and independent.  Only times that can be first are
    drawn, about ``m`` for a set of any size.
    """
    size = np.bincount(rows, minlength=n_rows)
    first = np.full(n_rows * m, np.inf)
    todo, reach = size > 0, _REACH
    while todo.any():
        use = todo[rows]
        row, h = rows[use], hashes[use]
        limit = reach / size[row]
        time = np.zeros(len(row))
        turn = 0
        while len(row):
            turn += 1
            draw = mix(h + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((draw >> np.uint64(11)) + 0.5) * 2.0**-53) / m
            keep = time <= limit
            row, h, time, limit, draw = row[keep], h[keep], time[keep], limit[keep], draw[keep]
            np.minimum.at(first, row * m + (draw & np.uint64(m - 1)).astype(np.int64), time)
        todo &= np.isinf(first).reshape(n_rows, m).any(axis=1)
        reach *= 3
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(first / RATE) / np.log(BASE))
    return np.clip(level, 0, 65535).astype(np.uint16).reshape(n_rows, m)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of four registers."""
    bands = np.ascontiguousarray(registers).view(np.uint64)
    return mix(bands + mix(np.arange(bands.shape[1], dtype=np.uint64) + np.uint64(1)))


def low_bytes(registers: np.ndarray) -> np.ndarray:
    """The low byte of each register; different registers share it once in 256 times."""
    return (registers & 0xFF).astype(np.uint8)


def may_reach_finely(a, b, n_a, n_b, threshold: float) -> np.ndarray:
    """As :func:`may_reach`, by the number of equal low bytes of finer registers."""
    same, m = (a == b).sum(axis=1), a.shape[1]
    equal = np.exp(_log_parts(n_a, n_b, np.array([threshold]))[2])[:, 0]
    at_least = equal + (1 - equal) / 256
    seen = np.clip(same / m, 1e-12, 1 - 1e-12)
    found = same * np.log(seen / at_least) + (m - same) * np.log((1 - seen) / (1 - at_least))
    return (seen >= at_least) | (found <= UNLIKELY)


def log_likelihoods(a, b, n_a, n_b, similarity: np.ndarray) -> np.ndarray:
    """Log-likelihood of each ``similarity`` for each pair of registers and set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    parts = zip((more, less, same), _log_parts(n_a, n_b, similarity), strict=True)
    return sum(n[:, None] * log for n, log in parts)


def _log_parts(n_a, n_b, similarity: np.ndarray) -> list[np.ndarray]:
    """Logarithms of the chances that a register is larger in a, larger in b, and equal."""
    u = (n_a / (n_a + n_b))[:, None]
    j = np.minimum(similarity[None, :], np.minimum(u / (1 - u), (1 - u) / u))

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = p(u - (1 - u) * j), p((1 - u) - u * j)
    return [np.log(np.maximum(x, 1e-12)) for x in (above, below, 1 - above - below)]


def may_reach(a, b, n_a, n_b, threshold: float) -> np.ndarray:
    """False for pairs whose registers all but rule out the threshold."""
    grid = np.concatenate([np.linspace(0, threshold, 33), np.linspace(threshold, 1, 9)[1:]])
    logs = log_likelihoods(a, b, n_a, n_b, grid)
    return logs[:, grid >= threshold].max(axis=1) >= logs.max(axis=1) - UNLIKELY


class Overlaps:
    """Sizes of a column's sets, none of them empty, and of the intersections of pairs."""

    def __init__(self, sets: pa.ListArray):
        self.size = np.diff(sets.offsets.to_numpy()).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        values = sets.flatten().to_numpy(zero_copy_only=False)
        known, self.items = np.unique(values, return_inverse=True)
        self.mark = np.zeros(len(known), bool)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of sets ``a`` with sets ``b``; one ``a`` at a time."""
        out = np.zeros(len(a), np.int64)
        order = np.argsort(a, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
            if len(part):
                one, others = a[part[0]], b[part]
                own = self.items[self.start[one] : self.start[one] + self.size[one]]
                size = self.size[others]
                cuts = np.cumsum(size) - size
                at = np.arange(size.sum()) + np.repeat(self.start[others] - cuts, size)
                self.mark[own] = True
                out[part] = np.add.reduceat(self.mark[self.items[at]], cuts, dtype=np.int64)
                self.mark[own] = False
        return out


def joining(a: np.ndarray, b: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links ``a, b`` only such that join groups; ``group`` then has the joined ones."""
    _, first = np.unique(np.stack([group[a], group[b]]), axis=1, return_index=True)
    used = []
    for i in first:
        x, y = group[a[i]], group[b[i]]
        if x != y:
            group[group == max(x, y)] = min(x, y)
            used.append(i)
    return a[used], b[used]


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable (``label``) for each node of ``edges(a, b)``.

    Each round takes the smallest label among neighbours and follows it one step further; rounds
    are stored, and only a count reaches the driver.
    """
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select("a", "b").unionByName(back)
    both = stored(both.distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("m"))
        )
        better = labels.withColumnRenamed("label", "old").join(near, "node", "left")
        better = better.select("node", "old", F.least("old", "m").alias("low"))
        step = labels.select(F.col("node").alias("low"), F.col("label").alias("further"))
        new = stored(
            better.join(step, "low", "left").select(
                "node", F.least("low", "further").alias("label"), "old"
            ),
            "labels",
        )
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


class _Finder:
    """The steps of one run, on nodes (ids of the first documents with each set)."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        self.id_type = docs.schema["_id"].dataType

    def sketched(self) -> DataFrame:
        """Per row: ``_id``, set size, two fingerprints of the set, registers."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, offsets = texts_of(batch, "_text")
                for lo, hi in blocks(offsets):
                    rows, hashes = shingles(raw, offsets[lo : hi + 1], size)
                    n = np.bincount(rows, minlength=hi - lo)
                    prints = []
                    for seed in (1, 2):
                        total = np.zeros(len(hashes) + 1, np.uint64)
                        np.cumsum(mix(hashes + np.uint64(seed)), out=total[1:])
                        ends = np.cumsum(n)
                        prints.append((total[ends] - total[ends - n]).view(np.int64))
                    registers = sketch(rows, hashes, hi - lo)
                    columns = [
                        batch.column("_id").slice(lo, hi - lo),
                        pa.array(n.astype(np.int64)),
                        *map(pa.array, prints),
                        pa.array([r.tobytes() for r in registers], pa.binary()),
                    ]
                    names = ["_id", "n", "p1", "p2", "registers"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        fields = [("_id", self.id_type), ("n", T.LongType()), ("p1", T.LongType())]
        fields += [("p2", T.LongType()), ("registers", T.BinaryType())]
        return self.docs.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))

    def banded(self, nodes: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = b"".join(batch.column("registers").to_pylist())
                keys = band_keys(np.frombuffer(raw, np.uint16).reshape(batch.num_rows, REGISTERS))
                at = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
                columns = [
                    pa.array(keys.ravel().view(np.int64)),
                    batch.column("_id").take(at),
                    batch.column("n").take(at),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "n"])

        fields = [("key", T.LongType()), ("node", self.id_type), ("n", T.LongType())]
        schema = T.StructType([T.StructField(*f) for f in fields])
        return nodes.select("_id", "n", "registers").mapInArrow(run, schema)

    def likely(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs ``a, b`` that the registers do not rule out."""
        threshold = self.percent / 100

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    a, b = (
                        np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(
                            -1, REGISTERS
                        )
                        for c in ("r_a", "r_b")
                    )
                    n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
                    keep = pa.array(may_reach(a, b, n_a, n_b, threshold))
                    yield batch.select(["a", "b"]).filter(keep)

        both = pairs
        for side in ("a", "b"):
            both = both.join(
                nodes.select(
                    F.col("_id").alias(side),
                    F.col("n").alias(f"n_{side}"),
                    F.col("registers").alias(f"r_{side}"),
                ),
                side,
            )
        schema = T.StructType([T.StructField(c, self.id_type) for c in ("a", "b")])
        both = both.where(f"100 * least(n_a, n_b) >= {self.percent} * greatest(n_a, n_b)")
        return both.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, schema)

    def finer(self, sets: DataFrame) -> DataFrame:
        """``(node, fine)``: low bytes of the finer registers of each set."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                ends = whole.column("shingles").offsets.to_numpy().astype(np.int64)
                # a block's shingles and registers count against its limit
                for lo, hi in blocks(ends + FINE * np.arange(len(ends)), 1 << 18):
                    batch = whole.slice(lo, hi - lo)
                    lists = batch.column("shingles")
                    sizes = np.diff(lists.offsets.to_numpy())
                    hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    rows = np.repeat(np.arange(batch.num_rows), sizes)
                    fine = low_bytes(sketch(rows, hashes, batch.num_rows, FINE))
                    columns = [batch.column("node"), pa.array(map(bytes, fine), pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["node", "fine"])

        schema = T.StructType(
            [T.StructField("node", self.id_type), T.StructField("fine", T.BinaryType())]
        )
        return sets.select("node", "shingles").mapInArrow(run, schema)

    def across(
        self,
        members: DataFrame,
        nodes: DataFrame,
        sets: DataFrame,
        nearest: bool,
        give: str = "pairs",
    ) -> DataFrame:
        """Likely pairs ``a, b`` of different components in buckets that hold several.

        A bucket is cut into blocks, and each pair of blocks is compared in one task, register by
        register, and by finer registers; only likely pairs leave it, or for each member only the
        ``nearest`` one.  To ``give`` "members" is to return the members (and their ``n``) with a
        likely partner instead of the pairs; "links" takes such members, confirms likely pairs on
        full sets instead of finer registers, and returns as many as join the components.
        """
        several = members.groupBy("key").agg(
            F.min("label").alias("l1"),
            F.max("label").alias("l2"),
            F.count("*").alias("c"),
            (F.sum("n") if give == "links" else F.lit(0)).alias("weight"),
        )
        cuts = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("weight") / SHINGLES))
        several = several.where("l1 <> l2").select("key", cuts.alias("blocks"))
        rows = members.join(several, "key").withColumn(
            "block", F.pmod(F.xxhash64("node"), F.col("blocks"))
        )
        known = nodes.select(F.col("_id").alias("node"), "n", "registers")
        if give == "links":  # a row may have an empty text beside another with its id
            known = known.join(sets.where(F.size("shingles") > 0), "node")
        elif not nearest:
            apart = rows.select("node").distinct()
            known = known.join(self.finer(sets.join(apart, "node", "left_semi")), "node")
        units = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "key",
            F.least("block", "other").alias("p"),
            F.greatest("block", "other").alias("q"),
            "block",
            "node",
            "label",
        )
        units = units.join(known, "node")
        threshold, percent = self.percent / 100, self.percent
        id_type = self.id_type

        def compare(unit: pa.Table) -> pa.Table:
            unit = unit.sort_by("node")
            raw = b"".join(unit.column("registers").to_pylist())
            registers = np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS)
            bands = band_keys(registers)
            key = unit.column("key").to_numpy().view(np.uint64)[0]
            n, block, p, q = (unit.column(c).to_numpy() for c in ("n", "block", "p", "q"))
            _, group = np.unique(np.array(unit.column("label").to_pylist()), return_inverse=True)
            left, right = np.flatnonzero(block == p[0]), np.flatnonzero(block == q[0])
            likely = np.zeros(len(n), bool)
            if give == "links":
                overlaps = Overlaps(unit.column("shingles").combine_chunks())
            elif not nearest:
                fine = np.frombuffer(b"".join(unit.column("fine").to_pylist()), np.uint8)
                fine = fine.reshape(-1, FINE)
            found = [np.zeros((2, 0), np.int64)]
            for at in range(0, len(left), 32):
                part = left[at : at + 32]
                same = (registers[part][:, None, :] == registers[right][None, :, :]).sum(axis=2)
                small = np.minimum(n[part][:, None], n[right][None, :])
                large = np.maximum(n[part][:, None], n[right][None, :])
                able = (group[part][:, None] != group[right][None, :]) & (
                    100 * small >= percent * large
                )
                # far below what a pair at the threshold shows
                able &= same >= REGISTERS * (threshold - 0.3)
                if give == "members":  # known ones need not meet again
                    able &= ~(likely[part][:, None] & likely[right][None, :])
                if nearest:
                    same = np.where(able, same, -1)
                    best = same.argmax(axis=1) if same.shape[1] else np.zeros(0, int)
                    x = np.flatnonzero(able[np.arange(len(part)), best])
                    y = best[x]
                else:
                    if p[0] == q[0]:  # each pair of a block once
                        able &= part[:, None] < right[None, :]
                    x, y = np.nonzero(able)
                x, y = part[x], right[y]
                # all members may be able pairs, so likelihoods are taken of a few at a time
                for some in range(0, len(x), PAIRS):
                    a, b = x[some : some + PAIRS], y[some : some + PAIRS]
                    if not nearest:  # a pair leaves the bucket of its first common band only
                        common = bands[a] == bands[b]
                        own = bands[a, common.argmax(axis=1)] == key
                        a, b = a[own], b[own]
                    keep = may_reach(registers[a], registers[b], n[a], n[b], threshold)
                    a, b = a[keep], b[keep]
                    if give == "links":
                        both = overlaps.common(a, b)
                        union = overlaps.size[a] + overlaps.size[b] - both
                        keep = 100 * both >= percent * union
                        a, b = joining(a[keep], b[keep], group)
                    elif not nearest:
                        keep = may_reach_finely(fine[a], fine[b], n[a], n[b], threshold)
                        a, b = a[keep], b[keep]
                    if give == "members":
                        likely[a] = likely[b] = True
                    else:
                        found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
            if give == "members":
                return unit.select(["key", "node", "label", "n"]).filter(pa.array(likely))
            a, b = np.concatenate(found, axis=1)
            node = unit.column("node")
            return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b))})

        fields = [("a", id_type), ("b", id_type)]
        if give == "members":
            fields = [("key", T.LongType()), ("node", id_type), ("label", id_type), ("n", T.LongType())]
        schema = T.StructType([T.StructField(*f) for f in fields])
        return units.groupBy("key", "p", "q").applyInArrow(compare, schema).distinct()

    def full_sets(self, ids: DataFrame) -> DataFrame:
        """Sorted shingles of the texts of ``ids``, distinct."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, offsets = texts_of(batch, "_text")
                for lo, hi in blocks(offsets):
                    rows, hashes = shingles(raw, offsets[lo : hi + 1], size)
                    ends = np.searchsorted(rows, np.arange(hi - lo + 1)).astype(np.int32)
                    sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
                    columns = [batch.column("_id").slice(lo, hi - lo), sets]
                    yield pa.RecordBatch.from_arrays(columns, names=["node", "shingles"])

        fields = [("node", self.id_type), ("shingles", T.ArrayType(T.LongType()))]
        schema = T.StructType([T.StructField(*f) for f in fields])
        return self.docs.join(ids, "_id", "left_semi").mapInArrow(run, schema)

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs whose sets reach the similarity."""
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
        both = F.size(F.array_intersect("s_a", "s_b"))
        linked = pairs.join(b, "b").join(a, "a").select(
            "a", "b", both.alias("both"), (F.size("s_a") + F.size("s_b")).alias("all")
        )
        enough = 100 * F.col("both") >= self.percent * (F.col("all") - F.col("both"))
        return linked.where(enough).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: its id, ``n_shingles``, ``component_id`` and ``kept``.

    A row's set are its distinct shingles of ``size`` words, A-Z in lower case; documents are
    linked if ``100 * intersection >= percent * union``.  ``component_id`` is the smallest id
    reachable by links, and ``kept`` marks its row.  Links are found by bands of registers; a pair
    at the threshold is missed with a chance of 5e-8, and every link is confirmed on full sets.

    Empty and null texts are linked with nothing.  Rows that share an id are one node with all
    their links.  A row without an id is kept, with a null component.  Other columns are left
    out.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    finder = _Finder(rows, size, percent)
    sketched = stored(finder.sketched(), "sketches")
    named = sketched.where("_id IS NOT NULL AND n > 0")
    firsts = stored(named.groupBy("p1", "p2").agg(F.min("_id").alias("node")), "firsts")
    members = stored(
        named.select("_id", "p1", "p2").join(firsts, ["p1", "p2"]).select("_id", "node").distinct(),
        "members",
    )
    # one row for each distinct set
    nodes = stored(
        named.join(firsts.select("p1", "p2", F.col("node").alias("_id")), ["p1", "p2", "_id"])
        .select("_id", "p1", "p2", "n", "registers")
        .dropDuplicates(["_id", "p1", "p2"]),
        "nodes",
    )
    bands = finder.banded(nodes)
    shared = bands.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("c"))
    shared = stored(shared.where("c > 1").select("key", "centre"), "buckets")
    crowd = stored(bands.join(shared, "key"), "crowd")  # bucket members, each with its centre

    wanted = crowd.select(F.col("node").alias("_id")).distinct()
    sets = stored(finder.full_sets(wanted), "sets")
    several = members.groupBy("_id").agg(F.min("node").alias("a"), F.count("*").alias("c"))
    ties = members.join(several.where("c > 1"), "_id").where("node <> a")
    # an id with several texts ties their nodes together
    links = stored(ties.select("a", F.col("node").alias("b")), "links")
    ends = [f("centre", "node") for f in (F.least, F.greatest)]
    apart = crowd.where("node <> centre").select(ends[0].alias("a"), ends[1].alias("b"))
    labels = None
    for turn in ("centre", "nearest", "rest"):
        if turn != "centre":
            labelled = crowd.join(labels, "node", "left").select(
                "key", "node", F.coalesce("label", "node").alias("label")
            )
        if turn == "rest":
            likely = finder.across(labelled, nodes, sets, False, "members")
            found = finder.across(stored(likely, "likely"), nodes, sets, False, "links")
        else:
            if turn == "centre":
                pairs = finder.likely(apart.distinct(), nodes)
            else:
                pairs = finder.across(labelled, nodes, sets, True)
            found = finder.verified(stored(pairs, "pairs"), sets)
        links = links.unionByName(stored(found, "links"))
        labels = components(links)
    placed = members.join(labels, "node", "left").groupBy("_id").agg(
        F.min(F.coalesce("label", "node")).alias("component_id")
    )
    return (
        sketched.select("_id", "n")
        .join(placed, "_id", "left")
        .select(
            F.col("_id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "_id").alias("component_id"),
            F.coalesce(F.col("_id") == F.coalesce("component_id", "_id"), F.lit(True)).alias("kept"),
        )
    )
