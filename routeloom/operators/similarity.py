"""Pairs of near vectors, and the vectors nearest to a point.

A join of near vectors places every vector in cells and compares only vectors that share one.  The
approximate join hashes by several random projections at once, one key per table, and also looks
into the neighbouring cells that are most likely to hold a near vector.  The exact join uses a grid
along the directions of largest spread, whose neighbouring cells hold every near vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.functions.skew import lookup_join
from routeloom.workspace import freeze, freeze_counting

#: Least and most members of a cell per block; between them a cell is cut into so many.
BLOCK, MOST, BLOCKS = 2_000, 32_000, 16
#: Members of two blocks that are compared at a time.
TILE = 2_048
#: Vectors that a plan is made from.
SAMPLE = 2_000
#: Members of a cell that are compared together with those of other cells.
FEW = 32
#: Vectors placed at a time in a task.
ROWS = 4_096
#: Comparisons with vectors that are not near, for each vector, that a plan allows.
COMPARED = 16
#: A place in a grid costs about as much as so many comparisons.
PLACE_COST = 200
#: Most hash tables, projections of a key and axes of a grid.
MAX_TABLES, MAX_PROJECTIONS, MAX_AXES = 64, 24, 6


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two array columns."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def distinct_vectors(df: DataFrame, key: str, column: str) -> DataFrame:
    """``(id, vector, copies)``: equal vectors once, under their smallest key."""
    vector = F.col(column).cast("array<double>").alias("vector")
    return df.select(F.col(key).alias("id"), vector).groupBy("vector").agg(
        F.min("id").alias("id"), F.count("*").alias("copies")
    )


def vector_members(df: DataFrame, key: str, column: str) -> DataFrame:
    """``(id, representative)``: for every row the smallest key among those of equal vectors.

    Pairs are given between representatives; with this table they become pairs of rows.  Vectors
    are told apart by a 128-bit hash; a row without a vector stands for itself.
    """
    numbers = F.transform(F.col(column).cast("array<double>"), lambda x: x + F.lit(0.0))
    text = F.array_join(numbers.cast("array<string>"), ",", "null")
    rows = df.select(F.col(key).alias("id"), F.md5(text.cast("binary")).alias("_same"))
    first = rows.groupBy("_same").agg(F.min("id").alias("representative"))
    return lookup_join(rows, first, "_same", "left").select(
        "id", F.coalesce("representative", "id").alias("representative")
    )


@dataclass(frozen=True)
class Hashing:
    """Random projections: ``tables`` keys of ``projections`` cells of ``length`` each."""

    tables: int
    projections: int
    length: float
    probes: int
    seed: int

    def places(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(row, cell, home)`` of all points; with ``probes`` more cells for each key."""
        rows = np.arange(len(points))
        for table in range(self.tables):
            rng = np.random.default_rng([self.seed, table])
            axes = rng.standard_normal((points.shape[1], self.projections))
            spot = points @ axes / self.length + rng.random(self.projections)
            cell = np.floor(spot).astype(np.int64)
            yield rows, _cell_keys(cell, table), np.ones(len(rows), bool)
            for side, near in _nearest_sides(spot - cell, self.probes):
                moved = cell.copy()
                moved[rows, near] += side
                yield rows, _cell_keys(moved, table), np.zeros(len(rows), bool)


@dataclass(frozen=True)
class Grid:
    """Cells as wide as the threshold along orthonormal ``axes``; nothing near is missed."""

    axes: np.ndarray
    width: float

    def places(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(row, cell, home)``; of two neighbouring cells the earlier one's vectors visit."""
        count = self.axes.shape[1]
        spot = points @ self.axes / self.width
        cell = np.floor(spot).astype(np.int64)
        rows = np.arange(len(points))
        yield rows, _cell_keys(cell, 0), np.ones(len(rows), bool)
        inside = spot - cell
        for number in range(1, 3**count):
            offset = np.array([number // 3**i % 3 for i in range(count)]) - 1
            if not offset.any() or offset[np.flatnonzero(offset)[0]] < 0:
                continue
            gap = np.where(offset > 0, 1 - inside, np.where(offset < 0, inside, 0.0))
            near = np.flatnonzero((gap * gap).sum(axis=1) <= 1 + 1e-9)
            yield near, _cell_keys(cell[near] + offset, 0), np.zeros(len(near), bool)


def _cell_keys(cells: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit number for each row of cell numbers; a chance meeting only adds comparisons."""
    start = (table + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF
    key = np.full(len(cells), start ^ start >> 32, np.uint64)
    for column in cells.T:
        key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _nearest_sides(inside: np.ndarray, probes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each further cell the step (-1 or 1) and the projection it goes along."""
    if not probes:
        return
    side = np.where(inside < 0.5, -1, 1)
    order = np.argsort(np.minimum(inside, 1 - inside), axis=1)
    rows = np.arange(len(inside))
    for near in order.T[:probes]:
        yield side[rows, near], near


def _agreement(ratio: np.ndarray) -> np.ndarray:
    """Chance that one projection puts two vectors in one cell; ``ratio``: length to distance."""
    ratio = np.maximum(ratio, 1e-9)
    tail = np.array([math.erfc(x / math.sqrt(2)) for x in ratio.ravel()]).reshape(ratio.shape)
    return 1 - tail - math.sqrt(2 / math.pi) / ratio * (1 - np.exp(-ratio * ratio / 2))


def _meetings(ratio: float, projections: int, probes: int, rng: np.random.Generator) -> float:
    """Chance that two vectors meet in a table, looking into further cells from both sides."""
    inside = rng.random((10_000, projections))
    other = inside + rng.standard_normal(inside.shape) / ratio
    step = np.floor(other).astype(np.int64)
    met = ~step.any(axis=1)
    rows = np.arange(len(inside))
    for own, sign in ((inside, 1), (other - step, -1)):
        for side, near in _nearest_sides(own, probes):
            moved = step.copy()
            moved[rows, near] -= sign * side
            met |= ~moved.any(axis=1)
    return float(met.mean())


def plan_hashing(
    distances: np.ndarray, n: int, threshold: float, recall: float, seed: int
) -> tuple[Hashing, float]:
    """The hashing with the fewest places that finds a pair at the threshold with chance ``recall``.

    ``distances`` is a sample between rows that are not near.  Of the hashings that compare a
    vector with at most ``COMPARED`` others, as the sample lets expect, the one with the fewest
    places is chosen, so more vectors get longer keys; if there is none, the one with the fewest
    comparisons.
    """
    found: list[tuple[bool, float, float, Hashing]] = []
    for ratio in (2.0, 3.0, 4.0, 6.0, 8.0, 12.0):
        apart = _agreement(ratio * threshold / np.maximum(distances, 1e-12))
        for projections in range(1, MAX_PROJECTIONS + 1):
            chance = float((apart**projections).mean())
            for probes in {0, min(2, projections)}:
                if probes:
                    rng = np.random.default_rng([seed, projections])
                    meets = _meetings(ratio, projections, probes, rng)
                else:
                    meets = float(_agreement(np.array([ratio]))[0]) ** projections
                meets = min(meets, 1 - 1e-12)
                if meets <= 0.02:
                    continue
                tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - meets)))
                if tables > MAX_TABLES:
                    continue
                compared = tables * n * (1 + 2 * probes) * chance / 2
                much, places = compared > COMPARED, tables * (1 + probes)
                plan = Hashing(tables, projections, ratio * threshold, probes, seed)
                found.append((much, compared if much else places, places + compared, plan))
    best = min(found, key=lambda f: f[:3])
    return best[3], best[2]


def plan_grid(sample: np.ndarray, n: int, threshold: float) -> Grid:
    """The number of axes, those of largest spread in the sample, with the least cost."""
    centred = sample - sample.mean(axis=0)
    axes = np.linalg.svd(centred, full_matrices=False)[2].T
    best: tuple[float, int] | None = None
    for count in range(min(MAX_AXES, axes.shape[1]) + 1):
        grid = Grid(axes[:, :count], threshold)
        home, visits, more = {}, {}, 0
        for _, cells, is_home in grid.places(sample):
            more += len(cells)
            for cell, own in zip(cells.tolist(), is_home.tolist(), strict=True):
                table = home if own else visits
                table[cell] = table.get(cell, 0) + 1
        pairs = sum(m * (m / 2 + visits.get(cell, 0)) for cell, m in home.items())
        cost = more / len(sample) * PLACE_COST + n * pairs / len(sample) ** 2
        if best is None or cost < best[0]:
            best = cost, count
    return Grid(axes[:, : best[1]], threshold)


class NearPairs:
    """Pairs of vectors nearer than ``threshold``; see :func:`similar_pairs`.

    ``plan`` tells how vectors are placed, ``vectors`` and ``places`` are the stored tables.
    """

    def __init__(
        self,
        df: DataFrame,
        key: str,
        column: str,
        threshold: float,
        recall: float | None = 0.99,
        seed: int = 42,
    ):
        if threshold <= 0 or (recall is not None and not 0 < recall < 1):
            raise ValueError("threshold must be positive and recall between 0 and 1, or None")
        whole = F.col("vector").isNotNull() & ~F.exists(
            "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        )
        self.threshold, self.exact = threshold, recall is None
        self.vectors, self.n = freeze_counting(
            distinct_vectors(df, key, column).where(whole), "vectors"
        )
        self.key_type = self.vectors.schema["id"].dataType
        kind = df.select(column).schema[0].dataType
        single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
        self.element = "float" if single else "double"
        self.plan = self._plan(recall, seed)

    def _plan(self, recall: float | None, seed: int) -> Hashing | Grid | None:
        if self.n < 2:
            return None
        # A fixed number of vectors by a hash of theirs: bounded, and the same at every run.
        order = F.xxhash64(F.lit(seed), F.col("vector"))
        picked = self.vectors.select("vector").orderBy(order).limit(SAMPLE).collect()
        sizes = {len(r[0]) for r in picked}
        if len(sizes) > 1:
            raise ValueError(f"vectors must be of one length, not {sorted(sizes)}")
        sample = np.array([r[0] for r in picked])
        if recall is None:
            return plan_grid(sample, self.n, self.threshold)
        rng = np.random.default_rng(seed)
        a, b = rng.integers(0, len(sample), (2, SAMPLE))
        apart = np.sqrt(((sample[a] - sample[b]) ** 2).sum(axis=1))
        apart = apart[apart >= self.threshold]
        apart = apart if len(apart) else np.array([2 * self.threshold])
        return plan_hashing(apart, self.n, self.threshold, recall, seed)[0]

    @cached_property
    def places(self) -> DataFrame:
        """``(id, cell, home)``: the cells of each vector, and those it looks into."""
        plan, id_type = self.plan, self.key_type
        schema = T.StructType(
            [
                T.StructField("id", id_type),
                T.StructField("cell", T.LongType()),
                T.StructField("home", T.BooleanType()),
            ]
        )
        if plan is None:
            return self.vectors.sparkSession.createDataFrame([], schema)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    ids = batch.column(0)
                    points = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
                    for rows, cells, home in plan.places(points):
                        columns = [ids.take(pa.array(rows)), pa.array(cells), pa.array(home)]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        placed = self.vectors.select("id", "vector").mapInArrow(place, schema)
        return freeze(placed, "places")

    @cached_property
    def cells(self) -> DataFrame:
        """``(cell, homes, visits, blocks)`` of the cells in which vectors meet."""
        counts = self.places.groupBy("cell").agg(
            F.sum(F.col("home").cast("bigint")).alias("homes"), F.count("*").alias("n")
        )
        return freeze(
            counts.where("homes > 0 AND n > 1").select(
                "cell",
                "homes",
                (F.col("n") - F.col("homes")).alias("visits"),
                F.ceil(
                    F.col("n") / F.greatest(
                        F.lit(BLOCK), F.least(F.lit(MOST), F.ceil(F.col("n") / BLOCKS))
                    )
                ).alias("blocks"),
            ),
            "cells",
        )

    def candidates(self) -> DataFrame:
        """One row: the number of ``vectors``, ``places`` and compared pairs (``candidates``)."""
        met = F.col("homes") * ((F.col("homes") - 1) / 2 + F.col("visits"))
        compared = self.cells.agg(F.coalesce(F.sum(met.cast("bigint")), F.lit(0)).alias("candidates"))
        placed = self.places.agg(F.count("*").alias("places"))
        return placed.join(F.broadcast(compared)).select(
            F.lit(self.n).cast("bigint").alias("vectors"), "places", "candidates"
        )

    def pairs(self) -> DataFrame:
        """``(id_a, id_b, distance, copies_a, copies_b)``, each pair once."""
        placed = lookup_join(self.places, self.cells.select("cell", "blocks"), "cell").withColumn(
            "block", F.expr("pmod(xxhash64(id), blocks)")
        )
        # Every pair of blocks, and each block with itself, is one group of two blocks at most.
        units = placed.withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        ).select(
            "cell",
            F.least("block", "other").alias("p"),
            F.greatest("block", "other").alias("q"),
            F.col("block").cast("bigint").alias("block"),
            "home",
            "id",
        )
        # only vectors that share a cell travel, as short as they came, and after the cells are known
        vectors = self.vectors.withColumn("vector", F.col("vector").cast(f"array<{self.element}>"))
        filled = lookup_join(units, vectors, "id")
        threshold = self.threshold
        schema = T.StructType(
            [
                T.StructField("id_a", self.key_type),
                T.StructField("id_b", self.key_type),
                T.StructField("distance", T.DoubleType()),
                T.StructField("copies_a", T.LongType()),
                T.StructField("copies_b", T.LongType()),
            ]
        )

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = None  # the last unit of a batch may go on in the next one
            for batch in batches:
                rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
                unit = rows[["cell", "p", "q"]].to_numpy()
                last = np.flatnonzero((unit != unit[-1]).any(axis=1))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield from _compared(rows.iloc[:cut], threshold)
                held = rows.iloc[cut:]
            if held is not None and len(held):
                yield from _compared(held, threshold)

        found = (
            filled.repartition("cell", "p", "q")
            .sortWithinPartitions("cell", "p", "q", "id")
            .mapInPandas(compare, schema)
        )
        return found if self.exact else found.dropDuplicates(["id_a", "id_b"])


def similar_pairs(
    df: DataFrame,
    key: str,
    column: str,
    threshold: float,
    recall: float | None = 0.99,
    seed: int = 42,
) -> DataFrame:
    """Pairs of vectors nearer than ``threshold``: ``(id_a, id_b, distance, copies_a, copies_b)``.

    ``recall`` is the chance to find a pair at the threshold, nearer ones are found more surely;
    None finds all.  Equal vectors are compared once, under their smallest key, and counted;
    :func:`vector_members` has all keys of each.  A large cell is cut into blocks, and each
    pair of blocks is a group of its own; only pairs below the threshold leave it.  The plan is
    made from a sample of ``SAMPLE`` vectors and the number of all, so that with more vectors
    keys become longer rather than cells fuller.

    Vectors that are null or have a null, infinite or undefined element have no distance and take
    no part.  Vectors of different lengths raise.  An empty table gives no rows.
    """
    return NearPairs(df, key, column, threshold, recall, seed).pairs()


def _compared(rows: pd.DataFrame, threshold: float) -> Iterator[pd.DataFrame]:
    """Pairs below the threshold in all units of ``rows``, which are sorted by unit and id."""
    unit = rows[["cell", "p", "q"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(rows)])
    number = np.repeat(np.arange(len(starts)), sizes)
    points = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    home, block = rows["home"].to_numpy(), rows["block"].to_numpy()
    across = unit[:, 1] != unit[:, 2]
    few = np.repeat(sizes <= FEW, sizes)
    found = []
    for apart in range(1, min(FEW, int(sizes.max()))):  # small units all at once
        a = np.flatnonzero(few[:-apart] & (number[:-apart] == number[apart:]))
        if len(a):
            found.append(_close(points, a, a + apart, home, block, across, threshold))
    for start, size in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
        one = slice(start, start + size)
        for a, b in _roughly_near(points[one], _meeting(home[one], block[one], unit[start]), threshold):
            found.append(_close(points, a + start, b + start, home, block, across, threshold))
    if not found:
        return
    a, b, distance = map(np.concatenate, zip(*found, strict=True))
    ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
    other = ids[a] != ids[b]  # two tables may give one vector the same cell by chance
    a, b, distance = a[other], b[other], distance[other]
    yield pd.DataFrame(
        {
            "id_a": ids[a],
            "id_b": ids[b],
            "distance": distance,
            "copies_a": copies[a],
            "copies_b": copies[b],
        }
    )


def _meeting(
    home: np.ndarray, block: np.ndarray, unit: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of members of a unit ``(cell, p, q)`` that meet; equal ones meet among themselves."""
    _, p, q = unit.tolist()
    homes, visits = (
        [np.flatnonzero((home == at_home) & (block == number)) for number in (p, q)]
        for at_home in (True, False)
    )
    if p == q:
        return [(homes[0], homes[0]), (homes[0], visits[0])]
    return [(homes[0], np.r_[homes[1], visits[1]]), (visits[0], homes[1])]


def _roughly_near(
    points: np.ndarray, meeting: list[tuple[np.ndarray, np.ndarray]], threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs that may be near, the earlier first, by products of ``TILE`` rows."""
    moved = points - points.mean(axis=0)
    squares = (moved * moved).sum(axis=1) / 2
    # The product form loses some digits, so it only sorts out what is clearly too far.
    size, near = points.shape[1] + 10, threshold * threshold / 2
    kind, slack = np.float32, size * 2.0**-21 * squares.max()
    if not slack < 0.01 * near:
        kind, slack = np.float64, size * 2.0**-50 * squares.max()
    limit = kind(near + slack)
    ones = np.ones(len(points))
    first = np.column_stack([-moved, squares, ones]).astype(kind)
    second = np.column_stack([moved, ones, squares]).astype(kind)
    for left, right in meeting:
        same = left is right
        for at in range(0, len(left), TILE):
            rows = left[at : at + TILE]
            for to in range(at if same else 0, len(right), TILE):
                columns = right[to : to + TILE]
                close = first[rows] @ second[columns].T < limit
                a, b = np.nonzero(np.triu(close, 1) if same and at == to else close)
                if len(a):
                    a, b = rows[a], columns[b]
                    yield np.minimum(a, b), np.maximum(a, b)


def _close(
    points: np.ndarray,
    a: np.ndarray,
    b: np.ndarray,
    home: np.ndarray,
    block: np.ndarray,
    across: np.ndarray,
    threshold: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those pairs that are near; visitors do not meet, nor members of a block in others' unit."""
    meet = (home[a] | home[b]) & ~(across[a] & (block[a] == block[b]))
    a, b = a[meet], b[meet]
    distance = np.concatenate(
        [
            np.sqrt(((points[a[i : i + ROWS]] - points[b[i : i + ROWS]]) ** 2).sum(axis=1))
            for i in range(0, len(a), ROWS)
        ]
        or [np.zeros(0)]
    )
    near = distance < threshold
    return a[near], b[near], distance[near]


def nearest(df: DataFrame, key: str, column: str, point: list[float], k: int) -> DataFrame:
    """The ``k`` vectors nearest to ``point``, the smaller key first on a tie."""
    to = F.array(*[F.lit(float(x)) for x in point])
    distance = euclidean(F.col(column).cast("array<double>"), to)
    return df.select(key, distance.alias("distance")).orderBy("distance", key).limit(k)
