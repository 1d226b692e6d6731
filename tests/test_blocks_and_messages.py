"""Block matrices, rounds of messages and frequent items against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from oracles import distances
from routeloom.operators import arcs as arc_module
from routeloom.operators import blocks, graph, messages
from routeloom.operators.blocks import BlockMatrix
from routeloom.operators.frequent import frequent_items, quantile_ranks


def entries(spark, found):
    rows = [(r, c, float(v)) for (r, c), v in found.items()]
    return spark.createDataFrame(rows, "row bigint, col bigint, value double")


def as_dict(matrix):
    return {(r.row, r.col): r.value for r in matrix.entries().collect()}


def random_cells(seed, rows, cols, n):
    r = random.Random(seed)
    return {(r.randrange(*rows), r.randrange(*cols)): r.randint(-3, 3) or 1 for _ in range(n)}


def product(a, b):
    out = Counter()
    for (i, j), v in a.items():
        for (k, l), w in b.items():
            if j == k:
                out[i, l] += v * w
    return {place: float(v) for place, v in out.items() if v}


@pytest.mark.parametrize("n", [40, 900])  # few entries a block, and nearly full blocks
def test_block_product(spark, monkeypatch, n):
    monkeypatch.setattr(blocks, "PAIRS", 3)
    a = random_cells(1, (-9, 20), (-5, 25), n) | {(i, 3): 2 for i in range(-9, 20)}
    b = random_cells(2, (-5, 25), (0, 12), n) | {(3, i): 1 for i in range(12)}
    left = BlockMatrix.from_entries(entries(spark, a), bits=2)
    right = BlockMatrix.from_entries(entries(spark, b), bits=2)
    assert as_dict(left.multiply(right)) == product(a, b)
    turned = {(j, i): float(v) for (i, j), v in b.items()}
    assert as_dict(right.transpose()) == turned
    sizes = left.blocks.selectExpr("max(size(v)) AS most").first()["most"]
    assert sizes <= 16


def test_block_entries(spark):
    rows = [(1, 1, 2.0), (1, 1, 3.0), (2, 1, 4.0), (2, 1, -4.0), (None, 1, 1.0), (5, 5, None)]
    rows += [(1 << 40, -(1 << 40), 7.0)]
    df = spark.createDataFrame(rows, "row bigint, col bigint, value double")
    matrix = BlockMatrix.from_entries(df)
    assert as_dict(matrix) == {(1, 1): 5.0, (1 << 40, -(1 << 40)): 7.0}
    assert as_dict(matrix.add(matrix)) == {(1, 1): 10.0, (1 << 40, -(1 << 40)): 14.0}
    empty = BlockMatrix.from_entries(df.limit(0))
    assert as_dict(matrix.multiply(empty)) == {}


def test_products_leave_a_task_as_sums(spark, monkeypatch):
    """However many blocks meet in a place of the product; stored rows stay short."""
    monkeypatch.setattr(blocks, "ENTRIES", 50)
    monkeypatch.setattr(blocks, "PRODUCTS", 30)
    a = random_cells(4, (-300, 300), (0, 4), 1500)
    tall = BlockMatrix.from_entries(entries(spark, a), bits=2)
    turned = {(j, i): v for (i, j), v in a.items()}
    made = blocks._multiplier

    def watched(bits):
        run = made(bits)
        counts = left_rows.add

        def counted(batches):
            for batch in run(batches):
                counts(batch.num_rows)
                yield batch

        return counted

    left_rows = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(blocks, "_multiplier", watched)
    square = tall.transpose().multiply(tall)
    assert as_dict(square) == product(turned, a)
    assert left_rows.value <= 4
    full = BlockMatrix.from_entries(entries(spark, {(i, j): 1 for i in range(8) for j in range(8)}), 3)
    for matrix in (full, full.multiply(full)):
        sizes = matrix.blocks.selectExpr("max(size(v)) AS most", "sum(size(v)) AS n").first()
        assert sizes.most <= 16 and sizes.n == 64


def test_dense_and_paired_products_agree():
    r = np.random.default_rng(3)
    x, y = r.integers(0, 3, (8, 8)).astype(float), r.integers(0, 3, (8, 8)).astype(float)
    (i, j), (k, l) = x.nonzero(), y.nonzero()
    whole = (x @ y).ravel()
    places, values = blocks._product((i, j, x[i, j]), (k, l, y[k, l]), 8)  # dense
    assert dict(zip(places, values)) == {p: whole[p] for p in whole.nonzero()[0]}
    few = i < 1
    places, values = blocks._product((i[few], j[few], x[i[few], j[few]]), (k, l, y[k, l]), 8)
    assert dict(zip(places, values)) == {p: whole[p] for p in whole[:8].nonzero()[0]}


def chain_and_ring(n):
    arcs = [(v, v + 1, 1) for v in range(20)] + [(20, 0, 1)]
    arcs += [(100 + v, 100 + (v + 1) % n, 2) for v in range(n)]
    return arcs + [(100 + v, 100 + (v * 7 + 3) % n, 1) for v in range(n)] + [(20, 50, 3)]


def test_residual_ranks(spark):
    df = spark.createDataFrame(chain_and_ring(30), "src bigint, dst bigint, n bigint")
    senders = []
    found = {x.vertex: x.rank for x in messages.residual_ranks(df, 1e-3, senders).collect()}
    full = {x.vertex: x.rank for x in graph.pagerank(df, tolerance=1e-4).collect()}
    assert found == pytest.approx(full, abs=0.01)
    # the ring is soon at rest while the chain still moves
    assert senders[-1] < senders[0] < len(found)
    nothing = spark.createDataFrame([], "src bigint, dst bigint, n bigint")
    assert messages.residual_ranks(nothing).collect() == []


@pytest.mark.parametrize("bucket_rows", [10, 2_000_000])
def test_distances_from(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(arc_module, "BUCKET_ROWS", bucket_rows)
    r = random.Random(5)
    edges = {(0, v): float(r.randint(0, 6)) for v in range(1, 25)}
    edges |= {(v, v + 1): 1.0 for v in range(24, 32)} | {(60, 61): 1.0}
    rows = [(a, b, w) for (a, b), w in edges.items()]
    rows += [(b, a, w) for a, b, w in rows]
    df = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    sources = spark.createDataFrame([(0,), (30,), (30,), (999,), (None,)], "id bigint")
    found = {x.vertex: x.dist for x in messages.distances_from(df, sources).collect()}
    one, two = distances(edges, 0), distances(edges, 30)
    assert found == {v: min(one[v], two[v]) for v in one}
    with pytest.raises(ValueError):
        messages.distances_from(df.selectExpr("src", "dst", "-1D AS weight"), sources)


def test_frequent_items_are_exact(spark):
    r = random.Random(7)
    values = [("hot" if r.random() < 0.4 else f"w{r.randrange(3000)}", r.randrange(40)) for _ in range(9000)]
    rows = [*values, *[("edge", None)] * 90, *[(None, None)] * 500]
    df = spark.createDataFrame(rows, "a string, `b c` int").repartition(16)
    found = {(x.column, x.item): x.n for x in frequent_items(df, ["a", "b c"], 0.009).collect()}
    want = {}
    for at, name in enumerate(["a", "b c"]):
        column = [str(x[at]) for x in rows if x[at] is not None]
        least = 0.009 * len(column)
        want |= {(name, v): n for v, n in Counter(column).items() if n >= least}
    assert found == want and ("a", "edge") in want
    assert frequent_items(df.limit(0), ["a"], 0.1).collect() == []
    with pytest.raises(ValueError):
        frequent_items(df, ["a"], 1e-6)


def test_quantile_ranks(spark):
    values = [float(v % 1000) for v in range(20000)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(8)
    for row in quantile_ranks(df, "x", [0.0, 0.3, 1.0], 0.01).collect():
        assert row.n == 20000
        assert row.below <= (row.probability + 0.01) * row.n + 1
        assert row.up_to >= (row.probability - 0.01) * row.n - 1
    assert quantile_ranks(df.limit(0), "x", [0.5]).collect() == []
