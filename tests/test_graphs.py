"""Graph operators against plain Python, with few buckets and with many and cut hubs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from oracles import components, distances, ranks, spanning_forest, triangles
from routeloom.operators import arcs as arc_module
from routeloom.operators import contraction, graph, trees
from routeloom.operators.analysis import bottleneck, complement_strength, tree_complement
from routeloom.operators.trees import as_edges, minimum_spanning_forest, shortest_path_tree
from routeloom.workspace import shared_folder


@pytest.fixture(params=["few", "many"])
def scale(request, monkeypatch):
    """Run with few buckets, then with many and so with hubs in several of them."""
    if request.param == "many":
        monkeypatch.setattr(arc_module, "BUCKET_ROWS", 10)
        monkeypatch.setattr(contraction, "CLIMBS", 1)
    return request.param


def hub_graph(seed=1, weights=lambda r: float(r.randint(0, 6))):
    """A hub that touches a third of all edges, a second component, and ties in weight."""
    r = random.Random(seed)
    edges = {(0, v): weights(r) for v in range(1, 31)}
    while len(edges) < 80:
        a, b = sorted(r.sample(range(1, 40), 2))
        edges[a, b] = weights(r)
    for a, b in [(100, 101), (101, 102), (102, 103), (100, 103), (100, 102)]:
        edges[a, b] = weights(r)
    return edges


def edge_df(spark, edges):
    rows = [(a, b, w) for (a, b), w in edges.items()]
    return spark.createDataFrame(rows, "src bigint, dst bigint, weight double")


def as_dict(df):
    return {(r.src, r.dst): r.weight for r in df.collect()}


def test_spanning_forest(spark, scale):
    edges = hub_graph()
    assert as_dict(minimum_spanning_forest(edge_df(spark, edges))) == spanning_forest(edges)


def test_shortest_paths(spark, scale):
    edges = hub_graph(2)
    tree = shortest_path_tree(edge_df(spark, edges), 0).collect()
    best = distances(edges, 0)
    assert {r.vertex: r.dist for r in tree} == {v: d for v, d in best.items() if v != 0}
    parent = {r.vertex: r.parent for r in tree}
    for r in tree:
        assert edges[min(r.parent, r.vertex), max(r.parent, r.vertex)] == r.edge_weight
        assert r.dist == best[r.parent] + r.edge_weight
        steps, at = 0, r.vertex
        while at != 0:
            at, steps = parent[at], steps + 1
            assert steps <= len(parent), "the tree has a cycle"


def test_components_and_triangles(spark, scale):
    edges = hub_graph(3)
    vertices = {v for e in edges for v in e} | {500}
    ids = spark.createDataFrame([(v,) for v in vertices], "id bigint")
    df = edge_df(spark, edges)
    found = graph.connected_components(ids, df)
    assert {r.id: r.component for r in found.collect()} == components(vertices, edges)
    found = graph.triangle_count(df)
    assert {r.vertex: r.triangles for r in found.collect()} == triangles(edges)


def test_ranks_and_neighbours(spark, scale):
    r = random.Random(4)
    arcs = [(v, 0, r.randint(1, 3)) for v in range(1, 31)]
    arcs += [(0, v, 1) for v in range(1, 16)]
    arcs += [(r.randint(1, 30), r.randint(40, 50), 2) for _ in range(20)]
    arcs = list({(a, b): (a, b, n) for a, b, n in arcs}.values())
    df = spark.createDataFrame(arcs, "src bigint, dst bigint, n bigint")
    want = ranks(arcs, 4)
    got = {x.vertex: x.rank for x in graph.pagerank(df, rounds=4).collect()}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(len(want))
    values = {v: float((v * 7) % 31) for v in want}
    table = spark.createDataFrame(list(values.items()), "vertex bigint, value double")
    got = {x.vertex: x.mean for x in graph.neighbor_mean(df, table).collect()}
    want = {}
    for v in values:
        larger = [(values[a], n) for a, b, n in arcs if b == v and values[a] > values[v]]
        if larger:
            want[v] = sum(x * n for x, n in larger) / sum(n for _, n in larger)
    assert got == pytest.approx(want)


def test_large_layout_keeps_edges_in_place(spark, monkeypatch):
    monkeypatch.setattr(arc_module, "BUCKET_ROWS", 20)
    hub = [(0, v, 1.0) for v in range(1, 400)] + [(v, 0, 1.0) for v in range(1, 400)]
    arcs = spark.createDataFrame(hub, "src bigint, dst bigint, weight double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with arc_module.ArcTable(arcs, len(hub)) as table:
            assert [tuple(r) for r in table.hubs.collect()] == [(0, 20)]
            shards = table.arcs.where("src = 0").groupBy("shard").count().collect()
            assert len(shards) == 20 and max(r["count"] for r in shards) < 60
            rows = spark.createDataFrame([(0, 1.0), (3, 1.0)], "src bigint, x double")
            sent = table.send(rows)
            plan = sent._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, plan
            assert sent.count() == 400
        assert not spark.catalog.tableExists(table.name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_negative_weights(spark):
    edges = {(1, 2): -3.0, (2, 3): 4.0, (1, 3): -1.0}
    with pytest.raises(ValueError):
        shortest_path_tree(edge_df(spark, edges), 1)
    assert as_dict(minimum_spanning_forest(edge_df(spark, edges))) == {(1, 2): -3.0, (1, 3): -1.0}


def test_zero_weights_make_no_cycle(spark):
    edges = {(1, 2): 0.0, (2, 3): 0.0, (1, 3): 0.0, (3, 4): 0.0, (2, 4): 0.0}
    tree = {r.vertex: r.parent for r in shortest_path_tree(edge_df(spark, edges), 4).collect()}
    assert tree == {3: 4, 2: 4, 1: 2}


def test_equal_weights_order_by_ends(spark):
    edges = {(a, b): 1.0 for a in range(6) for b in range(a + 1, 6)}
    want = {(0, b): 1.0 for b in range(1, 6)}
    assert as_dict(minimum_spanning_forest(edge_df(spark, edges))) == want


def test_unreached_vertices(spark):
    edges = {(1, 2): 1.0, (5, 6): 2.0}
    ids = spark.createDataFrame([(v,) for v in (1, 2, 5, 6, 9)], "id bigint")
    tree = shortest_path_tree(edge_df(spark, edges), 1, ids, keep_unreached=True)
    assert {r.vertex: (r.parent, r.dist) for r in tree.collect()} == {
        2: (1, 1.0), 5: (None, None), 6: (None, None), 9: (None, None),
    }


def test_graph_without_edges(spark):
    none = spark.createDataFrame([], "src bigint, dst bigint, weight double")
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert minimum_spanning_forest(none).count() == 0
    assert shortest_path_tree(none).count() == 0
    assert {tuple(r) for r in graph.connected_components(ids, none).collect()} == {(1, 1), (2, 2)}


def test_tree_has_no_bottleneck(spark):
    edges = edge_df(spark, {(1, 2): 1.0, (2, 3): 2.0})
    outside = tree_complement(edges, minimum_spanning_forest(edges))
    assert bottleneck(complement_strength(outside)).count() == 0


def test_long_path(spark):
    n = 40
    edges = edge_df(spark, {(v, v + 1): 1.0 + v % 3 for v in range(n)})
    tree = shortest_path_tree(edges, 0)
    assert tree.count() == n
    assert tree_complement(edges, tree).count() == 0
    assert minimum_spanning_forest(edges).count() == n


def test_path_writes_few_rows(spark, monkeypatch):
    """On a path of n vertices a hop improves one; all rounds write O(n log n) rows."""
    n, written = 32, []
    plain = trees._Reached.add

    def counting(self, rows):
        stored, count = plain(self, rows)
        written.append(count)
        return stored, count

    monkeypatch.setattr(trees._Reached, "add", counting)
    edges = edge_df(spark, {(v, v + 1): 1.0 for v in range(n)})
    tree = trees.shortest_path_tree(edges, 0)
    assert {r.vertex: r.dist for r in tree.collect()} == {v: float(v) for v in range(1, n + 1)}
    assert sum(written) <= 2 * n * n.bit_length()


def stored_names(spark):
    folder = f"{shared_folder(spark)}/routeloom".removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_only_results_stay_stored(spark, monkeypatch):
    """Rounds, levels, arcs and edges are deleted, also where the work fails."""
    monkeypatch.setattr(trees, "LEVELS", 3)
    monkeypatch.setattr(trees, "HOPS", 1)
    edges = edge_df(spark, {(v, v + 1): 1.0 for v in range(6)})
    before = stored_names(spark)
    tree = trees.shortest_path_tree(edges, 0)
    assert tree.count() == 6
    assert {name.split("-")[0] for name in stored_names(spark) - before} == {"tree"}
    before = stored_names(spark)
    assert minimum_spanning_forest(edges).count() == 6
    assert {name.split("-")[0] for name in stored_names(spark) - before} == {"forest"}
    before = stored_names(spark)
    with pytest.raises(Exception, match="nowhere"):
        minimum_spanning_forest(edges.withColumn("weight", F.expr("raise_error('nowhere')")))
    with pytest.raises(ValueError):
        trees.shortest_path_tree(edge_df(spark, {(1, 2): -1.0}), 1)
    monkeypatch.setattr(trees, "_best_offers", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        trees.shortest_path_tree(edges, 0)
    assert stored_names(spark) == before


def test_known_paths_are_not_shuffled(spark):
    """Offers are dealt by vertex, where the stored paths already lie."""
    edges = edge_df(spark, {(1, 2): 1.0, (2, 3): 2.0, (1, 3): 3.0})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with trees.ShortestPaths(edges, 1) as found:
            reached = found.reached
            assert len(reached.levels) > 1
            offers = spark.range(9).selectExpr(
                "id AS vertex", "1D AS dist", "1 AS hops", "0L AS parent", "true AS open", "1D AS weight"
            )
            better = reached.without_worse(trees._best_offers(offers, found.arcs.buckets))
            plan = better._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == len(reached.levels)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def brute_paths(edges, source):
    """Least (dist, hops, parent) of every vertex."""
    arcs = [(a, b, w) for (a, b), w in edges.items()] + [(b, a, w) for (a, b), w in edges.items()]
    best = {source: (0.0, 0, None)}
    for _ in range(len({x for e in edges for x in e}) + 1):
        for a, b, w in arcs:
            if a in best and b != source:
                offer = (best[a][0] + w, best[a][1] + 1, a)
                if b not in best or offer < best[b]:
                    best[b] = offer
    return {v: (d, p) for v, (d, _, p) in best.items() if v != source}


def brute_forest(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    out = {}
    for (a, b), w in sorted(edges.items(), key=lambda e: (e[1], e[0])):
        if find(a) != find(b):
            root[find(a)] = find(b)
            out[a, b] = w
    return out


@pytest.mark.parametrize("seed", range(3))
def test_relief_repairs_the_trees(spark, monkeypatch, seed):
    """What changes after relief equals a tree made anew, with small rounds and bands too."""
    monkeypatch.setattr(trees, "LEVELS", 2 + seed)
    monkeypatch.setattr(trees, "HOPS", 1 + seed)
    monkeypatch.setattr(trees, "BAND_ROWS", 2 + 3 * seed)
    rng = random.Random(seed)
    n = 14
    edges = {}
    for _ in range(34):
        a, b = sorted(rng.sample(range(n), 2))
        edges[a, b] = rng.choice([0.0, 0.5, 1.0, 2.0, 3.5, 8.0])
    edges[100, 101] = 1.0  # another component
    table = edge_df(spark, edges)
    vertex = rng.choice([x for e in edges for x in e if x < n])
    relieved = {e: w * 0.5 if vertex in e else w for e, w in edges.items()}
    source = min(x for e in edges for x in e)
    with trees.ShortestPaths(table, source) as found:
        before = {r.vertex: (r.dist, r.parent) for r in found.tree().collect()}
        after = found.relieved(vertex, 0.5).collect()
    assert before == brute_paths(edges, source)
    assert {r.vertex: (r.dist, r.parent) for r in after} == brute_paths(relieved, source)
    assert all(r.edge_weight == relieved[min(r.parent, r.vertex), max(r.parent, r.vertex)] for r in after)
    edges[3, 200] = -4.0
    table = edge_df(spark, edges)
    for vertex in (vertex, 3):  # at 3 a negative weight rises
        relieved = {e: w * 0.5 if vertex in e else w for e, w in edges.items()}
        forest = trees.relieved_forest(minimum_spanning_forest(table), table, vertex, 0.5)
        assert {(r.src, r.dst): r.weight for r in forest.collect()} == brute_forest(relieved)


def test_minima_need_no_sort(spark):
    """Picks are aggregated by hash."""
    edges = edge_df(spark, {(1, 2): 1.0, (2, 3): 2.0, (1, 3): 3.0})
    live = edges.selectExpr("src AS a", "dst AS b", "CAST(weight AS BIGINT) AS rank")
    frames = [contraction._ranked_hooks(live), contraction._hooks(live)]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="no vertex"):
        shortest_path_tree(edge_df(spark, {(1, 2): 1.0}), 7)


def test_forest_properties(spark):
    edges = hub_graph(5, lambda r: r.uniform(1, 9))
    df = edge_df(spark, edges)
    forest = as_dict(minimum_spanning_forest(df))
    vertices = {v for e in edges for v in e}
    n_components = len(set(components(vertices, edges).values()))
    assert len(forest) == len(vertices) - n_components
    outside = as_dict(tree_complement(df, edge_df(spark, forest)))
    assert {**outside, **forest} == edges and not set(outside) & set(forest)
    halved = edge_df(spark, {e: w * 0.5 for e, w in edges.items()})
    assert set(as_dict(minimum_spanning_forest(halved))) == set(forest)
    tree = as_edges(shortest_path_tree(df, 100))
    own = {e: w for e, w in forest.items() if e[0] >= 100}
    assert sum(own.values()) <= sum(as_dict(tree).values()) + 1e-9
