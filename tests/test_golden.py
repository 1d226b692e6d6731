"""The six-place example, worked by hand."""

import pytest
from pyspark.sql import functions as F

from routeloom.operators.analysis import (
    bottleneck,
    complement_strength,
    scale_vertex,
    tree_complement,
    tree_diff,
    tree_weight,
)
from routeloom.operators.routes import adjacency, average_edges, vertex_index, vertices
from routeloom.operators.trees import (
    minimum_spanning_forest,
    reference_rows,
    shortest_path_tree,
)
from routeloom.plans.delay_report import delay_report
from routeloom.plans.flight_job import analyse_flights, choose_factor

FLIGHTS = [
    (10721, 12892, 1.0), (10721, 12892, 2.0), (10721, 12892, 3.0), (12478, 10721, 4.0),
    (12892, 10721, 50.0), (12478, 13930, 6.0), (13930, 12478, 7.0), (12478, 13930, 8.0),
    (33333, 13930, 100.0), (33333, 44444, 800.0), (12478, 12892, 20.0), (10721, 33333, 5.0),
    (33333, 12478, 15.0), (44444, 13930, 300.0),
]
EDGES = {
    (1, 2): 4.0, (1, 3): 14.0, (1, 5): 5.0, (2, 3): 20.0, (2, 4): 7.0,
    (2, 5): 15.0, (4, 5): 100.0, (4, 6): 300.0, (5, 6): 800.0,
}
FACTOR = 0.42913216


def routes_df(spark, rows):
    return spark.createDataFrame(
        rows, "origin_id bigint, destination_id bigint, departure_delay double"
    )


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(a, b, w) for (a, b), w in EDGES.items()]
    return spark.createDataFrame(rows, "src bigint, dst bigint, weight double").cache()


def as_dict(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


def test_edges_from_flights(spark):
    routes = routes_df(spark, FLIGHTS)
    index = vertex_index(vertices(routes))
    assert {r["id"]: r["index"] for r in index.collect()} == {
        10721: 1, 12478: 2, 12892: 3, 13930: 4, 33333: 5, 44444: 6,
    }
    rows = adjacency(average_edges(routes), index)
    got = {(r.origin_index, r.destination_index): r.weight for r in rows.collect()}
    both = {**EDGES, **{(b, a): w for (a, b), w in EDGES.items()}}
    assert got == both


def test_distinct_mean_counts_a_delay_once(spark):
    routes = routes_df(spark, [*FLIGHTS, (10721, 12892, 1.0)])
    once = {(r.src, r.dst): r.weight for r in average_edges(routes).collect()}
    every = {(r.src, r.dst): r.weight for r in average_edges(routes, False).collect()}
    assert once[(10721, 12892)] == 14.0
    assert every[(10721, 12892)] == pytest.approx(11.4)


def test_same_delay_in_both_directions_counts_once(spark):
    routes = routes_df(spark, [(1, 2, 10.0), (2, 1, 10.0), (1, 2, 4.0), (7, 7, 3.0)])
    assert as_dict(average_edges(routes)) == {(1, 2): 7.0}
    assert {r.id for r in vertices(routes).collect()} == {1, 2, 7}


def test_shortest_path_tree(edges):
    tree = shortest_path_tree(edges, 5, keep_unreached=True)
    got = {(r[0], r[1]): r[2] for r in reference_rows(tree, 5).collect()}
    assert got == {
        (5, 5): 0.0, (5, 1): 5.0, (1, 2): 9.0, (2, 4): 16.0, (1, 3): 19.0, (4, 6): 316.0,
    }


def test_spanning_tree_and_bottleneck(edges):
    tree = minimum_spanning_forest(edges)
    assert as_dict(tree) == {
        (1, 2): 4.0, (1, 5): 5.0, (2, 4): 7.0, (1, 3): 14.0, (4, 6): 300.0,
    }
    assert tree_weight(tree).first().total == 330.0
    outside = tree_complement(edges, tree)
    assert set(as_dict(outside)) == {(2, 3), (2, 5), (4, 5), (5, 6)}
    strength = complement_strength(outside)
    assert {r.vertex: r.total for r in strength.collect()} == {
        5: 915.0, 6: 800.0, 4: 100.0, 2: 35.0, 3: 20.0,
    }
    assert tuple(bottleneck(strength).first()) == (5, 915.0)


@pytest.mark.parametrize("mode", ["mst", "spt"])
def test_report(spark, edges, mode):
    factor = spark.range(1).select(F.lit(FACTOR).cast("float").cast("double")).first()[0]
    report = delay_report(edges, factor, mode, 5)
    assert tuple(report.worst.first()) == (5, 915.0)
    diff = {(r.src, r.dst): r for r in report.diff.collect()}
    assert {k: r.status for k, r in diff.items()} == {
        (1, 2): "kept", (1, 3): "kept", (1, 5): "reweighted", (2, 4): "kept", (4, 6): "kept",
    }
    assert diff[(1, 5)].weight_after == 2.1456608176231384
    if mode == "spt":
        dist = {(r.parent, r.vertex): r.dist for r in report.after.collect()}
        assert dist == {
            (5, 1): 2.1456608176231384,
            (1, 2): 6.145660817623138,
            (2, 4): 13.145660817623138,
            (1, 3): 16.14566081762314,
            (4, 6): 313.14566081762314,
        }
    else:
        assert tree_weight(report.after).first().total == pytest.approx(327.14566081762314)


def test_scaling_leaves_other_edges(edges, spark):
    worst = spark.createDataFrame([(3, 1.0)], "vertex bigint, total double")
    scaled = as_dict(scale_vertex(edges, worst, 0.5))
    assert scaled == {k: w * 0.5 if 3 in k else w for k, w in EDGES.items()}


def test_removed_and_added_edges_show_in_the_diff(spark):
    before = spark.createDataFrame([(1, 2, 1.0), (2, 3, 2.0)], "src long, dst long, weight double")
    after = spark.createDataFrame([(1, 2, 1.0), (1, 3, 0.5)], "src long, dst long, weight double")
    got = {(r.src, r.dst): r.status for r in tree_diff(before, after).collect()}
    assert got == {(1, 2): "kept", (2, 3): "removed", (1, 3): "added"}


@pytest.mark.parametrize("mode", ["mst", "spt"])
def test_from_file_to_report(spark, tmp_path, mode):
    path = tmp_path / "flights.csv"
    lines = [
        f"1,2,AA,N1,12,{a},A,{b},B,600,605,{delay},900,,,300,77" for a, b, delay in FLIGHTS
    ]
    path.write_text("\n".join(lines) + "\n")
    index, report = analyse_flights(spark, str(path), 0.5, mode, source=33333)
    assert index.count() == 6
    rows = report.rows().collect()
    totals = {r.section: r.value for r in rows if r.section.startswith("total")}
    assert totals == {"total_before": 330.0, "total_after": 327.5}
    assert [(r.src, r.value) for r in rows if r.section == "bottleneck"] == [(33333, 915.0)]


def test_factor_choice():
    assert choose_factor(0.25) == 0.25
    assert 0 < choose_factor(None, 7) == choose_factor(None, 7) < 1
    with pytest.raises(ValueError):
        choose_factor(1.0)
