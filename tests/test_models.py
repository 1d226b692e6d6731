"""Fitted models on small data with a known answer."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.operators import best_items, features, models
from routeloom.sources.formats import bucketed, drop_table


@pytest.fixture(scope="module")
def blobs(spark):
    r = random.Random(1)
    places = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    rows = [(i, [x + r.uniform(-1, 1), y + r.uniform(-1, 1)]) for i, (x, y) in enumerate(places * 20)]
    return spark.createDataFrame(rows, "id bigint, v array<double>"), rows


@pytest.mark.parametrize("learn", [models.kmeans, models.bisecting_kmeans])
def test_clusters(blobs, learn):
    df, rows = blobs
    found = learn(df, "v", 3).collect()
    assert sorted(r["size"] for r in found) == [20, 20, 20]
    nearest = [min(math.dist(v, c["center"]) for c in found) for _, v in rows]
    assert max(nearest) < 2
    assert found[0]["cost"] == pytest.approx(sum(d * d for d in nearest))


def test_recommender(spark):
    r = random.Random(2)
    likes = [(u, i, 5.0 if u % 2 == i % 2 else 1.0) for u in range(12) for i in range(12) if r.random() < 0.9]
    rows = spark.createDataFrame(likes, "user int, item int, rating double")
    found = models.Recommender(rows, rank=2, rounds=10, reg=0.01)
    error = found.error().first()
    assert error["rmse"] < 0.5 and 0 < error["n"] < len(likes)
    best = found.for_users(3).collect()
    assert len(best) == 36 and all(x["user"] % 2 == x["item"] % 2 for x in best)
    for user in range(12):
        ratings = [x["rating"] for x in sorted(best, key=lambda x: x["place"]) if x["user"] == user]
        assert ratings == sorted(ratings, reverse=True)
    assert found.for_items(2).count() == 24
    some = spark.createDataFrame([(3,)], "user int")
    assert {x["user"] for x in found.for_users(2, some).collect()} == {3}


def test_long_and_text_ids(spark):
    likes = [(u * 10**12, f"i{i:02}", 5.0 if u % 2 == i % 2 else 1.0) for u in range(8) for i in range(8)]
    rows = spark.createDataFrame(likes + [(None, "i01", 1.0)], "user bigint, item string, rating double")
    found = models.Recommender(rows, rank=2, rounds=8, reg=0.01)
    best = found.for_users(2).collect()
    assert {x["user"] for x in best} == {u * 10**12 for u in range(8)}
    assert all(x["user"] // 10**12 % 2 == int(x["item"][1:]) % 2 for x in best)
    assert {x["user"] for x in found.for_items(1).collect()} <= {u * 10**12 for u in range(8)}


@pytest.mark.parametrize("flat", [False, True])
def test_best_items_equal_full_scoring(spark, monkeypatch, flat):
    """The same lists as scoring all pairs, ties included, from far fewer scores."""
    monkeypatch.setattr(best_items, "HEAD", 16)
    monkeypatch.setattr(best_items, "BLOCK", 32)
    monkeypatch.setattr(best_items, "GROUP", 20)
    rng = np.random.default_rng(3)
    users = rng.standard_normal((60, 6)) * (np.ones(6) if flat else [4, 2, 1, 0.3, 0.2, 0.1])
    items = np.repeat(rng.standard_normal((400, 6)), 2, axis=0)  # every item twice: ties
    items *= rng.lognormal(0, 0.0 if flat else 0.7, 800)[:, None].round(1)
    items[:3] = 0
    frames = [
        spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, features array<float>")
        for m in (users, items)
    ]
    search = best_items.BestItems(*frames, k=5)
    got = {}
    for r in search.best().orderBy("user", "place").collect():
        got.setdefault(r["user"], []).append((r["item"], r["score"]))
    u, v = users.astype(np.float32).astype(float), items.astype(np.float32).astype(float)
    for i in range(60):
        scores = best_items._scores(u[i][None], v)
        want = sorted(range(800), key=lambda j: (-scores[j], j))[:5]
        assert [j for j, _ in got[i]] == want
        assert [s for _, s in got[i]] == pytest.approx(list(scores[want]))
    cost = search.cost().first()
    assert cost["pairs"] == 48_000 and (flat or cost["scored"] < 0.2 * cost["pairs"])


@pytest.mark.parametrize("leading", [2, 16])
def test_best_items_of_equal_lengths(spark, monkeypatch, leading):
    """Directions alone leave few pairs to score; users without a direction take the first ids."""
    sizes = {"HEAD": 16, "BLOCK": 700, "GROUP": 150, "LEADING": leading}
    for name, value in sizes.items():
        monkeypatch.setattr(best_items, name, value)
    rng = np.random.default_rng(5)
    users = rng.standard_normal((300, 4)) * [3, 2, 0.1, 0.1]
    users[:2] = 0
    items = rng.standard_normal((3000, 4))
    items /= np.sqrt((items * items).sum(axis=1))[:, None]
    frames = [
        spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, features array<float>")
        for m in (users, items)
    ]
    search = best_items.BestItems(*frames, k=3)
    got = {}
    for r in search.best().orderBy("user", "place").collect():
        got.setdefault(r["user"], []).append(r["item"])
    u, v = users.astype(np.float32).astype(float), items.astype(np.float32).astype(float)
    for i in range(300):
        scores = best_items._scores(u[i][None], v)
        assert got[i] == sorted(range(3000), key=lambda j: (-scores[j], j))[:3]
    cost = search.cost().first()
    assert cost["pairs"] == 900_000 and cost["scored"] < 0.05 * cost["pairs"]


def test_many_equal_scores_keep_the_smallest_ids(monkeypatch):
    """More pairs than a task keeps, all equal."""
    monkeypatch.setattr(best_items, "KEPT", 100)
    monkeypatch.setattr(best_items, "TILE", 32)
    users, ids = np.ones((70, 2)), np.arange(500)[::-1].copy()
    row, item, score, scored = best_items._better(users, np.ones(70), np.ones((500, 2)), ids, 4, None)
    assert sorted(zip(row.tolist(), item.tolist())) == [(r, i) for r in range(70) for i in range(4)]
    assert set(score.tolist()) == {2.0} and scored.tolist() == [500] * 70


def test_few_or_no_items(spark):
    schema = "id int, features array<float>"
    one = spark.createDataFrame([(7, [1.0, 2.0]), (9, [0.0, 1.0])], schema)
    none = spark.createDataFrame([], schema)
    rows = best_items.BestItems(one, one, 5).best().orderBy("user", "place").collect()
    assert [(r["user"], r["item"], r["score"]) for r in rows] == [(7, 7, 5.0), (7, 9, 2.0), (9, 7, 2.0), (9, 9, 1.0)]
    assert best_items.BestItems(none, one, 5).best().count() == 0
    assert best_items.BestItems(one, none, 5).best().count() == 0


@pytest.fixture(scope="module")
def steps(spark):
    rows = [("hi" if i % 10 > 5 else "lo", float(i % 10), "a" if i % 3 else "b", 7.0 * (i % 10 > 5)) for i in range(200)]
    return spark.createDataFrame(rows, "label string, x double, c string, y double")


@pytest.mark.parametrize("trees", [1, 3])
def test_tree_and_forest(steps, trees):
    result = models.accuracy(models.tree_classifier(steps, "label", ["x"], ["c"], trees)).first()
    assert result["accuracy"] == 1.0 and 20 < result["n"] < 120


def test_regression_tree(steps):
    assert models.tree_regressor(steps, "y", ["x"], ["c"]).first()["rmse"] == pytest.approx(0.0)


@pytest.mark.parametrize("kind", ["logistic", "svm"])
def test_linear_classifiers(steps, kind):
    rows = steps.withColumn("good", (F.col("label") == "hi").cast("int"))
    areas = models.score_areas(models.binary_scores(rows, "good", ["x"], kind)).first()
    assert areas["roc_area"] == pytest.approx(1.0) and areas["pr_area"] == pytest.approx(1.0)


def test_survival(spark):
    r = random.Random(3)
    rows = [(i, math.exp(1 + 0.5 * (i % 2)) * r.expovariate(1.0) + 1e-6, 1.0, float(i % 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, time double, seen double, x double")
    fitted = models.Survival(df, "time", "seen", ["x"], [0.2, 0.8])
    terms = {t["term"]: t["value"] for t in fitted.terms().collect()}
    assert terms["x"] == pytest.approx(0.5, abs=0.25) and terms["scale"] == pytest.approx(1, abs=0.2)
    got = fitted.predicted("id").collect()
    assert len(got) == 600 and all(0 < p["quantiles"][0] < p["quantiles"][1] for p in got)
    expected = math.exp(terms["intercept"] + terms["x"])
    assert {round(p["prediction"], 6) for p in got if p["id"] % 2} == {round(expected, 6)}


def test_text_search(spark):
    rows = [(i, f"{'good fine' if i % 2 else 'bad poor'} words number{i % 7}", i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "id bigint, text string, label int")
    search = models.TextSearch(df, "text", "label")
    settings = search.settings().collect()
    assert len(settings) == 4 and max(s["area"] for s in settings) == pytest.approx(1.0)
    assert all(s["best"] == (s["area"] == max(t["area"] for t in settings)) for s in settings)
    more = spark.createDataFrame([(1, "fine good"), (2, "poor"), (3, None)], "id bigint, text string")
    got = {p["id"]: p["predicted"] for p in search.predicted(more, "id").collect()}
    assert got[1] == 1 and got[2] == 0 and len(got) == 3


def test_selection_and_hashing(spark):
    r = random.Random(4)
    rows = [(str(i % 2), float(i % 2), float(r.randint(0, 3)), float(i % 4 // 2)) for i in range(120)]
    df = spark.createDataFrame(rows, "label string, told double, noise double, other double")
    chosen = models.chi_square_select(df, "label", ["noise", "told", "other"], 1)
    assert {x["names"] for x in chosen.collect()} == {"told"}
    assert all(x["kept"] == [float(x["label"])] for x in chosen.collect())
    hashed = features.hash_features(df, ["noise", "label"], 16).collect()
    assert all(sum(x["features"].values) == x["noise"] + 1 for x in hashed)


def test_partitioned_buckets(spark):
    df = spark.range(200).selectExpr("id", "id % 3 AS part")
    name = bucketed(df, ["id"], 4, ["id"], ["part"])
    try:
        table = spark.table(name)
        assert sorted(tuple(x) for x in table.select("id", "part").collect()) == [(i, i % 3) for i in range(200)]
        plan = table.where("part = 1").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "PartitionFilters: [isnotnull(part" in plan
    finally:
        drop_table(spark, name)
