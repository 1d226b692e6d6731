"""The checks of fitted models find nothing in them, and find what is put wrong."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from routeloom import workspace
from routeloom.operators import model_checks, models


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(11)
    out = []
    for i in range(600):
        x, kind = r.randint(0, 40), r.choice("abc")
        label = "yes" if (x > 20) != (r.random() < 0.1) else "no"
        days = 1 + r.expovariate(1 / (5.0 + x))
        out.append((i, float(x), kind, label, x * 3.0 + r.random(), days, r.random() < 0.7))
    names = "id bigint, x double, kind string, label string, target double, days double, seen boolean"
    return spark.createDataFrame(out, names)


def test_clusters(spark):
    r = random.Random(3)
    points = [([c + r.random(), c - r.random()],) for c in (0.0, 10.0, 20.0) for _ in range(30)]
    df = spark.createDataFrame(points, "v array<double>")
    clusters = models.kmeans(df, "v", 3, rounds=100)
    found = model_checks.cluster_faults(df, "v", clusters).collect()
    assert len(found) == 3
    assert not any(f.size_fault or f.centre_fault or f.cost_fault for f in found)
    moved = clusters.withColumn("center", F.transform("center", lambda x: x + 0.01))
    assert all(f.centre_fault for f in model_checks.cluster_faults(df, "v", moved).collect())
    wrong = clusters.withColumns({"size": F.col("size") + 1, "cost": F.col("cost") * 2})
    found = model_checks.cluster_faults(df, "v", wrong).collect()
    assert all(f.size_fault and f.cost_fault and not f.centre_fault for f in found)


def test_factors(spark):
    r = random.Random(4)
    ratings = {(u, i): float(r.randint(1, 5)) for u in range(30) for i in r.sample(range(40), 12)}
    df = spark.createDataFrame(
        [(u, i, x) for (u, i), x in ratings.items()], "user bigint, item bigint, rating double"
    )
    found = models.Recommender(df, rank=4, rounds=3)
    result = model_checks.factor_faults(found).first()
    assert (result.unsolved, result.users) == (0, 30)
    found.reg *= 2
    assert model_checks.factor_faults(found).first().unsolved > 20


def test_ratings_are_stored_once_and_summed_by_user(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path))
    r = random.Random(8)
    likes = [(u, i, float(r.randint(1, 5))) for u in range(20) for i in range(30)]
    found = models.Recommender(spark.createDataFrame(likes, "user int, item int, rating double"), 3, 2)
    stored = [x.name.split("-")[0] for x in (tmp_path / "routeloom").iterdir()]
    assert stored.count("ratings") == 1 and stored.count("names") == 2
    assert model_checks.factor_faults(found).first().users == 20

    monkeypatch.setattr(model_checks, "ROWS", 2)
    rows = pa.table(
        {
            "user_number": pa.array([4, 4, 4, 7], pa.int32()),
            "rating": pa.array([2.0, 3.0, 5.0, 1.0]),
            "v": pa.array([[1.0, 0.0], [0.0, 2.0], [1.0, 1.0], [0.0, -1.0]], pa.list_(pa.float32())),
            "u": pa.array([[1.0, 1.0]] * 3 + [[2.0, 0.0]], pa.list_(pa.float32())),
        }
    )
    sums = [x for batch in model_checks._pulls(rows.to_batches()) for x in batch.to_pylist()]
    assert [(x["user_number"], x["n"], x["u"], x["pull"], x["scale"]) for x in sums] == [
        (4, 2, [1.0, 1.0], [1.0, 2.0], [2.0, 6.0]),
        (4, 1, [1.0, 1.0], [3.0, 3.0], [5.0, 5.0]),
        (7, 1, [2.0, 0.0], [0.0, -1.0], [0.0, 1.0]),
    ]


def test_leaves(rows):
    model, training, _ = models.fit_tree_regressor(rows, "target", ["x"], ["kind"])
    result = model_checks.regression_leaf_faults(model, training).first()
    assert (result.faults, result.rows) == (0, training.count())
    raised = training.withColumn("target", F.col("target") + F.col("x") * 0.1)
    assert model_checks.regression_leaf_faults(model, raised).first().faults > 0

    model, training, _ = models.fit_tree_classifier(rows, "label", ["x"], ["kind"])
    result = model_checks.class_leaf_faults(model, training, "label_index").first()
    assert (result.faults, result.rows) == (0, training.count())
    swapped = training.withColumn("label", F.when(F.col("x") > 30, "no").otherwise(F.col("label")))
    assert model_checks.class_leaf_faults(model, swapped, "label_index").first().faults > 0


def test_survival(rows):
    fitted = models.Survival(rows, "days", "seen", ["x"], [0.25, 0.75])
    result = model_checks.survival_faults(fitted).first()
    assert (result.faults, result.rows, result.balanced) == (0, 600, True)
    fitted.quantiles = [0.3, 0.75]
    fitted.points = fitted.points.withColumn("label", F.col("label") * 2)
    result = model_checks.survival_faults(fitted).first()
    assert (result.faults, result.balanced) == (600, False)
