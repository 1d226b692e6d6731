import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from routeloom.functions.ordering import dense_index, running_sums
from routeloom.functions.skew import lookup_join
from routeloom.functions.vectorised import centred, grouped_mean, multiply, with_group_mean
from routeloom.workspace import freeze, new_path


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_hot_keys(spark, how):
    rows = [(0, i) for i in range(400)] + [(k, k) for k in range(1, 300)] + [(None, 7)] * 300
    left = freeze(spark.createDataFrame(rows, "k bigint, x bigint").repartition(4))
    table = {k: str(k) for k in range(0, 300, 2)}
    right = spark.createDataFrame(list(table.items()), "k bigint, name string")
    got = Counter(map(tuple, lookup_join(left, right, "k", how).collect()))
    want = Counter((k, x, table.get(k)) for k, x in rows if how == "left" or k in table)
    assert got == want


@pytest.mark.parametrize("hot", [0, None])
def test_hot_key_is_cut(spark, hot):
    """Adaptive execution cuts the partition of a hot key, NULL too, at every size."""
    rows = spark.range(60_000).selectExpr(
        f"CAST(if(id % 3 = 0, {'NULL' if hot is None else hot}, id) AS BIGINT) AS k", "id AS x"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = freeze(rows.repartition(6))
        right = freeze(spark.range(60_000).withColumnRenamed("id", "k"))
        joined = lookup_join(left, right, "k", "left")
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_lookup_join_refuses_other_joins(spark):
    with pytest.raises(ValueError, match="balance"):
        lookup_join(spark.range(1), spark.range(1), "id", "outer")


def test_group_functions_with_nulls_and_overflow(spark):
    rows = [(1, 2.0), (1, None), (None, 4.0), (None, 8.0), (2, None)]
    df = spark.createDataFrame(rows, "k bigint, v double")
    want = {1: 2.0, None: 6.0, 2: None}
    assert {r["k"]: r["mean"] for r in grouped_mean(df, "k", "v").collect()} == want
    got = with_group_mean(df, "k", "v").collect()
    assert Counter((r["k"], r["v"], r["mean"]) for r in got) == Counter((*r, want[r[0]]) for r in rows)
    middle = centred(df, "k", "v").where("k IS NULL").collect()
    assert sorted(r["v"] for r in middle) == [-2.0, 2.0]
    pairs = spark.createDataFrame([((1 << 53) + 1, 1), (None, 3)], "a bigint, b bigint")
    assert [r[0] for r in pairs.select(multiply("a", "b")).collect()] == [(1 << 53) + 1, None]
    large = spark.createDataFrame([(1 << 62, 4)], "a bigint, b bigint")
    with pytest.raises(Exception, match="overflow"):
        large.select(multiply("a", "b")).collect()


def test_dense_index(spark):
    values = random.Random(1).sample(range(10**6), 5000)
    df = spark.createDataFrame([(v,) for v in values], "id bigint").repartition(16)
    got = {r["id"]: r["index"] for r in dense_index(df, ["id"]).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}
    down = dense_index(df, [F.desc("id")], "place")
    assert {r["id"]: r["place"] for r in down.collect()} == {
        v: i + 1 for i, v in enumerate(sorted(values, reverse=True))
    }


def test_running_sums(spark):
    rows = [(k, k % 7, 1) for k in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, x bigint, y bigint").repartition(8)
    got = {r.k: (r.sx, r.sy) for r in running_sums(df, ["k"], {"x": "sx", "y": "sy"}).collect()}
    total = 0
    for k, x, _ in rows:
        total += x
        assert got[k] == (total, k + 1)


def test_group_means_over_batches(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (2, 5.0), (2, 10.0)], "id int, v double")
    df = df.repartition(4)
    assert {tuple(r) for r in grouped_mean(df, "id", "v").collect()} == {(1, 1.5), (2, 6.0)}
    assert sorted(r.v for r in centred(df, "id", "v").collect()) == [-3.0, -1.0, -0.5, 0.5, 4.0]
    assert sorted(r["mean"] for r in with_group_mean(df, "id", "v").collect()) == [1.5, 1.5, 6, 6, 6]


def test_named_shared_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert new_path(spark, "x").startswith(named)


def test_pandas_there_and_back(spark):
    frame = pd.DataFrame({"x": [1, 2, 3]})
    back = spark.createDataFrame(frame).select("x", multiply("x", "x").alias("y")).toPandas()
    assert back["y"].tolist() == [1, 4, 9]
