"""Values that hold a given share of the rows, exactly, and quantiles within a given error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.workspace import freeze, releasing

#: The smallest share that the counters of the first pass can be asked for.
LEAST_SUPPORT = 1e-4


@releasing("items")
def frequent_items(df: DataFrame, columns: list[str], support: float) -> DataFrame:
    """All values that at least ``support`` of a column's values are: ``(column, item, n)``.

    The first pass keeps ``1 / support`` counters per column and task, which are merged and miss
    no such value; the second counts these candidates exactly.  There are at most ``1 / support`` a
    column, which bounds the table that is broadcast, and a value that many rows hold is counted
    where they are.  Items are strings; NULL is no value and takes no part in the share.
    """
    if not LEAST_SUPPORT <= support <= 1:
        raise ValueError(f"support must be from {LEAST_SUPPORT} to 1, not {support}")
    texts = df.select([F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    counters = texts.freqItems(texts.columns, support)
    likely = freeze(
        counters.select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(f"c{i}_freqItems").alias("items"))
                for i, c in enumerate(columns)
            ]))
        ).select("column", F.explode("items").alias("item"), F.lit(True).alias("likely")),
        "likely",
    )
    values = texts.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("item"))
            for i, c in enumerate(columns)
        ]))
    ).where("item IS NOT NULL")
    found = values.join(F.broadcast(likely.where("item IS NOT NULL")), ["column", "item"], "left")
    counts = freeze(
        found.groupBy("column", F.expr("if(likely, item, NULL) AS item")).agg(
            F.count("*").alias("n")
        ),
        "counts",
    )
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return (
        counts.join(totals, "column")
        .where(F.col("item").isNotNull() & (F.col("n") >= F.col("total") * support))
        .select("column", "item", "n")
    )


def quantile_ranks(
    df: DataFrame, column: str, probabilities: list[float], error: float = 0.001
) -> DataFrame:
    """Quantiles whose ranks are off by at most ``error`` of the rows, with their true ranks.

    Returns ``(probability, value, below, up_to, n)``: how many values are smaller, how many are
    not larger, and how many there are (NULL and NaN left out).
    """
    value = F.col(f"`{column}`").cast("double").alias("value")
    rows = df.select(value).where(F.col("value").isNotNull() & ~F.isnan("value"))
    found = rows.approxQuantile("value", probabilities, error)
    counts = [F.count("*").alias("n")]
    for k, q in enumerate(found):
        counts += [F.count_if(F.col("value") < q).alias(f"b{k}")]
        counts += [F.count_if(F.col("value") <= q).alias(f"u{k}")]
    quantiles = [
        F.struct(
            F.lit(float(p)).alias("probability"), F.lit(q).alias("value"),
            F.col(f"b{k}").alias("below"), F.col(f"u{k}").alias("up_to"), F.col("n"),
        )
        for k, (p, q) in enumerate(zip(probabilities, found))
    ]
    if not quantiles:  # no rows
        schema = "probability double, value double, below bigint, up_to bigint, n bigint"
        return df.sparkSession.createDataFrame([], schema)
    return rows.agg(*counts).select(F.inline(F.array(*quantiles)))
