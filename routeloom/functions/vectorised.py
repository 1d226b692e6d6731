"""Functions over Arrow batches, arranged so that no group has to fit in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.LongType())
def multiply(a: pa.Array, b: pa.Array) -> pa.Array:
    """Product of whole numbers; NULL stays NULL, and an overflow fails the query."""
    return pc.multiply_checked(a.cast(pa.int64()), b.cast(pa.int64()))


def grouped_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean of ``value`` per ``key`` as ``(key, mean)``, with a group for NULL keys.

    Arrow sums each batch; Spark adds up the batch sums.  A group may spread
    over all tasks.
    """

    def batch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by("_key").aggregate(
                [("_value", "sum"), ("_value", "count")]
            )
            yield from sums.select(["_key", "_value_sum", "_value_count"]).to_batches()

    fields = [
        T.StructField("_key", df.schema[key].dataType),
        T.StructField("_value_sum", T.DoubleType()),
        T.StructField("_value_count", T.LongType()),
    ]
    rows = df.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("_value"))
    sums = rows.mapInArrow(batch_sums, T.StructType(fields))
    return sums.groupBy(F.col("_key").alias(key)).agg(
        F.try_divide(F.sum("_value_sum"), F.sum("_value_count")).alias("mean")
    )


def with_group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row with the mean of its group, as an unbounded window would give it.

    Unlike a window, a join spreads the rows of a large group over several tasks.
    """
    means = df.groupBy(F.col(key).alias("_key")).agg(F.avg(value).alias("mean"))
    return df.join(means, df[key].eqNullSafe(means["_key"]), "left").drop("_key")


def centred(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row with its group's mean taken off ``value``."""
    around = with_group_mean(df, key, value)
    return around.withColumn(value, F.col(value) - F.col("mean")).drop("mean")
