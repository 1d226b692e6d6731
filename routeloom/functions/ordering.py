"""Global positions and running totals without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeloom.workspace import freeze

#: monotonically_increasing_id() keeps the row number of a partition in its low 33 bits.
ROW_BITS = 33


def ranged(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows sorted across range partitions, stored with their partition and position."""
    rows = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_spot", F.monotonically_increasing_id())
    )
    return (
        freeze(rows, "ranged")
        .withColumn("_part", F.shiftright("_spot", ROW_BITS))
        .withColumn("_pos", F.col("_spot").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("_spot")
    )


def dense_index(df: DataFrame, order: list[Column | str], index: str = "index") -> DataFrame:
    """Number all rows 1..n in the given order.

    Each range partition numbers its own rows; only one count per partition
    is summed up front, and that table is as small as the number of tasks.
    """
    rows = ranged(df, order)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    return rows.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_pos") + 1).alias(index)
    )


def running_sums(
    df: DataFrame, order: list[Column | str], sums: dict[str, str]
) -> DataFrame:
    """Add inclusive running sums over the given order; ``sums`` maps column to new name.

    Ordering keys should be unique, so that range partitions stay even.
    """
    rows = ranged(df, order)
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    starts = totals.select(
        "_part",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_s_{c}") for c in sums],
    )
    summed = rows.select("*", *[F.sum(c).over(inside).alias(f"_r_{c}") for c in sums])
    return summed.join(F.broadcast(starts), "_part").select(
        *df.columns,
        *[(F.col(f"_s_{c}") + F.col(f"_r_{c}")).alias(name) for c, name in sums.items()],
    )
