"""Parquet tables, and the route tables derived from them.

A route table has the columns ``origin_id``, ``destination_id`` (long) and
``departure_delay`` (double); it stands where a flight file would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routeloom.functions.ordering import ranged
from routeloom.functions.skew import lookup_join


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _shipments(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Line items with the nations they travel between.

    Orders meet their buyers first, so the line items move once for their
    order; those of a supplier that sells a large share do not move for it.
    """
    line = table(spark, folder, "lineitem")
    sellers = table(spark, folder, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
    buyers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders")
    placed = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    sold = lookup_join(line, sellers, "l_suppkey")
    return sold.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("s_nationkey").cast("long").alias("origin_id"),
        F.col("c_nationkey").cast("long").alias("destination_id"),
        *extra,
    )


def nation_routes(spark: SparkSession, folder: str) -> DataFrame:
    """One route per line item, from the supplier's to the customer's nation."""
    return _shipments(spark, folder, "l_quantity").withColumnRenamed(
        "l_quantity", "departure_delay"
    )


def nation_lead_times(spark: SparkSession, folder: str) -> DataFrame:
    """As :func:`nation_routes`, weighing days from order to shipment (may be negative)."""
    days = F.datediff("l_shipdate", "o_orderdate").cast("double")
    return _shipments(spark, folder, "l_shipdate", "o_orderdate").select(
        "origin_id", "destination_id", days.alias("departure_delay")
    )


def user_hops(spark: SparkSession, folder: str) -> DataFrame:
    """A route from the user of each event to the user of the next event that day."""
    return _hops(spark, folder)


def _hops(spark: SparkSession, folder: str, by_day: bool = False) -> DataFrame:
    """Routes between the users of successive events of a day.

    Each range partition of the global order looks ahead in itself; its last
    event meets the first one of the next partition.
    """
    events = table(spark, folder, "events").select("ts", "event_id", "user_id", "value")
    rows = ranged(events, ["ts", "event_id"])
    inside = Window.partitionBy("_part").orderBy("_pos")
    following = F.lead(F.struct("user_id", "ts")).over(inside)
    # one row per range partition
    firsts = rows.where("_pos = 0").select("_part", F.struct("user_id", "ts").alias("_first"))
    heads = firsts.select(
        F.lag("_part").over(Window.orderBy("_part")).alias("_part"), F.col("_first")
    )
    ahead = rows.withColumn("_next", following).join(F.broadcast(heads), "_part", "left")
    ahead = ahead.withColumn("_next", F.coalesce("_next", "_first"))
    day = F.unix_date(F.to_date("ts")).cast("long") * DAY_IDS if by_day else F.lit(0)
    return ahead.where(F.to_date("ts") == F.to_date("_next.ts")).select(
        (day + F.col("user_id")).alias("origin_id"),
        (day + F.col("_next.user_id")).alias("destination_id"),
        F.round(F.col("value") * 100).alias("departure_delay"),
    )


#: Vertices of a day are numbered from the day's number times this.
DAY_IDS = 1 << 32


def daily_hops(spark: SparkSession, folder: str) -> DataFrame:
    """As :func:`user_hops`, with a vertex for each user and day: no route leaves its day."""
    return _hops(spark, folder, by_day=True)


def supplier_part_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Routes between suppliers (even ids) and parts (odd ids)."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_suppkey") * 2).alias("origin_id"),
        (F.col("l_partkey") * 2 + 1).alias("destination_id"),
        F.col("l_quantity").alias("departure_delay"),
    )


def lineitem_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the shape of flight records, some with no arrival."""
    line = table(spark, folder, "lineitem")
    arrived = F.col("l_linestatus") == "F"
    return line.select(
        F.date_format("l_shipdate", "dd").alias("day_of_month"),
        F.dayofweek("l_shipdate").cast("string").alias("day_of_week"),
        F.col("l_returnflag").alias("carrier"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("tail_num"),
        F.col("l_linenumber").alias("flight_num"),
        F.col("l_suppkey").alias("origin_id"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("origin_name"),
        F.col("l_partkey").alias("destination_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("destination_name"),
        F.lit(600.0).alias("scheduled_departure_time"),
        (F.lit(600.0) + F.col("l_quantity")).alias("departure_real_time"),
        F.col("l_quantity").alias("departure_delay"),
        F.lit(900.0).alias("scheduled_arrival_time"),
        F.when(arrived, F.lit(900.0) + F.col("l_quantity")).alias("arrival_real_time"),
        F.when(arrived, F.col("l_quantity")).alias("arrival_delay"),
        F.lit(300.0).alias("elapsed_time"),
        F.col("l_linenumber").alias("distance"),
    )
