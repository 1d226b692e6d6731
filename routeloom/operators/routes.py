"""From route records to a weighted undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.functions.ordering import dense_index
from routeloom.functions.skew import lookup_join
from routeloom.workspace import freeze


def vertices(routes: DataFrame) -> DataFrame:
    """Every place that is an origin or a destination, once."""
    ends = F.explode(F.array("origin_id", "destination_id"))
    return routes.select(ends.alias("id")).distinct()


def vertex_index(ids: DataFrame) -> DataFrame:
    """Dense 1-based positions in id order."""
    return dense_index(ids.select("id"), ["id"], "index")


def average_edges(routes: DataFrame, distinct: bool = True) -> DataFrame:
    """Mean delay of each unordered pair as ``edges(src, dst, weight)``, ``src < dst``.

    ``distinct`` counts a delay once per pair, however often and in whichever
    direction it was flown; otherwise every record counts.  Routes from a place
    to itself give no edge.
    """
    pairs = routes.filter("origin_id <> destination_id").select(
        F.least("origin_id", "destination_id").alias("src"),
        F.greatest("origin_id", "destination_id").alias("dst"),
        F.col("departure_delay").alias("delay"),
    )
    if distinct:
        pairs = pairs.distinct()
    return pairs.groupBy("src", "dst").agg((F.sum("delay") / F.count("delay")).alias("weight"))


def paired_delays_sql(spark: SparkSession, routes: DataFrame) -> DataFrame:
    """Distinct delays of each pair, kept in one direction, by SQL over a temporary view.

    The ``NOT EXISTS`` branch keeps a pair whose reverse is missing; as every
    record counts in both directions, it never adds a row.  Pairs are compared
    once each, however many delays they have.
    """
    routes.select("origin_id", "destination_id", "departure_delay").createOrReplaceTempView(
        "routeloom_delays"
    )
    return spark.sql(
        """
        WITH both_ways AS (
            SELECT DISTINCT way.origin_id, way.destination_id, departure_delay
            FROM routeloom_delays LATERAL VIEW inline(array(
                struct(origin_id AS origin_id, destination_id AS destination_id),
                struct(destination_id AS origin_id, origin_id AS destination_id)
            )) way AS origin_id, destination_id
        ),
        pairs AS (SELECT DISTINCT origin_id, destination_id FROM both_ways),
        kept AS (
            SELECT p.origin_id, p.destination_id FROM pairs p
            WHERE p.origin_id < p.destination_id
               OR NOT EXISTS (
                    SELECT 1 FROM pairs r
                    WHERE r.origin_id = p.destination_id AND r.destination_id = p.origin_id))
        SELECT t.origin_id, t.destination_id, t.departure_delay
        FROM both_ways t
        LEFT SEMI JOIN kept k
          ON t.origin_id = k.origin_id AND t.destination_id = k.destination_id
        """
    )


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, in one pass."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    forward = F.struct("src", "dst", *rest)
    backward = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)
    return edges.select(F.inline(F.array(forward, backward)))


def adjacency(edges: DataFrame, index: DataFrame) -> DataFrame:
    """The adjacency matrix as rows, with the dense positions of both ends."""
    edges = freeze(edges, "edges")
    n_edges = edges.count()
    origin = index.select(F.col("id").alias("src"), F.col("index").alias("origin_index"))
    target = index.select(F.col("id").alias("dst"), F.col("index").alias("destination_index"))
    numbered = lookup_join(edges, origin, "src")
    numbered = freeze(numbered, "numbered")
    numbered = lookup_join(numbered, target, "dst")
    forward = F.struct(
        "origin_index",
        F.col("src").alias("origin_id"),
        "destination_index",
        F.col("dst").alias("destination_id"),
        "weight",
    )
    backward = F.struct(
        F.col("destination_index").alias("origin_index"),
        F.col("dst").alias("origin_id"),
        F.col("origin_index").alias("destination_index"),
        F.col("src").alias("destination_id"),
        "weight",
    )
    return numbered.select(F.inline(F.array(forward, backward)))


def default_source(edges: DataFrame) -> DataFrame:
    """One row: the smallest vertex that has an edge."""
    return edges.agg(F.min(F.least("src", "dst")).alias("vertex"))


def unreached_neighbors(ids: DataFrame, edges: DataFrame, start: int) -> DataFrame:
    """Vertices other than ``start`` that no edge joins to it."""
    touching = edges.filter((F.col("src") == start) | (F.col("dst") == start)).select(
        F.when(F.col("src") == start, F.col("dst")).otherwise(F.col("src")).alias("id")
    )
    return ids.filter(F.col("id") != start).join(touching, "id", "left_anti")
