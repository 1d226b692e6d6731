"""What lies outside a tree, the bottleneck there, and the effect of relieving it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.operators.trees import as_edges
from routeloom.sources.flights import check_factor


def tree_complement(edges: DataFrame, tree: DataFrame) -> DataFrame:
    """Edges of the graph that the tree does not use."""
    return edges.join(as_edges(tree).select("src", "dst"), ["src", "dst"], "left_anti")


def complement_strength(complement: DataFrame) -> DataFrame:
    """Total weight of the edges at each vertex."""
    ends = F.explode(F.array("src", "dst")).alias("vertex")
    return complement.select(ends, "weight").groupBy("vertex").agg(
        F.sum("weight").alias("total")
    )


def bottleneck(strength: DataFrame) -> DataFrame:
    """The vertex with the largest total (the smaller id on a tie); no row for no edges."""
    return strength.orderBy(F.desc("total"), F.asc("vertex")).limit(1)


def scale_vertex(edges: DataFrame, worst: DataFrame, factor: float) -> DataFrame:
    """Multiply the weight of every edge at the vertex of the one-row table ``worst``."""
    check_factor(factor)
    at_src = F.broadcast(worst.select(F.col("vertex").alias("src"), F.lit(True).alias("_s")))
    at_dst = F.broadcast(worst.select(F.col("vertex").alias("dst"), F.lit(True).alias("_d")))
    touched = F.coalesce("_s", "_d", F.lit(False))
    scaled = F.when(touched, F.col("weight") * F.lit(float(factor))).otherwise(F.col("weight"))
    return (
        edges.join(at_src, "src", "left")
        .join(at_dst, "dst", "left")
        .select("src", "dst", scaled.alias("weight"))
    )


def tree_weight(tree: DataFrame) -> DataFrame:
    """Sum of the edge weights of a tree."""
    return as_edges(tree).agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total"))


def tree_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Edges of two trees as ``(src, dst, status, weight_before, weight_after)``."""
    old = as_edges(before).withColumnRenamed("weight", "weight_before")
    new = as_edges(after).withColumnRenamed("weight", "weight_after")
    was, now = F.col("weight_before"), F.col("weight_after")
    status = (
        F.when(was.isNull(), "added")
        .when(now.isNull(), "removed")
        .when(was == now, "kept")
        .otherwise("reweighted")
    )
    return old.join(new, ["src", "dst"], "full_outer").select(
        "src", "dst", status.alias("status"), "weight_before", "weight_after"
    )
