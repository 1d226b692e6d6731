"""Graphs as text: one edge per line, and one result per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_edge_list(spark: SparkSession, path: str, canonical: bool = False) -> DataFrame:
    """Directed edges ``(src, dst)`` from lines of two ids with blanks between.

    Empty lines and lines that start with ``#`` are skipped; any other bad line
    fails the query.  ``canonical`` puts the smaller id first.
    """
    lines = spark.read.text(path).where("trim(value) <> '' AND NOT startswith(value, '#')")
    fields = F.split(F.trim("value"), r"\s+")
    bad = F.raise_error(F.concat(F.lit("not an edge: "), F.col("value"))).cast("bigint")

    def end(place: int):
        return F.when(F.size(fields) >= 2, fields[place].cast("bigint")).otherwise(bad)

    edges = lines.select(end(0).alias("src"), end(1).alias("dst"))
    if canonical:
        edges = edges.selectExpr("least(src, dst) AS src", "greatest(src, dst) AS dst")
    return edges


def write_lines(df: DataFrame, path: str, separator: str = "\t") -> None:
    """Write the columns of each row as one line of text."""
    df.select(F.concat_ws(separator, *df.columns)).write.text(path)
