"""Statistics over table columns: correlation, independence, similarity, curves."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.functions.ordering import running_sums
from routeloom.functions.skew import lookup_join
from routeloom.workspace import freeze


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as ``(a, b, corr)``, in one pass."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*entries)))


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """Rank of every distinct value, equal values sharing the mean of their places."""
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    upto = running_sums(counts, [column], {"_n": "_upto"})
    place = F.col("_upto") - (F.col("_n") - 1) / F.lit(2.0)
    return upto.select(column, place.alias(f"rank_{column}"))


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spearman rank correlation of every pair of columns as ``(a, b, corr)``.

    A value is ranked among all values of its column; as for :func:`pearson`, a row counts for
    the pairs of which it has both values.  Distinct values are ranked, so a value that fills a
    third of the rows costs no more than any other.
    """
    rows = freeze(df.select(*columns), "values")
    ranked = rows
    for column in columns:
        ranks = average_ranks(rows.where(F.col(column).isNotNull()), column)
        ranked = lookup_join(ranked, ranks, column, "left")
    renamed = ranked.select(*[F.col(f"rank_{c}").alias(c) for c in columns])
    return pearson(renamed, columns)


def contingency(df: DataFrame, label: str, features: dict[str, Column]) -> DataFrame:
    """Counts ``(feature, value, label, n)`` of all features in one pass."""
    entries = [
        F.struct(F.lit(name).alias("feature"), value.cast("string").alias("value"))
        for name, value in features.items()
    ]
    return (
        df.select(F.col(label).cast("string").alias("label"), F.inline(F.array(*entries)))
        .groupBy("feature", "value", "label")
        .agg(F.count("*").alias("n"))
    )


def _join_equal(cells: DataFrame, sums: DataFrame, column: str) -> DataFrame:
    """Join on the feature and a column that may be NULL on both sides."""
    sums = sums.withColumnsRenamed({"feature": "_feature", column: "_value"})
    same = (F.col("feature") == F.col("_feature")) & F.col(column).eqNullSafe(F.col("_value"))
    return cells.join(sums, same).drop("_feature", "_value")


def chi_square(df: DataFrame, label: str, features: dict[str, Column]) -> DataFrame:
    """Independence of each feature and the label: ``(feature, statistic, dof)``.

    NULL is a value, and a label, like any other.
    """
    cells = freeze(contingency(df, label, features), "cells")
    by_value = cells.groupBy("feature", "value").agg(F.sum("n").alias("value_n"))
    by_label = cells.groupBy("feature", "label").agg(F.sum("n").alias("label_n"))
    totals = by_label.groupBy("feature").agg(
        F.sum("label_n").alias("total"), F.count("*").alias("labels")
    )
    expected = F.col("value_n") * F.col("label_n") / F.col("total")
    scored = (
        _join_equal(_join_equal(cells, by_value, "value"), by_label, "label")
        .join(totals, "feature")
        .withColumn("expected", expected)
        .groupBy("feature")
        .agg(
            F.sum(F.pow(F.col("n") - F.col("expected"), 2) / F.col("expected")).alias("seen"),
            F.sum("expected").alias("covered"),
            F.max("total").alias("total"),
            F.max("labels").alias("labels"),
        )
    )
    values = by_value.groupBy("feature").agg(F.count("*").alias("values"))
    # A cell without rows adds its expected count.
    return scored.join(values, "feature").select(
        "feature",
        (F.col("seen") + F.col("total") - F.col("covered")).alias("statistic"),
        ((F.col("values") - 1) * (F.col("labels") - 1)).alias("dof"),
    )


def column_cosine(df: DataFrame, column: str) -> DataFrame:
    """Cosine similarity of every two columns of a vector column: ``(i, j, similarity)``.

    Each task adds its rows up to one Gram matrix; Spark adds the matrices.
    """

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                rows = np.stack(batch[column].to_numpy()).astype("float64")
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"i": i, "j": j, "dot": total[i, j]})

    parts = df.select(column).mapInPandas(gram, "i bigint, j bigint, dot double")
    dots = freeze(parts.groupBy("i", "j").agg(F.sum("dot").alias("dot")), "dots")
    norms = dots.where("i = j").select("i", F.sqrt("dot").alias("norm"))
    of_i = norms.withColumnRenamed("norm", "norm_i")
    of_j = norms.select(F.col("i").alias("j"), F.col("norm").alias("norm_j"))
    return (
        dots.where("i < j")
        .join(of_i, "i")
        .join(of_j, "j")
        .select("i", "j", (F.col("dot") / (F.col("norm_i") * F.col("norm_j"))).alias("similarity"))
    )


def sampled_column_cosine(
    df: DataFrame, column: str, threshold: float, seed: int = 42
) -> DataFrame:
    """Estimate of :func:`column_cosine` from sampled elements, sure only above ``threshold``.

    An element of a column is kept with a chance that falls with the column's length, so long
    columns give no more products than short ones; kept elements are scaled so that the products'
    sum is right on average.  Arrays and sparse or dense vectors are taken.  Each batch adds one
    Gram matrix of its kept elements, and these are added like the exact ones.  A smaller
    ``threshold`` keeps more; 0 keeps all.
    """
    values = F.col(column)
    if isinstance(df.schema[column].dataType, VectorUDT):
        values = vector_to_array(values)
    rows = df.select(values.cast("array<double>").alias("row")).where("row IS NOT NULL")

    def squares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                total = (np.stack(batch["row"].to_numpy()) ** 2).sum(axis=0)
                yield pd.DataFrame({"i": np.arange(len(total)), "square": total})

    sums = rows.mapInPandas(squares, "i bigint, square double").groupBy("i").agg(F.sum("square"))
    lengths = np.sqrt([total for _, total in sorted(tuple(r) for r in sums.collect())])
    reach = np.inf if threshold < 1e-6 else np.sqrt(10 * np.log(max(2, len(lengths))) / threshold)
    scale = np.where(lengths > 0, np.minimum(reach, lengths), 1.0)
    chance = np.divide(reach, lengths, out=np.ones(len(lengths)), where=lengths > 0)

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(lengths), len(lengths)))
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            if len(batch):
                values = np.stack(batch["row"].to_numpy())
                kept = np.where(rng.random(values.shape) < chance, values / scale, 0.0)
                total += kept.T @ kept
        i, j = np.triu_indices(len(lengths), 1)
        some = total[i, j] != 0
        yield pd.DataFrame({"i": i[some], "j": j[some], "part": total[i, j][some]})

    parts = rows.mapInPandas(gram, "i bigint, j bigint, part double")
    return parts.groupBy("i", "j").agg(F.sum("part").alias("similarity"))


def mean_absolute_error(exact: DataFrame, estimate: DataFrame) -> DataFrame:
    """Mean distance of an estimate from exact entries; a missing entry counts as zero."""
    guess = estimate.withColumnRenamed("similarity", "guess")
    error = F.abs(F.col("similarity") - F.coalesce("guess", F.lit(0.0)))
    return exact.join(guess, ["i", "j"], "left").agg(F.avg(error).alias("error"))


def threshold_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """For each score as threshold, how many positives and negatives reach it."""
    steps = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_sums(steps, [F.desc("threshold")], {"pos": "tp", "neg": "fp"})


def threshold_metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Precision, recall, F-measures and false positive rate at every threshold."""
    counts = threshold_counts(scored, score, label)
    totals = scored.agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("q")
    ).first()
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.col("tp") / F.lit(totals["p"])

    def f_measure(beta: float) -> Column:
        b = F.lit(beta * beta)
        hits = (1 + b) * F.col("tp")
        return hits / (hits + b * (F.lit(totals["p"]) - F.col("tp")) + F.col("fp"))

    return counts.select(
        "threshold",
        "pos",
        "neg",
        "tp",
        "fp",
        precision.alias("precision"),
        recall.alias("recall"),
        (F.col("fp") / F.lit(totals["q"])).alias("fall_out"),
        f_measure(1.0).alias("f1"),
        f_measure(0.5).alias("f_half"),
    )


def curve_areas(metrics: DataFrame) -> DataFrame:
    """Areas under the ROC and precision-recall curves, from :func:`threshold_metrics`."""
    earlier_tp = F.col("tp") - F.col("pos")
    earlier_all = F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    # Before the first threshold the precision is taken to be that of the first.
    earlier_precision = F.when(earlier_all == 0, F.col("precision")).otherwise(
        earlier_tp / F.nullif(earlier_all, F.lit(0))
    )
    strips = metrics.select(
        "pos",
        "neg",
        (F.col("neg") * (F.col("tp") + earlier_tp)).alias("roc"),
        (F.col("pos") * (F.col("precision") + earlier_precision)).alias("pr"),
    )
    p, q = F.sum("pos"), F.sum("neg")
    return strips.agg(
        (F.sum("roc") / (2 * p * q)).alias("roc_area"), (F.sum("pr") / (2 * p)).alias("pr_area")
    )


def vector_mean(df: DataFrame, column: str) -> DataFrame:
    """Mean of each position of an array column as ``(position, mean)``."""
    return (
        df.select(F.posexplode(column).alias("position", "x"))
        .groupBy("position")
        .agg((F.sum(F.col("x").cast("double")) / F.count("x")).alias("mean"))
    )


def vector_summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, deviation and extremes of each position of a vector column, in one pass."""
    measures = ["mean", "std", "min", "max"]
    found = df.select(Summarizer.metrics(*measures).summary(F.col(column)).alias("s"))
    parts = [vector_to_array(f"s.{m}").alias(m) for m in measures]
    zipped = found.select(*parts).select(F.posexplode(F.arrays_zip(*measures)))
    return zipped.selectExpr(
        "pos AS position", "col.mean AS mean", "col.std AS deviation", "col.min AS least",
        "col.max AS most",
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev(column).alias("deviation"),
        F.min(column).alias("least"),
        F.max(column).alias("most"),
    )
