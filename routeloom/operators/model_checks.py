"""What must hold for a fitted model, counted on its own rows.

Each check recomputes, from the rows and the model's output, a property that only the right
answer has: a nearest centre, a solved equation, the mean of a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.functions.skew import lookup_join
from routeloom.operators.models import Recommender, Survival, TextSearch

#: Ratings that are summed up at a time.
ROWS = 100_000


def _squared_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def cluster_faults(points: DataFrame, column: str, clusters: DataFrame) -> DataFrame:
    """Clusters ``(cluster, size, center, cost)`` against their points.

    Returns per cluster ``size_fault`` and ``centre_fault``, whether another number of points is
    nearest to its centre than ``size``, or their mean is not the centre, and for the whole model
    ``cost_fault``.  The centres, as many as the caller asked for, are broadcast.
    """
    centres = clusters.agg(F.collect_list(F.struct("cluster", "center")).alias("centres"))
    vector = F.col(column).cast("array<double>").alias("vector")
    measured = points.select(vector).join(F.broadcast(centres)).select(
        "vector",
        F.array_min(F.transform("centres", lambda c: F.struct(
            _squared_distance(F.col("vector"), c["center"]).alias("cost"),
            c["cluster"].alias("cluster"),
        ))).alias("best"),
    )
    elements = measured.select("best", F.posexplode("vector").alias("at", "x"))
    means = elements.groupBy("best.cluster", "at").agg(F.avg("x").alias("mean")).groupBy(
        "cluster"
    ).agg(F.map_from_entries(F.collect_list(F.struct("at", "mean"))).alias("means"))
    found = measured.groupBy("best.cluster").agg(
        F.count("*").alias("members"), F.sum("best.cost").alias("costs")
    )
    every = clusters.join(found, "cluster", "left").join(means, "cluster", "left")
    total = found.agg(F.sum("costs").alias("whole"))
    far = F.exists(
        F.sequence(F.lit(0), F.size("center") - 1),
        lambda at: F.abs(F.get("center", at) - F.element_at("means", at)) > 1e-6,
    )
    return every.join(F.broadcast(total)).select(
        "cluster",
        (F.coalesce("members", F.lit(0)) != F.coalesce("size", F.lit(0))).alias("size_fault"),
        F.coalesce(far, F.lit(False)).alias("centre_fault"),
        (F.abs(F.col("cost") - F.col("whole")) > 1e-6 * F.col("whole")).alias("cost_fault"),
    )


def _pulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per user in succession: ratings, factors, errors times items' factors, and their sizes."""

    def matrix(column: pa.Array, rows: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)

    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            users, ratings = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("user_number", "rating")
            )
            ratings = ratings.astype(np.float64)
            u, v = (matrix(batch.column(c), len(users)) for c in "uv")
            starts = np.flatnonzero(np.r_[True, users[1:] != users[:-1]])
            error = ratings - (u * v).sum(axis=1)
            pull = np.add.reduceat(error[:, None] * v, starts)
            scale = np.add.reduceat(np.abs(ratings[:, None] * v), starts)
            sums = [
                pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), v.shape[1]).cast(
                    pa.list_(pa.float64())
                )
                for x in (u[starts], pull, scale)
            ]
            n = np.diff(np.r_[starts, len(users)])
            columns = [pa.array(users[starts], pa.int32()), pa.array(n, pa.int64()), *sums]
            yield pa.RecordBatch.from_arrays(
                columns, names=["user_number", "n", "u", "pull", "scale"]
            )


def factor_faults(recommender: Recommender) -> DataFrame:
    """Users whose factors do not solve their normal equations: ``(unsolved, users)``.

    The learner solves for the users last: of a user's ratings, the errors times the items'
    factors sum to the user's factors times the penalty and the number of ratings.
    """
    model = recommender.model
    users = model.userFactors.select(F.col("id").alias("user_number"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item_number"), F.col("features").alias("v"))
    rated = recommender.training.select("user_number", "item_number", "rating")
    # an item's factors travel once with each rating; what leaves is summed by user
    met = lookup_join(rated, items, "item_number").select("user_number", "rating", "v")
    parts = lookup_join(met, users, "user_number").mapInArrow(
        _pulls, "user_number int, n bigint, u array<double>, pull array<double>, scale array<double>"
    )
    sums = parts.select(
        "user_number", "n", F.posexplode(F.arrays_zip("u", "pull", "scale")).alias("at", "sums")
    ).groupBy("user_number", "at").agg(
        F.sum("sums.pull").alias("pull"),
        F.sum("sums.scale").alias("scale"),
        (F.max("sums.u") * F.sum("n") * recommender.reg).alias("penalty"),
    )
    missed = F.abs(F.col("pull") - F.col("penalty")) > 1e-3 * (1 + F.col("scale"))
    return sums.groupBy("user_number").agg(F.max(missed).alias("missed")).agg(
        F.count_if("missed").alias("unsolved"), F.count("*").alias("users")
    )


def regression_leaf_faults(model, training: DataFrame) -> DataFrame:
    """``(faults, rows)``: predictions that are not the mean target of the rows that get them."""
    found = model.transform(training).groupBy("prediction").agg(
        F.avg("target").alias("mean"), F.count("*").alias("n")
    )
    off = F.abs(F.col("mean") - F.col("prediction")) > 1e-6 * (1 + F.abs("mean"))
    return found.agg(F.count_if(off).alias("faults"), F.sum("n").alias("rows"))


def class_leaf_faults(model, training: DataFrame, target: str) -> DataFrame:
    """``(faults, rows)``: class shares that are not those of the rows that get them.

    Also a fault is a prediction other than a class of the largest share.
    """
    shares = vector_to_array("probability").alias("shares")
    rows = model.transform(training).select(shares, "prediction", F.col(target).alias("label"))
    cells = rows.groupBy("shares", "prediction", "label").agg(F.count("*").alias("n"))
    sizes = cells.groupBy("shares", "prediction").agg(
        F.sum("n").alias("size"),
        F.map_from_entries(F.collect_list(F.struct(F.col("label").cast("int"), "n"))).alias("by"),
    )
    off = F.exists(
        F.sequence(F.lit(0), F.size("shares") - 1),
        lambda k: F.abs(
            F.get("shares", k) - F.coalesce(F.element_at("by", k), F.lit(0)) / F.col("size")
        ) > 1e-9,
    )
    chosen = F.get("shares", F.col("prediction").cast("int"))
    fault = off | (chosen < F.array_max("shares"))
    return sizes.agg(F.count_if(fault).alias("faults"), F.sum("size").alias("rows"))


def survival_faults(survival: Survival) -> DataFrame:
    """``(faults, rows, balanced)``: quantiles off the fitted law, and a sign of the optimum.

    The time that a share p has reached is the prediction times (-log(1 - p)) to the scale.  At
    the optimum the hazards that rows have gathered sum to the ends seen, up to what the
    learner's tolerance leaves.
    """
    model = survival.model
    found = survival.model.transform(survival.points).select(
        "label", "censor", "prediction", vector_to_array("quantiles").alias("q")
    )
    law = F.array(*[
        F.col("prediction") * F.pow(-F.log(F.lit(1.0 - p)), F.lit(float(model.scale)))
        for p in survival.quantiles
    ])
    off = F.exists(F.zip_with("q", law, lambda a, b: F.abs(a - b) > 1e-6 * b), lambda x: x)
    hazard = F.pow(F.col("label") / F.col("prediction"), F.lit(1.0 / float(model.scale)))
    gap = F.abs(F.sum(hazard) / F.sum("censor") - 1)
    return found.agg(
        F.count_if(off).alias("faults"), F.count("*").alias("rows"), (gap < 0.01).alias("balanced")
    )


def text_faults(search: TextSearch, texts: DataFrame, *keep: str) -> DataFrame:
    """``(faults, rows, best)``: predictions that do not follow their probability.

    ``best`` tells whether the marked setting, and no other, has the largest area.
    """
    settings = search.settings()
    top = settings.agg(
        (F.max("area") == F.max(F.when(F.col("best"), F.col("area")))).alias("best")
    )
    found = search.predicted(texts, *keep)
    wrong = (F.col("probability") > 0.5).cast("int") != F.col("predicted")
    return found.agg(F.count_if(wrong).alias("faults"), F.count("*").alias("rows")).join(
        F.broadcast(top)
    )
