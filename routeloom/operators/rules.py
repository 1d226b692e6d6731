"""Association rules between the items of baskets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.functions.skew import lookup_join
from routeloom.workspace import freeze, freeze_counting


def association_rules(
    entries: DataFrame, basket: str, item: str, min_support: float, min_confidence: float
) -> DataFrame:
    """Rules ``antecedent => consequent`` with support, confidence and lift.

    Rare items go first: with baskets of b distinct items on average, at most
    b / min_support items are frequent, so no basket can keep more than that,
    whatever its size.
    """
    pairs, n_pairs = freeze_counting(
        entries.select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct(),
        "pairs",
    )
    n_baskets = pairs.select("basket").distinct().count()
    counts = pairs.groupBy("item").count().where(F.col("count") >= min_support * n_baskets)
    frequent = freeze(counts.select("item", F.col("item").alias("kept")), "frequent")
    # A basket left without items still counts towards every support.
    marked = lookup_join(pairs, frequent, "item", "left")
    sets = freeze(marked.groupBy("basket").agg(F.collect_set("kept").alias("items")), "baskets")
    learner = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    return learner.fit(sets).associationRules
