"""Feature columns: thresholds, buckets, term counts, hashes, scaling, cosine transform."""

from __future__ import annotations

from itertools import pairwise

from pyspark.ml.feature import DCT, FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.functions.ordering import dense_index
from routeloom.functions.skew import lookup_join
from routeloom.operators.words import words
from routeloom.workspace import freeze


def binarize(column: str | Column, threshold: float) -> Column:
    """1 above the threshold, else 0; NULL stays NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value > threshold, 1.0).when(value.isNotNull(), 0.0)


def bucketize(column: str, splits: list[float]) -> Column:
    """Number of the interval ``[low, high)`` that holds the value; the last one is closed.

    A value outside all intervals fails the query.
    """
    if len(splits) < 3 or any(low >= high for low, high in pairwise(splits)):
        raise ValueError("splits must hold at least three rising values")
    value = F.col(column)
    last = len(splits) - 2
    outside = F.raise_error(F.lit(f"{column} lies outside its buckets")).cast("double")
    found = F.when(value.isNull(), F.lit(None).cast("double")).when(value < splits[0], outside)
    for bucket in range(last):
        found = found.when(value < splits[bucket + 1], float(bucket))
    return found.when(value <= splits[-1], float(last)).otherwise(outside)


def vocabulary(term_counts: DataFrame, min_docs: int, size: int | None = None) -> DataFrame:
    """``(word, term)``: words by falling count, numbered from 0, equal counts by word.

    All words in at least ``min_docs`` texts, or of these the ``size`` most frequent.
    """
    found = (
        term_counts.groupBy("word")
        .agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
        .where(F.col("docs") >= min_docs)
    )
    # stored, as sampling for the order would count the words again
    found = freeze(found.select("word", "total"), "words")
    placed = dense_index(found, [F.desc("total"), F.asc("word")], "place")
    if size is not None:
        placed = placed.where(F.col("place") <= size)
    return placed.select("word", (F.col("place") - 1).alias("term"))


def count_vectorize(
    texts: DataFrame, key: str, column: str, min_docs: int = 1, size: int | None = None
) -> DataFrame:
    """Counts of vocabulary terms in each text, as sparse rows ``(key, term, word, n)``."""
    found = words(texts.select(key, column), column).groupBy(key, "word")
    counts = freeze(found.agg(F.count("*").alias("n")), "terms")
    terms = vocabulary(counts, min_docs, size)
    return lookup_join(counts, terms, "word").select(key, "term", "word", "n")


def hash_features(df: DataFrame, columns: list[str], size: int, out: str = "features") -> DataFrame:
    """Hash numbers and categories into one sparse vector."""
    return FeatureHasher(inputCols=columns, outputCol=out, numFeatures=size).transform(df)


def scale_elements(column: str, factors: list[float]) -> Column:
    """Multiply an array by fixed factors, position by position."""
    weights = F.array(*[F.lit(float(f)) for f in factors])
    return F.zip_with(F.col(column), weights, lambda x, w: x * w)


def cosine_transform(df: DataFrame, column: str, out: str, inverse: bool = False) -> DataFrame:
    """Orthonormal discrete cosine transform of an array column."""
    vectors = df.withColumn("_in", array_to_vector(F.col(column).cast("array<double>")))
    transformed = DCT(inverse=inverse, inputCol="_in", outputCol="_out").transform(vectors)
    return transformed.withColumn(out, vector_to_array("_out")).drop("_in", "_out")
