"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that the next one reads.  All but
the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.llm.classifier import fit_documents, score_documents
from routeloom.llm.decontaminate import mark_contaminated
from routeloom.llm.line_dedup import drop_repeated_lines
from routeloom.llm.near_dedup import near_duplicates
from routeloom.llm.packing import pack_documents
from routeloom.llm.queries import REJECT_BELOW, TOKENIZER
from routeloom.llm.storage import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality is at least 0.7; labels teach, text decides."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_documents(docs, labels)
    scored = score_documents(docs, model, score_col="_score")
    return scored.where(F.col("_score") >= REJECT_BELOW).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one has; ``n_chars`` follows the text."""
    kept = drop_repeated_lines(docs)
    n_chars = F.when(kept["n_dropped"] > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars.cast("long")).select(*docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five-word shingles)."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no notable part of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = mark_contaminated(docs, items).where("contaminated").select("row_hash").distinct()
    keyed = docs.withColumn("row_hash", F.xxhash64("doc_id", "text"))
    return keyed.join(marked, "row_hash", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The classifier and the sketches cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences made of the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage{number}")
    return docs
