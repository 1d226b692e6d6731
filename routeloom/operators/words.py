"""Word counts over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines end at a line break; words within a line at a space or tab.
BLANKS = r"[ \t\r\n]"

#: As BLANKS, with tabs kept inside words.
SPACES = r"[ \r\n]"


def words(texts: DataFrame, column: str = "text", pattern: str = BLANKS) -> DataFrame:
    """One row per non-empty word, with the other columns of ``texts``."""
    rest = [c for c in texts.columns if c != column]
    split = F.explode(F.split(column, pattern)).alias("word")
    return texts.select(*rest, split).where("word <> ''")


def word_counts(texts: DataFrame, column: str = "text", pattern: str = BLANKS) -> DataFrame:
    return words(texts.select(column), column, pattern).groupBy("word").agg(F.count("*").alias("n"))


def word_total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"))
