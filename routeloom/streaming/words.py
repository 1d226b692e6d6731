"""Word counts of each micro-batch of a text stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.operators.words import SPACES, word_counts
from routeloom.workspace import new_path

COUNT_SCHEMA = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("epoch_id", T.LongType()),
    ]
)


def text_stream(
    spark: SparkSession, path: str, schema: str = "text string", files_per_batch: int = 1000
) -> DataFrame:
    """A stream over the Parquet files of ``path``, old and new."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def count_stream(texts: DataFrame, column: str = "text") -> DataFrame:
    """Count the words of every available micro-batch: ``(epoch_id, word, n)``.

    Each batch overwrites the folder of its own epoch, so a batch that is
    repeated after a failure counts once.
    """
    spark = texts.sparkSession
    out = new_path(spark, "word-epochs")

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        counts = word_counts(batch, column, SPACES)
        counts.write.mode("overwrite").parquet(f"{out}/epoch_id={epoch_id}")

    query = (
        texts.writeStream.foreachBatch(write_epoch)
        .option("checkpointLocation", new_path(spark, "word-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    nothing = spark.createDataFrame([], COUNT_SCHEMA)
    nothing.write.mode("append").partitionBy("epoch_id").parquet(out)
    return spark.read.schema(COUNT_SCHEMA).parquet(out).select("epoch_id", "word", "n")


def running_total(epochs: DataFrame) -> DataFrame:
    """Counts over all batches so far."""
    return epochs.groupBy("word").agg(F.sum("n").alias("n"))
