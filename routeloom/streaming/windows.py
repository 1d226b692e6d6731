"""Event-time windows over a stream, kept across batches and restarts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.workspace import freeze, new_path

#: Files of a batch that :func:`in_batches` writes.
FILES = 4


def in_batches(df: DataFrame, order: str, n: int) -> str:
    """Write ``df`` as ``n`` batches of ``FILES`` files in the order of a column; their folder.

    Read with ``FILES`` files per trigger it arrives in that order; NULLs come first.
    """
    path = new_path(df.sparkSession, "batches")
    number = F.unix_micros(order)
    shares = [(i + 1) / n for i in range(n - 1)]
    bounds = df.agg(F.percentile_approx(number, shares, 10_000)).first()[0] if shares else None
    batch = sum((F.coalesce(number > b, F.lit(False)).cast("int") for b in bounds or []), F.lit(0))
    for i in range(n):
        df.where(batch == i).repartition(FILES).write.mode("append").parquet(path)
    return path


@dataclass
class WindowCounts:
    """Counts and sums per key and window of the files of ``path``, batch by batch.

    ``run`` takes what has arrived since the last run and goes on from the stored state. Windows
    stay open until the latest time seen, less ``delay``, has passed their end; rows that come for
    a window after that are late, left out and counted.  Rows without a time belong nowhere.
    Each batch combines its rows by key before they are shuffled to the state.
    """

    spark: SparkSession
    path: str
    schema: str
    time: str
    keys: list[str]
    value: str
    width: str
    delay: str
    files_per_batch: int = FILES

    def __post_init__(self) -> None:
        self.out = new_path(self.spark, "window-epochs")
        self.progress = new_path(self.spark, "window-progress")

    def _stream(self) -> DataFrame:
        rows = (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", self.files_per_batch)
            .parquet(self.path)
            .where(F.col(self.time).isNotNull())
        )
        return (
            rows.withWatermark(self.time, self.delay)
            .groupBy(*self.keys, F.window(self.time, self.width).alias("_window"))
            .agg(F.count("*").alias("n"), F.sum(self.value).alias("total"))
            .select(*self.keys, F.col("_window.start").alias("start"), "n", "total")
        )

    def run(self) -> None:
        """Take all new files.  A batch overwrites the folder of its epoch, so it counts once."""
        out = self.out

        def write_epoch(changed: DataFrame, epoch: int) -> None:
            changed.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

        query = (
            self._stream()
            .writeStream.outputMode("update")
            .foreachBatch(write_epoch)
            .option("checkpointLocation", self.progress)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def windows(self) -> DataFrame:
        """``(keys, start, n, total)``: every window as its last batch left it."""
        stream = self._stream()
        schema = stream.schema.add("epoch", "long")
        nothing = self.spark.createDataFrame([], schema)
        nothing.write.mode("append").partitionBy("epoch").parquet(self.out)
        epochs = self.spark.read.schema(schema).parquet(self.out)
        last = F.max_by(F.struct("n", "total"), "epoch").alias("last")
        return epochs.groupBy(*self.keys, "start").agg(last).select(*self.keys, "start", "last.*")

    def late(self) -> DataFrame:
        """One row: the ``late`` rows among all ``arrived`` with a time."""
        arrived = self.spark.read.schema(self.schema).parquet(self.path)
        arrived = arrived.where(F.col(self.time).isNotNull()).agg(F.count("*").alias("arrived"))
        counted = self.windows().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("counted"))
        both = freeze(arrived, "arrived").join(F.broadcast(freeze(counted, "counted")))
        return both.select((F.col("arrived") - F.col("counted")).alias("late"), "arrived")
