"""A directed edge table laid out for repeated sends from vertices to neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.sources.formats import bucketed, drop_table
from routeloom.workspace import discard, freeze

#: Arcs per bucket of a fixed layout.
BUCKET_ROWS = 2_000_000

#: Spark's own limit on the buckets of a table; beyond it buckets hold more arcs each.
MAX_BUCKETS = 100_000


class ArcTable:
    """``arcs(src, dst, ...)``, stored once and joined to vertex rows every round.

    The table is bucketed by ``(src, shard)``, so a round moves only the
    vertex rows.  A hub, a vertex with more arcs than an average bucket, is cut
    into shards over its neighbours; there are fewer hubs than buckets, which
    bounds the table that is broadcast.  Use it in a ``with`` block, which deletes
    the stored tables at its end.
    """

    def __init__(self, arcs: DataFrame, n_arcs: int):
        self.spark = arcs.sparkSession
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = self.buckets = min(max(tasks, -(-n_arcs // BUCKET_ROWS)), MAX_BUCKETS)
        share = max(1, -(-n_arcs // buckets))
        degrees = arcs.groupBy("src").count().where(F.col("count") > share)
        self.hubs = freeze(
            degrees.select("src", F.ceil(F.col("count") / share).cast("int").alias("shards")),
            "hubs",
        )
        self.split = not self.hubs.isEmpty()
        shard = F.pmod(F.xxhash64("dst"), F.coalesce("shards", F.lit(1))).cast("int")
        laid = (
            arcs.join(F.broadcast(self.hubs), "src", "left")
            .withColumn("shard", shard)
            .drop("shards")
            .repartition(buckets, "src", "shard")
        )
        self.name = bucketed(laid, ["src", "shard"], buckets, ["src", "shard"])
        self.arcs = self.spark.table(self.name)

    def __enter__(self) -> ArcTable:
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def drop(self) -> None:
        drop_table(self.spark, self.name)
        discard(self.hubs)

    def send(self, rows: DataFrame) -> DataFrame:
        """Pair every row, keyed by ``src``, with each arc leaving that vertex."""
        if not self.split:
            return rows.withColumn("shard", F.lit(0)).join(self.arcs, ["src", "shard"]).drop("shard")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("shards", F.lit(1)) - 1))
        spread_rows = (
            rows.join(F.broadcast(self.hubs), "src", "left")
            .withColumn("shard", copies)
            .drop("shards")
        )
        return spread_rows.join(self.arcs, ["src", "shard"]).drop("shard")
