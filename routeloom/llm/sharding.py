"""Sharding by a two-pass external shuffle.

The first pass scatters every record uniformly, by a seeded hash, into buckets that fit in
memory; the second shuffles each bucket (Fisher-Yates) and writes it.  A shard is the sequence of
its buckets, so its order is a random order of its records.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.llm.storage import replaced, stored

#: Text bytes per bucket; a task holds one bucket at a time.
BUCKET_BYTES = 32 << 20
#: Tasks of the second pass; more buckets than that are shuffled one after the other.
MAX_TASKS = 100_000


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """The shard whose hash with the key is the largest.

    With one more shard, a key either stays or moves to the new one.
    """
    scores = F.array(*[F.xxhash64(F.lit(seed), F.lit(i), key) for i in range(shards)])
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Deal all rows into ``shards`` shards by their id, in random order.

    Returns all columns and ``size`` (UTF-8 bytes plus 1), ``shard``, ``grown_shard`` (with one
    more shard), ``bucket`` and ``slot`` (place in the shard, gapless from 0).  Id and number of
    shards alone decide on the shard: repeated rows meet in one shard, spread over its buckets
    by the partition they come from; rows without an id share one shard.  A null text counts as
    empty.  An input column with a new column's name is replaced.  An empty table gives none.
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    largest = (
        docs.select(size.alias("size"), rendezvous(key, shards, seed).alias("shard"))
        .groupBy("shard")
        .agg(F.sum("size").alias("size"))
        .agg(F.max("size"))
        .first()[0]
    )
    buckets = max(1, math.ceil((largest or 0) / bucket_bytes))
    scatter = F.xxhash64(F.lit(seed + 1), key, text, F.spark_partition_id())
    dealt = replaced(
        docs,
        {
            "size": size,
            "shard": rendezvous(key, shards, seed),
            "grown_shard": rendezvous(key, shards + 1, seed),
            "bucket": F.pmod(scatter, F.lit(buckets)).cast("int"),
            "slot": F.xxhash64(F.lit(seed + 2), key, text),
        },
    )
    schema = T.StructType(dealt.schema.fields)

    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("slot", "ascending"), ("size", "ascending")])
        rng = np.random.default_rng([seed & 0xFFFFFFFF, key[0].as_py(), key[1].as_py()])
        order = np.arange(rows.num_rows)
        rng.shuffle(order)  # Fisher-Yates
        rows = rows.take(pa.array(order))
        place = pa.array(np.arange(rows.num_rows), pa.int64())
        return rows.set_column(rows.schema.get_field_index("slot"), "slot", place)

    # some tasks stay empty, but few get several buckets by the hash of their numbers
    tasks = min(4 * shards * buckets, MAX_TASKS)
    scattered = dealt.repartition(tasks, "shard", "bucket").groupBy("shard", "bucket")
    written = stored(scattered.applyInArrow(shuffle, schema), "shards")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        written.groupBy("shard", "bucket")
        .agg(F.count("*").alias("_n"))
        .select("shard", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    # stored, so that its size is known and the documents stay in place where it is small
    joined = written.join(stored(starts, "starts"), ["shard", "bucket"])
    return joined.select(
        *[
            (F.col("slot") + F.col("_start")).alias("slot") if c == "slot" else F.col(f"`{c}`")
            for c in written.columns
        ]
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, **options: object) -> None:
    """Write :func:`shard_documents` below ``path``, a folder per shard.

    Read file by file, by their names, the rows of a shard come in slot order: tasks take ranges of
    buckets.
    """
    dealt = shard_documents(docs, shards, **options)
    ranged = dealt.repartitionByRange("shard", "bucket").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").option("compression", "zstd").parquet(path)
