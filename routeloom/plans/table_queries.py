"""Registered queries over tables, files, streams and vectorised functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeloom.functions.vectorised import centred, grouped_mean, multiply, with_group_mean
from routeloom.operators.words import word_counts, word_total
from routeloom.sources.formats import (
    bucketed,
    drop_table,
    merged,
    read_by_sql,
    round_trip,
    write_table,
)
from routeloom.sources.tables import table
from routeloom.streaming.windows import WindowCounts, in_batches
from routeloom.streaming.words import count_stream, running_total, text_stream
from routeloom.workspace import freeze, new_path

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _documents(spark, folder):
    return table(spark, folder, "documents").select("text")


def _stream(spark, folder):
    # As a pattern, the path may name one file or a folder of files.
    return count_stream(text_stream(spark, f"{folder}/documents.parque[t]"))


def daily_delay(spark, folder):
    """Mean days from order to shipment, and mean quantity, by day of order."""
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(
            (F.sum(F.datediff("l_shipdate", "o_orderdate")) / F.count("*")).alias("ship_delay"),
            (F.sum("l_quantity") / F.count("*")).alias("quantity"),
        )
    )


def delays_to(spark, folder):
    """Select and filter: the shipments of urgent orders."""
    orders = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    line = table(spark, folder, "lineitem")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *LINE_KEY, F.datediff("l_shipdate", "o_orderdate").alias("delay")
    )


def sql_expressions(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("routeloom_people")
    return spark.sql(
        "SELECT c_name AS name, c_nationkey + 1 AS next FROM routeloom_people"
        " WHERE c_acctbal > 2000"
    )


def sql_group_count(spark, folder):
    people = table(spark, folder, "customer")
    return people.groupBy("c_mktsegment").count().withColumnRenamed("count", "n")


def sql_global_view(spark, folder):
    table(spark, folder, "customer").createOrReplaceGlobalTempView("routeloom_people")
    return spark.newSession().sql(
        "SELECT c_custkey, c_name FROM global_temp.routeloom_people"
        " WHERE c_acctbal >= 1300 AND c_acctbal <= 1900"
    )


def _line(spark, folder):
    return table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_returnflag")


def _nested(spark, folder):
    people = table(spark, folder, "customer")
    return people.select("c_custkey", F.struct("c_name", "c_mktsegment", "c_nationkey").alias("who"), "c_acctbal")


def roundtrip_json(spark, folder):
    return round_trip(_nested(spark, folder), "json").select("c_custkey", "who.*", "c_acctbal")


def roundtrip_csv(spark, folder):
    """All columns, of the types that inference gives them."""
    return round_trip(table(spark, folder, "customer"), "csv", infer=True)


def roundtrip_times(spark, folder):
    """Timestamps and dates by way of text."""
    orders = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    return round_trip(round_trip(orders, "json"), "csv")


def roundtrip_arrays(spark, folder):
    """Arrays by way of JSON and ORC."""
    vectors = round_trip(round_trip(table(spark, folder, "embeddings"), "json"), "orc")
    return vectors.select("vec_id", "label", F.posexplode("embedding").alias("position", "x"))


def roundtrip_partitioned(spark, folder):
    return round_trip(_line(spark, folder), "parquet", partition_by=["l_returnflag"])


def roundtrip_bucketed(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    left = bucketed(_line(spark, folder), ["l_orderkey"], 8, ["l_orderkey"])
    right = bucketed(orders, ["o_orderkey"], 8, ["o_orderkey"])
    joined = spark.table(left).join(
        spark.table(right), F.col("l_orderkey") == F.col("o_orderkey")
    )
    totals = joined.groupBy("l_orderkey").agg(
        F.max("o_totalprice").alias("price"), F.sum("l_quantity").alias("quantity")
    )
    stored = freeze(totals, "totals")
    drop_table(spark, left)
    drop_table(spark, right)
    return stored


def partitioned_and_bucketed(spark, folder):
    name = bucketed(_line(spark, folder), ["l_orderkey"], 4, ["l_orderkey"], ["l_returnflag"])
    stored = freeze(spark.table(name), "lines")
    drop_table(spark, name)
    return stored


def built_schema(spark, folder):
    """Records of text, read by a schema put together at run time from the table's own types."""
    people = table(spark, folder, "customer")
    texts = people.select(
        F.to_json(
            F.struct(
                "c_custkey", "c_name", "c_acctbal",
                F.struct(
                    F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
                ).alias("place"),
            )
        ).alias("record")
    )
    place = T.StructType(
        [
            T.StructField("nation", people.schema["c_nationkey"].dataType),
            T.StructField("segment", people.schema["c_mktsegment"].dataType),
        ]
    )
    kept = [people.schema[c] for c in ("c_custkey", "c_name", "c_acctbal")]
    schema = T.StructType([*kept, T.StructField("place", place)])
    return texts.select(F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")).select(
        "r.c_custkey", "r.c_name", "r.c_acctbal", "r.place.nation", "r.place.segment"
    )


def file_by_sql(spark, folder):
    path = new_path(spark, "parts")
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size")
    write_table(part, path, "parquet")
    return read_by_sql(spark, path)


def merge_schema(spark, folder):
    part = table(spark, folder, "part")
    return merged(
        {
            "1": part.select("p_partkey", (F.col("p_size") * F.col("p_size")).alias("square")),
            "2": part.select(
                "p_partkey", (F.col("p_size") * F.col("p_size") * F.col("p_size")).alias("cube")
            ),
        }
    )


def udf_scalar(spark, folder):
    line = table(spark, folder, "lineitem")
    return line.select(*LINE_KEY, multiply("l_partkey", "l_suppkey").alias("product"))


def _event_windows(spark, folder):
    """Six-hour windows by kind of event, from five batches in the order of time."""
    # the table's times have no zone; as instants of UTC they fall in the same windows anywhere
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', ts)")
    events = table(spark, folder, "events").select(
        F.timestamp_micros(micros).alias("ts"), "event_type", "value"
    )
    counts = WindowCounts(
        spark, in_batches(events, "ts", 5), "ts timestamp, event_type string, value double",
        time="ts", keys=["event_type"], value="value", width="6 hours", delay="1 hour",
    )
    counts.run()
    return counts


def event_windows(spark, folder):
    found = _event_windows(spark, folder).windows()
    start = F.expr("unix_micros(start) DIV 1000000").alias("start")
    return found.select("event_type", start, "n", F.round("total", 4).alias("total"))


QUERIES = {
    "event_windows": event_windows,
    "event_windows_late": lambda s, d: _event_windows(s, d).late(),
    "word_count": lambda s, d: word_counts(_documents(s, d)),
    "word_total": lambda s, d: word_total(word_counts(_documents(s, d))),
    "stream_word_count": _stream,
    "stream_word_total": lambda s, d: running_total(_stream(s, d)),
    "daily_delay": daily_delay,
    "delays_to": delays_to,
    "sql_expressions": sql_expressions,
    "sql_group_count": sql_group_count,
    "sql_global_view": sql_global_view,
    "format_roundtrip_parquet": lambda s, d: round_trip(
        table(s, d, "lineitem"), "parquet", bloom_columns=["l_orderkey"]
    ),
    "format_roundtrip_orc": lambda s, d: round_trip(
        table(s, d, "lineitem"), "orc", bloom_columns=["l_orderkey"]
    ),
    "format_roundtrip_times": roundtrip_times,
    "format_roundtrip_arrays": roundtrip_arrays,
    "format_roundtrip_json": roundtrip_json,
    "format_roundtrip_csv": roundtrip_csv,
    "format_roundtrip_partitioned": roundtrip_partitioned,
    "format_roundtrip_bucketed": roundtrip_bucketed,
    "partitioned_and_bucketed": partitioned_and_bucketed,
    "built_schema": built_schema,
    "file_by_sql": file_by_sql,
    "merge_schema": merge_schema,
    "udf_scalar": udf_scalar,
    "udf_group_center": lambda s, d: centred(_line(s, d), "l_suppkey", "l_quantity"),
    "udf_group_mean": lambda s, d: grouped_mean(_line(s, d), "l_suppkey", "l_quantity"),
    "udf_window_mean": lambda s, d: with_group_mean(_line(s, d), "l_suppkey", "l_quantity"),
}

_KEY = ", ".join(LINE_KEY)
_LINE = f"SELECT {_KEY}, l_quantity, l_returnflag FROM lineitem"

SQL = {
    "word_count": r"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\r\n]')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "word_total": r"""
        SELECT count(*) AS words
        FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\r\n]')) AS word FROM documents)
        WHERE word <> ''""",
    "event_windows": """
        SELECT event_type, CAST(epoch(time_bucket(INTERVAL 6 HOURS, CAST(ts AS TIMESTAMP),
                                                  TIMESTAMP '1970-01-01')) AS BIGINT) AS start,
               count(*) AS n, round(sum(value), 4) AS total
        FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
    "event_windows_late": """
        SELECT CAST(0 AS BIGINT) AS late, count(ts) AS arrived FROM events""",
    "stream_word_count": r"""
        SELECT CAST(0 AS BIGINT) AS epoch_id, word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '[ \r\n]')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "stream_word_total": r"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '[ \r\n]')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "daily_delay": """
        SELECT CAST(o_orderdate AS DATE) AS day,
               sum(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)))
                   / count(*) AS ship_delay,
               sum(l_quantity) / count(*) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "delays_to": f"""
        SELECT {_KEY}, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))
                            AS INTEGER) AS delay
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderpriority = '1-URGENT'""",
    "sql_expressions": """
        SELECT c_name AS name, c_nationkey + 1 AS next FROM customer WHERE c_acctbal > 2000""",
    "sql_group_count": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
    "sql_global_view": """
        SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 1300 AND c_acctbal <= 1900""",
    "format_roundtrip_parquet": "SELECT * FROM lineitem",
    "format_roundtrip_orc": "SELECT * FROM lineitem",
    "format_roundtrip_times": "SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders",
    "format_roundtrip_arrays": """
        SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS position,
               unnest(embedding) AS x
        FROM embeddings""",
    "format_roundtrip_json": """
        SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal FROM customer""",
    "format_roundtrip_csv": """
        SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "format_roundtrip_partitioned": _LINE,
    "partitioned_and_bucketed": _LINE,
    "built_schema": """
        SELECT c_custkey, c_name, c_acctbal,
               c_nationkey AS nation, c_mktsegment AS segment
        FROM customer""",
    "format_roundtrip_bucketed": """
        SELECT l_orderkey, max(o_totalprice) AS price, sum(l_quantity) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""",
    "file_by_sql": "SELECT p_partkey, p_brand, p_size FROM part",
    "merge_schema": """
        SELECT p_partkey, p_size * p_size AS square, CAST(NULL AS INTEGER) AS cube, 1 AS part
        FROM part
        UNION ALL SELECT p_partkey, NULL, p_size * p_size * p_size, 2 FROM part""",
    "udf_scalar": f"SELECT {_KEY}, l_partkey * l_suppkey AS product FROM lineitem",
    "udf_group_center": f"""
        SELECT {_KEY}, l_returnflag,
               l_quantity - sum(l_quantity) OVER (PARTITION BY l_suppkey)
                   / count(*) OVER (PARTITION BY l_suppkey) AS l_quantity
        FROM lineitem""",
    "udf_group_mean": """
        SELECT l_suppkey, sum(l_quantity) / count(*) AS mean FROM lineitem GROUP BY l_suppkey""",
    "udf_window_mean": f"""
        SELECT {_KEY}, l_quantity, l_returnflag,
               sum(l_quantity) OVER (PARTITION BY l_suppkey)
                   / count(*) OVER (PARTITION BY l_suppkey) AS mean
        FROM lineitem""",
}
