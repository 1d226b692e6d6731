"""Writing and reading tables in the file formats Spark ships."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from routeloom.workspace import new_path, remove, shared_folder

#: Writer options of each format.
WRITE_OPTIONS = {
    "parquet": {},
    "json": {},
    "csv": {"header": True, "sep": ";"},
    "orc": {},
}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str,
    partition_by: list[str] | None = None,
    bloom_columns: list[str] | None = None,
) -> None:
    """Write ``df`` as ``fmt``; ORC and Parquet can carry bloom filters."""
    writer = df.write.format(fmt).options(**WRITE_OPTIONS[fmt])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bloom_columns and fmt == "orc":
        writer = writer.option("orc.bloom.filter.columns", ",".join(bloom_columns))
    for column in bloom_columns or []:
        if fmt == "parquet":
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt: str, schema=None) -> DataFrame:
    """Read a table; without a schema, CSV and JSON types are inferred in a pass of their own."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, sep=";")
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def round_trip(df: DataFrame, fmt: str, infer: bool = False, **layout) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = new_path(df.sparkSession, fmt)
    write_table(df, path, fmt, **layout)
    return read_table(df.sparkSession, path, fmt, None if infer else df.schema)


def read_by_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Query files directly by SQL, without a table."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def bucketed(
    df: DataFrame,
    by: list[str],
    buckets: int,
    sort_by: list[str],
    partition_by: list[str] | None = None,
) -> str:
    """Write a bucketed, sorted table and return its name; joins on ``by`` need no shuffle.

    With ``partition_by`` each folder of these columns' values holds its own buckets.
    """
    name = f"routeloom_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets, *by).sortBy(*sort_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", _table_path(df.sparkSession, name)).saveAsTable(name)
    return name


def _table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/routeloom/{name}"


def drop_table(spark: SparkSession, name: str) -> None:
    """Take a table that :func:`bucketed` wrote out of the catalog and delete its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, _table_path(spark, name))


def merged(parts: dict[str, DataFrame], key: str = "part") -> DataFrame:
    """Write parts of differing columns below one path and read them as one table."""
    spark = next(iter(parts.values())).sparkSession
    path = new_path(spark, "merged")
    for value, df in parts.items():
        df.write.parquet(f"{path}/{key}={value}")
    return spark.read.option("mergeSchema", True).parquet(path)
