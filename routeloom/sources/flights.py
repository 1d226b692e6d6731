"""Flight records from comma-separated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The field order and types of the flight file format.
FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("day_of_month", T.StringType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("tail_num", T.StringType()),
        T.StructField("flight_num", T.IntegerType()),
        T.StructField("origin_id", T.LongType()),
        T.StructField("origin_name", T.StringType()),
        T.StructField("destination_id", T.LongType()),
        T.StructField("destination_name", T.StringType()),
        T.StructField("scheduled_departure_time", T.DoubleType()),
        T.StructField("departure_real_time", T.DoubleType()),
        T.StructField("departure_delay", T.DoubleType()),
        T.StructField("scheduled_arrival_time", T.DoubleType()),
        T.StructField("arrival_real_time", T.DoubleType()),
        T.StructField("arrival_delay", T.DoubleType()),
        T.StructField("elapsed_time", T.DoubleType()),
        T.StructField("distance", T.IntegerType()),
    ]
)

#: Fields that may be left empty, with the value they then take.
FLIGHT_DEFAULTS = {"arrival_real_time": 0.0, "arrival_delay": 0.0}


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace missing values of the named columns."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def _required() -> list[str]:
    return [
        f.name
        for f in FLIGHT_SCHEMA.fields
        if not isinstance(f.dataType, T.StringType) and f.name not in FLIGHT_DEFAULTS
    ]


def _present(name: str) -> Column:
    missing = F.raise_error(F.lit(f"flight field {name} is empty"))
    return F.when(F.col(name).isNull(), missing).otherwise(F.col(name))


def read_flights(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Typed flights from a headerless, unquoted file; a malformed line fails the job.

    Spark checks only the columns a query uses, and skips blank lines.
    ``strict`` checks every field of every line, blank ones too, at the price of
    reading all columns.  A line with more fields than the format has is
    malformed as well.
    """
    if strict:
        return _checked_flights(spark, path)
    raw = (
        spark.read.schema(FLIGHT_SCHEMA)
        .option("header", False)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    texts = {f.name: "" for f in FLIGHT_SCHEMA.fields if isinstance(f.dataType, T.StringType)}
    checked = raw.withColumns({c: _present(c) for c in _required()})
    return with_defaults(checked, {**texts, **FLIGHT_DEFAULTS})


def _checked_flights(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_flights`, from whole lines, each cut and converted in full."""
    wanted = len(FLIGHT_SCHEMA.fields)
    fields = F.split("value", ",", -1)
    wrong = F.raise_error(F.concat(F.lit("malformed flight line: "), "value"))
    parts = F.when(F.size(fields) == wanted, fields).otherwise(wrong.cast("array<string>"))
    columns = []
    for i, field in enumerate(FLIGHT_SCHEMA.fields):
        text = F.col("parts")[i]
        if isinstance(field.dataType, T.StringType):
            columns.append(text.alias(field.name))
            continue
        value = F.trim(text).try_cast(field.dataType)
        empty = F.length(F.trim(text)) == 0
        default = FLIGHT_DEFAULTS.get(field.name)
        if default is not None:
            value = F.when(empty, F.lit(default)).otherwise(value)
        bad = F.raise_error(F.concat(F.lit(f"malformed {field.name}: "), text))
        columns.append(F.coalesce(value, bad.cast(field.dataType)).alias(field.name))
    flights = spark.read.text(path).select(parts.alias("parts")).select(*columns)
    # Always true, but no field can be skipped to find out.
    return flights.filter(F.xxhash64(*flights.columns) >= F.lit(-(1 << 63)))


def write_flights(df: DataFrame, path: str) -> None:
    """Write flights in the format that :func:`read_flights` reads."""
    df.select(*FLIGHT_SCHEMA.names).write.option("header", False).option("quote", "").csv(path)


def check_factor(factor: float) -> float:
    """A scaling factor must lie strictly between 0 and 1."""
    if not 0.0 < factor < 1.0:
        raise ValueError(f"factor must be in ]0, 1[, got {factor}")
    return float(factor)
