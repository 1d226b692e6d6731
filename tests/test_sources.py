import pytest

from routeloom.operators.routes import average_edges
from routeloom.plans.delay_report import delay_report
from routeloom.sources.edge_list import read_edge_list
from routeloom.sources.flights import check_factor, read_flights
from routeloom.plans.table_queries import QUERIES
from routeloom.sources.formats import bucketed, drop_table, read_table, round_trip

LINE = "1,2,AA,N1,{n},{a},Aname,{b},Bname,600,605,{delay},900,{arr},{arr_delay},300,77"


def line(a=1, b=2, delay="5.0", n="12", arr="905", arr_delay="5"):
    return LINE.format(a=a, b=b, delay=delay, n=n, arr=arr, arr_delay=arr_delay)


def write(tmp_path, *lines):
    path = tmp_path / "flights.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_flight_fields(spark, tmp_path):
    path = write(tmp_path, line(), line(arr="", arr_delay="", delay="-3"))
    rows = read_flights(spark, path, strict=True).collect()
    assert len(rows[0]) == 17
    assert (rows[0].origin_id, rows[0].departure_delay, rows[0].arrival_real_time) == (1, 5.0, 905.0)
    assert (rows[1].arrival_real_time, rows[1].arrival_delay, rows[1].departure_delay) == (0, 0, -3)


def test_empty_text_is_kept_as_text(spark, tmp_path):
    path = write(tmp_path, line().replace("N1", ""), line().replace("N1", '"q'))
    assert [r.tail_num for r in read_flights(spark, path).collect()] == ["", '"q']


@pytest.mark.parametrize(
    "bad",
    [
        line(delay="late"), line(delay=""), line(n="x"), ",".join(line().split(",")[:16]),
        line() + ",more", "", "  ",
    ],
    ids=["text delay", "no delay", "bad number", "short line", "long line", "blank", "blanks"],
)
def test_malformed_line_fails(spark, tmp_path, bad):
    path = write(tmp_path, line(), bad)
    with pytest.raises(Exception):
        read_flights(spark, path, strict=True).collect()


def test_strict_checks_fields_the_query_skips(spark, tmp_path):
    path = write(tmp_path, line(), line(n="x"))
    with pytest.raises(Exception):
        read_flights(spark, path, strict=True).select("origin_id").collect()


def test_only_needed_columns_are_read(spark, tmp_path):
    flights = read_flights(spark, write(tmp_path, line(), line(1, 1), line(2, 1, "7")))
    edges = average_edges(flights)
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<origin_id:bigint,destination_id:bigint,departure_delay:double>" in plan
    assert [tuple(r) for r in edges.collect()] == [(1, 2, 6.0)]


@pytest.mark.parametrize("factor", [0, 1, -1, 1.5])
def test_factor_range(spark, factor):
    with pytest.raises(ValueError):
        check_factor(factor)
    with pytest.raises(ValueError):
        delay_report(spark.createDataFrame([], "src bigint, dst bigint, weight double"), factor)


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_round_trip(spark, fmt):
    df = spark.createDataFrame([(1, "a;b", 0.5), (2, 'c"d', 1.5)], "i int, s string, x double")
    assert sorted(map(tuple, round_trip(df, fmt).collect())) == sorted(map(tuple, df.collect()))


def test_inferred_and_given_schemas(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("name;age\nJoe;20\nTom;30\n")
    assert read_table(spark, str(path), "csv").dtypes == [("name", "string"), ("age", "int")]
    given = read_table(spark, str(path), "csv", "name string, age string")
    assert given.dtypes == [("name", "string"), ("age", "string")]
    from pyspark.sql import Row

    assert spark.createDataFrame([Row(name="Joe", age=20)]).dtypes == [
        ("name", "string"), ("age", "bigint"),
    ]


def test_edge_list(spark, tmp_path):
    path = tmp_path / "edges.txt"
    path.write_text("# from to\n2 1\n\n 4\t7 \n2 1\n")
    assert sorted(map(tuple, read_edge_list(spark, str(path)).collect())) == [(2, 1), (2, 1), (4, 7)]
    canonical = read_edge_list(spark, str(path), canonical=True)
    assert sorted(map(tuple, canonical.collect())) == [(1, 2), (1, 2), (4, 7)]
    path.write_text("1 2\n3\n")
    with pytest.raises(Exception):
        read_edge_list(spark, str(path)).collect()


def test_bucketed_tables_join_in_place(spark):
    df = spark.range(200).selectExpr("id % 20 AS k", "id AS x")
    names = [bucketed(df, ["k"], 8, ["k"]) for _ in range(2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            drop_table(spark, name)


def test_filters_reach_the_files(spark, sf):
    plan = QUERIES["delays_to"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan
    assert "l_quantity" not in plan
