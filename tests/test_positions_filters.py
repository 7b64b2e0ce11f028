"""Positions compare by number, filters keep whole rows."""

from pyspark.sql import functions as F

from rowtide.functions.position import is_valid_position, parse_position
from rowtide.operators import filters, positions


def test_numeric_not_text_order(spark):
    df = spark.createDataFrame([("s", "mysql-bin.000010:99964"), ("s", "mysql-bin.000010:119884"),
                                ("s", "mysql-bin.000021:0"), ("s", "junk")], "source string, label string")
    r = positions.newest_position(df).collect()[0]
    assert r["newest"] == "mysql-bin.000021:0"
    two = df.filter(F.col("label").startswith("mysql-bin.000010"))
    r = positions.newest_position(two).collect()[0]
    assert r["newest"] == "mysql-bin.000010:119884" and r["newest_by_text"] == "mysql-bin.000010:99964"


def test_parse_and_validate(spark):
    df = spark.createDataFrame([("mysql-bin.000021:7930",), ("mysql-bin.000021:",), ("nofile",), (None,)], "l string")
    got = df.select(is_valid_position("l").alias("ok"), parse_position("l").alias("p")).collect()
    assert [g["ok"] for g in got] == [True, False, False, False]
    assert got[0]["p"]["pos_key"] == 21 * 2 ** 32 + 7930 and got[1]["p"] is None
    assert positions.label_key("mysql-bin.000021:7930") == 21 * 2 ** 32 + 7930


def _changes(spark):
    rows = [(i, "app" if i % 2 else "audit", f"t{i % 3}", ["insert", "update", "delete", "query"][i % 4],
             i * 100) for i in range(40)]
    return spark.createDataFrame(rows, "seq long, db string, tbl string, event_type string, pos_key long")


def test_filters(spark):
    df = _changes(spark)
    assert filters.allow_databases(df, []).count() == 40
    assert filters.allow_databases(df, ["app"]).count() == 20
    assert filters.ignore_databases(df, ["app"]).count() == 20
    assert filters.subscribe(df, ["query"]).count() == 10
    inc = filters.include_tables(df, [("app", "t0"), ("audit", "t1")])
    exc = filters.exclude_tables(df, [("app", "t0"), ("audit", "t1")])
    assert inc.count() + exc.count() == 40
    big = [f"db{i}" for i in range(filters.MAX_IN_LIST + 5)] + ["audit"]       # join path
    assert filters.allow_databases(df, big).count() == 20
    lst = spark.createDataFrame([("app",)], "name string")                        # DataFrame list
    assert filters.allow_databases(df, lst).count() == 20


def test_bounded_scan(spark):
    df = spark.range(0, 10).select((F.lit(3 * 2 ** 32) + F.col("id") * 100).alias("pos_key"))
    got = positions.bounded_scan(df, "mysql-bin.000003:200", "mysql-bin.000003:700")
    assert sorted(r[0] - 3 * 2 ** 32 for r in got.collect()) == [300, 400, 500, 600]
