"""Envelopes built by our writer and read back, value by value."""

import datetime
import json
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators import consume, schema, shape

WIDE = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("u_big", T.DecimalType(20, 0)),
    T.StructField("tiny", T.ByteType()), T.StructField("flag", T.BooleanType()),
    T.StructField("day", T.DateType()), T.StructField("moment", T.TimestampNTZType()),
    T.StructField("price", T.DecimalType(10, 2)), T.StructField("ratio", T.DoubleType()),
    T.StructField("kind", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("blob", T.StringType()), T.StructField("yr", T.IntegerType()),
    T.StructField("medium", T.IntegerType()), T.StructField("note", T.StringType()),
])


def _image(medium, note="x"):
    return (1, Decimal("18446744073709551615"), -1, True, datetime.date(2018, 5, 8),
            datetime.datetime(2018, 5, 8, 15, 30, 21), Decimal("9.39"), 9.39, "en2", ["set1", "set3"],
            "YmxvYg==", 2018, medium, note)


def _update(spark):
    schema_ = T.StructType([T.StructField("log_file", T.StringType()), T.StructField("log_pos", T.LongType()),
                            T.StructField("db", T.StringType()), T.StructField("tbl", T.StringType()),
                            T.StructField("event_type", T.StringType()), T.StructField("query", T.StringType()),
                            T.StructField("primary", T.StringType()), T.StructField("before", WIDE),
                            T.StructField("after", WIDE), T.StructField("ev_ts", T.TimestampNTZType())])
    row = ("mysql-bin.000005", 4, "shop", "items", "update", "", "id", _image(-3, None), _image(-5, None),
           datetime.datetime(2018, 11, 22, 11, 31, 15))
    return spark.createDataFrame([row], schema_)


def test_update_round_trip(spark):
    env = shape.envelope(_update(spark))
    text = env.select(shape.envelope_text().alias("v")).collect()[0]["v"]
    doc = json.loads(text)
    assert doc["binlog"] == "mysql-bin.000005:4" and doc["table"] == "items" and doc["primary"] == "id"
    assert doc["timestamp"] == 1542886275
    assert doc["before"]["medium"] == -3 and doc["after"]["medium"] == -5
    assert "note" in doc["before"] and doc["before"]["note"] is None          # null kept as a key
    assert doc["after"]["tags"] == ["set1", "set3"]
    back = shape.parse_envelope_json(env.select(shape.envelope_text().alias("value")))
    assert back.collect()[0]["binlog"] == "mysql-bin.000005:4"
    parsed = env.select(F.from_json(shape.envelope_text(), T.StructType(
        [T.StructField("after", WIDE)])).alias("e")).collect()[0]["e"]["after"]
    assert parsed["u_big"] == Decimal("18446744073709551615") and parsed["day"] == datetime.date(2018, 5, 8)


def test_changed_columns_finds_the_one_change(spark):
    fields = [f.name for f in WIDE.fields]
    got = consume.changed_columns(_update(spark), fields).select("changed", "n_changed").collect()[0]
    assert got["changed"] == "medium" and got["n_changed"] == 1


def test_ddl_envelope(spark):
    rows = [("mysql-bin.000021", 1126, "shop", "", "query",
             "ALTER TABLE `orders2`  ADD `note` INT(12) NOT NULL  AFTER `qty`", "",
             datetime.datetime(2018, 11, 22, 11, 31, 15), 0, 0)]
    df = spark.createDataFrame(rows, "log_file string, log_pos long, db string, tbl string, event_type string, "
                                     "query string, primary string, ev_ts timestamp_ntz, pos_key long, row_no int")
    df = df.withColumn("before", F.lit(None).cast(WIDE)).withColumn("after", F.lit(None).cast(WIDE))
    doc = json.loads(shape.envelope(df).select(shape.envelope_text().alias("v")).collect()[0]["v"])
    assert doc["before"] == {} and doc["after"] == {} and doc["event_type"] == "query"
    t = schema.ddl_changes(df).collect()[0]
    assert (t["ddl_kind"], t["db"], t["tbl"]) == ("ALTER", "shop", "orders2")
    q = df.withColumn("query", F.lit("alter table `crm`.`people` drop column x"))
    t = schema.ddl_changes(q).collect()[0]
    assert (t["db"], t["tbl"]) == ("crm", "people")


def test_pair_updates_keeps_odd_tail(spark):
    img = "struct<row_no:bigint,v:bigint>"
    ev = spark.createDataFrame([(1, 0, "update", [(0, 10), (1, 11), (2, 20)])],
                               f"l_orderkey long, chunk long, op string, rows array<{img}>")
    got = shape.pair_updates(ev).orderBy("pair_no").collect()
    assert [r["status"] for r in got] == ["paired", "odd_tail"]
    assert got[0]["before"]["v"] == 10 and got[0]["after"]["v"] == 11 and got[1]["after"] is None
    empty = spark.createDataFrame([(2, 0, "update", [])], f"l_orderkey long, chunk long, op string, rows array<{img}>")
    assert shape.pair_updates(empty).count() == 0


def test_envelope_text_is_valid_json_for_awkward_values(spark):
    import json

    from rowtide.operators.shape import envelope_text
    rows = [("f.000001:4", "d", 't"1', "ALTER TABLE `t` ADD `c` INT -- \"q\"\n", "query", "", None, None, None),
            ("f.000001:9", "d", "t", "", "insert", "id", None, (1, 'a\\b"c\n', None), 1542886275),
            ("f.000001:12", "d", "t", "", "delete", "id", (2, None, 1.5), None, 0)]
    img = "struct<id:bigint,s:string,x:double>"
    df = spark.createDataFrame(rows, f"binlog string, db string, table string, query string, event_type string, "
                                     f"primary string, before {img}, after {img}, timestamp bigint")
    got = [json.loads(r[0]) for r in df.select(envelope_text()).collect()]
    assert list(got[0]) == ["binlog", "db", "table", "query", "event_type", "primary", "before", "after",
                            "timestamp"]
    assert got[0]["table"] == 't"1' and got[0]["query"].endswith('"q"\n')
    assert got[0]["before"] == {} and got[0]["after"] == {} and got[0]["timestamp"] is None
    assert got[1]["after"] == {"id": 1, "s": 'a\\b"c\n', "x": None} and got[1]["before"] == {}
    assert got[2]["before"] == {"id": 2, "s": None, "x": 1.5} and got[2]["timestamp"] == 0


def test_variant_route_types_each_table(spark):
    from pyspark.sql import functions as F

    from rowtide.operators.shape import envelope, envelope_text, parse_envelope_variant, typed_images
    from rowtide.sources import feeds
    from tests.conftest import SF_SMALL
    env = envelope(feeds.changelog(spark, SF_SMALL))
    parsed = parse_envelope_variant(env.select(envelope_text().alias("value"))
                                    .unionByName(feeds.shop_envelopes(spark, SF_SMALL)))
    img = "struct<id:bigint,value:double,props:string>"
    back = typed_images(parsed.filter(F.col("db").isin("app", "audit")), img)
    cols = ["binlog", "event_type", "before", "after"]
    assert sorted(back.select(cols).collect()) == sorted(env.select(cols).collect())
    shop = typed_images(parsed.filter(F.col("db") == "shop"),
                        "struct<l_orderkey:bigint,l_linenumber:int,l_partkey:bigint,l_quantity:double>")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter(F.col("l_linenumber") != feeds.GARBLED_LINE)
    assert shop.count() == li.count() and shop.filter(F.col("before").isNotNull()).count() == 0
    assert shop.agg(F.sum("after.l_quantity")).first()[0] == li.agg(F.sum("l_quantity")).first()[0]
    garbled = parsed.filter("malformed")
    assert garbled.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter(
        F.col("l_linenumber") == feeds.GARBLED_LINE).count()
    assert garbled.filter(F.col("db").isNotNull()).count() == 0


def test_latest_state_partial_images(spark):
    from pyspark.sql import functions as F

    from rowtide.functions.image import present_fields
    from rowtide.operators import consume
    from rowtide.sources import feeds
    from tests.conftest import SF_SMALL
    img = "struct<id:bigint,value:double,props:string>"
    rows = [  # (pos, op, after, present mask: bit0 id, bit1 value, bit2 props)
        (1, "insert", (1, 1.0, "a"), 7),
        (2, "update", (1, None, "b"), 5),          # value absent
        (3, "update", (1, 2.0, None), 3),          # props absent
        (4, "insert", (2, 5.0, "x"), 7),
        (5, "update", (2, 6.0, None), 7),          # props present and NULL
        (6, "insert", (3, 1.0, "q"), 7),
        (7, "delete", None, 0)]
    df = spark.createDataFrame(
        [("d", "t", p, 0, op, a, m, (3, None, None) if op == "delete" else None) for p, op, a, m in rows],
        f"db string, tbl string, pos_key long, row_no int, event_type string, after {img}, "
        f"after_present long, before {img}")
    got = {r["id"]: (r["value"], r["props"], r["last_op"]) for r in consume.latest_state_partial(df).collect()}
    assert got == {1: (2.0, "b", "update"), 2: (6.0, None, "update")}
    assert df.select(present_fields("after_present", ["id", "value", "props"]).alias("f")).first()["f"] == \
        ["id", "value", "props"]
    # on the derived MINIMAL feed the per-column answer differs from "newest image wins"
    part = feeds.partial_changelog(spark, SF_SMALL)
    a = consume.latest_state_partial(part).select("db", "tbl", "id", "props")
    b = consume.latest_state(part).select("db", "tbl", "id", "props")
    assert a.exceptAll(b).count() > 0
