"""Raw event bytes: checksum verdicts and body splits on hand-built events."""

import struct
import zlib

from pyspark.sql import functions as F

from rowtide.functions import header as H
from rowtide.operators import rawlog


def _event(type_code, body, log_pos=120, flags=0, ts=1542886275, server=2):
    size = 19 + len(body) + 4
    head = struct.pack("<IBIIIH", ts, type_code, server, size, log_pos, flags)
    raw = head + body
    return raw + struct.pack("<I", zlib.crc32(raw))


def test_query_and_rotate(spark):
    q = _event(2, struct.pack("<IIBHH", 9, 0, 4, 0, 0) + b"shop" + b"\x00" + b"ALTER TABLE t ADD c INT")
    r = _event(4, struct.pack("<Q", 4) + b"mysql-bin.000022", log_pos=0, flags=32)
    bad = bytearray(_event(16, struct.pack("<Q", 77)))
    bad[20] ^= 0xFF
    df = spark.createDataFrame([("s", 1, q), ("s", 2, r), ("s", 3, bytes(bad))], "source string, ordinal long, payload binary")
    ev = rawlog.decode_headers(df).orderBy("ordinal").collect()
    assert [e["type_code"] for e in ev] == [2, 4, 16]
    assert [e["checksum_ok"] for e in ev] == [True, True, False]
    assert ev[1]["flags"] == 32 and ev[0]["server_id"] == 2
    body = df.filter("ordinal = 1").select(H.query_body("payload").alias("q")).collect()[0]["q"]
    assert (body["schema"], body["query"], body["proxy_id"]) == ("shop", "ALTER TABLE t ADD c INT", 9)
    rot = df.filter("ordinal = 2").select(H.rotate_body("payload").alias("r")).collect()[0]["r"]
    assert (rot["next_pos"], rot["next_file"]) == (4, "mysql-bin.000022")


def test_names(spark):
    df = spark.createDataFrame([(31, 1 | 32 | 1024), (99, 0)], "t int, f int")
    got = df.select(H.event_name("t").alias("n"), H.flag_names("f").alias("fl")).collect()
    assert got[0]["n"] == "UPDATE_ROWS_EVENTv2" and got[1]["n"] == "99"
    assert got[0]["fl"] == ["LOG_EVENT_BINLOG_IN_USE_F", "LOG_EVENT_ARTIFICIAL_F", "UNKNOWN_0x400"]
    assert got[1]["fl"] == []


def test_fill_log_file_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(rawlog, "ORDINAL_BUCKET_BITS", 2)
    rot = _event(4, struct.pack("<Q", 4) + b"f.000001", log_pos=0)
    rot2 = _event(4, struct.pack("<Q", 4) + b"f.000002", log_pos=0)
    other = _event(16, struct.pack("<Q", 1))
    rows = [("s", 0, rot)] + [("s", i, other) for i in range(1, 30)] + [("s", 30, rot2), ("s", 31, other)]
    df = rawlog.decode_headers(spark.createDataFrame(rows, "source string, ordinal long, payload binary"))
    got = dict(rawlog.fill_log_file(df).select("ordinal", "log_file").collect())
    assert got[29] == "f.000001" and got[31] == "f.000002" and got[0] == "f.000001"


def test_torn_header_has_no_fields(spark):
    from rowtide.functions import header
    df = spark.createDataFrame([(bytearray(b"x" * 18),), (bytearray(b""),), (None,)], "p binary")
    assert {tuple(r["h"]) for r in df.select(header.header("p").alias("h")).collect()} == {(None,) * 6}


def _raw_log(spark, tmp_path):
    """The raw log of 2,000 events, and its decoded headers."""
    from datetime import datetime

    from rowtide.sources.rawlog import raw_events
    rows = [(i, datetime(2024, 1, 1, 0, i // 60 % 60, i % 60), i % 7, ("view", "signup", "error")[i % 3], float(i), f"p{i}") for i in range(2000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    return rawlog.decode_headers(raw_events(spark, str(tmp_path)))


def test_dispatch_does_not_build_payloads_again(spark, tmp_path):
    kept = rawlog.dispatch(_raw_log(spark, tmp_path))
    assert "crc32" not in kept.select("ordinal", "type_code")._jdf.queryExecution().optimizedPlan().toString()
    got = {r["type_code"]: r["n"] for r in kept.groupBy("type_code").agg(F.count("*").alias("n")).collect()}
    assert got[4] == 2 and got[2] == 8 and got[16] == 1992 and got[30] + got[31] + got[32] == 1992 and 33 not in got


def test_server_filter_does_not_build_payloads_again(spark, tmp_path):
    from rowtide.operators import filters
    kept = filters.from_server(_raw_log(spark, tmp_path), 3)
    assert "crc32" not in kept.select("ordinal", "server_id")._jdf.queryExecution().optimizedPlan().toString()
    users = [i % 7 for i in range(2000)]
    odd = [i for i, u in enumerate(users) if u % 2]  # users of db audit
    assert kept.count() == sum((i % 1000 == 0) + 2 + (i % 250 != 0) for i in odd)
