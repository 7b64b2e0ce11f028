"""A raw binlog (RAW_EVENT: source, ordinal, payload) derived from the change feed.

Each change becomes the events a server writes for it: a GTID event, the
row event (WRITE/UPDATE/DELETE_ROWS v2) or the QUERY event, and an XID
commit after row events; every 1000th change opens a new log file with an
artificial ROTATE event.  Payloads carry real headers, query / rotate / GTID
/ XID bodies and a CRC32 trailer, built with Spark expressions.  Row bodies
are a table id and flags only (the per-row byte codec is not rebuilt).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.header import le_hex, text_hex
from ..model import CHECKSUM_LEN, HEADER_LEN
from ..operators.shape import event_seconds
from .feeds import changelog, stored

SOURCE = "srv-2"
# Changes of db "app" come from server 2, all others from server 3.
SERVER_APP, SERVER_OTHER = 2, 3
ARTIFICIAL_FLAG = 32


def _event(offset, type_code, body_hex, log_pos, flags, ts):
    tc = type_code if isinstance(type_code, Column) else F.lit(type_code)
    return F.struct(F.lit(offset).alias("k"), tc.cast("int").alias("type_code"),
                    body_hex.alias("body"), log_pos.cast("long").alias("log_pos"),
                    flags.cast("int").alias("flags"), ts.cast("long").alias("ts"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log, landed: a filter on a decoded field would otherwise be pushed below the payload
    and put it together again for every byte that the field's expression names."""
    cl = changelog(spark, sf_dir)
    seq, et = F.col("seq"), F.col("event_type")
    secs = event_seconds("ev_ts")
    row_code = F.when(et == "insert", 30).when(et == "update", 31).when(et == "delete", 32)
    rotate = _event(0, 4, F.concat(le_hex(F.lit(4), 8), text_hex("log_file")), F.lit(0),
                    F.lit(ARTIFICIAL_FLAG), F.lit(0))
    gtid = _event(1, 33, F.concat(F.lit("00" * 17), le_hex(seq, 8)), F.col("log_pos") + 1, F.lit(0), secs)
    flags = (seq * 37) % 2048
    query = _event(2, 2, F.concat(le_hex(seq, 4), le_hex(F.lit(0), 4), le_hex(F.octet_length("db"), 1),
                                  le_hex(F.lit(0), 2), le_hex(F.lit(0), 2), text_hex("db"), F.lit("00"),
                                  text_hex("query")),
                   F.col("log_pos"), flags, secs)
    rows = _event(2, row_code, F.concat(le_hex(F.substring("tbl", 2, 9).cast("long") + 100, 6),
                                        le_hex(F.lit(1), 2)),
                  F.col("log_pos"), flags, secs)
    xid = _event(3, 16, le_hex(seq, 8), F.col("log_pos") + 2, F.lit(0), secs)
    # Absent events (no rotate, no XID after a query) are null slots, dropped after
    # the explode: a plain filter stays in generated code, a lambda filter would not.
    events = F.array(F.when(seq % 1000 == 0, rotate), gtid, F.when(et == "query", query).otherwise(rows),
                     F.when(et != "query", xid))
    server = F.when(F.col("db") == "app", SERVER_APP).otherwise(SERVER_OTHER)
    ev = (cl.select(seq, server.alias("server_id"), F.explode(events).alias("e"))
            .filter(F.col("e").isNotNull()).select("seq", "server_id", "e.*"))
    size = F.lit(HEADER_LEN + CHECKSUM_LEN) + F.length("body") / 2
    head = F.concat(le_hex("ts", 4), le_hex("type_code", 1), le_hex("server_id", 4),
                    le_hex(size.cast("long"), 4), le_hex("log_pos", 4), le_hex("flags", 2))
    body = F.unhex(F.concat(head, F.col("body")))
    return stored(ev.select(F.lit(SOURCE).alias("source"), (F.col("seq") * 4 + F.col("k")).alias("ordinal"),
                            F.concat(body, F.unhex(le_hex(F.crc32(body), CHECKSUM_LEN))).alias("payload")), "raw")


def damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events with damage: every 71st is cut inside its header, every 89th loses its last five bytes, and of
    every 53rd the byte before the trailer is inverted."""
    p, n = F.col("payload"), F.length("payload")
    byte = F.unhex(F.translate(F.hex(p.substr(n - CHECKSUM_LEN, F.lit(1))), "0123456789ABCDEF", "FEDCBA9876543210"))
    wrong = F.concat(p.substr(F.lit(1), n - CHECKSUM_LEN - 1), byte, p.substr(n - CHECKSUM_LEN + 1, F.lit(CHECKSUM_LEN)))
    o = F.col("ordinal")
    damaged = (F.when(o % 71 == 0, p.substr(1, 12)).when(o % 89 == 0, p.substr(F.lit(1), n - 5)).when(o % 53 == 0, wrong).otherwise(p))
    # the payload stands in every branch: raw_events is landed, so it is put together once
    return raw_events(spark, sf_dir).withColumn("payload", damaged)
