"""Randomised checks of the codecs against plain-Python decoders of the documented layouts.

Each property runs a few hundred random cases (boundary values included) in
one Spark job, so the check is broad without one job per example.
"""

import datetime
import random
import struct
import zlib

from pyspark.sql import functions as F

from rowtide.functions import decode as D
from rowtide.operators import rawlog

N = 400
U32 = (1 << 32) - 1


def _rnd(seed):
    return random.Random(seed)


def test_header_codec_against_struct(spark):
    rnd = _rnd(1)
    edge = [0, 1, U32, U32 - 1, 1 << 31]
    rows, want = [], {}
    for i in range(N):
        ts, server, log_pos = (rnd.choice(edge) if rnd.random() < 0.3 else rnd.randint(0, U32) for _ in range(3))
        tc, flags = rnd.randint(0, 255), rnd.choice([0, 0xFFFF, rnd.randint(0, 0xFFFF)])
        body = bytes(rnd.randint(0, 255) for _ in range(rnd.randint(0, 40)))
        size = 19 + len(body) + 4
        raw = struct.pack("<IBIIIH", ts, tc, server, size, log_pos, flags) + body
        payload = raw + struct.pack("<I", zlib.crc32(raw))
        if i % 7 == 0:                                   # corrupt one byte: the checksum must fail
            b = bytearray(payload)
            b[rnd.randrange(len(b) - 4)] ^= 0x5A
            payload = bytes(b)
            ts, tc, server, size, log_pos, flags = struct.unpack("<IBIIIH", payload[:19])
        rows.append(("s", i, payload))
        want[i] = (ts, tc, server, size, log_pos, flags, i % 7 != 0)
    df = rawlog.decode_headers(spark.createDataFrame(rows, "source string, ordinal long, payload binary"))
    got = df.select("ordinal", F.unix_seconds("ts").alias("ts"), "type_code", "server_id", "event_size",
                    "log_pos", "flags", "checksum_ok").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_datetime2_and_packed_date(spark):
    rnd = _rnd(2)
    rows, want = [], {}
    for i in range(N):
        d = datetime.datetime(rnd.randint(1000, 9999), rnd.randint(1, 12), rnd.randint(1, 28),
                              rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
        if i % 50 == 0:
            d = datetime.datetime(9999, 12, 31, 23, 59, 59)
        ym = d.year * 13 + d.month
        dt2 = (1 << 39) | (ym << 22) | (d.day << 17) | (d.hour << 12) | (d.minute << 6) | d.second
        d3 = (d.year << 9) | (d.month << 5) | d.day
        rows.append((i, dt2, d3))
        want[i] = (d, d.date())
    df = spark.createDataFrame(rows, "i long, dt2 long, d3 long")
    got = df.select("i", D.datetime2("dt2").alias("a"), D.packed_date("d3").alias("b")).collect()
    assert {r["i"]: (r["a"], r["b"]) for r in got} == want


def test_integer_reinterpretation(spark):
    rnd = _rnd(3)
    rows, want = [], {}
    for i in range(N):
        bits = rnd.choice([8, 16, 24, 32, 64])
        x = rnd.choice([-1, -(1 << (bits - 1)), 0, (1 << (bits - 1)) - 1, rnd.randint(-(1 << (bits - 1)),
                                                                                     (1 << (bits - 1)) - 1)])
        raw24 = rnd.randint(0, (1 << 24) - 1)
        rows.append((i, bits, x, raw24))
        want[i] = (x % (1 << bits), raw24 - (1 << 24) if raw24 >= (1 << 23) else raw24)
    df = spark.createDataFrame(rows, "i long, bits int, x long, raw24 long")
    u = F.coalesce(*[F.when(F.col("bits") == b, D.unsigned("x", b).cast("decimal(20,0)")) for b in (8, 16, 24, 32, 64)])
    got = df.select("i", u.alias("u"), D.signed24("raw24").alias("s")).collect()
    assert {r["i"]: (int(r["u"]), r["s"]) for r in got} == want


def test_set_and_bit(spark):
    rnd = _rnd(4)
    labels = [f"m{k}" for k in range(64)]
    rows, want = [], {}
    for i in range(N):
        mask = rnd.choice([0, (1 << 63) - 1, -1, -(1 << 63), rnd.getrandbits(63)])   # -1, -2^63: bit 63 set
        nbytes = rnd.randint(1, 8)
        b = bytes(rnd.randint(0, 255) for _ in range(nbytes))
        rows.append((i, mask, b))
        want[i] = ([lab for k, lab in enumerate(labels) if mask >> k & 1], int.from_bytes(b, "big"))
    df = spark.createDataFrame(rows, "i long, mask long, b binary")
    arr = F.array(*[F.lit(x) for x in labels])
    got = df.select("i", D.set_labels("mask", arr).alias("s"), D.bit_value("b").alias("v"),
                    D.set_labels("mask", labels).alias("s2")).collect()
    assert {r["i"]: (list(r["s"]), int(r["v"])) for r in got} == want
    assert all(list(r["s"]) == list(r["s2"]) for r in got)             # literal labels: same answer


def test_time_and_time2(spark):
    """TIME (signed HHMMSS integer) and TIME2 (0x800000 + sign * hour<<12|minute<<6|second),
    range -838:59:59 .. 838:59:59, against seconds and [-]H:MM:SS text."""
    rnd = _rnd(5)
    rows, want = [], {}
    for i in range(N):
        h, m, s = rnd.choice([0, 838, rnd.randint(0, 838)]), rnd.randint(0, 59), rnd.randint(0, 59)
        sign = -1 if rnd.random() < 0.4 and (h, m, s) != (0, 0, 0) else 1
        rows.append((i, sign * (h * 10000 + m * 100 + s), 0x800000 + sign * ((h << 12) | (m << 6) | s)))
        secs = sign * (h * 3600 + m * 60 + s)
        want[i] = (secs, secs, f"{'-' if sign < 0 else ''}{h}:{m:02d}:{s:02d}")
    df = spark.createDataFrame(rows, "i long, hhmmss long, t2 long")
    t1, t2 = D.time_hhmmss("hhmmss"), D.time2("t2")
    got = df.select("i", D.interval_seconds(t1).cast("long").alias("a"), D.interval_seconds(t2).cast("long").alias("b"),
                    D.interval_text(t1).alias("c")).collect()
    assert {r["i"]: (r["a"], r["b"], r["c"]) for r in got} == want


def test_fractional_seconds_kept(spark):
    """DATETIME2 / TIMESTAMP2 with their fraction in microseconds, TIME2 with its stored bytes:
    a negative time is the complement of all its bytes together."""
    rnd = _rnd(6)
    rows, want = [], {}
    for i in range(N):
        d = datetime.datetime(rnd.randint(1970, 2037), rnd.randint(1, 12), rnd.randint(1, 28),
                              rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
        us = rnd.choice([0, 999999, rnd.randint(0, 999999)])
        dt2 = (1 << 39) | ((d.year * 13 + d.month) << 22) | (d.day << 17) | (d.hour << 12) | (d.minute << 6) | d.second
        h, m, s = rnd.randint(0, 838), rnd.randint(0, 59), rnd.randint(0, 59)
        sign = rnd.choice([1, -1])
        stored = (0x800000 << 24) + sign * ((((h << 12) | (m << 6) | s) << 24) + us)
        secs = rnd.randint(0, U32)
        rows.append((i, dt2, stored >> 24, stored & 0xFFFFFF, secs, us))
        want[i] = (d.replace(microsecond=us), sign * ((h * 3600 + m * 60 + s) * 1000000 + us), secs * 1000000 + us)
    df = spark.createDataFrame(rows, "i long, dt2 long, t2 long, f long, secs long, us long")
    iv = D.time2("t2", "f")
    got = df.select("i", D.datetime2("dt2", "us").alias("a"),
                    (D.interval_seconds(iv) * 1000000).cast("long").alias("b"),
                    F.unix_micros(D.timestamp_from_seconds("secs", "us")).alias("c")).collect()
    assert {r["i"]: (r["a"], r["b"], r["c"]) for r in got} == want
