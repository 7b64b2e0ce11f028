"""Stored DECIMAL, FLOAT and DOUBLE bytes, character sets by row and integers by type text, against Python."""

import math
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide.functions import decode as D

SIZES = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]


def stored(value: str, p: int, s: int) -> bytes:
    """DECIMAL(p, s) as a server stores it."""
    minus, digits = value.startswith("-"), value.lstrip("-")
    whole, _, frac = digits.partition(".")
    whole, frac = whole.zfill(p - s) if p > s else "", frac.ljust(s, "0")
    groups = [whole[:len(whole) % 9]] + [whole[i:i + 9] for i in range(len(whole) % 9, len(whole), 9)]
    groups += [frac[i:i + 9] for i in range(0, len(frac), 9)]
    out = bytearray(b"".join(int(g).to_bytes(SIZES[len(g)], "big") for g in groups if g))
    out[0] ^= 0x80
    return bytes(b ^ 0xFF for b in out) if minus else bytes(out)


def text(value: str, p: int, s: int) -> str:
    d = Decimal(value)
    return f"{abs(d) if d == 0 else d:.{s}f}"


def test_decimals_of_every_shape(spark):
    rng = random.Random(11)
    rows = []
    for p, s in {(w + f, f) for w in [*range(0, 20), 27, 35, 36] for f in [*range(0, 20), 27, 30] if 0 < w + f <= 65}:
        for digits in ("0" * p, "9" * p, "1".zfill(p), "".join(rng.choice("0123456789") for _ in range(p))):
            for sign in ("", "-"):
                v = sign + (digits[:p - s] or "0") + ("." + digits[p - s:] if s else "")
                rows.append((len(rows), p, s, stored(v, p, s), text(v, p, s)))
    df = spark.createDataFrame(rows, "i int, p int, s int, raw binary, want string")
    bad = df.withColumn("got", D.decimal_text("raw", F.col("p"), F.col("s"))).where(~F.col("got").eqNullSafe(F.col("want")))
    assert bad.collect() == [] and len(rows) > 3000


def test_decimal_as_number_and_malformed(spark):
    good = [stored(v, 12, 2) for v in ("-0.01", "1234567890.12", "0", "-9999999999.99")]
    bad = [b"", good[0][:-1], good[0] + b"\0", bytes([0x80 | 0x7F]) + good[1][1:], None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(good + bad)], "i int, raw binary")
    got = [r.v for r in df.select("i", D.decimal_bytes("raw", 12, 2).alias("v")).orderBy("i").collect()]
    assert got == [Decimal("-0.01"), Decimal("1234567890.12"), Decimal("0.00"), Decimal("-9999999999.99")] + [None] * 5
    wide = "123456789" * 7 + "01"
    df = spark.createDataFrame([(stored(wide, 65, 0),)], "raw binary")
    assert df.select(D.decimal_bytes("raw", 65, 0)).first()[0] == wide
    assert df.select(D.decimal_text("raw", 66, 0)).first()[0] is None and df.select(D.decimal_text("raw", 5, 6)).first()[0] is None


@pytest.mark.parametrize("code, decoder", [("<f", D.float_bytes), ("<d", D.double_bytes)])
def test_floats(spark, code, decoder):
    rng, n = random.Random(12), struct.calcsize(code)
    raws = [rng.randbytes(n) for _ in range(2000)]
    raws += [struct.pack(code, v) for v in (0.0, -0.0, 1.0, -1.5, float("inf"), float("-inf"), float("nan"), 5e-324 if n == 8 else 1e-45, 3.4e38)]
    raws += [bytes([1] + [0] * (n - 1)), bytes([255] * (n - 2) + [0x7F if n == 4 else 0xEF, 0x7F])]  # least subnormal, largest
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw binary")
    got = {r.i: r.v for r in df.select("i", decoder("raw").cast("double").alias("v")).collect()}
    for i, raw in enumerate(raws):
        want = struct.unpack(code, raw)[0]
        assert math.isnan(got[i]) if math.isnan(want) else struct.pack("<d", got[i]) == struct.pack("<d", want), (raw, want, got[i])
    assert [r[0] for r in spark.createDataFrame([(b"",), (b"\1" * (n - 1),), (None,)], "raw binary").select(decoder("raw")).collect()] == [None] * 3


def test_character_set_of_the_row(spark):
    rows = [("é".encode(), "utf8mb4", "é", None), ("é€".encode("cp1252"), "LATIN1", "é€", None), ("é".encode(), None, "é", None),
            (b"\xff", "utf8", None, "malformed utf8 text"), (b"a", "koi8r", None, "unknown charset koi8r"), (None, "koi8r", None, None),
            ("h\U0001f600".encode("utf-16-be"), "utf16", "h\U0001f600", None), (b"\x80", "ascii", None, "malformed ascii text")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, raw binary, charset string, want string, error string")
    got = df.select("i", D.text_by_charset("raw", "charset"), D.charset_error("raw", "charset")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [r[2:] for r in rows]


def test_integers_by_type_text(spark):
    cases = [(1, "tinyint(1)", "true", None), (0, "TINYINT(1)", "false", None), (7, "tinyint(1)", None, "no value of tinyint: 7"), (-1, "tinyint", "-1", None),
             (255, "tinyint(3)", "-1", None), (-1, "tinyint unsigned", "255", None), (300, "tinyint", None, "no value of tinyint: 300"),
             (-1, "mediumint(8) unsigned zerofill", "16777215", None), (16777215, "mediumint", "-1", None), (-5, "int(10) unsigned", "4294967291", None),
             (-1, "bigint unsigned", "18446744073709551615", None), (-(2 ** 63), "bigint", str(-(2 ** 63)), None), (2, "enum('a','it''s, unsigned','')", "it's, unsigned", None),
             (0, "enum('a')", "", None), (4, "enum('a','b')", None, "no value of enum: 4"), (5, "set('x','y','z')", "x,z", None), (0, "set('x')", "", None),
             (8, "set('x','y','z')", None, "no value of set: 8"), (101, "year(4)", "2001", None), (0, "year", "0", None), (5, "bit(3)", "5", None),
             (1, "varchar(9)", None, "no decoder for varchar"), (1, None, None, "no such column"), (None, "int", None, None)]
    df = spark.createDataFrame([(i, v, t) for i, (v, t, *_) in enumerate(cases)], "i int, v long, t string")
    got = df.select("i", D.by_type("v", "t").alias("d")).orderBy("i").collect()
    assert [(r.d.value, r.d.error) for r in got] == [c[2:] for c in cases]
    flags = df.where("i = 12").select(D.column_flags("t", F.lit(""), F.lit("")).alias("f")).first().f
    assert not flags.unsigned


def test_type_text_is_taken_apart_below_the_join(spark):
    from rowtide.operators import schema
    cells = spark.createDataFrame([("d", "t", 5, 1, 3), ("d", "t", 5, 2, 1), ("d", "t", 5, 3, 1), ("d", "t", 5, 1, None)], "db string, tbl string, pos_key long, ordinal int, stored long")
    columns = spark.createDataFrame([("d", "t", 1, "a", "SET('x','y')", "", 0, None), ("d", "t", 2, "b", "int unsigned", "PRI", 0, None)],
                                    "db string, tbl string, ordinal int, name string, type string, key string, valid_from long, valid_to long")
    out = schema.decode_by_schema(cells, columns)
    got = sorted(((r.ordinal, r.value, r.error, r.unsigned) for r in out.collect()), key=str)
    assert got == sorted([(1, "x,y", None, False), (1, None, None, False), (2, "1", None, True), (3, None, "no such column", None)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower().split("join")[0]
