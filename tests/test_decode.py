"""Boundary values of every stored-value decoder."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from rowtide.functions import decode as D


def one(spark, expr, value, schema="x long"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_unsigned(spark):
    assert one(spark, D.unsigned("x", 8), -1) == 255
    assert one(spark, D.unsigned("x", 8), -128) == 128
    assert one(spark, D.unsigned("x", 16), -1) == 65535
    assert one(spark, D.unsigned("x", 24), -1) == 16777215
    assert one(spark, D.unsigned("x", 32), -2147483648) == 2147483648
    assert one(spark, D.unsigned("x", 64), -1) == Decimal("18446744073709551615")
    assert one(spark, D.unsigned("x", 64), 5) == Decimal(5)


def test_signed24(spark):
    assert one(spark, D.signed24("x"), 8388608) == -8388608
    assert one(spark, D.signed24("x"), 16777215) == -1
    assert one(spark, D.signed24("x"), 8388607) == 8388607
    assert one(spark, D.signed24("x"), 256) == 256          # more than the low byte


def test_bool_year_decimal(spark):
    assert one(spark, D.tinyint_bool("x"), 1) is True
    assert one(spark, D.tinyint_bool("x"), 0) is False
    assert one(spark, D.tinyint_bool("x"), 7) is None
    assert one(spark, D.year("x"), 0) is None
    assert one(spark, D.year("x"), 118) == 2018
    assert one(spark, D.exact_decimal("x", 10, 2), "9.39", "x string") == Decimal("9.39")
    assert one(spark, D.exact_decimal("x", 65, 30), "1.5", "x string") == "1.5"
    assert one(spark, D.exact_decimal("x", 10, 2), "junk", "x string") is None


def test_dates_and_times(spark):
    assert one(spark, D.packed_date("x"), (2018 << 9) | (5 << 5) | 8) == datetime.date(2018, 5, 8)
    assert one(spark, D.packed_date("x"), 0) is None
    assert one(spark, D.packed_date("x"), (2018 << 9) | (2 << 5) | 30) is None      # Feb 30
    assert one(spark, D.interval_seconds(D.time_hhmmss("x")), 153959) == 15 * 3600 + 39 * 60 + 59
    assert one(spark, D.interval_text(D.time_hhmmss("x")), -8385959) == "-838:59:59"
    t2 = 8388608 - ((12 << 12) | (10 << 6) | 10)                                  # -12:10:10
    assert one(spark, D.interval_text(D.time2("x")), t2) == "-12:10:10"
    assert one(spark, D.datetime_from_int("x"), 20180508153021) == datetime.datetime(2018, 5, 8, 15, 30, 21)
    assert one(spark, D.datetime_from_int("x"), 0) is None
    dt2 = 549755813888 | ((2018 * 13 + 5) << 22) | (8 << 17) | (15 << 12) | (30 << 6) | 21
    assert one(spark, D.datetime2("x"), dt2) == datetime.datetime(2018, 5, 8, 15, 30, 21)
    assert one(spark, D.datetime2("x"), 549755813888) is None                       # zero date
    assert one(spark, D.datetime2("x", F.lit(250000)), dt2) == datetime.datetime(2018, 5, 8, 15, 30, 21, 250000)


def test_enum_set_bit_text(spark):
    labels = F.array(F.lit("en1"), F.lit("en2"))
    assert one(spark, D.enum_label("x", labels), 2) == "en2"
    assert one(spark, D.enum_label("x", labels), 0) == ""
    assert one(spark, D.enum_label("x", labels), 3) is None
    many = F.array(*[F.lit(f"m{i}") for i in range(64)])
    got = one(spark, D.set_labels("x", many), -9223372036854775807 - 1)      # bit 63 only
    assert got == ["m63"]
    assert one(spark, D.set_labels("x", F.array(F.lit("set1"), F.lit("set2"), F.lit("set3"))), 5) == ["set1", "set3"]
    assert one(spark, D.bit_value("x"), bytes([0xff] * 8), "x binary") == Decimal("18446744073709551615")
    assert one(spark, D.bit_value("x"), bytes([8]), "x binary") == Decimal(8)
    assert one(spark, D.text_value("x", "latin1"), "caf\xe9".encode("latin-1"), "x binary") == "caf\xe9"


def test_type_text(spark):
    labels = one(spark, D.type_labels("x"), "enum('a,b','it''s','x)y')", "x string")
    assert labels == ["a,b", "it's", "x)y"]
    assert one(spark, D.type_labels("x"), "int", "x string") is None
    f = one(spark, D.column_flags("x", F.lit("PRI"), F.lit("auto_increment")), "bigint(20) unsigned", "x string")
    assert f.unsigned and f.is_primary and f.auto_increment and not f.is_bool
    assert one(spark, D.decode_error("x"), 255) == "unimplemented type FIELD_TYPE_GEOMETRY"
    assert one(spark, D.decode_error("x"), 100) == "unknown field type 100"
    assert one(spark, D.decode_error("x"), 3) is None


def test_fraction_widths_of_time2(spark):
    """-00:00:01.5 at every width: the integer part is one lower, the fraction a complement."""
    for fsp, bits, unit in ((1, 8, 100), (2, 8, 100), (3, 16, 10_000), (4, 16, 10_000), (5, 24, 1_000_000), (6, 24, 1_000_000)):
        for sign in (1, -1):
            stored = (0x800000 << bits) + sign * ((1 << bits) + unit // 2)
            iv = D.time2(F.lit(stored >> bits), F.lit(stored & ((1 << bits) - 1)), fsp)
            assert float(spark.range(1).select(D.interval_seconds(iv)).first()[0]) == sign * 1.5
        assert spark.range(1).select(D.fraction_micros(F.lit(unit // 2), fsp)).first()[0] == 500_000


def test_text_in_every_character_set(spark):
    cases = [("utf8mb4", "caf\u00e9 \U0001f600".encode(), "caf\u00e9 \U0001f600"), ("utf8", b"\xff\xfe", None), ("utf8mb4", b"\xc3", None),
             ("latin1", b"\x80\x9f\x81\xe9", "\u20ac\u0178\x81\u00e9"), ("ascii", b"abc", "abc"), ("ascii", b"\x80", None),
             ("utf16", "h\U0001f600".encode("utf-16-be"), "h\U0001f600"), ("utf16", b"\xd8\x00\x00\x41", None), ("utf16", b"\x00", None),
             ("utf16le", "h\U0001f600".encode("utf-16-le"), "h\U0001f600"), ("utf16le", b"\x00\xdc", None), ("klingon", b"x", None)]
    for charset, raw, want in cases:
        r = spark.createDataFrame([(bytearray(raw),)], "x binary").select(D.text_value("x", charset).alias("t"), D.text_error("x", charset).alias("e")).first()
        assert (r.t, r.e is None) == (want, want is not None), (charset, raw, r)
    assert spark.createDataFrame([(None,)], "x binary").select(D.text_error("x", "utf8")).first()[0] is None
