"""Stored-value decoders (D1-D19): Column -> Column, all JVM-side expressions.

Input cells are the integers / text / bytes a row image stores for a column,
plus that column's catalogue entry (type text, charset, scale).  Every
decoder is a pure projection, so Catalyst pushes filters below it, prunes the
columns it does not read and compiles it into the scan's codegen stage.
Invalid stored values give null (and a reason from ``decode_error``) instead
of failing the task: ANSI mode is on, so only ``try_*`` builders are used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import FIELD_TYPE_NAMES, UNSUPPORTED_FIELD_CODES

TWO_64 = "18446744073709551616BD"  # 2^64 as an exact decimal literal
# The epoch as a wall clock: zone-free arithmetic on timestamp_ntz values.
def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# D1 ------------------------------------------------------------------------
def unsigned(x, bits: int) -> Column:
    """Reinterpret a signed stored integer as unsigned (8/16/24/32/64 bits)."""
    v = _c(x).cast("long")
    if bits == 64:
        d = v.cast("decimal(20,0)")
        return F.when(v < 0, d + F.expr(TWO_64)).otherwise(d).cast("decimal(20,0)")
    return v.bitwiseAND(F.lit((1 << bits) - 1)).cast("long")


def signed24(x) -> Column:
    """Sign-extend a raw 24-bit pattern (MEDIUMINT)."""
    v = _c(x).cast("long")
    return (v.bitwiseAND(F.lit(8388607)) - v.bitwiseAND(F.lit(8388608))).cast("int")


# D2 ------------------------------------------------------------------------
def tinyint_bool(x) -> Column:
    """``tinyint(1)``: 1 -> true, 0 -> false, anything else -> null (keep the number beside it)."""
    v = _c(x)
    return F.when(v == 1, F.lit(True)).when(v == 0, F.lit(False))


# D3 ------------------------------------------------------------------------
def year(x) -> Column:
    """YEAR byte: 0 means no year, otherwise 1900 + byte."""
    v = _c(x).cast("int")
    return F.when(v != 0, v + 1900)


# D5 ------------------------------------------------------------------------
def exact_decimal(text, precision: int, scale: int) -> Column:
    """DECIMAL text -> decimal(p, s); text kept when p exceeds Spark's 38 digits."""
    t = _c(text)
    if precision > 38:
        return t.cast("string")
    return t.try_cast(f"decimal({precision},{scale})")


# FIXED VALUE: bytes that hold 0 to 9 decimal digits of a stored DECIMAL.
DIGIT_BYTES = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
_HEX, _INVERTED, _TOP_FLIPPED = "0123456789ABCDEF", "FEDCBA9876543210", "89ABCDEF01234567"


def decimal_text(raw, precision, scale) -> Column:
    """Stored DECIMAL bytes -> its exact text, up to 65 digits.

    ``precision`` and ``scale`` are numbers or columns.  The bytes hold the integer digits and then
    the fraction, nine digits in four bytes (big-endian), a short group of the other digits first
    and last; the top bit is set for values of zero or more, and negative ones have every bit
    inverted.  Null for bytes of another length and groups with more digits than they may hold.
    """
    n, s = (x if isinstance(x, Column) else F.lit(x) for x in (precision, scale))
    n, s, sizes = n.cast("int"), s.cast("int"), F.array(*[F.lit(x) for x in DIGIT_BYTES])

    def parts(v: Column) -> Column:
        whole, left = v["whole"], v["left"]
        lead, tail = F.get(sizes, whole % 9), F.get(sizes, left % 9)
        size = lead + (whole / 9).cast("int") * 4 + (left / 9).cast("int") * 4 + tail
        hexed = F.hex(v["raw"])
        top = F.substring(hexed, 1, 1)
        minus = top < "8"
        bits = F.concat(F.translate(top, _HEX, _TOP_FLIPPED), F.substr(hexed, F.lit(2)))
        bits = F.when(minus, F.translate(bits, _HEX, _INVERTED)).otherwise(bits)
        # (first byte, bytes, digits) of every group
        def group(at: Column, width: Column, digits: Column) -> Column:
            return F.struct(at.alias("at"), width.alias("width"), digits.alias("digits"))

        def full(count: Column, start: Column) -> Column:
            return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: group(start + i * 4, F.lit(4), F.lit(9)))).otherwise(
                F.array().cast("array<struct<at:int,width:int,digits:int>>"))

        fraction = lead + (whole / 9).cast("int") * 4
        groups = F.flatten(F.array(F.array(group(F.lit(0), lead, whole % 9)), full((whole / 9).cast("int"), lead), full((left / 9).cast("int"), fraction),
                                   F.array(group(fraction + (left / 9).cast("int") * 4, tail, left % 9))))
        texts = F.transform(F.filter(groups, lambda g: g["width"] > 0), lambda g: F.struct(
            F.conv(F.substr(bits, g["at"] * 2 + 1, g["width"] * 2), 16, 10).alias("t"), g["digits"].alias("d")))
        digits = F.array_join(F.transform(texts, lambda g: F.lpad(g["t"], g["d"], F.lit("0"))), "")
        fits = F.forall(texts, lambda g: F.length(g["t"]) <= g["d"])
        number = F.regexp_replace(F.substr(digits, F.lit(1), whole), "^0+(?=.)", "")
        text = F.concat(F.when(F.length(number) > 0, number).otherwise("0"), F.when(left > 0, F.concat(F.lit("."), F.substr(digits, whole + 1, left))).otherwise(""))
        signed = F.when(minus & digits.rlike("[1-9]"), F.concat(F.lit("-"), text)).otherwise(text)
        return F.when((F.length(v["raw"]) == size) & fits, signed)

    given = F.struct(_c(raw).alias("raw"), (n - s).alias("whole"), s.alias("left"))
    legal = (n >= 1) & (n <= 65) & (s >= 0) & (s <= n)
    # computed once for all the mentions of it
    return F.when(legal, F.element_at(F.transform(F.array(given), parts), 1))


def decimal_bytes(raw, precision: int, scale: int) -> Column:
    """Stored DECIMAL bytes -> decimal(p, s); its text when p exceeds Spark's 38 digits."""
    return exact_decimal(decimal_text(raw, precision, scale), precision, scale)


# D6 ------------------------------------------------------------------------
def packed_date(x) -> Column:
    """3-byte DATE: year (15 bits) | month (4) | day (5); zero parts -> null."""
    v = _c(x).cast("long")
    y = F.shiftright(v, 9).bitwiseAND(32767)
    m = F.shiftright(v, 5).bitwiseAND(15)
    d = v.bitwiseAND(31)
    text = F.format_string("%04d-%02d-%02d", y, m, d)
    return F.when((y > 0) & (m > 0) & (d > 0), F.try_to_date(text, "yyyy-MM-dd"))


# D7 ------------------------------------------------------------------------
def _interval(neg: Column, h: Column, m: Column, s: Column, micros: Column | None = None) -> Column:
    secs = s.cast("decimal(18,6)")
    if micros is not None:
        secs = secs + micros.cast("decimal(18,6)") / F.lit(1000000)
    iv = F.make_dt_interval(F.lit(0), h.cast("int"), m.cast("int"), secs)
    return F.when(neg, -iv).otherwise(iv)


def time_hhmmss(x) -> Column:
    """Old TIME: signed integer ``HHMMSS``."""
    v = _c(x).cast("long")
    a = F.abs(v)
    return _interval(v < 0, (a / 10000).cast("long"), (a / 100).cast("long") % 100, a % 100)


def time2(x, frac=None, fsp: int = 6) -> Column:
    """TIME2: 3 bytes offset by 0x800000; |value| = hour(10) | minute(6) | second(6).

    ``frac``: the fraction's bytes as an unsigned integer (``fsp`` 1-2: one byte,
    3-4: two, 5-6: three).  The value is signed as a whole, all its bytes taken
    together: a negative time with a fraction is stored with the integer part one
    lower and the fraction as complement.
    """
    v = _c(x).cast("long") - F.lit(8388608)
    if frac is None:
        a, micros = F.abs(v), None
        neg = v < 0
    else:
        bits = 8 * ((fsp + 1) // 2)
        whole = F.shiftleft(v, bits) + _c(frac).cast("long")
        neg, a = whole < 0, F.shiftright(F.abs(whole), bits)
        micros = fraction_micros(F.abs(whole).bitwiseAND(F.lit((1 << bits) - 1)), fsp)
    return _interval(neg, F.shiftright(a, 12).bitwiseAND(1023), F.shiftright(a, 6).bitwiseAND(63),
                     a.bitwiseAND(63), micros)


def fraction_micros(frac, fsp: int = 6) -> Column:
    """Fraction bytes of DATETIME2 / TIMESTAMP2 / TIME2 (non-negative) -> microseconds."""
    return _c(frac).cast("long") * F.lit(10 ** (6 - 2 * ((fsp + 1) // 2)))


def interval_seconds(iv) -> Column:
    """Signed seconds of a day-time interval (for comparisons and JSON)."""
    i = _c(iv)
    return (F.extract(F.lit("DAY"), i) * 86400 + F.extract(F.lit("HOUR"), i) * 3600
            + F.extract(F.lit("MINUTE"), i) * 60 + F.extract(F.lit("SECOND"), i))


def interval_text(iv) -> Column:
    """``[-]H:MM:SS`` text of a TIME value (hours may exceed 24)."""
    secs = F.abs(interval_seconds(iv)).cast("long")
    sign = F.when(interval_seconds(iv) < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.format_string("%d:%02d:%02d", (secs / 3600).cast("long"),
                                          ((secs / 60).cast("long") % 60), secs % 60))


# D8 ------------------------------------------------------------------------
def timestamp_from_seconds(x, micros=None) -> Column:
    """TIMESTAMP / TIMESTAMP2: UTC epoch seconds (plus fraction) -> timestamp."""
    v = _c(x).cast("long")
    if micros is not None:
        return F.timestamp_micros(v * 1000000 + _c(micros).cast("long"))
    return F.timestamp_seconds(v)


def utc_wall_clock(x) -> Column:
    """Epoch seconds as a UTC wall clock (``timestamp_ntz``), independent of the session zone."""
    return F.timestamp_add("SECOND", _c(x).cast("long"), epoch_ntz())


# D9 ------------------------------------------------------------------------
def datetime_from_int(x) -> Column:
    """Old DATETIME: integer ``YYYYMMDDHHMMSS``; the zero date -> null."""
    v = _c(x).cast("long")
    d, t = (v / 1000000).cast("long"), v % 1000000
    return F.try_make_timestamp_ntz((d / 10000).cast("int"), ((d / 100).cast("long") % 100).cast("int"),
                                    (d % 100).cast("int"), (t / 10000).cast("int"),
                                    ((t / 100).cast("long") % 100).cast("int"), (t % 100).cast("int"))


# D10 -----------------------------------------------------------------------
def datetime2(x, micros=None) -> Column:
    """DATETIME2: 40 bits = sign(1) | year*13+month (17) | day (5) | hour (5) | minute (6) | second (6)."""
    v = _c(x).cast("long")
    ym = F.shiftright(v, 22).bitwiseAND(131071)
    secs = v.bitwiseAND(63).cast("decimal(18,6)")
    if micros is not None:
        secs = secs + _c(micros).cast("decimal(18,6)") / F.lit(1000000)
    return F.try_make_timestamp_ntz((ym / 13).cast("int"), (ym % 13).cast("int"),
                                    F.shiftright(v, 17).bitwiseAND(31).cast("int"),
                                    F.shiftright(v, 12).bitwiseAND(31).cast("int"),
                                    F.shiftright(v, 6).bitwiseAND(63).cast("int"), secs)


# D11 -----------------------------------------------------------------------
def enum_label(idx, labels) -> Column:
    """ENUM 1-based index -> label; index 0 (invalid value) -> ''; out of range -> null."""
    i = _c(idx).cast("int")
    return F.when(i == 0, F.lit("")).otherwise(F.try_element_at(_c(labels), i))


# D12 -----------------------------------------------------------------------
def set_labels(mask, labels) -> Column:
    """SET bitmask -> labels in definition order (up to 64 members).

    ``labels`` is a column (per-row definitions, e.g. from the catalogue) or a
    list known when the plan is built; a list needs no lambda.
    """
    m = _c(mask).cast("long")
    if isinstance(labels, (list, tuple)):
        return F.array_compact(F.array(*[
            F.when(m.bitwiseAND(F.shiftleft(F.lit(1).cast("long"), i)) != 0, F.lit(v)) for i, v in enumerate(labels)]))
    return F.filter(_c(labels),
                    lambda v, i: m.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)


# D13 -----------------------------------------------------------------------
def bit_value(b) -> Column:
    """BIT(n) bytes (big-endian, n <= 64) -> unsigned integer."""
    return F.conv(F.hex(_c(b)), 16, 10).cast("decimal(20,0)")


# D14 / D15 -----------------------------------------------------------------
# FIXED VALUES: MySQL character sets Spark's ``decode`` reads, and the Java name used.
CHARSETS = {
    "utf8": "UTF-8",
    "utf8mb3": "UTF-8",
    "utf8mb4": "UTF-8",
    "latin1": "windows-1252",
    "ascii": "US-ASCII",
    "utf16": "UTF-16",
    "utf16le": "UTF-16LE",
}


# Bytes 0x80-0x9F of MySQL's latin1 are those of Windows-1252; the five that it leaves open
# keep their code.
_C1 = [chr(i) for i in range(0x80, 0xA0)]
_C1_AS_1252 = [bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)]
# Well-formed UTF-16, as pairs of hex digits, most significant byte first: no half surrogate pairs.
_UTF16_HEX = r"^(?:(?!D[89A-F]..)....|D[89AB]..D[C-F]..)*$"
_UTF16LE_HEX = r"^(?:(?!..D[89A-F])....|..D[89AB]..D[C-F])*$"


def text_value(b, charset: str = "utf8mb4") -> Column:
    """CHAR / VARCHAR / TEXT bytes in a known character set -> string.

    Null for bytes that are no text in that character set and for an unknown
    character set; ``text_error`` has the reason.
    """
    java, raw = CHARSETS.get(charset.lower()), _c(b).cast("binary")
    if java is None:
        return F.lit(None).cast("string")
    if java == "UTF-8":
        return F.try_validate_utf8(raw.cast("string"))
    if java == "windows-1252":
        return F.translate(F.decode(raw, "ISO-8859-1"), "".join(_C1), "".join(_C1_AS_1252))
    if java == "US-ASCII":
        text = F.decode(raw, "ISO-8859-1")
        return F.when(~text.rlike(r"[^\x00-\x7F]"), text)
    pattern = _UTF16LE_HEX if java == "UTF-16LE" else _UTF16_HEX
    return F.when(F.hex(raw).rlike(pattern), F.decode(raw, java))


def text_error(b, charset: str = "utf8mb4") -> Column:
    """Why ``text_value`` gives null for bytes that are not null; null otherwise."""
    if charset.lower() not in CHARSETS:
        return F.when(_c(b).isNotNull(), F.lit(f"unknown charset {charset}"))
    return F.when(_c(b).isNotNull() & text_value(b, charset).isNull(), F.lit(f"malformed {charset.lower()} text"))


def text_by_charset(b, charset) -> Column:
    """``text_value`` with the character set taken from a column, as a catalogue row gives it (null: utf8mb4)."""
    name = F.lower(F.coalesce(_c(charset), F.lit("utf8mb4")))
    out = F.lit(None).cast("string")
    for c in CHARSETS:
        out = F.when(name == c, text_value(b, c)).otherwise(out)
    return out


def charset_error(b, charset) -> Column:
    """Why ``text_by_charset`` gives null for bytes that are not null; null otherwise."""
    name = F.lower(F.coalesce(_c(charset), F.lit("utf8mb4")))
    return (F.when(_c(b).isNull(), None).when(~name.isin(*CHARSETS), F.concat(F.lit("unknown charset "), name))
             .when(text_by_charset(b, charset).isNull(), F.concat(F.lit("malformed "), name, F.lit(" text"))))


def _ieee(sign: Column, exponent: Column, fraction: Column, bits: int, bias: int) -> Column:
    """The number of IEEE-754 parts: subnormal, normal, infinite or none."""
    top = 2 * bias + 1
    # a power of two is exact, so is its product with a fraction of at most 53 bits
    normal = (fraction + F.lit(1 << bits)).cast("double") * F.pow(F.lit(2.0), (exponent - (bias + bits)).cast("double"))
    small = fraction.cast("double") * F.pow(F.lit(2.0), F.lit(float(1 - bias - bits)))
    size = (F.when(exponent == 0, small).when(exponent < top, normal).when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
    return F.when(sign == 1, -size).otherwise(size)


def double_bytes(raw) -> Column:
    """Stored DOUBLE, eight little-endian bytes; null for another length."""
    high, low = _le32(raw, 4), _le32(raw, 0)
    fraction = F.shiftleft(high.bitwiseAND(F.lit(0xFFFFF)), 32).bitwiseOR(low)
    value = _ieee(F.shiftright(high, 31), F.shiftright(high, 20).bitwiseAND(F.lit(0x7FF)), fraction, 52, 1023)
    return F.when(F.length(_c(raw)) == 8, value)


def float_bytes(raw) -> Column:
    """Stored FLOAT, four little-endian bytes; null for another length."""
    bits = _le32(raw, 0)
    value = _ieee(F.shiftright(bits, 31), F.shiftright(bits, 23).bitwiseAND(F.lit(0xFF)), bits.bitwiseAND(F.lit(0x7FFFFF)), 23, 127)
    return F.when(F.length(_c(raw)) == 4, value.cast("float"))


def _le32(raw, offset: int) -> Column:
    """Four little-endian bytes as a number without sign."""
    from .header import le_int
    return le_int(_c(raw), offset, 4)


def blob_text(b) -> Column:
    """BLOB for JSON output: base64 text (bytes stay binary in tables)."""
    return F.base64(_c(b))


# D17 -----------------------------------------------------------------------
def field_type_name(code) -> Column:
    """Name of a field type code; unknown codes as text."""
    m = F.create_map(*[F.lit(x) for kv in FIELD_TYPE_NAMES.items() for x in kv])
    c = _c(code).cast("int")
    return F.coalesce(F.try_element_at(m, c), c.cast("string"))


def decode_error(code) -> Column:
    """Reason a cell cannot be decoded, or null when a decoder exists."""
    c = _c(code).cast("int")
    known = F.lit(list(FIELD_TYPE_NAMES)).cast("array<int>")
    return (F.when(c.isin(*UNSUPPORTED_FIELD_CODES),
                   F.concat(F.lit("unimplemented type "), field_type_name(c)))
             .when(~F.array_contains(known, c), F.concat(F.lit("unknown field type "), c.cast("string"))))


# D18 / D19 -----------------------------------------------------------------
# FIXED VALUE: a quoted label inside enum(...) / set(...); '' is an escaped quote.
LABEL_PATTERN = r"'((?:[^']|'')*)'"


def type_labels(column_type) -> Column:
    """ENUM / SET member list from the column type text, in definition order."""
    t = _c(column_type)
    is_list = F.lower(t).rlike(r"^\s*(enum|set)\s*\(")
    raw = F.regexp_extract_all(t, F.lit(LABEL_PATTERN), 1)
    return F.when(is_list, F.transform(raw, lambda s: F.replace(s, F.lit("''"), F.lit("'"))))


def by_type(stored, column_type) -> Column:
    """A stored integer by its column's type text -> struct(kind, value, error).

    ``value`` is the text of the decoded value: ``true`` or ``false``, a number, a label, labels
    joined by commas.  ``error`` says why there is none (no decoder, or a stored value that the type
    can't hold); a null stored value has neither.
    """
    return by_type_parts(stored, type_parts(column_type))


def type_parts(column_type) -> Column:
    """What ``by_type`` needs of a type text, kind, labels and the text in lower case: once a column, not once a cell."""
    t = F.lower(_c(column_type))
    return F.struct(F.nullif(F.regexp_extract(t, r"^\s*([a-z]+)", 1), F.lit("")).alias("kind"), type_labels(column_type).alias("labels"), t.alias("type"))


def by_type_parts(stored, parts) -> Column:
    """``by_type`` of a stored integer by the ``type_parts`` of its column (null: no such column)."""
    parts = _c(parts)

    def once(value: Column, f) -> Column:
        return F.element_at(F.transform(F.array(value), f), 1)

    def of(x: Column) -> Column:
        kind, labels, v, bits, top, low = (x[c] for c in ("kind", "labels", "v", "bits", "top", "low"))
        is_unsigned = x["type"].rlike(r"\bunsigned\b")
        fits = F.when(bits == 64, F.lit(True)).otherwise((v >= -top) & (v < top * 2))
        big = F.when((bits == 64) & (low < 0), low.cast("decimal(20,0)") + F.expr(TWO_64)).otherwise(low.cast("decimal(20,0)"))
        signed = F.when(bits == 64, v).otherwise(F.when(low >= top, low - top * 2).otherwise(low))
        number = F.when(is_unsigned, big.cast("string")).otherwise(signed.cast("string"))
        chosen = F.transform(labels, lambda l, i: F.when(F.call_function("shiftright", v, i).bitwiseAND(F.lit(1)) == 1, l))
        value = (F.when(x["type"] == "tinyint(1)", F.when(v == 1, "true").when(v == 0, "false"))
                  .when(bits.isNotNull(), F.when(fits, number))
                  .when(kind == "enum", F.when(v == 0, "").when(v > 0, F.get(labels, (v - 1).cast("int"))))
                  .when(kind == "set", F.when((F.size(labels) >= 64) | ((v >= 0) & (v < F.call_function("shiftleft", one, F.size(labels)))),
                                              F.array_join(F.array_compact(chosen), ",")))
                  .when(kind == "year", F.when(v == 0, "0").when((v > 0) & (v < 256), (v + 1900).cast("string")))
                  .when(kind == "bit", F.when(v >= 0, v.cast("string"))))
        known = bits.isNotNull() | kind.isin("enum", "set", "year", "bit")

        def judged(value: Column) -> Column:
            error = (F.when(v.isNull(), None).when(kind.isNull(), "no such column").when(~known, F.concat(F.lit("no decoder for "), kind))
                      .when(value.isNull(), F.concat(F.lit("no value of "), kind, F.lit(": "), v.cast("string"))))
            return F.struct(kind.alias("kind"), F.when(error.isNull(), value).alias("value"), error.alias("error"))

        return once(value, judged)

    # lambdas are interpreted: each step names what the next mentions often, so that it is computed once a cell
    one = F.lit(1).cast("long")

    def sized(x: Column) -> Column:
        kind = x["kind"]
        bits = F.when(kind == "tinyint", 8).when(kind == "smallint", 16).when(kind == "mediumint", 24).when(kind.isin("int", "integer"), 32).when(kind == "bigint", 64)
        return F.struct(*[x[c].alias(c) for c in ("kind", "labels", "type", "v")], bits.alias("bits"))

    def topped(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("kind", "labels", "type", "v", "bits")], F.call_function("shiftleft", one, x["bits"] - 1).alias("top"))

    def lowered(x: Column) -> Column:
        low = F.when(x["bits"] == 64, x["v"]).otherwise(x["v"].bitwiseAND(x["top"] * 2 - 1))
        return F.struct(*[x[c].alias(c) for c in ("kind", "labels", "type", "v", "bits", "top")], low.alias("low"))

    given = F.struct(*[parts[c].alias(c) for c in ("kind", "labels", "type")], _c(stored).cast("long").alias("v"))
    for step in (sized, topped, lowered, of):
        given = once(given, step)
    return given


def column_flags(column_type, column_key, extra) -> Column:
    """is_bool, unsigned, is_primary (any key kind), auto_increment from catalogue text."""
    t, k, e = _c(column_type), _c(column_key), _c(extra)
    return F.struct((F.lower(t) == "tinyint(1)").alias("is_bool"),
                    F.regexp_replace(F.lower(t), LABEL_PATTERN, "").rlike(r"\bunsigned\b").alias("unsigned"),
                    (F.coalesce(k, F.lit("")) != "").alias("is_primary"),
                    F.lower(F.coalesce(e, F.lit(""))).contains("auto_increment").alias("auto_increment"))
