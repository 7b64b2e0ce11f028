"""Raw binlog event bytes as columns (H1, H3-H7, H9).

A raw event is one ``binary`` cell: a 19-byte little-endian header
(timestamp u32, type u8, server_id u32, event_size u32, log_pos u32,
flags u16), a body, and -- when checksums are on -- a 4-byte CRC32 trailer.
Everything here is ``substr`` / ``hex`` / ``conv`` on the binary column, so
it runs inside whole-stage codegen with no Python on the path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import CHECKSUM_LEN, EVENT_NAMES, FLAG_NAMES, HEADER_LEN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_int(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# Reversing the hex text of a value reverses its bytes *and* the two nibbles
# inside each byte; swapping the nibbles arithmetically first (or after, when
# decoding) leaves a pure byte reversal: little-endian <-> big-endian with one
# ``reverse`` instead of one substring per byte.
_NIBBLES = 0x0F0F0F0F0F0F0F0F


def _swap_nibbles(v: Column) -> Column:
    return (F.shiftleft(v.bitwiseAND(F.lit(_NIBBLES)), 4)
            .bitwiseOR(F.shiftright(v, 4).bitwiseAND(F.lit(_NIBBLES))))


# ---- encoding (used to build raw feeds from tables) -------------------------
def le_hex(x, nbytes: int) -> Column:
    """Hex text of a non-negative integer as ``nbytes`` little-endian bytes."""
    return F.reverse(F.lpad(F.hex(_swap_nibbles(_c(x).cast("long"))), 2 * nbytes, "0"))


def text_hex(s) -> Column:
    return F.hex(F.encode(_c(s), "UTF-8"))


# ---- decoding ----------------------------------------------------------------
def le_int(payload, offset, nbytes: int) -> Column:
    """Unsigned little-endian integer of ``nbytes`` (<= 8) at 0-based ``offset``."""
    h = F.reverse(F.hex(_c(payload).substr(_lit_int(offset) + 1, F.lit(nbytes))))
    return _swap_nibbles(F.conv(h, 16, -10).cast("long"))


def header(payload) -> Column:
    """H1: the six header fields as a struct.

    The 19 bytes become reversed hex text once (generated code evaluates a repeated
    expression once); every field is then a slice of that text.
    """
    p = _c(payload)
    text = F.when(F.length(p) >= HEADER_LEN, F.reverse(F.hex(p.substr(1, HEADER_LEN))))  # a torn header has no fields

    def field(offset: int, nbytes: int) -> Column:
        h = F.substring(text, 2 * (HEADER_LEN - offset - nbytes) + 1, 2 * nbytes)
        return _swap_nibbles(F.conv(h, 16, -10).cast("long"))

    return F.struct(F.timestamp_seconds(field(0, 4)).alias("ts"), field(4, 1).cast("int").alias("type_code"),
                    field(5, 4).alias("server_id"), field(9, 4).alias("event_size"), field(13, 4).alias("log_pos"),
                    field(17, 2).cast("int").alias("flags"))


def strip_checksum(payload) -> Column:
    """H9: the event without its CRC32 trailer."""
    p = _c(payload)
    return p.substr(F.lit(1), F.length(p) - CHECKSUM_LEN)


def checksum_ok(payload) -> Column:
    """H9: does the trailer equal CRC32 of the rest?"""
    p = _c(payload)
    return F.crc32(strip_checksum(p)) == le_int(p, F.length(p) - CHECKSUM_LEN, CHECKSUM_LEN)


def event_name(type_code) -> Column:
    """H3: event name for a code; unknown codes as text."""
    m = F.create_map(*[F.lit(x) for kv in EVENT_NAMES.items() for x in kv])
    c = _c(type_code).cast("int")
    return F.coalesce(F.try_element_at(m, c), c.cast("string"))


def flag_names(flags) -> Column:
    """H4: names of the set header flag bits; bits above the known ten as one hex item."""
    f = _c(flags).cast("int")
    names = F.array_compact(F.array(*[F.when(f.bitwiseAND(F.lit(1 << i)) != 0, F.lit(n))
                                      for i, n in enumerate(FLAG_NAMES)]))
    unknown = f.bitwiseAND(F.lit(~((1 << len(FLAG_NAMES)) - 1) & 0xFFFF))
    extra = F.when(unknown != 0, F.array(F.concat(F.lit("UNKNOWN_0x"), F.lower(F.hex(unknown)))))
    return F.concat(names, F.coalesce(extra, F.array().cast("array<string>")))


def query_body(payload, checksum: bool = True) -> Column:
    """H6: proxy id, exec time, error code, status vars, schema and SQL of a query event
    (schema or SQL null where their bytes are no UTF-8)."""
    p = _c(payload)
    end = F.length(p) - (CHECKSUM_LEN if checksum else 0)
    o = HEADER_LEN
    slen = le_int(p, o + 8, 1)
    vlen = le_int(p, o + 11, 2)
    vars_at = F.lit(o + 13)
    schema_at = vars_at + vlen
    sql_at = schema_at + slen + 1
    return F.struct(le_int(p, o, 4).alias("proxy_id"), le_int(p, o + 4, 4).alias("exec_time"),
                    le_int(p, o + 9, 2).cast("int").alias("error_code"),
                    p.substr(vars_at + 1, vlen).alias("status_vars"),
                    F.try_validate_utf8(p.substr(schema_at + 1, slen).cast("string")).alias("schema"),
                    F.try_validate_utf8(p.substr(sql_at + 1, end - sql_at).cast("string")).alias("query"))


def rotate_body(payload, checksum: bool = True) -> Column:
    """H7: next position and next file name of a rotate event."""
    p = _c(payload)
    end = F.length(p) - (CHECKSUM_LEN if checksum else 0)
    o = HEADER_LEN
    return F.struct(le_int(p, o, 8).alias("next_pos"),
                    F.try_validate_utf8(p.substr(F.lit(o + 9), end - (o + 8)).cast("string")).alias("next_file"))
