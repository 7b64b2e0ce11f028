"""Raw-event ingest (H1, H2, H9, H11): classify and route events without row bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.header import checksum_ok, header, rotate_body, strip_checksum
from ..model import HEADER_LEN, ROTATE_CODE, SKIPPED_EVENT_CODES
from .ordered import keyed_window, shift_bucket

# Window bucket over event ordinals within a source: 2^20 events (a whole server log is
# one key, so this is the width that keeps both levels of the keyed window small).
ORDINAL_BUCKET_BITS = 20


def decode_headers(raw: DataFrame, checksum: bool = True) -> DataFrame:
    """H1 + H9: header columns, checksum verdict and the payload without trailer."""
    p = F.col("payload")
    cols = [F.col(c) for c in raw.columns if c != "payload"]
    out = raw.select(*cols, p, header(p).alias("h"))
    extra = [checksum_ok(p).alias("checksum_ok"), strip_checksum(p).alias("event")] if checksum \
        else [F.lit(None).cast("boolean").alias("checksum_ok"), p.alias("event")]
    return out.select(*cols, "payload", "h.*", *extra)


def event_error(payload: str = "payload", size: str = "event_size", checksum: str = "checksum_ok") -> Column:
    """H9: why a raw event can't be decoded; null for whole ones.

    A torn header has no fields, a payload of another length than its header says was cut or run
    together, and a trailer that is not the CRC32 of the rest says that a byte is wrong.
    """
    n = F.length(payload)
    return (F.when(F.col(payload).isNull() | (n < HEADER_LEN), "torn header")
             .when(F.col(size) != n, F.concat(F.lit("size "), n.cast("string"), F.lit(" instead of "), F.col(size).cast("string")))
             .when(~F.col(checksum), "bad checksum"))


def whole_events(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """H9 + K6: (whole events, quarantine) of ``decode_headers``; the quarantine keeps the payload and the ``reason``."""
    judged = decoded.withColumn("reason", event_error())
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull()).select(
        *[c for c in ("source", "ordinal") if c in decoded.columns], "payload", "reason")


def dispatch(events: DataFrame) -> DataFrame:
    """H2: drop heartbeat, ignorable and GTID kinds before any body is decoded."""
    return events.filter(~F.col("type_code").isin(*SKIPPED_EVENT_CODES))


def fill_log_file(events: DataFrame, checksum: bool = True) -> DataFrame:
    """Every event gets the file named by the latest rotate event of its source.

    A forward fill over the whole log of a source is a window with one
    partition per source -- the hottest key there is.  ``keyed_window`` splits
    it into ordinal buckets and carries the last file name across them.
    """
    nf = F.when(F.col("type_code") == ROTATE_CODE, rotate_body("payload", checksum)["next_file"])
    d = events.withColumn("__next_file", nf)
    d = keyed_window(d, ["source"], ["ordinal"], shift_bucket("ordinal", ORDINAL_BUCKET_BITS),
                     fill=["__next_file"])
    return d.withColumnRenamed("fill___next_file", "log_file").drop("__next_file")
