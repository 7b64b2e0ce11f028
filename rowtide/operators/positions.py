"""Position operators.

Positions compare by ``pos_key`` (file number, then offset), never as text.
Scalar parameters given as labels are parsed once on the driver; everything
that touches rows is a filter or an aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.position import VALID_POSITION
from ..model import POS_SHIFT


def label_key(label: str) -> int:
    """``file.NNN:offset`` -> pos_key (a parameter, not a row)."""
    if not re.match(VALID_POSITION, label or ""):
        raise ValueError(f"not a log position: {label!r}")
    f, p = label.rsplit(":", 1)
    return int(re.search(r"(\d+)$", f).group(1)) * POS_SHIFT + int(p)


def at_fraction(df: DataFrame, part: int, of: int) -> str:
    """Position ``part / of`` of the way through a log, so a bound moves as the log grows.

    Files count as long as the longest one; only the log's newest position and that
    length (one row) come to the driver.
    """
    newest = df.agg(F.max("pos_key").alias("k"), F.max("log_pos").alias("w"),
                    F.max_by("log_file", "pos_key").alias("f")).first()
    files, last = divmod(newest["k"] or POS_SHIFT, POS_SHIFT)
    width = newest["w"] or 1
    at = ((files - 1) * width + last) * part // of
    name = re.sub(r"\d+$", "", newest["f"] or "mysql-bin.")
    return f"{name}{1 + at // width:06d}:{at % width}"


def bounded_scan(df: DataFrame, start: str | None = None, stop: str | None = None) -> DataFrame:
    """S3: events after ``start`` and ending before ``stop``.

    ``log_pos`` is an event's end offset: an event that begins at ``start`` ends
    after it, and the event whose end reaches ``stop`` is left out.
    """
    if start:
        df = df.filter(F.col("pos_key") > F.lit(label_key(start)))
    if stop:
        df = df.filter(F.col("pos_key") < F.lit(label_key(stop)))
    return df


def latest_position(df: DataFrame) -> DataFrame:
    """Newest position of the log (one row)."""
    w = F.max_by(F.struct("log_file", "log_pos"), F.col("pos_key")).alias("w")
    return df.agg(w).select("w.log_file", "w.log_pos",
                            F.concat_ws(":", "w.log_file", F.col("w.log_pos").cast("string")).alias("binlog"))


def newest_position(candidates: DataFrame, group: Sequence[str] = ("source",), label: str = "label") -> DataFrame:
    """Newest of several saved positions per group, by number (and the text rule beside it)."""
    from ..functions.position import is_valid_position, parse_position
    c = (candidates.filter(is_valid_position(F.col(label)))
                   .select(*group, F.col(label).alias("__l"), parse_position(F.col(label)).alias("__p")))
    return c.groupBy(*group).agg(F.max_by("__l", "__p.pos_key").alias("newest"),
                                 F.max("__l").alias("newest_by_text"))


def resume_after(df: DataFrame, saved: str) -> DataFrame:
    """P4 (batch): everything after a saved position."""
    return df.filter(F.col("pos_key") > F.lit(label_key(saved)))


def dedup_replay(df: DataFrame, identity: Sequence[str] = ("log_file", "log_pos", "row_no")) -> DataFrame:
    """P6 (batch): one copy of each change after a replayed overlap."""
    return df.dropDuplicates(list(identity))
