"""Log positions as columns (P1, F7, R10, pos_key).

A position is ``file:offset``.  The file name ends in a number; the total
order of the log is ``(file_no, offset)``, packed into one ``bigint``
``pos_key = file_no * 2^32 + offset`` (offset is an unsigned 32-bit value).
Comparing the text form is wrong (``...:99964`` sorts after ``...:119884``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import POS_SHIFT

# FIXED VALUE: a valid position is a numbered log file, a colon and an offset.
VALID_POSITION = r"^[^:]+\.\d+:\d+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_no(log_file) -> Column:
    """Number at the end of a log file name (``mysql-bin.000021`` -> 21)."""
    return F.regexp_extract(_c(log_file), r"(\d+)$", 1).try_cast("int")


def pos_key(file_number, offset) -> Column:
    return (_c(file_number).cast("long") * F.lit(POS_SHIFT) + _c(offset).cast("long"))


def position_label(log_file, offset) -> Column:
    """``file:offset`` label of an event."""
    return F.concat_ws(":", _c(log_file), _c(offset).cast("string"))


def is_valid_position(label) -> Column:
    """non-empty, contains ``:``, numbered file and numeric offset."""
    return F.coalesce(_c(label).rlike(VALID_POSITION), F.lit(False))


def parse_position(label) -> Column:
    """``file:offset`` -> struct(log_file, file_no, pos, pos_key); null when invalid."""
    lab = _c(label)
    f = F.regexp_extract(lab, r"^(.*):[^:]*$", 1)
    p = F.regexp_extract(lab, r":([^:]*)$", 1).try_cast("long")
    ok = is_valid_position(lab)
    n = file_no(f)
    return F.when(ok, F.struct(f.alias("log_file"), n.alias("file_no"), p.alias("pos"),
                               pos_key(n, p).alias("pos_key")))
