"""Consumer-side operators over an ENVELOPE change table.

All of them order changes by ``(pos_key, row_no)``, the log's total order,
never by arrival or by the 1-second event time.  Per-key windows go through
``keyed_window`` so a hot key cannot pin one task; aggregates use ``max_by``
with map-side partial aggregation (one row per key and task is shuffled).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import keyed_window, shift_bucket

ORDER = ["pos_key", "row_no"]
# One window bucket per 2^26 bytes (64 MiB) of one log file (pos_key's low 32 bits are
# the offset): a few hundred thousand changes, so neither a bucket's window nor a hot
# key's bucket summary outgrows one task at 10^12 changes (see operators.ordered).
POS_BUCKET_BITS = 26


def pos_bucket(col: str = "pos_key") -> Column:
    return shift_bucket(col, POS_BUCKET_BITS)


def with_record_key(df: DataFrame, key_fields: Sequence[str] = ("id",)) -> DataFrame:
    """Record key of a change: ``coalesce(after.k, before.k)``; query rows have none."""
    cols = [F.coalesce(F.col("after")[k], F.col("before")[k]).alias(k) for k in key_fields]
    return df.select("*", *cols)


def keyed_changes(df: DataFrame, key_fields: Sequence[str] = ("id",)) -> DataFrame:
    out = with_record_key(df.filter(F.col("event_type") != "query"), key_fields)
    present = F.col(key_fields[0]).isNotNull()
    for k in key_fields[1:]:
        present = present & F.col(k).isNotNull()
    return out.filter(present)


def latest_state(df: DataFrame, key_fields: Sequence[str] = ("id",), keep_deletes: bool = False) -> DataFrame:
    """A1: newest image per key; a delete removes the key (unless ``keep_deletes``).

    One ``max_by`` aggregate: partial aggregation on the map side keeps the
    shuffle at one row per key and task, whatever the key skew.
    """
    keys = ["db", "tbl", *key_fields]
    k = keyed_changes(df, key_fields)
    win = F.max_by(F.struct("event_type", "after", "log_file", "log_pos", "pos_key"),
                   F.struct(*ORDER)).alias("w")
    agg = k.groupBy(*keys).agg(win, F.count(F.lit(1)).alias("n_changes"))
    if not keep_deletes:
        agg = agg.filter(F.col("w.event_type") != "delete")
    fields = [f for f in df.schema["after"].dataType.fieldNames() if f not in key_fields]
    return agg.select(*keys, *[F.col("w.after")[f].alias(f) for f in fields],
                      F.col("w.event_type").alias("last_op"),
                      F.col("w.log_file").alias("log_file"), F.col("w.log_pos").alias("log_pos"),
                      "n_changes")


def latest_state_partial(df: DataFrame, key_fields: Sequence[str] = ("id",), mask: str = "after_present",
                         keep_deletes: bool = False) -> DataFrame:
    """A1 for logs of partial (MINIMAL) row images.

    Each column of a key takes its value from the newest change in which the
    column was present (a present NULL counts, an absent column does not); the
    newest change decides whether the key is deleted.  A row comes back after
    a delete only through an insert, which carries every column, so values
    from before the delete are always superseded.  One aggregate: per column
    ``max_by(value, position if present)``, which ignores absent rows and
    combines map-side like ``latest_state``.
    """
    from ..functions.image import is_present
    keys = ["db", "tbl", *key_fields]
    names = df.schema["after"].dataType.fieldNames()
    fields = [f for f in names if f not in key_fields]
    order = F.struct(*ORDER)
    k = keyed_changes(df, key_fields)
    cols = [F.max_by(F.col("after")[f], F.when(is_present(mask, names.index(f)), order)).alias(f) for f in fields]
    agg = k.groupBy(*keys).agg(*cols, F.max_by("event_type", order).alias("last_op"),
                               F.count(F.lit(1)).alias("n_changes"))
    return agg if keep_deletes else agg.filter(F.col("last_op") != "delete")


def key_history(df: DataFrame, key_fields: Sequence[str] = ("id",)) -> DataFrame:
    """A2: every change of a key with its validity interval [valid_from, valid_to)."""
    k = keyed_changes(df, key_fields).withColumn("valid_from", F.col("ev_ts"))
    k = keyed_window(k, ["db", "tbl", *key_fields], ORDER, pos_bucket(), lead=["valid_from"], seq="version")
    return k.withColumn("valid_to", F.col("next_valid_from")).drop("next_valid_from")


def key_order(df: DataFrame, key_fields: Sequence[str] = ("id",)) -> DataFrame:
    """A3: position of each change within its key (1 = first)."""
    k = keyed_changes(df, key_fields)
    return keyed_window(k, ["db", "tbl", *key_fields], ORDER, pos_bucket(), seq="key_seq")


def changed_columns(df: DataFrame, fields: Sequence[str], sep: str = ",") -> DataFrame:
    """A4: names of the columns an update changed (null-safe compare)."""
    names = F.array(*[F.when(~(F.col("before")[c].eqNullSafe(F.col("after")[c])), F.lit(c))
                      for c in fields])
    changed = F.array_compact(names)
    return (df.filter(F.col("event_type") == "update")
              .select("*", F.array_join(changed, sep).alias("changed"), F.size(changed).alias("n_changed")))


def change_rollup(df: DataFrame) -> DataFrame:
    """A5: change counts by db, table and operation, with subtotals and total."""
    return (df.rollup("db", "tbl", "event_type")
              .agg(F.count(F.lit(1)).alias("n_changes"),
                   F.grouping_id("db", "tbl", "event_type").alias("gid")))


def continuity(df: DataFrame, key_fields: Sequence[str] = ("id",)) -> DataFrame:
    """Changes whose ``before`` differs from the key's previous ``after``."""
    k = keyed_changes(df, key_fields)
    k = keyed_window(k, ["db", "tbl", *key_fields], ORDER, pos_bucket(), lag=["after"])
    prev = F.col("prev_after")
    same = F.col("before").eqNullSafe(prev)
    return (k.filter(F.col("before").isNotNull() & ~same)
              .withColumn("status", F.when(prev.isNull(), "no_prior_image").otherwise("mismatch")))


def last_changes(df: DataFrame, n: int, db: str | None = None, tbl: str | None = None) -> DataFrame:
    """Newest ``n`` changes (of one table when given): a TakeOrdered, no full sort."""
    if db is not None:
        df = df.filter(F.col("db") == db)
    if tbl is not None:
        df = df.filter(F.col("tbl") == tbl)
    return df.orderBy(F.col("pos_key").desc(), F.col("row_no").desc()).limit(n)


def merge_feeds(*feeds: DataFrame, identity: Sequence[str] = ("log_file", "log_pos", "row_no")) -> DataFrame:
    """A10: union several feeds and keep one copy of each change."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out.dropDuplicates(list(identity))


def feed_difference(a: DataFrame, b: DataFrame,
                    identity: Sequence[str] = ("log_file", "log_pos", "row_no")) -> DataFrame:
    """Changes of feed ``a`` missing from feed ``b``."""
    return a.join(b.select(*identity).distinct(), list(identity), "left_anti")


def lookup_current(changes: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current row of every changed key; deleted keys come back with nulls."""
    changed = changes.select(*keys).distinct()
    return changed.join(current, list(keys), "left")


def change_rate(df: DataFrame, width: str, slide: str | None = None, by: Sequence[str] = ("db",),
                ts: str = "ev_ts") -> DataFrame:
    """A7 (batch): changes per tumbling / sliding event-time window.

    ``window`` + ``groupBy`` aggregates partially on the map side, so a busy
    window or database costs one row per task in the shuffle.
    """
    w = F.window(F.col(ts), width, slide) if slide else F.window(F.col(ts), width)
    agg = df.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n_changes"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                      "n_changes")


def session_bucket_seconds(df: DataFrame, by: Sequence[str], secs: Column) -> int:
    """Time-bucket width for per-group windows: span / sqrt(rows) of the busiest group.

    A group of N rows over a span T cut into buckets of width W costs window tasks
    of about N*W/T rows and a bucket summary of T/W rows; W = T/sqrt(N) balances
    the two for the group that matters, the largest.  One aggregate with map-side
    combining; one scalar reaches the driver.
    """
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.max(secs) - F.min(secs)).alias("span"))
    r = g.agg(F.max_by(F.struct("n", "span"), "n").alias("top")).first()
    if r is None or r["top"] is None:
        return 60
    n, span = r["top"]["n"], r["top"]["span"] or 0
    return max(1, int(span / math.sqrt(n)))


def change_sessions(df: DataFrame, by: Sequence[str], gap_seconds: int, ts: str = "ev_ts",
                    bucket_seconds: int | None = 60) -> DataFrame:
    """A7 (batch): activity sessions per group; a gap of more than ``gap_seconds`` starts a new one.

    Same sessions as ``session_window`` (a session ends ``gap`` after its last
    change), computed with two skew-safe keyed windows (previous time, then a
    forward fill of the session start) and one partial aggregate, so a hot
    group is spread over time buckets instead of one task.  Buckets are
    ``bucket_seconds`` wide (a minute: near span / sqrt(rows) for a group holding
    a third of 10^12 changes over a year); ``None`` sizes them from the busiest
    group with one extra aggregate (``session_bucket_seconds``).
    """
    by = list(by)
    order = [ts, "pos_key", "row_no"]
    from ..functions.decode import epoch_ntz
    # Event-time buckets: monotone in (ts, pos_key, row_no), zone-free for wall clocks.
    t = F.col(ts)
    secs = (F.timestamp_diff("SECOND", epoch_ntz(), t) if dict(df.dtypes)[ts] == "timestamp_ntz"
            else F.unix_seconds(t))
    width = bucket_seconds or session_bucket_seconds(df, by, secs)
    bucket = F.floor(secs / width)
    d = df.select(*by, *order)
    d = keyed_window(d, by, order, bucket, lag=[ts])
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    start = F.col("prev_" + ts).isNull() | (F.col(ts) > F.col("prev_" + ts) + gap)
    d = d.withColumn("__start", F.when(start, F.col(ts)))
    d = keyed_window(d, by, order, bucket, fill=["__start"])
    s = d.groupBy(*by, F.col("fill___start").alias("session_start")).agg(
        F.max(ts).alias("__last"), F.count(F.lit(1)).alias("n_changes"))
    return s.select(*by, "session_start", (F.col("__last") + gap).alias("session_end"), "n_changes")
