"""Skew-safe neighbours and numbering within a key.

``lag``/``lead``/``row_number``/``last(ignorenulls)`` over
``Window.partitionBy(key)`` put every row of a key into one task, and AQE does
not split window partitions.  A change feed is exactly the data where one key
(one hot row, one busy table, the single log of a server) can hold a third of
all changes.  This module computes the same answers with hot keys split:

1. one map-side-combined count finds the hot keys, those of more than
   ``hot_rows`` rows: N / ``hot_rows`` of them at most, so they are broadcast;
2. the window runs over ``(key, bucket)``, where ``bucket`` is null for all other
   keys and, for a hot key, a coarse, monotone function of the order (e.g.
   ``pos_key >> 20``: one MiB of log), so no window partition outgrows
   ``hot_rows`` or the bucket width;
3. one summary row per hot ``(key, bucket)`` (count, first row, last row, last
   non-null value; built with partial aggregation) is ordered per key with a
   second, small window, and joined back on ``(key, bucket)`` to patch the
   first/last row of each bucket and to offset row numbers.

The big side is shuffled once, by ``(key, bucket)``, which the join reuses.  Without
hot keys AQE sees the empty broadcast and drops step 3: what is left is the count
and a plain window.

Sizing: a key of N rows cut into buckets of B rows costs one window task of at
most B rows per bucket and one summary window of N / B rows.  Both stay under
about a million rows for N near 10^12 (a third of 100 TB of changes) when B is
around sqrt(N), i.e. a few hundred thousand rows: 64 MiB of log, 2^20 event
ids or ordinals.  Smaller widths only help small inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


HOT_ROWS = 1 << 20  # rows of a key that one window partition may hold


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyed_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 bucket: Sequence[Column] | Column, *, lag: Sequence[str] = (),
                 lead: Sequence[str] = (), fill: Sequence[str] = (), sums: Sequence[str] = (),
                 before: Sequence[str] = (), seq: str | None = None, prev_prefix: str = "prev_", next_prefix: str = "next_",
                 fill_prefix: str = "fill_", sum_prefix: str = "sum_", before_prefix: str = "before_",
                 hot_rows: int | None = None) -> DataFrame:
    """Add neighbour columns computed per ``keys`` in ``order``.

    * ``lag`` columns c -> ``prev_c``: value on the previous row of the key;
    * ``lead`` columns c -> ``next_c``: value on the next row of the key;
    * ``fill`` columns c -> ``fill_c``: last non-null c up to and including the row;
    * ``before`` columns c -> ``before_c``: last non-null c of the rows before;
    * ``sums`` columns c -> ``sum_c``: running sum of c (nulls count as 0) up to and
      including the row; the per-bucket totals are plain sums, so that part of
      the summary stays a hash aggregate;
    * ``seq``: 1-based position of the row within its key.

    Keys of more than ``hot_rows`` rows (``HOT_ROWS`` unless given) are split into their
    buckets (0: all keys).

    ``order`` must be a total order within a key; ``bucket`` must be
    non-decreasing in ``order`` (e.g. a right shift of the first order column).
    A null key is a group of its own, as in ``Window.partitionBy``: nullable
    key columns are replaced inside by the non-null pair ``(coalesce(k, zero),
    isnull(k))``, so plain equality on ``(key, bucket)`` still matches every
    row and the join reuses the window's hash partitioning of the big side
    instead of shuffling it a second time (a null-safe join would not).
    """
    keys, order = list(keys), list(order)
    buckets = [bucket] if isinstance(bucket, Column) else list(bucket)
    bnames = [f"__b{i}" for i in range(len(buckets))]
    kcols, knames = [], []
    for i, k in enumerate(keys):
        field = df.schema[k]
        if not field.nullable:
            knames.append(k)
            continue
        kcols += [F.coalesce(F.col(k), _zero(field.dataType)).alias(f"__kz{i}"),
                  F.col(k).isNull().alias(f"__kn{i}")]
        knames += [f"__kz{i}", f"__kn{i}"]
    d = df.select("*", *kcols)
    keys = knames
    part = keys + bnames
    okey = F.struct(*[F.col(c) for c in order])
    hot = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > (HOT_ROWS if hot_rows is None else hot_rows))
            .select(*keys, F.lit(True).alias("__hot")))
    d = d.join(F.broadcast(hot), keys, "left").select(
        *df.columns, *[c for c in keys if c not in df.columns], "__hot",
        *[F.when(F.col("__hot"), b).alias(n) for b, n in zip(buckets, bnames)])
    split = d.filter(F.col("__hot"))

    w = Window.partitionBy(*part).orderBy(*order)
    local = [F.row_number().over(w).alias("__rn")]
    if lead:
        local.append(F.lead(F.lit(1)).over(w).isNull().alias("__is_last"))
    local += [F.lag(c).over(w).alias(f"__l_{c}") for c in lag]
    local += [F.lead(c).over(w).alias(f"__n_{c}") for c in lead]
    wfill = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local += [F.last(c, ignorenulls=True).over(wfill).alias(f"__f_{c}") for c in fill]
    wbefore = w.rowsBetween(Window.unboundedPreceding, -1)
    local += [F.last(c, ignorenulls=True).over(wbefore).alias(f"__p_{c}") for c in before]
    local += [F.sum(F.coalesce(F.col(c), F.lit(0))).over(wfill).alias(f"__s_{c}") for c in sums]
    d = d.drop("__hot").select("*", *local)

    aggs = [F.count(F.lit(1)).alias("__cnt")]
    if lag:
        aggs.append(F.max_by(F.struct(*lag), okey).alias("__lastrow"))
    if lead:
        aggs.append(F.min_by(F.struct(*lead), okey).alias("__firstrow"))
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"__bf_{c}") for c in dict.fromkeys([*fill, *before])]
    aggs += [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__bs_{c}") for c in sums]
    summary = split.groupBy(*part).agg(*aggs)

    ws = Window.partitionBy(*keys).orderBy(*bnames)
    earlier = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum("__cnt").over(earlier), F.lit(0)).alias("__before")]
    if lag:
        carry.append(F.lag("__lastrow").over(ws).alias("__carry_prev"))
    if lead:
        carry.append(F.lead("__firstrow").over(ws).alias("__carry_next"))
    carry += [F.last(f"__bf_{c}", ignorenulls=True).over(earlier).alias(f"__cf_{c}") for c in dict.fromkeys([*fill, *before])]
    carry += [F.coalesce(F.sum(f"__bs_{c}").over(earlier), F.lit(0)).alias(f"__cs_{c}") for c in sums]
    summary = summary.select(*part, *carry)

    j = d.join(summary, part, "left")
    out = [F.col(c) for c in df.columns]
    out += [F.when(F.col("__rn") == 1, F.col("__carry_prev")[c]).otherwise(F.col(f"__l_{c}"))
            .alias(prev_prefix + c) for c in lag]
    out += [F.when(F.col("__is_last"), F.col("__carry_next")[c]).otherwise(F.col(f"__n_{c}"))
            .alias(next_prefix + c) for c in lead]
    out += [F.coalesce(F.col(f"__f_{c}"), F.col(f"__cf_{c}")).alias(fill_prefix + c) for c in fill]
    out += [F.coalesce(F.col(f"__p_{c}"), F.col(f"__cf_{c}")).alias(before_prefix + c) for c in before]
    out += [(F.col(f"__s_{c}") + F.coalesce(F.col(f"__cs_{c}"), F.lit(0))).alias(sum_prefix + c) for c in sums]
    if seq:
        out.append((F.coalesce(F.col("__before"), F.lit(0)) + F.col("__rn")).cast("long").alias(seq))
    return j.select(*out)


def _zero(t: T.DataType) -> Column:
    """A non-null stand-in value of type ``t`` (its ``isnull`` flag keeps nulls apart)."""
    if isinstance(t, T.StringType):
        return F.lit("")
    if isinstance(t, T.BooleanType):
        return F.lit(False)
    if isinstance(t, T.NumericType):
        return F.lit(0).cast(t)
    if isinstance(t, T.BinaryType):
        return F.lit(b"")
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(t)
    raise TypeError(f"keyed_window key of type {t.simpleString()} is not supported")


def shift_bucket(col: str | Column, bits: int) -> Column:
    """Monotone bucket of a non-negative integer order column."""
    return F.shiftright(_col(col).cast("long"), bits)
