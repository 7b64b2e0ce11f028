"""Join helpers with size-checked broadcasts and a skew-safe as-of join.

A side is broadcast only after its row count and byte size have been checked
against bounds (one aggregate over ``limit(bound + 1)`` reads at most
bound + 1 rows).  Beyond either bound the plan falls back to a shuffle join
that does not depend on the side being small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import keyed_window

# Rows a lookup side may hold to be broadcast (a catalogue or list, not a log).
MAX_BROADCAST_ROWS = 200_000
# Bytes of its rows (as JSON text) a broadcast side may hold.
MAX_BROADCAST_BYTES = 64 << 20
# Versions one key may have for the broadcast as-of join: each event probes all
# versions of its key, so this bounds the range checks per event.
MAX_VERSIONS_PER_KEY = 64


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    One pass over at most ``max_rows + 1`` rows measures both: the row count
    and the JSON text length of those rows (an upper-side estimate of the
    hashed relation for text and a fair one for numbers), so a side of few but
    wide rows (long type texts, big arrays) is not broadcast either.
    """
    return _fits(_profile(df, max_rows), max_rows, max_bytes)


def _profile(df: DataFrame, max_rows: int | None, keys: Sequence[str] = ()):
    """Rows, JSON bytes and (with ``keys``) the largest group of at most ``max_rows + 1`` rows: one job."""
    rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    head = df.limit(rows + 1)
    if keys:
        head = head.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b"))
        return head.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("n").alias("m")).first()
    return head.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()


def _fits(r, max_rows: int | None, max_bytes: int | None) -> bool:
    rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    size = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    return (r["n"] or 0) <= rows and (r["b"] or 0) <= size


def lookup_join(big: DataFrame, small: DataFrame, on, how: str, max_rows: int | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """Join ``big`` with a lookup side; broadcast it only when its size is proven small."""
    side = F.broadcast(small) if fits_broadcast(small, max_rows, max_bytes) else small
    return big.join(side, on, how)


def list_frame(spark, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A small in-memory list (an allow / deny list) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema=list(columns))


def asof_join(events: DataFrame, versions: DataFrame, keys: Sequence[str], pos: str = "pos_key",
              vfrom: str = "valid_from", vto: str = "valid_to", max_rows: int | None = None,
              bucket_bits: int = 20, max_bytes: int | None = None,
              max_per_key: int | None = None) -> DataFrame:
    """Left join each event to the version of its key valid at its position.

    ``versions`` holds non-overlapping ``[vfrom, vto)`` intervals per key
    (``vto`` null = open), so at most one version matches an event.  Small
    version tables with few versions per key are broadcast and the range is
    checked inside the broadcast hash join (each event probes the versions of
    its key, at most MAX_VERSIONS_PER_KEY).  Others are joined on
    ``(keys, pos >> bucket_bits)``:
    each bucket gets the version in effect at its start plus the versions that
    start inside it, so a busy key is spread over its buckets instead of
    landing in one sort-merge partition.
    """
    keys = list(keys)
    vcols = [c for c in versions.columns if c not in keys]
    ren = {c: f"__v_{c}" for c in keys + vcols}
    v = versions.select(*[F.col(c).alias(ren[c]) for c in keys + vcols])
    lo, hi = F.col(ren[vfrom]), F.col(ren[vto])
    p = F.col(pos)
    cond = [F.col(k) == F.col(ren[k]) for k in keys] + [p >= lo, hi.isNull() | (p < hi)]
    out = [F.col(c) for c in events.columns] + [F.col(ren[c]).alias(c) for c in vcols]

    per_key = MAX_VERSIONS_PER_KEY if max_per_key is None else max_per_key
    prof = _profile(versions, max_rows, keys)
    if _fits(prof, max_rows, max_bytes) and (prof["m"] or 0) <= per_key:
        return events.join(F.broadcast(v), cond, "left").select(*out)

    b = F.shiftright(p, bucket_bits)
    eb = events.select(*keys, b.alias("__b")).distinct()
    # Version in effect at the start of each bucket: a forward fill over the
    # union of version starts and bucket starts, per key, in position order.
    starts = versions.select(*keys, F.col(vfrom).alias("__p"), F.lit(0).alias("__kind"),
                             F.col(vfrom).cast("long").alias("__vid"))
    marks = eb.select(*keys, F.shiftleft(F.col("__b"), bucket_bits).alias("__p"), F.lit(1).alias("__kind"),
                      F.lit(None).cast("long").alias("__vid"))
    filled = keyed_window(starts.unionByName(marks), keys, ["__p", "__kind"],
                          F.shiftright(F.col("__p"), bucket_bits + 12), fill=["__vid"])
    at_start = (filled.filter((F.col("__kind") == 1) & F.col("fill___vid").isNotNull())
                      .select(*keys, F.shiftright(F.col("__p"), bucket_bits).alias("__b"),
                              F.col("fill___vid").alias("__vid")))
    inside = versions.select(*keys, F.shiftright(F.col(vfrom), bucket_bits).alias("__b"),
                             F.col(vfrom).cast("long").alias("__vid"))
    cand = (at_start.unionByName(inside).distinct()
                    .join(v, [*[F.col(k) == F.col(ren[k]) for k in keys],
                              F.col("__vid") == lo.cast("long")], "inner")
                    .select(F.col("__b").alias("__cb"), *[F.col(ren[c]) for c in keys + vcols]))
    return (events.withColumn("__b", b)
                  .join(cand, [*cond, F.col("__b") == F.col("__cb")], "left")
                  .select(*out))
