"""Suffix-array dedup: remove every byte of a 100-byte string that also starts earlier.

Earlier means a smaller document id, or the same document and an earlier start.  Strings
are judged on the input, never cross documents, and may overlap.

A suffix array of the whole corpus fits no task, so the corpus is cut into buckets that
hold all copies of a string together:

1. Every window of ``length`` bytes picks one of its ``gram``-byte strings, the one with
   the least hash (the leftmost of equals).  Equal windows pick equal grams, so a string's
   copies meet under their gram.  The neighbouring windows that pick the same gram are one
   stretch of text.  Stretches with equal bytes are merged before the shuffle, inside each
   batch, and again in their bucket: all but the earliest are removed.
2. Under a gram that one stretch holds, there's nothing left to find.  The distinct stretches of
   the others are dealt to buckets by gram; each bucket is sorted as a suffix array in two
   stages (``suffix_sort``), and neighbours with ``length`` bytes in common are copies.
3. A gram with so many distinct stretches that its bucket would outgrow a task is found on
   a sample of documents beforehand, or in its bucket; its stretches are dealt out by
   window hash instead, earliest first, so no bucket holds more than equal windows.

The removed spans of all steps are united per document.

Null text is empty and stays so.  Null ids come before all others.  Rows with equal id and
text are one document, and each comes back with the same bytes; rows with equal id and
different texts are ordered by a hash of the text.  Further columns are ignored, whatever
their names; an empty table gives an empty result.  Ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .suffix_sort import joined, two_stage

BLOCK_BITS = 20  # bytes worked on at once: 2 ** 20
FIRST = -(1 << 63)  # order of null ids
RECORD = np.dtype([("gram", "i8"), ("what", "i8"), ("id", "i8"), ("rk", "i4"), ("lo", "i4"), ("n", "u1")])
SPAN = np.dtype([("id", "i8"), ("rk", "i4"), ("lo", "i4"), ("hi", "i4")])
SORTED_PIECES = 6_000  # stretches in a suffix array, on average
#: 0: removed [lo, hi); 1: stretch of [lo, hi) whose gram has others; 2: the same, too many of them
FOUND = "kind byte, id long, rk int, lo int, hi int, gram long"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def _gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes, put together from runs of powers of two."""
    out, done, power, run, size = None, 0, np.uint64(0xA24BAED4963EE407), x.astype(np.uint64) + np.uint64(1), 1
    while True:
        if gram & size:
            out = run[:len(x) - size + 1] if out is None else out[:len(x) - done - size + 1] * power + run[done:len(x) - size + 1]
            done += size
        if done == gram:
            return _mix(out)
        run = run[:len(run) - size] * power + run[size:]
        power, size = power * power, size * 2


def stretches(raw: bytes, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, first window, last window) of the stretches of a block of documents that start at ``starts``."""
    x = np.frombuffer(raw, np.uint8)
    n = len(x) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none
    with np.errstate(over="ignore"):
        h = _gram_hashes(x, gram)
    low = np.uint64((1 << BLOCK_BITS) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # the place breaks ties, leftmost first
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < width:
        key = np.minimum(key[:n], key[width - size:width - size + n])
    place = (key[:n] & low).astype(np.int64)
    ends = np.append(starts[1:], len(x))
    inside = np.zeros(n + 1, np.int64)
    some = ends - starts >= length
    np.add.at(inside, starts[some], 1)
    np.add.at(inside, (ends - length + 1)[some], -1)
    place[np.cumsum(inside[:n]) == 0] = -1
    doc = np.searchsorted(starts, np.arange(n), "right") if len(starts) > 1 else np.zeros(n, np.int64)
    change = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])))
    last = np.append(change[1:], n) - 1
    good = place[change] >= 0
    lo, hi = change[good], last[good]
    return h[place[lo]].view(np.int64), lo, hi


def _blocks(ids: list, rks: list, raws: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Blocks of whole documents, or of overlapping parts of one longer than a block: (bytes, (id, rk, start in block, offset))."""
    most = 1 << BLOCK_BITS
    part, size, docs = [], 0, []
    for i, rk, raw in zip(ids, rks, raws):
        if len(raw) < length:
            continue
        at = 0
        while len(raw) - at > most:  # each window start falls to one part
            yield raw[at:at + most], [(i, rk, 0, at)]
            at += most - length + 1
        tail = raw[at:] if at else raw
        if len(tail) < length:
            continue
        if size + len(tail) > most:
            yield b"".join(part), docs
            part, size, docs = [], 0, []
        docs.append((i, rk, size, at))
        part.append(tail)
        size += len(tail)
    if docs:
        yield b"".join(part), docs


def _records(ids: list, rks: list, raws: list[bytes], length: int, gram: int) -> np.ndarray:
    out = []
    for raw, docs in _blocks(ids, rks, raws, length):
        starts = np.array([d[2] for d in docs], np.int64)
        g, lo, hi = stretches(raw, starts, length, gram)
        doc = np.searchsorted(starts, lo, "right") - 1
        r = np.empty(len(lo), RECORD)
        digest = xxhash.xxh3_64_intdigest
        r["what"] = np.fromiter((digest(raw[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist())), np.uint64, len(lo)).view(np.int64)
        r["gram"], r["n"] = g, hi - lo
        r["id"] = np.array([d[0] for d in docs], np.int64)[doc]
        r["rk"] = np.array([d[1] for d in docs], np.int32)[doc]
        r["lo"] = lo - starts[doc] + np.array([d[3] for d in docs], np.int64)[doc]
        out.append(r)
    return np.concatenate(out) if out else np.empty(0, RECORD)


def _earliest(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest stretch of each kind, and those that come after it."""
    mixed = r["gram"] ^ (r["what"] << 1)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    tied = np.zeros(len(r), bool)
    tied[1:] |= same
    tied[:-1] |= same
    alone, rest = r[order[~tied]], r[order[tied]]
    rest = rest[np.lexsort((rest["lo"], rest["rk"], rest["id"], rest["n"], rest["what"], rest["gram"]))]
    new = np.ones(len(rest), bool)
    new[1:] = (rest["gram"][1:] != rest["gram"][:-1]) | (rest["what"][1:] != rest["what"][:-1]) | (rest["n"][1:] != rest["n"][:-1])
    head = rest[np.maximum.accumulate(np.where(new, np.arange(len(rest)), 0))] if len(rest) else rest
    later = (rest["id"] != head["id"]) | (rest["rk"] != head["rk"]) | (rest["lo"] != head["lo"])
    return np.concatenate([alone, rest[new]]), rest[later]


def _spans(r: np.ndarray, length: int) -> np.ndarray:
    """What the stretches cover, united per document."""
    r = r[np.lexsort((r["lo"], r["rk"], r["id"]))]
    hi = r["lo"].astype(np.int64) + r["n"] + length
    new = np.ones(len(r), bool)
    if len(r):
        other = (r["id"][1:] != r["id"][:-1]) | (r["rk"][1:] != r["rk"][:-1])
        new[1:] = other | (r["lo"][1:] > hi[:-1])  # equal lengths but for n: ends grow with starts, up to n
    at = np.flatnonzero(new)
    s = np.empty(len(at), SPAN)
    for c in ("id", "rk", "lo"):
        s[c] = r[c][at]
    s["hi"] = np.maximum.reduceat(hi, at) if len(at) else 0
    return s


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, rk, t): the order of a document's id, a hash that tells texts with the same id apart, and the text."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.hash(text_col).alias("rk"),
                       F.col(text_col).alias("t"))


def _too_common(rows: DataFrame, length: int, gram: int, one_in: int, least: int) -> list[int]:
    """At most 2,000 grams with very many distinct stretches, from one document in ``one_in``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = _earliest(_records(*_batch(batch), length, gram))[0]
            g, n = np.unique(r["gram"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n.astype(np.int64))], ["gram", "n"])

    counts = (rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(one_in)) == 0).mapInArrow(count, "gram long, n long")
              .groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
    return [x["gram"] for x in counts.orderBy(F.desc("n"), "gram").limit(2_000).collect()]


def _batch(batch: pa.RecordBatch) -> tuple[list, list, list[bytes]]:
    texts = batch.column("t").cast(pa.binary())
    return (batch.column("id").to_pylist(), batch.column("rk").to_pylist(), [x or b"" for x in texts.to_pylist()])


def find(rows: DataFrame, length: int, gram: int, n_buckets: int, hot: list[int], most: int) -> DataFrame:
    """Step 1: what stretches alone show (see ``FOUND``)."""
    hot_grams = np.array(sorted(hot), np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, later = _earliest(_records(*_batch(batch), length, gram))
            spread = np.where(np.isin(first["gram"], hot_grams), first["gram"] ^ first["what"], first["gram"])
            bucket = (_mix(spread.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ids, begin = np.unique(bucket[order], return_index=True)
            first = first[order]
            out = [(int(b), _packed(first[i:j])) for b, i, j in zip(ids, begin, np.append(begin[1:], len(first)))]
            spans = _spans(later, length)
            out += [(n_buckets + int(spans["lo"][i]) % n_buckets, spans[i:i + 100_000].tobytes()) for i in range(0, len(spans), 100_000)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
                                                 ["bucket", "payload"])

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= n_buckets:
            return _found(0, np.concatenate([np.frombuffer(p, SPAN) for p in frame["payload"]]))
        first, later = _earliest(np.concatenate([_unpacked(p) for p in frame["payload"]]))
        first = first[np.argsort(first["gram"], kind="stable")]
        _, index, n = np.unique(first["gram"], return_inverse=True, return_counts=True)
        n, is_hot = n[index], np.isin(first["gram"], hot_grams)
        parts = [_found(0, _spans(later, length))]
        for kind, mask in ((1, (n > 1) & ~is_hot & (n <= most)), (2, is_hot | (n > most))):
            some = first[mask]
            s = np.empty(len(some), SPAN)
            for c in ("id", "rk", "lo"):
                s[c] = some[c]
            s["hi"] = some["lo"] + some["n"].astype(np.int64) + length
            parts.append(_found(kind, s, some["gram"]))
        return pd.concat(parts, ignore_index=True)

    return rows.mapInArrow(cut, "bucket int, payload binary").groupBy("bucket").applyInPandas(meet, FOUND)


def _packed(r: np.ndarray) -> bytes:
    """Column after column, which compresses better."""
    return b"".join(np.ascontiguousarray(r[c]).tobytes() for c in RECORD.names)


def _unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // RECORD.itemsize
    r, at = np.empty(n, RECORD), 0
    for c in RECORD.names:
        r[c] = np.frombuffer(raw, RECORD[c], n, at)
        at += n * RECORD[c].itemsize
    return r


def _found(kind: int, s: np.ndarray, grams: np.ndarray | None = None) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.full(len(s), kind, np.int8), "id": s["id"], "rk": s["rk"], "lo": s["lo"], "hi": s["hi"],
                         "gram": grams if grams is not None else np.zeros(len(s), np.int64)})


def _with_bytes(rows: DataFrame, asked: DataFrame, max_broadcast: int) -> DataFrame:
    """(kind, id, rk, lo, gram, piece): the asked stretches with their bytes."""
    by_row = asked.groupBy("id", "rk").agg(F.collect_list(F.struct("kind", "lo", "hi", "gram")).alias("q"))
    if asked.count() <= max_broadcast:
        by_row = F.broadcast(by_row)
    raw = F.col("t").cast("binary")
    return (rows.join(by_row, ["id", "rk"]).select("id", "rk", raw.alias("b"), F.explode("q").alias("q"))
            .select("q.kind", "id", "rk", "q.lo", "q.gram", F.substring("b", F.col("q.lo") + 1, F.col("q.hi") - F.col("q.lo")).alias("piece"))
            .dropDuplicates(["id", "rk", "lo"]))


def sorted_copies(pieces: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """Step 2: (id, rk, lo, hi) of windows that a suffix array of each bucket shows to be later copies."""

    def sort(frame: pd.DataFrame) -> pd.DataFrame:
        strings = frame["piece"].tolist()
        x, starts = joined(strings)
        sa, lcp = two_stage(x, length)
        copy = lcp >= length
        run = np.cumsum(~copy)
        in_run = copy.copy()
        in_run[:-1] |= copy[1:]
        pos, run = sa[in_run], run[in_run]
        piece = np.searchsorted(starts, pos, "right") - 1
        whole = pos + length < np.append(starts, len(x))[piece + 1]  # equal strings beyond a piece's end are no windows
        pos, run, piece = pos[whole], run[whole], piece[whole]
        doc, rk = frame["id"].to_numpy()[piece], frame["rk"].to_numpy()[piece]
        lo = frame["lo"].to_numpy()[piece] + pos - starts[piece]
        order = np.lexsort((lo, rk, doc, run))
        doc, rk, lo, run = doc[order], rk[order], lo[order], run[order]
        new = np.append(True, run[1:] != run[:-1]) if len(run) else np.zeros(0, bool)
        head = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0)) if len(run) else np.zeros(0, np.int64)
        later = (doc != doc[head]) | (rk != rk[head]) | (lo != lo[head])
        r = np.zeros(int(later.sum()), RECORD)
        r["id"], r["rk"], r["lo"] = doc[later], rk[later], lo[later]
        return pd.DataFrame(_spans(r, length))

    bucket = F.pmod(F.xxhash64("gram"), F.lit(n_buckets))
    return (pieces.withColumn("bucket", bucket).select("bucket", "id", "rk", "lo", "piece")
            .groupBy("bucket").applyInPandas(lambda _, frame: sort(frame), "id long, rk int, lo int, hi int"))


def hashed_copies(pieces: DataFrame, length: int) -> DataFrame:
    """Step 3: the same for pieces of too common grams, each window dealt out by its own hash."""

    @F.arrow_udf("array<struct<a:bigint,b:bigint>>")
    def windows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for p in batch:
                raw = p.as_py()
                whole = [xxhash.xxh3_128_digest(raw[i:i + length]) for i in range(len(raw) - length + 1)]
                out.append([{"a": int.from_bytes(d[:8], "big", signed=True), "b": int.from_bytes(d[8:], "big", signed=True)} for d in whole])
            yield pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    each = pieces.select("id", "rk", "lo", F.posexplode(windows("piece")).alias("i", "w")).select(
        F.col("w.a").alias("a"), F.col("w.b").alias("b"), F.struct("id", "rk", (F.col("lo") + F.col("i")).alias("lo")).alias("at"))
    first = each.groupBy("a", "b").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    return (each.join(first, ["a", "b"]).where("at > first")
            .select("at.id", "at.rk", "at.lo", (F.col("at.lo") + length).cast("int").alias("hi")))


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 24,
                  bucket_records: int = 300_000, most: int = 10_000, max_broadcast: int = 300_000) -> DataFrame:
    """(id, rk, spans): the removed runs of bytes, [lo, hi), of each row that has any, apart and in order."""
    ship()
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("t"))).collect()[0][0] or 0
    records = size // ((length - gram + 2) // 2) + 1
    n_buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), records // bucket_records + 1)
    one_in = 64
    hot = _too_common(rows, length, gram, one_in, max(most // one_in, 16))
    found = written(find(rows, length, gram, n_buckets, hot, most), "stretches")
    asked = found.where("kind > 0")
    pieces = written(_with_bytes(rows, asked, max_broadcast), "pieces")
    n_sorted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pieces.where("kind = 1").count() // SORTED_PIECES + 1)
    spans = (found.where("kind = 0").select("id", "rk", "lo", "hi")
             .unionByName(sorted_copies(pieces.where("kind = 1"), length, n_sorted))
             .unionByName(hashed_copies(pieces.where("kind = 2"), length)))
    return spans.groupBy("id", "rk").agg(_united()(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def _united():
    """Overlapping and touching spans made one, in order."""

    @F.arrow_udf("array<struct<lo:int,hi:int>>")
    def unite(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends = batch.offsets.to_numpy()
            lo, hi = (batch.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi"))
            row = np.repeat(np.arange(len(batch)), np.diff(ends))
            lo, hi = lo[ends[0]:ends[-1]], hi[ends[0]:ends[-1]]
            order = np.lexsort((lo, row))
            row, lo, hi = row[order], lo[order], hi[order]
            reach = np.maximum.accumulate(hi + (row << 32))  # later rows are beyond all earlier ones
            new = np.ones(len(row), bool)
            new[1:] = lo[1:] + (row[1:] << 32) > reach[:-1]
            at = np.flatnonzero(new)
            end = reach[np.append(at[1:], len(row)) - 1] - (row[at] << 32) if len(at) else lo
            spans = pa.StructArray.from_arrays([pa.array(lo[at], pa.int32()), pa.array(end, pa.int32())], ["lo", "hi"])
            sizes = np.bincount(row[at], minlength=len(batch))
            yield pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), spans)

    return unite


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per row: id, ``kept`` (the bytes that are left), ``spans`` (the removed runs), ``n_bytes``, ``n_removed``, ``n_spans``."""
    spans = removed_spans(docs, id_col, text_col, **kw)

    @F.arrow_udf("binary")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, runs in batches:
            out = []
            for t, s in zip(texts.cast(pa.binary()), runs):
                raw, s = t.as_py(), s.as_py()
                if raw is not None and s:
                    ends = [0, *(x["hi"] for x in s)]
                    raw = b"".join(raw[a:b] for a, b in zip(ends, [*(x["lo"] for x in s), len(raw)]))
                out.append(raw)
            yield pa.array(out, pa.binary())

    rows = docs.select(F.col(id_col).alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"),
                       F.hash(text_col).alias("rk"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    both = rows.join(spans, ["id", "rk"], "left").select("own", "t", F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))
    # only texts that lose something go through Python
    changed = cut(F.when(F.size("spans") > 0, F.col("t")), F.col("spans"))
    both = both.select("own", F.coalesce(changed, F.col("t").cast("binary")).alias("kept"), "spans", F.octet_length("t").cast("long").alias("n_bytes"))
    return both.select(F.col("own").alias(id_col), "kept", "spans", "n_bytes",
                       (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"))
