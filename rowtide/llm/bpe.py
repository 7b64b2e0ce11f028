"""Byte-level BPE: encode texts to ids, decode ids to bytes.

Texts up to ``chunk`` characters are pre-tokenised whole.  A longer one is cut
into chunks that overlap by ``overlap`` characters on either side; each chunk is
pre-tokenised on its own, in whatever task it falls to.  The pattern only looks
ahead, so two runs that share one boundary agree on all later ones: the first
boundary which the chunks on both sides of a seam share is where they are
stitched.  Each piece between two seams is then encoded, and a text's pieces are
joined in order.  A text with a seam that has no shared boundary (one word longer
than the overlap) is encoded whole.  Decoding concatenates the raw bytes of the ids.

Null text counts as empty: no ids, no bytes.  Every input row gives one row,
repeated rows as often as they come; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from .common import ship

CACHE_PIECES = 100_000  # distinct pre-tokens remembered by a worker; then it starts anew
BATCH_CHARS = 1_000_000  # of text in a batch of results


@lru_cache(maxsize=4)
def vocabulary(ranks_path: str) -> dict[bytes, int]:
    with open(ranks_path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Pieces(dict):
    """Pre-token -> its ids as packed 32-bit integers."""

    def __init__(self, ranks_path: str, pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=vocabulary(ranks_path),
                                          special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        packed = array("i", self.encoding.encode_ordinary(piece)).tobytes()
        if len(piece) < 100:
            self[piece] = packed
        return packed


@lru_cache(maxsize=4)
def pieces_of(ranks_path: str, pattern: str) -> tuple[Pieces, regex.Pattern]:
    return Pieces(ranks_path, pattern), regex.compile(pattern)


def _token_table(ranks_path: str) -> list[bytes]:
    ranks = vocabulary(ranks_path)
    token = [b""] * (max(ranks.values(), default=-1) + 1)
    for raw, i in ranks.items():
        token[i] = raw
    return token


def _encode_rows(rows: DataFrame, ranks_path: str, pattern: str, decoded: str | None) -> DataFrame:
    """The rows with their text column ``t`` replaced by ``ids`` and, if named, the bytes that these decode to."""
    names = [c for c in rows.columns if c != "t"]
    types = [rows.schema[c] for c in names]
    schema = StructType([*types, StructField("ids", ArrayType(IntegerType()))]
                        + ([StructField(decoded, BinaryType())] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, split = pieces_of(ranks_path, pattern)
        token = _token_table(ranks_path) if decoded else []
        for batch in batches:
            texts, start = batch.column("t"), 0
            while start < len(texts):
                blobs, chars, stop = [], 0, start
                while stop < len(texts) and chars < BATCH_CHARS:
                    t = texts[stop].as_py()
                    blobs.append(b"".join(map(packed.__getitem__, split.findall(t))))
                    chars += len(t)
                    stop += 1
                ends = np.cumsum([0] + [len(x) // 4 for x in blobs])
                out = [batch.column(c).slice(start, stop - start) for c in names]
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                    pa.array(np.frombuffer(b"".join(blobs), np.int32), pa.int32())))
                if decoded:
                    out.append(pa.array([b"".join(map(token.__getitem__, np.frombuffer(x, np.int32).tolist())) for x in blobs],
                                        pa.binary()))
                yield pa.RecordBatch.from_arrays(out, schema.fieldNames())
                start = stop

    return rows.mapInArrow(run, schema)


def _boundaries(pattern: str):
    """Starts of the pre-tokens of a chunk, but those near its end that more text could move."""

    @F.arrow_udf("array<int>")
    def starts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split = regex.compile(pattern)
        for batch in batches:
            yield pa.array([[m.start() for m in split.finditer(t.as_py() or "")][:-2] for t in batch],
                           pa.list_(pa.int32()))

    return starts


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = 65_536, overlap: int = 1_024, decoded: str | None = None) -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of every row; ``decoded`` names a column for the bytes these decode to."""
    ship()
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    short = _encode_rows(rows.where(F.length("t") <= chunk), ranks_path, pattern, decoded)
    # long texts: equal rows are encoded once and given back as often as they came
    long = rows.where(F.length("t") > chunk).groupBy(id_col, "t").agg(F.count("*").alias("copies"))
    last = F.floor((F.length("t") - 1) / F.lit(chunk)).cast("int")
    chunks = long.select(id_col, F.xxhash64("t").alias("k"), "copies", "t", F.explode(F.sequence(F.lit(0), last)).alias("c"))
    chunks = chunks.select(
        id_col, "k", "copies", "c", F.greatest(F.col("c") * chunk - overlap, F.lit(0)).alias("at"),
        F.substring("t", F.greatest(F.col("c") * chunk - overlap, F.lit(0)) + 1,
                    F.lit(chunk + overlap) + F.least(F.col("c") * chunk, F.lit(overlap))).alias("part"))
    chunks = chunks.repartition(id_col, "k", "c")
    chunks = chunks.withColumn("starts", F.transform(_boundaries(pattern)("part"), lambda x: x + F.col("at")))
    edge = (F.col("c") + 1) * chunk
    chunks = chunks.withColumns({
        "right": F.filter("starts", lambda x: x >= edge - overlap),
        "left": F.filter("starts", lambda x: x < F.col("at") + 2 * overlap)}).drop("starts")
    by_doc = Window.partitionBy(id_col, "k").orderBy("c")
    chunks = chunks.withColumns({
        "seam": F.array_min(F.array_intersect("right", F.lead("left").over(by_doc))),
        "is_last": F.lead("c").over(by_doc).isNull()})
    chunks = chunks.withColumns({
        "from": F.when(F.col("c") == 0, F.lit(0)).otherwise(F.lag("seam").over(by_doc)),
        "torn": F.max((~F.col("is_last") & F.col("seam").isNull()).cast("int")).over(Window.partitionBy(id_col, "k"))})
    end = F.when(F.col("is_last"), F.col("at") + F.length("part")).otherwise(F.col("seam"))
    pieces = chunks.where("torn = 0").select(
        id_col, "k", "copies", "c", F.substring("part", F.col("from") - F.col("at") + 1, end - F.col("from")).alias("t"))
    whole = (_encode_rows(pieces, ranks_path, pattern, None)
             .groupBy(id_col, "k", "copies").agg(F.array_sort(F.collect_list(F.struct("c", "ids"))).alias("ps"))
             .select(id_col, "copies", F.flatten(F.col("ps.ids")).alias("ids")))
    torn = chunks.where("torn = 1 AND c = 0").select(F.col(id_col).alias("i"), F.col("k").alias("j"))
    rest = long.join(torn, F.col(id_col).eqNullSafe(F.col("i")) & (F.xxhash64("t") == F.col("j")), "left_semi")
    whole = whole.unionByName(_encode_rows(rest, ranks_path, pattern, None))
    whole = whole.select(id_col, F.explode(F.array_repeat("ids", F.col("copies").cast("int"))).alias("ids"))
    return short.unionByName(decode(whole, ranks_path, to=decoded) if decoded else whole)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", to: str = "bytes") -> DataFrame:
    """The rows with one more column: the concatenated bytes of their ids (null ids: empty)."""
    ship()

    @F.arrow_udf("binary")
    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = _token_table(ranks_path)
        for batch in batches:
            values = batch.values.to_numpy(zero_copy_only=False)
            ends = batch.offsets.to_numpy()
            yield pa.array([b"".join(map(token.__getitem__, values[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:])],
                           pa.binary())

    return encoded.withColumn(to, join(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", **kw) -> DataFrame:
    """Per row: id, number of tokens, and the digests of its ids and of what they decode to."""
    both = encode(docs, ranks_path, pattern, id_col, decoded="bytes", **kw)
    return both.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
