"""Phrase collocations of every language, mined by the two-pass partitioning of SON.

The documents fall into a few shards by a hash.  A phrase that occurs ``min_count`` times has, in
at least one shard, at least its share of them: ``min_count`` times the shard's part of all bytes.
So the first pass counts every phrase of every shard, by 64-bit hash, and keeps those that reach
their shard's lowered support; a shard is counted by as many tasks as it has, and few shards
keep the lowered support above one.  The hashes kept by any shard go into a bit table of
fixed size (hashes may meet, which only adds candidates), the only thing that reaches the driver
and is broadcast.  The second pass reads the texts again
and counts the phrases in the table, by their words, exactly; those under ``min_count`` go.  A
table that is full lets more through and changes no result.

Tasks count phrases of a block of words as packed numbers; the first pass shuffles them as arrays
of hashes, dealt to as many groups as the bytes of text ask for.  Scores, containment and the best phrases of a language are joins
and aggregates over the frequent phrases; a part that very many phrases share is salted.

Words are what lies between spaces and tabs, pieces what lies between ``.,;:!?`` and line breaks
(U+000A to U+000D); A-Z are lower-cased.  Null text counts as empty, a null language as ``und``.
Repeated rows count as often as they come, ids don't matter, further columns are ignored, texts
are read whole however long.  Ties are broken by the phrase, so results don't depend on
partitioning.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

TABLE_WORDS = 1 << 21     # of 64 bits: the table of candidates, 16 MB whatever the input
BLOCK_WORDS = 1_500_000   # counted at once by a task, fewer where a block has a million different ones
GROUP_BYTES = 64 << 20    # of packed hashes that one group of the first pass merges
HOT = 200_000             # phrases that share a part before that part is salted
BREAK = b"\n"

#: one pass over the bytes: A-Z to a-z, tabs to spaces, the ends of pieces to line breaks
_FOLD = bytes(ord("\n") if b in b".,;:!?\n\x0b\x0c\r" else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: bytes) -> list[bytes]:
    """The folded words of a text, with a line break between pieces."""
    return list(filter(None, text.translate(_FOLD).replace(BREAK, b" \n ").split(b" ")))


class Words(dict):
    """Word -> its number in a block; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Block:
    """Words of some texts of several groups; ``counts`` gives the distinct phrases of each."""

    def __init__(self, longest: int):
        self.longest, self.bits = longest, 62 // longest
        self.room = min(BLOCK_WORDS, (1 << self.bits) // 2)  # words of a part: each may be a new one
        self.clear()

    def clear(self) -> None:
        self.words, self.parts, self.size = Words({BREAK: 0}), {}, 0

    def add(self, group: tuple, tokens: list[bytes]) -> Iterator[None]:
        """Yields whenever the block is full and must be counted and cleared."""
        step = self.room
        for at in range(0, len(tokens), step):
            part = tokens[at:at + step + self.longest - 1]  # phrases may run on into the next part
            starts = min(step, len(tokens) - at)
            if self.size and (len(self.words) + len(part) > 1 << self.bits or self.size + len(part) > BLOCK_WORDS + step):
                yield
            ids = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
            self.parts.setdefault(group, []).append((ids, starts))
            self.size += len(part)
            if self.size >= BLOCK_WORDS:
                yield

    def counts(self) -> Iterator[tuple[tuple, int, np.ndarray, np.ndarray]]:
        """(group, words in a phrase, phrases as packed word numbers, how often each occurs)."""
        for group, parts in self.parts.items():
            end = np.zeros(1, np.int64)
            ids = np.concatenate([x for a, _ in parts for x in (a, end)])
            starts = np.concatenate([np.arange(len(a) + 1) < n for a, n in parts])
            key, good = ids, starts & (ids > 0)
            for k in range(1, self.longest + 1):
                if k > 1:
                    key = key[:-1] << self.bits | ids[k - 1:]
                    good = good[:-1] & (ids[k - 1:] > 0)
                phrases, n = np.unique(key[good], return_counts=True)
                if len(phrases):
                    yield group, k, phrases, n

    def numbers(self, phrases: np.ndarray, k: int) -> list[np.ndarray]:
        """The word numbers of packed phrases, one array for each place."""
        mask = (1 << self.bits) - 1
        return [phrases >> self.bits * (k - 1 - j) & mask for j in range(k)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hashes(lang: str, block: Block, word_hash: np.ndarray, phrases: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(phrases), xxhash.xxh64_intdigest(lang.encode(), k), np.uint64)
    for ids in block.numbers(phrases, k):
        h = _mix(h ^ word_hash[ids])
    return h


def _counted(rows: DataFrame, longest: int, schema: str, emit) -> DataFrame:
    """``emit(block)`` of blocks that hold the rows' (lang, shard, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(longest)
        for batch in batches:
            langs, shards = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, shard, text in zip(langs, shards, batch.column(2)):
                for _ in block.add((lang, shard), words(text.as_py())):
                    yield from emit(block)
                    block.clear()
        yield from emit(block)

    return rows.mapInArrow(run, schema)


def shard_sizes(rows: DataFrame, shards: int) -> list[int]:
    """Bytes of text of each shard."""
    size = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).collect()}
    return [size.get(s, 0) for s in range(shards)]


def supports_of(sizes: list[int], min_count: int) -> list[int]:
    """The lowered support of each shard: its part of all bytes, of ``min_count``, rounded up."""
    total = sum(sizes)
    return [max(1, -(-min_count * n // total)) if total else 1 for n in sizes]


def buckets_for(size: int) -> int:
    """Bits of a hash that deal the first pass's phrases to groups of about ``GROUP_BYTES`` bytes."""
    return max(6, (5 * size // (2 * GROUP_BYTES)).bit_length())


def _spot(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and place in the bucket's part of the table of 64-bit hashes: the top bits, and the low 32 scaled."""
    region = max(64, (TABLE_WORDS * 64) >> bits)
    return (h >> np.uint64(64 - bits)).astype(np.int64), ((h & np.uint64(0xFFFFFFFF)) * np.uint64(region) >> np.uint64(32)).astype(np.int64)


def candidates(rows: DataFrame, longest: int, supports: list[int], bits: int) -> DataFrame:
    """First pass: (bucket, table): the part of the bit table of the phrases that some shard holds at its lowered support.

    A task hands over its phrases as one row of packed 32-bit hashes and counts for each bucket and
    shard of a block; a group merges a bucket.  Counts are cut at the largest support: more makes no difference.
    """
    most = max(supports)
    kind = np.uint8 if most < 256 else np.int64

    def emit(block: Block) -> Iterator[pa.RecordBatch]:
        word_hash = np.fromiter(map(xxhash.xxh64_intdigest, block.words), np.uint64, len(block.words))
        by_shard: dict[int, list] = {}
        for (lang, shard), k, phrases, n in block.counts():
            by_shard.setdefault(shard, []).append((_hashes(lang, block, word_hash, phrases, k), np.minimum(n, most).astype(kind)))
        for shard, parts in by_shard.items():
            h, n = (np.concatenate(x) for x in zip(*parts))
            bucket = (h >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
            order = np.argsort(bucket, kind="stable")
            h, n, bucket = h[order].astype(np.uint32), n[order], bucket[order]
            at = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(h)]]) if len(h) else np.zeros(1, np.int64)
            spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[at[:-1]].astype(np.int32)), pa.array(np.full(len(spans), shard, np.int32)),
                 pa.array([h[x:y].tobytes() for x, y in spans], pa.binary()), pa.array([n[x:y].tobytes() for x, y in spans], pa.binary())],
                ["bucket", "shard", "h", "n"])

    def merge(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        shards = group.column("shard").to_numpy()
        region = np.zeros(max(64, (TABLE_WORDS * 64) >> bits), bool)
        for shard in np.unique(shards):
            rows = group.take(np.flatnonzero(shards == shard))
            h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in rows.column("h")])
            n = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows.column("n")])
            order = np.argsort(h)
            h = h[order]
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            found = h[starts][np.add.reduceat(n[order], starts, dtype=np.int64) >= supports[shard]]
            region[_spot(found.astype(np.uint64), bits)[1]] = True
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "table": pa.array([np.packbits(region, bitorder="little").tobytes()], pa.binary())})

    packed = _counted(rows, longest, "bucket int, shard int, h binary, n binary", emit)
    return packed.groupBy("bucket").applyInArrow(merge, "bucket int, table binary")


def bit_table(parts: DataFrame, bits: int) -> np.ndarray:
    """The whole table, one byte for eight bits: ``TABLE_WORDS`` 64-bit words, or 64 bits for each of more buckets."""
    table = np.zeros((1 << bits, max(64, (TABLE_WORDS * 64) >> bits) // 8), np.uint8)
    rows = parts.toArrow()
    for bucket, part in zip(rows.column("bucket").to_pylist(), rows.column("table")):
        table[bucket] = np.frombuffer(part.as_buffer(), np.uint8)
    return table


def count_exactly(rows: DataFrame, longest: int, table: np.ndarray, bits: int, min_count: int) -> DataFrame:
    """Second pass: (lang, phrase, k, f) of the phrases of ``k`` words that occur ``min_count`` times; ``k`` 0: all words."""
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def emit(block: Block) -> Iterator[pa.RecordBatch]:
        has = shared.value
        spelt = list(block.words)
        word_hash = np.fromiter(map(xxhash.xxh64_intdigest, spelt), np.uint64, len(spelt))
        for (lang, _), k, phrases, n in block.counts():
            if k == 1:
                yield batch(lang, 0, [b""], [int(n.sum())])
            h = _hashes(lang, block, word_hash, phrases, k)
            bucket, spot = _spot(h, bits)
            found = (has[bucket, spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)
            places = [[spelt[i] for i in ids.tolist()] for ids in block.numbers(phrases[found], k)]
            yield batch(lang, k, places[0] if k == 1 else list(map(b" ".join, zip(*places))), n[found])

    def batch(lang: str, k: int, phrases: list[bytes], n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases)).cast(pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                                           pa.array(np.full(len(phrases), k, np.int32)), pa.array(n, pa.int64())], ["lang", "phrase", "k", "n"])

    counts = _counted(rows, longest, "lang string, phrase string, k int, n long", emit)
    return counts.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("f")).where((F.col("k") == 0) | (F.col("f") >= min_count))


def _with_count(rows: DataFrame, frequent: DataFrame, part: str, name: str) -> DataFrame:
    """``rows`` with the count of their column ``part``; parts of over ``HOT`` rows are dealt over several keys."""
    hot = (rows.groupBy("lang", part).agg(F.count("*").alias("n")).where(F.col("n") > HOT)
           .select("lang", part, F.ceil(F.col("n") / HOT).cast("int").alias("deals")))
    deals = F.coalesce("deals", F.lit(1))
    counts = frequent.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    # at most one hot part for every HOT rows
    counts = counts.join(F.broadcast(hot), ["lang", part], "left").select("lang", part, name, F.explode(F.sequence(F.lit(0), deals - 1)).alias("deal"))
    dealt = rows.join(F.broadcast(hot), ["lang", part], "left").withColumn("deal", F.pmod(F.xxhash64("phrase"), deals).cast("int")).drop("deals")
    return dealt.join(counts, ["lang", part, "deal"]).drop("deal")


def _span(column: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(column, start, length), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, score): every phrase of two words or more, at its lowest-scoring cut."""
    w = F.split("phrase", " ")
    cuts = (frequent.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), w.alias("w"))
            .select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .select("lang", "phrase", "k", "a", "cut", _span("w", F.lit(1), F.col("cut")).alias("left"),
                    _span("w", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right")))
    cuts = _with_count(_with_count(cuts, frequent, "left", "l"), frequent, "right", "r")
    wide = {c: F.col(c).cast("decimal(15,0)") for c in "alr"}
    # exact to 38 digits; div cuts off the fraction
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", "l", "r", *[v.alias("w" + c) for c, v in wide.items()])
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (wa * wa)) div (wl * wr)")
    return (cuts.withColumn("score", score.cast("long"))
            .groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
            .select("lang", "phrase", "k", "a", "s.l", "s.r", "s.score"))


def absorbed(frequent: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase, most): how often the commonest longer frequent phrase around a phrase occurs."""
    w = F.split("phrase", " ")
    inner = (frequent.where("k > 2").select("lang", "f", "k", w.alias("w"))
             .select("*", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
             .select("*", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("at")))
    return inner.groupBy("lang", _span("w", F.col("at"), F.col("m")).alias("phrase")).agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, min_count: int = 10, longest: int = 3, percent: int = 50, top: int = 2000, shards: int = 3,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of two to ``longest`` words."""
    ship()
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(F.col(text_col)), F.lit(shards)).cast("int").alias("shard"), text.alias("text"))
    sizes = shard_sizes(rows, shards)
    bits = buckets_for(sum(sizes))
    table = bit_table(candidates(rows, longest, supports_of(sizes, min_count), bits), bits)
    frequent = written(count_exactly(rows, longest, table, bits, min_count), "frequent-phrases")
    kept = (scored(frequent).join(absorbed(frequent, percent), ["lang", "phrase"], "left")
            .where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).drop("most"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's best are among the best of its slices, so no task orders a whole language
    kept = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = frequent.where("k = 0").select("lang", F.col("f").alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
