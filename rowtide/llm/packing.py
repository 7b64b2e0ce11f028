"""Packing of tokenised documents into windows of a fixed length by minimum bin slack.

Every document is encoded whole and closed with an end id.  Its full windows are sequences of
their own; the rest, shorter than a window, goes to the task's pool, kept by length.  When the
pool holds ``pool_size`` rests, windows are filled: the longest rest is the seed, and a
subset-sum table over the remaining lengths (a bit for every total that some multiset of them
reaches, counts split into powers of two) tells the multiset that comes closest to the room
left; walking the table back gives how many of each length to take, and the window is repeated
as long as the counts last.  A window that no multiset fills gets the head of another rest; the
rest's tail goes back to the pool.  At the end of a task, whose last tokens fill no window, windows
of the largest power of two that still fits are filled in the same way, and need no padding.

Tasks pack on their own: a sequence never mixes rows of two tasks, nothing is shuffled, and a task
holds at most ``pool_size`` rests.  ``sequence_id`` is unique, not dense: the task's number and a
count.  A task that runs again packs its rows anew, as a whole.

Null text counts as empty: one piece, the end id.  Every row gives its pieces, repeated rows and
repeated or null ids as often as they come; further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import ship

SEQUENCE_BITS = 40       # of a sequence id count within a task
BATCH_TOKENS = 500_000   # of pieces in a batch of results


class Encoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library, added tokens included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the printable stand-ins of the 256 bytes: printable Latin-1 characters stand for
        # themselves, the other bytes for the characters from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in byte for c in t)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        merged = [(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"]["".join(m)] for m in merged]
        if order != sorted(order):
            raise ValueError(f"{path}: ids don't follow the order of merges")
        self.ranks = {t: i for t, i in ranks.items() if i not in self.added.values()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    @lru_cache(maxsize=2)
    def encoding(self, pattern: str) -> tiktoken.Encoding:
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    def ids(self, text: str, pattern: str) -> list[int]:
        encode = self.encoding(pattern).encode_ordinary
        if not self.split or not self.split.search(text):
            return encode(text)
        return [i for part in self.split.split(text) if part for i in ([self.added[part]] if part in self.added else encode(part))]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Pool:
    """Rests by length: ``take`` and ``put`` keep ``lengths`` sorted and free of empty ones."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.lengths: list[int] = []
        self.size = self.tokens = 0

    def put(self, item: tuple, length: int) -> None:
        if length not in self.by_length:
            self.by_length[length] = []
            insort(self.lengths, length)
        self.by_length[length].append(item)
        self.size += 1
        self.tokens += length

    def take(self, length: int) -> tuple:
        items = self.by_length[length]
        item = items.pop()
        if not items:
            del self.by_length[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.size -= 1
        self.tokens -= length
        return item


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose total comes closest to ``room`` from below.

    Bit ``t`` of a table says that some multiset of the lengths so far totals ``t``.  Lengths are
    taken from the longest down, and only until a multiset fills the room.
    """
    mask, full = (1 << room + 1) - 1, 1 << room
    reach, steps = 1, []
    for length in reversed(lengths):
        if length > room:
            continue
        left, copies = min(counts[length], room // length), 1
        while left and not reach & full:
            n = min(copies, left)
            steps.append((length, n, reach))
            reach |= reach << n * length & mask
            left -= n
            copies *= 2
        if reach & full:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            total -= n * length
            chosen[length] = chosen.get(length, 0) + n
    return chosen


def windows(pool: Pool, window: int, last: bool, keep: int) -> Iterator[list[tuple]]:
    """Fill windows until the pool holds ``keep`` rests or, at the ``last`` call, nothing.

    An item is (row, start, ids as bytes of four each).  A window is a list of items.
    """
    while pool.size > keep or last and pool.size:
        size = window if pool.tokens >= window else 1 << pool.tokens.bit_length() - 1
        if pool.tokens < window and not last:
            return
        at = bisect_left(pool.lengths, size + 1) - 1
        if at < 0:  # nothing fits: the window is the head of a rest
            yield [_head(pool, pool.lengths[-1], size)]
            continue
        seed = pool.lengths[at]
        counts = {n: len(items) for n, items in pool.by_length.items()}
        counts[seed] -= 1
        chosen = fullest(counts, [n for n in pool.lengths if counts[n]], size - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        slack = size - sum(n * k for n, k in chosen.items())
        counts[seed] += 1
        again = min(counts[n] // k for n, k in chosen.items()) if not slack and size == window else 1
        for _ in range(again):
            filled = [pool.take(n) for n, k in chosen.items() for _ in range(k)]
            if slack:
                filled.append(_head(pool, pool.lengths[bisect_left(pool.lengths, slack)], slack))
            yield filled


def _head(pool: Pool, length: int, size: int) -> tuple:
    """The first ``size`` ids of a rest; the others go back."""
    row, start, ids = pool.take(length)
    if length > size:
        pool.put((row, start + size, ids[4 * size:]), length - size)
    return row, start, ids[:4 * size]


def pack(docs: DataFrame, tokenizer: str, pattern: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", pool_size: int = 2_000) -> DataFrame:
    """Per piece: id, ``start``, ``length``, ``ids`` (unsigned 32-bit little-endian), ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, ``pattern`` its pre-tokeniser's.
    """
    if window < 2 or window & window - 1:
        raise ValueError("the window must be a power of two")
    ship()
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    key = rows.schema[id_col]
    schema = StructType([key, StructField("start", LongType()), StructField("length", IntegerType()), StructField("ids", BinaryType()),
                         StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()), StructField("offset", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        pool, out, held, arrow = Pool(), [], 0, None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = [arrow, pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.fieldNames())

        def emit(filled: list[tuple]) -> None:
            nonlocal sequence, held
            offset = 0
            for (name, tokens), start, ids in filled:
                out.append((name, start, len(ids) // 4, ids, tokens, sequence, offset))
                offset += len(ids) // 4
            sequence += 1
            held += offset

        for batch in batches:
            arrow = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = array("I", encode(text.as_py(), pattern))
                ids.append(end_id)
                row, raw, full = (name, len(ids)), ids.tobytes(), len(ids) // window * window
                for start in range(0, full, window):
                    emit([(row, start, raw[4 * start:4 * (start + window)])])
                if full < len(ids):
                    pool.put((row, full, raw[4 * full:]), len(ids) - full)
                if pool.size >= pool_size:
                    for filled in windows(pool, window, False, pool_size // 2):
                        emit(filled)
                if held >= BATCH_TOKENS:
                    yield flush()
                    out, held = [], 0
        for filled in windows(pool, window, True, 0):
            emit(filled)
            if held >= BATCH_TOKENS:
                yield flush()
                out, held = [], 0
        if out:
            yield flush()

    return rows.mapInArrow(run, schema)


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """Per sequence: ``sequence_id``, ``ids`` (as in ``pack``, padded to the window unless the length is a power of two) and ``n_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence's pieces: at most ``window``
    whole = pieces.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_ids"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    pad = F.when(F.col("n_ids").bitwiseAND(F.col("n_ids") - 1) == 0, 0).otherwise(F.lit(window) - F.col("n_ids")).cast("int")
    filler = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), pad))
    return whole.select("sequence_id", F.concat(joined, filler).alias("ids"), "n_ids")
