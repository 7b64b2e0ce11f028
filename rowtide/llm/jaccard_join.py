"""N-gram Jaccard join of whole texts by chosen paths.

A text is the set of its runs of ``size`` words (a shorter one is the run of all its
words), words being what stands between ASCII white space.  Texts with equal sets are one
node.  Two nodes are linked if the Jaccard similarity of their sets is ``least`` or more.

Chosen paths: in every run each set picks each of its tokens with probability
1 / (least * size of the set), by a hash of run and token, so two similar sets pick a
shared token together about once.  Sets with the same pick share a bucket.  Buckets of
up to ``small`` sets are compared all with all; the sets of larger ones pick again, and
again, among their other tokens, and are split by the picks.  Runs are repeated until a pair at the limit
is missed with at most the probability 1 - ``recall`` (at the deepest level; more similar
pairs are missed less).

A bucket still large at the end is a group of near copies.  Large buckets that
share sets make one group, whose sets are dealt to blocks; each pair of blocks is
compared in one task, so no task holds a group.  No limit is set on partners.

Candidates are first compared by a sketch, then exactly, by their whole sets.  A pair that
meets in several buckets counts only in the first, so links are counted without listing
pairs: a group's output has a row per set, not per pair.

Texts without words (null, empty, blank) link to nothing.  Repeated rows and texts with
equal sets are copies: linked, one class, never expanded into pairs.  Null ids come before all others.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHUFFLED, ship, written
from .components import components

FIRST = -(1 << 63)  # order of null ids
BINS = 64  # of the sketch
BLOCK_WORDS = 200_000
DEPTH = 3


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct token hashes of each text."""
    at = 0
    while at < len(texts):
        words: list[bytes] = []
        counts = []
        while at < len(texts) and len(words) < BLOCK_WORDS:
            w = texts[at].encode("utf-8", "surrogatepass").split()
            words += w
            counts.append(len(w))
            at += 1
        ids, kinds = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), np.uint64, len(kinds))[ids]
        tokens = h[:max(len(h) - size + 1, 0)].copy()
        for j in range(1, size):
            tokens = tokens * np.uint64(0xA24BAED4963EE407) + h[j:j + len(tokens)]
        tokens = _mix(tokens)
        end = np.cumsum(counts)
        for a, b in zip(end - counts, end):
            if b - a >= size:
                yield np.unique(tokens[a:b - size + 1])
            elif b > a:
                short = np.uint64(b - a)
                for x in h[a:b]:
                    short = short * np.uint64(0xA24BAED4963EE407) + x
                yield _mix(np.array([short]))
            else:
                yield h[:0]


def chosen_paths(tokens: np.ndarray, seeds: np.ndarray, least: float) -> list[tuple[int, list[int]]]:
    """(first pick, the paths that three picks from there on make) of every run."""
    n = len(tokens)
    limit = np.uint64(min(2.0 ** 64 - 2049, 2.0 ** 64 / (least * max(n, 1))))
    run, first = np.nonzero(_mix(tokens[None] ^ seeds[:, None]) <= limit)
    keys = _mix(tokens[first] + seeds[run])
    parent, path, used = np.arange(len(keys)), keys, [first]
    for _ in range(DEPTH - 1):
        more, token = np.nonzero(_mix(tokens[None] ^ path[:, None]) <= limit)
        fresh = np.ones(len(more), bool)
        for u in used:
            fresh &= u[more] != token
        more, token = more[fresh], token[fresh]
        path, parent, used = _mix(path[more] * np.uint64(3) + tokens[token]), parent[more], [*(u[more] for u in used), token]
    leaves: list[list[int]] = [[] for _ in keys]
    for p, k in zip(parent.tolist(), path.view(np.int64).tolist()):
        leaves[p].append(k)
    return list(zip(keys.view(np.int64).tolist(), leaves))


def sketch(tokens: np.ndarray) -> bytes:
    """One byte of the least token of each of the bins that the hashes fall to; 0 for an empty bin."""
    out = np.zeros(BINS, np.uint8)
    h = _mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
    order = np.lexsort((h >> np.uint64(6), h & np.uint64(BINS - 1)))
    h = h[order]
    bins, at = np.unique(h & np.uint64(BINS - 1), return_index=True)
    out[bins.astype(np.int64)] = ((h[at] >> np.uint64(20)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out.tobytes()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64(text_col).alias("tk"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))


def _described(texts: DataFrame, size: int, least: float, runs: int) -> DataFrame:
    """(id, tk, n, s1, s2, sketch, paths): what the join needs to know of every text."""
    schema = "id long, tk long, n int, s1 long, s2 long, sketch binary, paths array<struct<key:long,leaves:array<long>>>"
    kind = pa.list_(pa.struct([("key", pa.int64()), ("leaves", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch.slice(at, 2_000)
                n, s1, s2, sk, paths = [], [], [], [], []
                with np.errstate(over="ignore"):
                    for tokens in shingle_sets(part.column("t").to_pylist(), size):
                        n.append(len(tokens))
                        s1.append(tokens.sum(dtype=np.uint64).astype(np.int64))
                        s2.append(_mix(tokens).sum(dtype=np.uint64).astype(np.int64))
                        sk.append(sketch(tokens))
                        paths.append([{"key": k, "leaves": v} for k, v in chosen_paths(tokens, seeds, least)] if len(tokens) else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("tk"), pa.array(n, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                     pa.array(sk, pa.binary()), pa.array(paths, kind)], ["id", "tk", "n", "s1", "s2", "sketch", "paths"])

    return texts.mapInArrow(run, schema)


def _buckets(nodes: DataFrame, small: int, least: float) -> DataFrame:
    """(bucket, node, n, dense) of the buckets that can hold a link."""
    rows = nodes.select("node", "n", F.explode("paths").alias("p")).select("node", "n", "p.key", "p.leaves")

    def sizes(r: DataFrame) -> DataFrame:
        got = r.groupBy("key").agg(F.count("*").alias("c"), F.min("n").alias("n0"), F.max("n").alias("n1"))
        return got.where((F.col("c") > 2) | (F.col("c") == 2) & (F.col("n0") + 1e-6 >= least * F.col("n1"))).select("key", "c")

    level = rows.join(sizes(rows.select("key", "n")).hint(SHUFFLED), "key")
    leaf = level.where(F.col("c") > small).select("node", "n", F.explode("leaves").alias("key")).distinct()
    leaf = leaf.join(sizes(leaf).hint(SHUFFLED), "key")
    return (level.where(F.col("c") <= small).select(F.col("key").alias("bucket"), "node", "n", F.lit(False).alias("dense"))
            .unionByName(leaf.select(F.col("key").alias("bucket"), "node", "n", (F.col("c") > small).alias("dense")))).distinct()


def _plausible(rows: DataFrame, least: float, n_chunks: int) -> DataFrame:
    """(bucket, node) of the rows (bucket, node, n, sketch, grp) with a partner that sketches don't rule out."""

    def look(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bucket", kind="stable")
        bucket = frame["bucket"].to_numpy()
        n, grp = frame["n"].to_numpy().astype(np.float64), frame["grp"].to_numpy()
        sk = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, BINS)
        at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        keep = np.zeros(len(bucket), bool)
        for a, b in zip(at, np.append(at[1:], len(bucket))):
            x, m, g = sk[a:b], n[a:b], grp[a:b]
            same = ((x[:, None] == x[None]) & (x[:, None] > 0)).sum(axis=2)
            filled = ((x[:, None] > 0) | (x[None] > 0)).sum(axis=2)
            low, high = np.minimum(m[:, None], m[None]), np.maximum(m[:, None], m[None])
            # 0.3 under the limit is six deviations of 64 bins; small sets fill too few to tell
            ok = (low + 1e-6 >= least * high) & ((same >= (least - 0.3) * filled) | (low < 100)) & ((g[:, None] != g[None]) | (g[:, None] < 0))
            np.fill_diagonal(ok, False)
            keep[a:b] = ok.any(axis=1)
        return frame.loc[keep, ["bucket", "node"]]

    return (rows.withColumn("chunk", F.pmod(F.xxhash64("bucket"), F.lit(n_chunks)))
            .groupBy("chunk").applyInPandas(lambda _, f: look(f), "bucket long, node long"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None, columns: int = 2_048) -> np.ndarray:
    """Numbers of shared tokens of all pairs, by products of 0/1 matrices of a bounded width."""
    sets = left + (right or [])
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    row = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1  # tokens of one set alone don't matter
    some = times[token] > 1
    row, token = row[some], number[token[some]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    k = len(left)
    out = np.zeros((k, len(right) if right is not None else k), np.float32)
    width = int(token[-1]) + 1 if len(token) else 0
    for at in range(0, width, columns):
        a, b = np.searchsorted(token, [at, at + columns])
        m = np.zeros((len(sets), min(columns, width - at)), np.float32)
        m[row[a:b], token[a:b] - at] = 1
        out += m[:k] @ (m[k:] if right is not None else m).T
    return out.astype(np.float64)


def _roots(linked: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least label of each row's component in a symmetric matrix."""
    while True:
        best = np.minimum(label, np.where(linked, label[None], np.iinfo(np.int64).max).min(axis=1))
        if (best == label).all():
            return label
        label = best


def _verify(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """(node, links, root) of the cells of a chunk, by whole sets."""
    out = []
    for (dense, _, i, j), cell in frame.groupby(["dense", "bucket", "i", "j"], sort=False):
        sets = [np.frombuffer(x, np.uint64) for x in cell["tokens"]]
        node, copies = cell["node"].to_numpy(), cell["copies"].to_numpy().astype(np.float64)
        n = np.fromiter(map(len, sets), np.float64, len(sets))
        if dense and i != j:
            side = cell["block"].to_numpy() == i
            a, b = np.flatnonzero(side), np.flatnonzero(~side)
            if not len(a) or not len(b):
                continue
            both = overlaps([sets[x] for x in a], [sets[x] for x in b])
            part = (1 + least) * both >= least * (n[a][:, None] + n[b][None]) - 1e-6
            links = np.zeros(len(sets))
            links[a], links[b] = part @ copies[b], copies[a] @ part
            linked = np.zeros((len(sets), len(sets)), bool)
            linked[np.ix_(a, b)] = part
            linked |= linked.T
        else:
            both = overlaps(sets, None)
            linked = (1 + least) * both >= least * (n[:, None] + n[None]) - 1e-6
            np.fill_diagonal(linked, False)
            if not dense:
                # a pair counts in its first bucket, and not here if a group of near copies has it
                group = cell["grp"].to_numpy()
                linked &= (group[:, None] != group[None]) | (group[:, None] < 0)
                here = cell["bucket"].iloc[0]
                earlier = [[x for x in b if x < here] for b in cell["buckets"]]
                names = {x: k for k, x in enumerate(sorted({x for b in earlier for x in b}))}
                if names:
                    e = np.zeros((len(sets), len(names)), np.float32)
                    for r, b in enumerate(earlier):
                        e[r, [names[x] for x in b]] = 1
                    linked &= (e @ e.T) == 0
            links = linked @ copies
        some = links > 0
        if some.any():
            out.append(pd.DataFrame({"node": node[some], "links": links[some].astype(np.int64), "root": _roots(linked, node.copy())[some]}))
    return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []}).astype(np.int64)


def _linked(texts: DataFrame, nodes: DataFrame, size: int, least: float, small: int, block: int, max_broadcast: int) -> DataFrame:
    """(node, links, root) of all links, found once each; a node may have several rows."""
    spark = texts.sparkSession
    buckets = written(_buckets(nodes, small, least), "buckets")
    # groups of near copies: large buckets joined where they share sets
    dense = buckets.where("dense")
    stars = dense.join(dense.groupBy("bucket").agg(F.min("node").alias("v")), "bucket").select(F.col("node").alias("u"), "v")
    group = components(stars).select("node", F.col("root").alias("grp"))
    group = written(group.join(group.groupBy("grp").agg(F.count("*").alias("members")), "grp"), "near-copies")
    rows = buckets.where("NOT dense").join(group.select("node", "grp"), "node", "left").fillna(-1, ["grp"])
    rows = rows.join(nodes.select("node", "sketch"), "node").select("bucket", "node", "n", "sketch", "grp")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = written(_plausible(rows, least, 8 * parts), "plausible")
    # buckets of the same sets are one
    marks = chosen.groupBy("bucket").agg(F.count("*").alias("c"), F.sum(F.col("node").cast("decimal(38,0)")).alias("s"),
                                         F.bit_xor(F.xxhash64("node")).alias("x"))
    chosen = chosen.join(marks.groupBy("c", "s", "x").agg(F.min("bucket").alias("bucket")).select("bucket"), "bucket")
    lists = chosen.groupBy("node").agg(F.array_sort(F.collect_list("bucket")).alias("buckets"))
    blocks = F.ceil(F.col("members") / block).cast("int")
    asked = lists.join(group, "node", "full").select(
        "node", F.coalesce("buckets", F.array().cast("array<bigint>")).alias("buckets"), F.coalesce("grp", F.lit(-1)).alias("grp"),
        blocks.alias("blocks"), F.pmod(F.xxhash64(F.lit("block"), "node"), blocks).cast("int").alias("block"))
    asked = written(asked.join(nodes.select("node", "id", "tk", "copies"), "node"), "asked")
    if asked.count() <= max_broadcast:  # else both sides are shuffled
        asked = F.broadcast(asked)
    found = texts.join(asked, ["id", "tk"]).dropDuplicates(["node"])
    names = ["node", "copies", "buckets", "grp", "blocks", "block"]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch.slice(at, 2_000)
                with np.errstate(over="ignore"):
                    sets = [x.tobytes() for x in shingle_sets(part.column("t").to_pylist(), size)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(sets, pa.binary())], [*names, "tokens"])

    full = found.select(*names, "t").mapInArrow(
        tokens, "node long, copies long, buckets array<long>, grp long, blocks int, block int, tokens binary")
    own, none = F.col("block"), F.array().cast("array<struct<dense:boolean,bucket:bigint,i:int,j:int>>")
    cells = F.concat(
        F.transform("buckets", lambda b: F.struct(F.lit(False).alias("dense"), b.alias("bucket"), F.lit(0).alias("i"), F.lit(0).alias("j"))),
        F.when(F.col("blocks").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
            F.lit(True).alias("dense"), F.col("grp").alias("bucket"), F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))).otherwise(none))
    cells = full.withColumn("cell", F.explode(cells)).select("cell.*", "node", "copies", "grp", "block", "tokens",
                                                             F.when(~F.col("cell.dense"), F.col("buckets")).otherwise(F.array().cast("array<bigint>")).alias("buckets"))
    chunk = F.when(F.col("dense"), F.xxhash64("bucket", "i", "j")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(16 * parts)))
    return (cells.withColumn("chunk", chunk).groupBy("chunk")
            .applyInPandas(lambda _, f: _verify(f, least), "node long, links long, root long"))


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs until a pair at the limit shares a path of ``depth`` picks, each pick shared about once, with that probability."""
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(lost - 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, least: float = 0.8, recall: float = 0.9995,
         small: int = 64, block: int = 2_048, max_broadcast: int = 100_000) -> DataFrame:
    """(id, tk, class, keeper, n_links) of every row: its class's least id, whether it is the class's first text, and
    the number of other rows that it is linked with.  Null ids have the least long."""
    ship()
    texts = _texts(docs, id_col, text_col)
    all_rows = written(_described(texts, size, least, runs_for(recall)), "texts")
    of = ["s1", "s2", "n"]
    nodes = (all_rows.where("n > 0").groupBy(*of)
             .agg(F.min(F.struct("id", "tk")).alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths"))
             .select(F.monotonically_increasing_id().alias("node"), *of, "rep.*", "copies", "sketch", "paths"))
    nodes = written(nodes, "nodes")
    links = written(_linked(texts, nodes, size, least, small, block, max_broadcast), "links")
    roots = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    per_node = (nodes.select(*of, "node", "id", "tk", "copies").join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
                .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    heads = per_node.groupBy("root").agg(F.min(F.struct("id", "tk")).alias("head"))
    per_node = per_node.join(heads, "root").select(*of, "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return (all_rows.select("id", "tk", *of).join(per_node, of, "left")
            .select("id", "tk", F.coalesce("head.id", "id").alias("class"),
                    F.coalesce((F.col("head.id") == F.col("id")) & (F.col("head.tk") == F.col("tk")), F.lit(True)).alias("keeper"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def classes(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """One row per row of the table: id, ``class_id`` and ``n_links``."""
    def back(c: str):
        return F.when(F.col(c) != FIRST, F.col(c))

    return join(docs, id_col, **kw).select(back("id").alias(id_col), back("class").alias("class_id"), "n_links")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The first row of every class, with its own columns; of wholly repeated rows, one.  Rows without words all stay."""
    kept = join(docs, id_col, text_col, **kw).where("keeper").select("id", "tk").distinct()
    rows = docs.select(F.struct("*").alias("d"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64(text_col).alias("tk"))
    rows = rows.join(kept, ["id", "tk"]).dropDuplicates(["id", "tk"])
    return rows.select(*[F.col("d").getField(c).alias(c) for c in docs.columns])
