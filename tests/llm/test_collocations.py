"""Collocations against counting every phrase, and the two passes one by one."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import collocations as C

from .helpers import awkward, frame, with_clashes

SCHEMA = "doc_id long, text string, lang string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def phrases(docs, longest=3):
    """lang -> (words, Counter of word tuples)."""
    out = {}
    for _, text, lang, *_ in docs:
        n, f = out.setdefault(lang or "und", [0, Counter()])
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            w = re.findall("[^ \t]+", piece)
            out[lang or "und"][0] += len(w)
            f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return out


def best(docs, least=10, longest=3, percent=50, top=2000):
    out = []
    for lang, (n, f) in phrases(docs, longest).items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i:i + k]] = max(most[p[i:i + k]], a)
        rows = []
        for p, a in frequent.items():
            if p in most and 100 * most[p] >= percent * a:
                continue
            score, _, l, r = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, k + 1, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def prose(rng, docs=60, kinds=40, langs=("en", "fr", None)):
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", "; ", "? ", "\r", "\x0b"]
    vocabulary = [rng.choice(["W", "w", "É", "é", "x\x00", "ß"]) + str(k % 12) for k in range(kinds)]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randrange(200)))
        rows.append((i, text, rng.choice(langs)))
    return rows


def collected(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equals_counting_every_phrase(spark, seed):
    rng = random.Random(seed)
    docs = prose(rng) + [(99, "new york city. " * 40 + "NEW YORK, york city", "en")]
    assert collected(C.collocations(frame(spark, docs, SCHEMA))) == best(docs)
    docs = prose(rng, 20)
    got = C.collocations(frame(spark, docs, SCHEMA), min_count=3, longest=4, percent=80, top=25, shards=7)
    assert collected(got) == best(docs, 3, 4, 80, 25)


def test_blocks_and_parts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_WORDS", 50)  # on the driver; the blocks of one are counted here
    rng = random.Random(4)
    docs = prose(rng, 8, 10)
    got = {}
    block = C.Block(3)

    def count():
        words = list(block.words)
        for group, k, found, n in block.counts():
            for ids, m in zip(zip(*[x.tolist() for x in block.numbers(found, k)]), n.tolist()):
                got.setdefault(group, Counter())[tuple(words[i].decode() for i in ids)] += m
        block.clear()

    for _, text, lang in docs:
        for _ in block.add(lang or "und", C.words(text.encode())):
            assert block.size <= 50 + 52
            count()
    count()
    assert got == {lang: f for lang, (_, f) in phrases(docs).items() if f}


def test_first_pass_misses_no_frequent_phrase(spark):
    rng = random.Random(6)
    docs = prose(rng, 80, 60) + [(200, "same text here " * 300, "en")] * 3
    rows = frame(spark, docs, SCHEMA).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.pmod(F.xxhash64("text"), F.lit(4)).cast("int").alias("shard"),
                                             F.col("text").cast("binary").alias("text"))
    sizes = C.shard_sizes(rows, 4)
    supports, bits = C.supports_of(sizes, 10), C.buckets_for(sum(sizes))
    assert max(supports) > 1 and sum(supports) >= 10
    table = C.bit_table(C.candidates(rows, 3, supports, bits), bits)
    assert 0 < np.unpackbits(table).sum() < 1500
    frequent = {(lang, " ".join(p)): a for lang, (_, f) in phrases(docs).items() for p, a in f.items() if a >= 10}
    got = {(r.lang, r.phrase): r.f for r in C.count_exactly(rows, 3, table, bits, 10).where("k > 0").collect()}
    assert got == frequent
    # more buckets, and a table that lets everything through, change nothing
    for more, t in ((18, C.bit_table(C.candidates(rows, 3, supports, 18), 18)), (bits, np.full_like(table, 255))):
        assert {(r.lang, r.phrase): r.f for r in C.count_exactly(rows, 3, t, more, 10).where("k > 0").collect()} == frequent


def test_scores_beyond_64_bits_and_hot_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT", 2)
    rng = random.Random(7)
    f = {(f"w{i}",): rng.randrange(10 ** 11, 10 ** 12) for i in range(6)}
    for k in (2, 3):
        f |= {p: rng.randrange(10 ** 9, 10 ** 11) for p in {tuple(f"w{rng.randrange(6)}" for _ in range(k)) for _ in range(400)}}
    f |= {(f"w{i}", f"w{j}"): 10 ** 11 for i in range(6) for j in range(6)}
    frequent = spark.createDataFrame([("en", " ".join(p), len(p), a) for p, a in f.items()], "lang string, phrase string, k int, f long")
    got = {r.phrase: (r.l, r.r, r.score) for r in C.scored(frequent).collect()}
    want = {}
    for p, a in f.items():
        if len(p) > 1:
            score, _, l, r = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            want[" ".join(p)] = (l, r, score)
    assert got == want


def test_awkward_rows(spark):
    rows = awkward()
    assert collected(C.collocations(with_clashes(frame(spark, rows)), min_count=2)) == best([(i, t, lang) for i, t, lang, *_ in rows], 2)
    assert C.collocations(frame(spark, [])).collect() == []
    assert C.collocations(frame(spark, [(1, None, None), (2, "", "en"), (3, " .\n", "en")], SCHEMA)).collect() == []
