import random

import numpy as np

from rowtide.llm import suffix_dedup as S
from rowtide.llm.suffix_sort import joined, two_stage

from .helpers import awkward, frame, kept_bytes, with_clashes

SCHEMA = "doc_id long, text string"


def result(df, **kw):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.dedup(df, **kw).collect()}


def corpus(rng, n):
    base = ["".join(rng.choice("abcdefgh é") for _ in range(400)) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            a = rng.randrange(0, 300)
            parts += [rng.choice(base)[a:a + rng.randrange(50, 200)], "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(0, 120)))]
        docs.append((i, "".join(parts)))
    return docs + [(9000, "a" * 700), (9001, "ab" * 400), (9002, None), (9003, ""), (9004, base[0]), (9005, base[0]), (9006, "a" * 700), (9007, "x" * 99)]


def test_two_stage_sorting():
    rng = random.Random(4)
    for _ in range(300):
        letters = rng.choice([b"ab", b"a", bytes(range(256)), b"\x00\xff"])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randrange(0, 30))) for _ in range(rng.randrange(1, 5))]
        depth = rng.choice([5, 14, 100])
        x, _ = joined(strings + strings[:1])
        sa, lcp = two_stage(x, depth)
        cut = [x[i:i + depth].tolist() for i in sa]
        assert cut == sorted(cut) and sorted(sa.tolist()) == list(range(len(x)))
        for k in range(1, len(cut)):
            n = next((i for i, (p, q) in enumerate(zip(cut[k - 1], cut[k])) if p != q), min(len(cut[k - 1]), len(cut[k])))
            assert lcp[k] == n


def test_against_marking_every_window(spark):
    docs = corpus(random.Random(3), 150)
    df = frame(spark, docs, SCHEMA, 5)
    want = kept_bytes(docs)
    assert result(df) == want
    assert result(df, most=2, max_broadcast=0) == want  # too common grams, and shuffled instead of broadcast


def test_documents_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BITS", 9)
    docs = corpus(random.Random(8), 40) + [(5000, "".join(t for _, t in corpus(random.Random(8), 40)[:12]))]
    raws = [(t or "").encode() for _, t in docs]
    with np.errstate(over="ignore"):
        records = S._records([i for i, _ in docs], [0] * len(docs), raws, 100, 24)
    starts = {(int(r["id"]), w) for r in records for w in range(int(r["lo"]), int(r["lo"]) + int(r["n"]) + 1)}
    assert starts == {(i, w) for (i, _), raw in zip(docs, raws) for w in range(len(raw) - 99)}


def test_repeated_rows_nulls_clashes_and_empty_table(spark):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdef") for _ in range(300))
    df = frame(spark, [(1, t), (1, t), (2, t), (None, t[:150]), (None, None)], SCHEMA)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in S.dedup(with_clashes(df)).collect())
    assert got == [("1", 300, 150, 1), ("1", 300, 150, 1), ("2", 300, 300, 1), ("None", 0, 0, 0), ("None", 150, 0, 0)]
    one = frame(spark, [(1, "c" * 300), (1, "c" * 300), (2, "c" * 300), (None, "c" * 150)], SCHEMA)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in S.dedup(one).collect())
    assert got == [("1", 300, 300, 1), ("1", 300, 300, 1), ("2", 300, 300, 1), ("None", 150, 149, 1)]  # one byte of the first copy stays
    assert S.dedup(df.limit(0)).count() == 0
    assert S.dedup(with_clashes(frame(spark, awkward()))).count() == len(awkward())
