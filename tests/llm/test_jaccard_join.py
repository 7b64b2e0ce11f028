import random

from rowtide.llm import jaccard_join as J

from .helpers import awkward, frame, near_classes, with_clashes, words

SCHEMA = "doc_id long, text string"


def corpus(rng):
    texts = []
    for _ in range(25):
        base = words(rng, rng.choice([6, 30, 120]), 3000).split()
        for _ in range(rng.choice([1, 2, 3, 8])):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(3000)}"
            texts.append(" ".join(w))
    base = words(rng, 150, 3000).split()
    for _ in range(150):  # a large group of near copies
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(3000)}"
        texts.append(" ".join(w))
    passage = words(rng, 60, 3000)
    texts += [f"{words(rng, 70, 3000)} {passage}" for _ in range(100)]  # a passage that many texts share
    texts += ["", "  ", None, "a b", "a b", "a  b", "a b c"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_against_comparing_all(spark):
    docs = corpus(random.Random(3))
    df = frame(spark, docs, SCHEMA, 5)
    want = sorted(near_classes(docs))
    assert sorted(tuple(r) for r in J.classes(df).collect()) == want
    # small buckets and blocks, and shuffled instead of broadcast
    assert sorted(tuple(r) for r in J.classes(df, small=8, block=40, max_broadcast=0).collect()) == want


def test_similarity_at_the_limit_counts(spark):
    base = [f"w{i}" for i in range(40)]  # 36 shingles; 4 more at the end: 36 of 40, and so on
    docs = [(1, " ".join(base)), (2, " ".join(base + ["x"] * 9)), (3, " ".join(base + [f"y{i}" for i in range(9)])), (4, " ".join(base + [f"z{i}" for i in range(10)]))]
    assert sorted(tuple(r) for r in J.classes(frame(spark, docs, SCHEMA)).collect()) == sorted(near_classes(docs))


def test_first_of_each_class_stays(spark):
    docs = corpus(random.Random(6))
    kept = {r.doc_id for r in J.keep_first(frame(spark, docs, SCHEMA)).collect()}
    assert kept == {c for i, c, n in near_classes(docs)}


def test_repeated_rows_nulls_clashes_and_empty_table(spark):
    df = with_clashes(frame(spark, awkward()))
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in J.classes(df).collect())
    assert got == sorted((str(i), str(c), n) for i, c, n in near_classes([r[:2] for r in awkward()]))
    out = J.keep_first(df)
    assert out.columns == df.columns
    assert sum(r.doc_id == 5 for r in out.collect()) == 2 and sum(r.doc_id == 6 for r in out.collect()) == 0
    assert J.classes(df.limit(0)).count() == 0 and J.keep_first(df.limit(0)).count() == 0


def test_runs_follow_the_recall():
    assert J.runs_for(0.9) < J.runs_for(0.999) < J.runs_for(0.99999)


def test_picks_of_unseen_number_are_shuffled(spark):
    nodes = frame(spark, [(i, 9, [(i // 2, [i]), (7, [i % 3, i])]) for i in range(40)], "node long, n int, paths array<struct<key:long,leaves:array<long>>>")
    buckets = J._buckets(nodes, 8, 0.8)
    assert buckets.count() > 0
    assert "Broadcast" not in buckets._jdf.queryExecution().executedPlan().toString()
