import random

from pyspark.sql import functions as F

from rowtide.llm import line_dedup as L

from .helpers import awkward, frame, left_lines, with_clashes

SCHEMA = "doc_id long, text string"


def edited(rng, line):
    k = rng.randrange(len(line))
    return rng.choice([line[:k] + "é" + line[k + 1:], line[:k] + line[k + 1:], line[:k] + "q" + line[k:]])


def corpus(rng, n):
    lines = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([5, 19, 20, 21, 63, 64, 65, 128, 200]))) for _ in range(40)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            x = rng.choice(lines)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                x = edited(rng, x)
            parts.append(rng.choice(["", " ", "\t"]) + x)
        docs.append((i, "\n".join(parts)))
    return docs


def test_against_comparing_all_lines(spark):
    for seed, limit in ((1, 200_000), (2, 0)):  # the second one shuffles what the first one broadcasts
        rng = random.Random(seed)
        docs = corpus(rng, 120) + [(500, None), (501, ""), (502, "\n\n"), (503, "a" * 100), (504, "a" * 101), (505, "a" * 102)]
        got = {r.doc_id: r.text for r in L.dedup_lines(frame(spark, docs, SCHEMA), max_broadcast=limit).collect()}
        assert got == left_lines(docs)


def test_counts_and_earliest(spark):
    a = "The quick brown fox jumps over it."
    docs = [(2, a + "\nother words stand here"), (1, a.replace("quick", "quack")), (3, a), (4, "short\nshort\nshort."), (None, "nobody's line comes first\n" + a)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in L.dedup_lines(frame(spark, docs, SCHEMA)).collect()}
    assert got[None] == ("nobody's line comes first\n" + a, 2, 0)  # null ids come first
    assert got[1] == ("", 1, 1) and got[2] == ("other words stand here", 2, 1) and got[3] == ("", 1, 1)
    assert got[4] == ("short\nshort.", 3, 1)  # short lines only when equal


def test_repeated_rows_and_long_lines(spark):
    line = "x" * 30_000 + "y" * 30_000
    docs = [(1, line), (1, line), (2, line[:31_000] + "z" + line[31_001:]), (3, line[1:]), (4, line[2:])]
    got = sorted((r.doc_id, len(r.text)) for r in L.dedup_lines(frame(spark, docs, SCHEMA)).collect())
    assert got == [(1, 60_000), (1, 60_000), (2, 0), (3, 0), (4, 0)]  # 4 is one edit from 3, which is judged on the input


def test_stage_keeps_columns(spark):
    df = with_clashes(frame(spark, awkward()))
    out = L.drop_lines(df)
    assert out.columns == df.columns
    ids = sorted((str(r.doc_id), str(r.text)) for r in out.where(F.col("doc_id").isNull() | (F.col("doc_id") <= 3)).collect())
    assert [x[0] for x in ids] == ["1", "2", "3", "None", "None"]
    assert L.drop_lines(df.limit(0)).count() == 0 and L.dedup_lines(df).count() == len(awkward())


def test_sides_of_unseen_size_are_shuffled(spark):
    rng = random.Random(3)
    docs = frame(spark, corpus(rng, 60), SCHEMA)
    wanted = L.candidates(L.first_lines(docs, "doc_id", "text", 20))
    near = L.near_lines(docs, wanted, "doc_id", "text", 0)
    assert near.count() > 0
    for df in (wanted, near):  # Spark takes the exploded keys for small here: they would go to every executor, however many
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
