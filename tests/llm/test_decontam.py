import random

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from rowtide.llm import decontam as D
from rowtide.llm import queries

from .helpers import awkward, frame, with_clashes

ITEM = "If Tom has 12 apples and gives 3 apples to Anna, how many apples does Tom have left at noon?"
DOC = "doc_id long, text string"


def found(spark, docs, items=(ITEM,), **kw):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in D.leaks(frame(spark, docs, DOC), benchmark, **kw).collect())


def test_template(spark):
    t = "Tom bought 12 kg of apples in Paris. Then Tom paid 3,50 dollars, said Anna's brother (really)."
    r = spark.createDataFrame([(t,)], "t string").select(D.template(F.col("t")).alias("w"), D.raw_words(F.col("t")).alias("v")).first()
    assert " ".join(r.w) == ("tom bought <number> <unit> of apples in <name> then <name> paid <number> <unit> said <name> brother really")
    assert " ".join(r.v) == "tom bought 12 kg of apples in paris then tom paid 3,50 dollars said anna brother really"


def test_reparameterised_question_and_inconsistent_slots(spark):
    docs = [(1, "Quiz. " + ITEM), (2, "so If Bob has 99 apples and gives 5 apples to Eve, how many apples does Bob have left at noon? ok"),
            (3, "so If Bob has 99 apples and gives 5 apples to Eve, how many apples does Eve have left at noon? ok"),
            (4, "If Bob has 9 apples and gives 9 apples to Eve, how many apples does Bob have left at noon?"),
            (5, "apples and more apples, how many apples"), (6, None), (7, "")]
    assert found(spark, docs) == [(1, 0), (2, 0)]
    assert found(spark, docs, max_broadcast=-1) == [(1, 0), (2, 0)]  # shuffled instead of broadcast


def test_share_and_short_items(spark):
    item = " ".join(f"word{i}" for i in range(40))
    part = " ".join(f"word{i}" for i in range(20))
    docs = [(1, f"a b {item} c"), (2, f"a {part} b"), (3, f"what colour is the sky today, he said"), (4, "what colour is the sea today")]
    assert found(spark, docs, (item, "What colour is the sky?", None, "", "too few words")) == [(1, 0), (3, 1)]
    assert found(spark, docs, (item,), min_share=0.3) == [(1, 0), (2, 0)]


def test_stage_repeats_clashes_and_empty_tables(spark):
    rows = awkward() + [(20, "X. " + ITEM, None, None, None)] * 2
    df = with_clashes(frame(spark, rows))
    benchmark = with_clashes(spark.createDataFrame([(1, ITEM), (2, ITEM), (None, "five words are enough here")], "item_id long, text string"))
    out = D.drop_leaks(df, benchmark)
    assert out.columns == df.columns and out.count() == len(awkward())
    assert D.leaks(df, benchmark).count() == 2  # the repeated document once for each of the equal items
    assert D.drop_leaks(df, benchmark.limit(0)).count() == len(rows) and D.leaks(df.limit(0), benchmark).count() == 0


def test_long_run_of_a_long_item(spark):
    item = " ".join(f"word{i}" for i in range(40))
    cut = lambda a, b: " ".join(f"word{i}" for i in range(a, b))
    docs = [(1, f"a {cut(0, 20)} b"), (2, f"a {cut(27, 40)} b"), (3, f"a {cut(0, 12)} b {cut(20, 32)}"), (4, item)]
    assert found(spark, docs, (item,), min_run=13) == [(1, 0), (2, 0), (4, 0)]


def test_pipeline_stage_finds_what_line_dedup_left_of_an_item(spark, tmp_path):
    item = " ".join(f"word{i}" for i in range(40))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, [(1, "so " + " ".join(item.split()[:20])), (2, "nothing of it")], DOC)
    assert [r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()] == [2]


def test_one_changed_slot_costs_its_windows_only(spark):
    item = "When Tom came home " + " ".join(f"word{i}" for i in range(30)) + " because Tom was late"
    docs = [(1, item.replace("because Tom", "because Tim")), (2, item.replace("Tom", "Bob")), (3, "X. " + item)]
    for limit in (500_000, -1):
        assert found(spark, docs, (item,), max_broadcast=limit) == [(1, 0), (2, 0), (3, 0)]


def test_new_values_may_coincide(spark):
    nine = "If Bob has 9 apples and gives 9 apples to Eve, how many apples does Bob have left at noon?"
    item = "There are 3 pears and 3 plums on the table, so what is the sum of them all?"
    docs = [(1, nine), (2, item.replace("3 pears", "4 pears")), (3, ITEM.replace("does Tom", "does Anna").replace("Tom", "Bob"))]
    assert found(spark, docs, (ITEM, item), meet=True) == [(1, 0), (2, 1)]


def test_items_without_countable_windows_are_found_verbatim(spark):
    items = ("What is 12 * 7 + 3?", "THE OLD MAN AND THE SEA STANDS ALONE HERE", "too few words", "* + ?", "", " ", None)
    docs = [(1, "Quiz: what is 12 * 7 + 3? Yes."), (2, "what is 12 * 7 - 3?"), (3, "the old man and the sea stands alone here."),
            (4, "the old man and the sea stands alone there"), (5, "(too few words)"), (6, "so * + ? it is"), (7, ""), (8, None)]
    for limit in (500_000, -1):
        assert found(spark, docs, items, max_broadcast=limit) == [(1, 0), (3, 1), (5, 2), (6, 3)]


def test_a_number_maps_to_one_number(spark):
    item = "Tom picked 12 apples from the old tree and then he sold all 12 apples to the shop for 3 coins"
    docs = [(1, item.replace("12", "9")), (2, item.replace("12 apples from", "9 apples from").replace("12 apples to", "7 apples to")),
            (3, item.replace("12", "3")), (4, item)]
    assert found(spark, docs, (item,), meet=True, min_share=0.8) == [(1, 0), (3, 0), (4, 0)]


def test_anchored_windows_are_the_windows_with_an_anchor(spark, monkeypatch):
    rng = random.Random(3)
    items = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 30))) for _ in range(12)]
    docs = [(i, " ".join([f"w{rng.randrange(60)}"] * rng.randrange(3) + items[i % 12].split()[rng.randrange(3):] + ["w1", "w2"])) for i in range(60)]
    docs += [(60, "w1"), (61, "w1 w2"), (62, "")]
    anchored = found(spark, docs, items, min_run=6, meet=True)
    monkeypatch.setattr(D, "MAX_ANCHORS", 0)  # every window is hashed
    assert anchored == found(spark, docs, items, min_run=6, meet=True) and len(anchored) > 20
    monkeypatch.undo()


def test_template_equals_two_passes(spark):
    """The patterns that look around find what the SQL's two passes find."""
    rng = random.Random(9)
    bits = ["Bob", "Ann's", "x", "3", "3,50", "12th", "kg", "(", ")", "--", ".", ",", "'", "\u00c9va", "a-B", "7.", "\t", "\n", "  ", "St. ", "I", "4-5-6", "%", "!"]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", " ", "", "\t"]) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]

    def twice(text):
        t = text
        for pattern, to in ((D.NAMED, f"$1{D.NAME}"), (D.NUMBERED, f"$1{D.NUMBER}$2"), (None, None), (D.MEASURED, f"{D.NUMBER}$1{D.UNIT}$2"), (D.EDGES, "$1$2")):
            for _ in range(1 if pattern in (None, D.MEASURED) else 2):
                t = F.regexp_replace(t, pattern, to) if pattern else F.lower(t)
        return F.filter(F.split(t, rf"[{D.WHITE}]+"), lambda w: w != "")

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(D.template(F.col("t")) != twice(F.col("t"))).limit(5).collect() == []


def test_the_sql_states_the_same_rule(spark, tmp_path):
    """On texts where a run, a torn slot or a bare item decides."""
    words = [f"word{i}" for i in range(40)]
    long, twelve = " ".join(words), "Tom picked 12 apples from the old tree and then he sold all 12 apples to the shop for 3 coins"
    items = [ITEM, long, twelve, "What is 12 * 7 + 3?", "too few words"]
    docs = ["Quiz. " + ITEM, "so If Bob has 99 apples and gives 5 apples to Eve, how many apples does Bob have left at noon? ok", "a " + " ".join(words[:20]),
            " ".join(words[:12]) + " x " + " ".join(words[20:32]), "x " + " ".join(words[27:]), twelve.replace("12", "9"),
            twelve.replace("12 apples from", "9 apples from").replace("12 apples to", "7 apples to"), "Quiz: what is 12 * 7 + 3? Yes.", "what is 12 * 7 - 3?",
            "(too few words)", "nothing of it", "", None]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(list(enumerate(docs)), DOC).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    for t in ("benchmark", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = sorted((d, i, n, round(x, 9)) for d, i, n, x in con.execute("select doc_id, item_id, n_matched, share from (" + queries.LEAK_SQL + ")").fetchall())
    got = sorted((r.doc_id, r.item_id, r.n_matched, round(r.share, 9)) for r in queries.QUERIES["op7_benchmark_decontamination"](spark, str(tmp_path)).collect())
    assert got == want and {(0, 0), (1, 0), (2, 1), (4, 1), (5, 2), (7, 3), (9, 4)} <= {x[:2] for x in got} and not {3, 8, 10, 11, 12} & {x[0] for x in got}
