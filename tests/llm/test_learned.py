"""Language identification and toxicity: held-out accuracy, and the odd cases."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.llm import lang_id, toxicity
from rowtide.llm.common import table

from ..conftest import SF_SMALL
from .helpers import SCHEMA, awkward, frame, with_clashes


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "/root/testdata/sf0.01", "documents")


def test_language_held_out_accuracy(spark, docs):
    model = lang_id.train(docs, per_lang=100, epochs=8)
    got = lang_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_texts(spark, docs):
    model = lang_id.train(docs, per_lang=30, epochs=4)
    rows = awkward() + [(30, "123 !?", None, None, None), (31, "the " * 400_000, None, None, None)]
    got = lang_id.predict(with_clashes(frame(spark, rows)), model).collect()
    assert len(got) == len(rows)
    und = {(str(r[0]), r[1] is None) for r in rows if not r[1] or not any(c.isalpha() for c in r[1])}
    assert sum(r.lang_pred == "und" for r in got) == len(und) and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in got} <= {"und", *model.langs}


def test_language_without_labels(spark):
    df = frame(spark, [(i, "some text", None, None, None) for i in range(8)], SCHEMA)
    assert {r.lang_pred for r in lang_id.predict(df, lang_id.train(df)).collect()} == {"und"}
    assert lang_id.predict(df.limit(0), lang_id.train(df.limit(0))).count() == 0


def test_held_out_remainder(spark):
    import zlib
    got = spark.range(200).select("id", lang_id.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_prediction_ignores_neighbours(spark, docs):
    model = lang_id.train(docs, per_lang=30, epochs=4)
    few = docs.limit(20)
    alone = {r.doc_id: r.score for r in lang_id.predict(few.repartition(20), model).collect()}
    assert alone == {r.doc_id: r.score for r in lang_id.predict(few.coalesce(1), model).collect()}


def test_folding():
    assert toxicity.fold("1D10T, l0ser! $cum іdіоt ｔｒａｓｈ 2024 a.b") == " idiot loser scum idiot trash 2024 a b "
    assert toxicity.fold(None) == toxicity.fold("") == "  "


def planted(rng, n):
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zorgo", "blirk", "b1irk", "vexun", "vexalo", "vexi"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_words_and_beginnings(spark):
    rows, labels = planted(random.Random(2), 800)
    df, marks = frame(spark, rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, marks)
    got = toxicity.score(df, model).join(marks, "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.predicted == r.toxic for r in got) / len(got) >= 0.97
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_exceptions_and_length(spark):
    model = toxicity.Model({" trash ": 5.0, " idio": 5.0}, [-4.0, 0.5, 1.5, 0.0])
    score = lambda t: model.score(t)[0]
    assert model.score("put it in the trash can")[1] == 0 and model.score("this is trash")[1] == 1
    assert score("idiot") > score("idiot " + "word " * 100) > score("word " * 101)


def test_toxicity_odd_rows(spark):
    df = with_clashes(frame(spark, awkward()))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    marks = spark.createDataFrame([(1, 1), (1, None), (5, 0), (5, 1), (None, 1), (6, 0)], "doc_id long, toxic int")
    for labels in (none, marks):
        got = toxicity.score(df, toxicity.train(df, labels)).collect()
        assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(df.limit(0), toxicity.train(df.limit(0), marks)).count() == 0
    small = table(spark, SF_SMALL, "documents")
    assert toxicity.score(small, toxicity.train(small, table(spark, SF_SMALL, "labels"))).where(F.col("score").isNull()).count() == 0
