"""The registered queries against their SQL, and the pipeline against brute-force stages."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from rowtide.llm import bpe, queries, repetition
from rowtide.llm.common import table
from rowtide.plans.verify import compare, duck_connection

from ..conftest import SF_SMALL
from .helpers import awkward, frame, kept_bytes, left_lines, near_classes, with_clashes


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    report = compare(spark, duck_connection(SF_SMALL), name, SF_SMALL, queries.QUERIES, queries.SQL)
    assert report["ok"], report


def test_suffix_dedup_query(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op10_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == {i: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for i, v in kept_bytes(docs).items()}


def test_jaccard_query(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.QUERIES["op5_ngram_jaccard_join"](spark, SF_SMALL).collect())) == sorted(near_classes(docs))


def test_pipeline_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    good = {r.doc_id for r in repetition.quality(table(spark, SF_SMALL, "documents")).where("kept").collect()}
    docs = [(i, t) for i, t in docs if i in good]
    left = left_lines(docs)
    docs = [(i, left[i]) for i, t in docs if left[i].strip() or not t.strip()]
    first = {c for _, c, _ in near_classes(docs)}
    docs = [(i, t) for i, t in docs if i in first]
    items = [tuple(r)[1].lower().split() for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]

    def leaked(text):
        w = text.lower().split()
        seen = {tuple(w[a:a + 8]) for a in range(len(w) - 7)}
        return any(sum(tuple(x[a:a + 8]) in seen for a in range(len(x) - 7)) >= 0.6 * (len(x) - 7) for x in items if len(x) >= 8)

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.vocabulary(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {i: (len(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs if not leaked(t)}
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want and len(got) > 100


def test_stages_take_awkward_documents(spark):
    for rows in (awkward(), []):
        docs = with_clashes(frame(spark, rows))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert sorted(out.columns) == sorted(docs.columns), name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
