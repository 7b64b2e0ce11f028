import hashlib

import public_tokenizers as P
import tiktoken

from rowtide.llm import bpe

from .helpers import awkward, frame, with_clashes

RANKS = P.path("byte_bpe_50k.tiktoken")


def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.vocabulary(RANKS), special_tokens={})


def digest(enc, text):
    ids = enc.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


TEXTS = [None, "", " ", "  \n\n  a", "don't  you'll\t\t7,000 €5 <|endoftext|>", "naïve ∑ 漢字かな\u3000x 👩‍👩‍👧 \u00a0y", "a" * 5000,
         " " * 3000 + "b", "word " * 900, "x\r\n" * 700, "'s't're" * 50, "\x00\ufeffé" * 40]


def test_digests_equal_the_library(spark):
    enc = reference()
    df = frame(spark, list(enumerate(TEXTS)), "doc_id long, text string")
    for sizes in ({}, {"chunk": 100, "overlap": 20}, {"chunk": 17, "overlap": 4}):  # the last ones cut and stitch
        got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, RANKS, P.PATTERN, **sizes).collect()}
        assert got == {i: digest(enc, t) for i, t in enumerate(TEXTS)}


def test_round_trip_of_ids(spark):
    df = frame(spark, list(enumerate(TEXTS)), "doc_id long, text string")
    ids = bpe.encode(df, RANKS, P.PATTERN)
    assert ids.columns == ["doc_id", "ids"]
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(ids, RANKS).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert [bytes(r.bytes) for r in bpe.decode(spark.sql("SELECT CAST(NULL AS array<int>) AS ids"), RANKS).collect()] == [b""]


def test_repeated_rows_clashes_and_empty_table(spark):
    df = with_clashes(frame(spark, awkward()))
    for sizes in ({}, {"chunk": 1_000, "overlap": 50}):
        got = bpe.digests(df, RANKS, P.PATTERN, **sizes).collect()
        want = [(r[0], *digest(reference(), r[1])) for r in awkward()]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.digests(df.limit(0), RANKS, P.PATTERN).count() == 0
