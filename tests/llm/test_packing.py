"""Packing: every id in one piece, gapless sequences, no padding; the subset-sum table against all multisets."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from rowtide.llm import packing, queries
from rowtide.llm.common import table

from ..conftest import SF_SMALL
from .helpers import awkward, frame, with_clashes, words

PATH = P.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, docs, window=2048):
    """Pieces of whole documents with distinct ids; returns the number of pieces that no full window asked for."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == {i for i, _ in docs}
    cuts = 0
    for i, t in docs:
        want = ids_of(t)
        ps = sorted(by_doc[i], key=lambda p: p.start)
        assert [p.start for p in ps] == list(itertools.accumulate([0] + [p.length for p in ps[:-1]]))
        assert [x for p in ps for x in np.frombuffer(p.ids, "<u4").tolist()] == want
        assert all(p.doc_tokens == len(want) and p.length * 4 == len(p.ids) > 0 for p in ps)
        cuts += len(ps) - -(-len(want) // window)
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == list(itertools.accumulate([0] + [p.length for p in ps[:-1]]))
        total = sum(p.length for p in ps)
        assert 0 < total <= window and total & total - 1 == 0
    return cuts


@pytest.mark.parametrize("seed", range(30))
def test_fullest_is_the_best_multiset(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
    room = rng.randint(0, 60)
    chosen = packing.fullest(counts, sorted(counts), room)
    assert all(0 < n <= counts[k] for k, n in chosen.items())
    best = max(t for pick in itertools.product(*[range(n + 1) for n in counts.values()])
               if (t := sum(k * n for k, n in zip(counts, pick))) <= room)
    assert sum(k * n for k, n in chosen.items()) == best


def test_query_and_whole_documents(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    pieces = packing.pack(table(spark, SF_SMALL, "documents"), PATH, P.PATTERN).collect()
    assert check(pieces, docs) < 30
    got = queries.QUERIES["op11_packing"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {t for c, t in got.dtypes} == {"bigint"}
    crc = {(p.doc_id, p.start): zlib.crc32(p.ids) for p in pieces}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in got.collect()} == crc


def test_many_rests_over_few_tasks(spark):
    rng = random.Random(4)
    docs = [(i, words(rng, rng.randrange(1, 90))) for i in range(3000)]
    pieces = packing.pack(frame(spark, docs, "doc_id long, text string", 2), PATH, P.PATTERN, window=256, pool_size=200).collect()
    assert check(pieces, docs, 256) <= 0.02 * len(docs)


def test_equal_lengths_are_cut_to_fill(spark):
    docs = [(i, "word " * 149) for i in range(400)]
    pieces = packing.pack(frame(spark, docs, "doc_id long, text string", 1), PATH, P.PATTERN, window=256, pool_size=50).collect()
    check(pieces, docs, 256)


def test_special_strings_and_long_words(spark):
    docs = [(1, "a<|endoftext|>b"), (2, "x" * 20_000), (3, "é\U0001f600  \n\n  a"), (4, "<|endoftext|>"), (5, "\x00\x01 ok")]
    check(packing.pack(frame(spark, docs, "doc_id long, text string"), PATH, P.PATTERN).collect(), docs)


def test_awkward_rows(spark):
    rows = awkward()
    pieces = packing.pack(with_clashes(frame(spark, rows)), PATH, P.PATTERN).collect()
    want = Counter()
    for i, t, *_ in rows:
        want[i] += len(ids_of(t))
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want
    starts = Counter(p.doc_id for p in pieces if p.start == 0)
    assert starts == Counter(i for i, *_ in rows)
    assert packing.pack(frame(spark, []), PATH, P.PATTERN).collect() == []
    with pytest.raises(ValueError):
        packing.pack(frame(spark, rows), PATH, P.PATTERN, window=1000)


def test_sequences_join_the_pieces(spark):
    docs = [(1, "one two three"), (2, "four five")]
    pieces = packing.pack(frame(spark, docs, "doc_id long, text string", 1), PATH, P.PATTERN)
    rows = packing.sequences(pieces).collect()
    assert sum(r.n_ids for r in rows) == sum(len(ids_of(t)) for _, t in docs)
    padded = packing.sequences(pieces.withColumns({"length": pieces["length"] + 0, "sequence_id": pieces["sequence_id"] * 0}).where("offset = 0 and length = 3")).collect()
    assert all(r.n_ids == 3 and len(r.ids) == 4 * 2048 for r in padded)
