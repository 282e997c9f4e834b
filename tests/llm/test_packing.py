import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlens.llm import packing as p
from .conftest import make_docs


def check(rows, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= p.SEQUENCE
    return sum(r.length for r in rows), len(sequences)


def test_round_trip_and_padding(spark, few):
    rows = p.op6_packing(spark, "/root/testdata/sf0.001").collect()
    tokens, sequences = check(rows, dict(few))
    assert sequences * p.SEQUENCE < 1.03 * tokens + p.SEQUENCE


def test_odd_texts(spark):
    texts = [None, "", "<|endoftext|> inside", "x" * 5000, "é ü 漢字 \u0000", " ".join(f"w{k}" for k in range(20_000)), "same", "same"]
    docs = make_docs(spark, texts).withColumn("length", F.lit("clash")).withColumn("piece", F.lit(1))
    check(p.placements(docs).collect(), dict(enumerate(texts)))
    assert p.placements(docs.limit(0)).count() == 0


def test_short_documents_fill_their_sequences(spark):
    docs = make_docs(spark, [None if k % 2 else "" for k in range(5000)])         # one id each
    _, sequences = check(p.placements(docs).collect(), dict(enumerate([""] * 5000)))
    assert sequences == 3
    texts = ["a b"[:1 + k % 3] for k in range(3000)] + ["many words in a row " * 90] * 5
    tokens, sequences = check(p.placements(make_docs(spark, texts)).collect(), dict(enumerate(texts)))
    assert sequences <= tokens / p.SEQUENCE * 1.02 + 1


def test_sequences_hold_the_ids(spark):
    docs = make_docs(spark, [f"some words {k} " * (k + 1) for k in range(40)])
    pieces = p.tokenized(docs)
    out = p.sequences(pieces, p.pack(pieces)).collect()
    assert sum(len(r.ids) // 4 for r in out) == sum(r.length for r in pieces.select("length").collect())
    assert all((np.frombuffer(r.ids, "<u4") == 1).sum() == len(r.documents) for r in out)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    for n in (1, 7, 300, 100_000):
        widths = np.clip(rng.lognormal(4, 0.9, n), 1, 256).astype(int)
        histogram = {int(w): int(c) for w, c in zip(*np.unique(widths, return_counts=True))}
        patterns = p.plan(histogram, 256)
        held = {}
        for pattern, times in patterns:
            assert sum(w * c for w, c in pattern.items()) <= 256
            for w, c in pattern.items():
                held[w] = held.get(w, 0) + c * times
        assert all(held[w] >= c for w, c in histogram.items())
        assert sum(t for _, t in patterns) <= 1.01 * widths.sum() / 256 + 2


def test_knapsack_against_brute_force():
    from itertools import product
    rng = np.random.default_rng(5)
    for _ in range(20):
        widths = np.unique(rng.integers(2, 9, 3))
        prices = rng.random(len(widths))
        best = max(float(np.dot(c, prices)) for c in product(range(8), repeat=len(widths)) if np.dot(c, widths) <= 14)
        value, pattern = p.knapsack(prices, widths, 14)
        assert abs(value - best) < 1e-9 and pattern @ widths <= 14 and abs(pattern @ prices - value) < 1e-9
