import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from spendlens.llm import common, jaccard_join as j
from spendlens.llm.common import WordHashes
from spendlens.llm.components import components
from .conftest import make_docs


def sets(rows, n=4):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, percent=85):
    s = sets(rows)
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(s[a] & s[b])
            if s[a] and s[b] and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                group[root(a)] = root(b)
    out = []
    for k, (ident, _) in enumerate(rows):
        ids = [i for m, (i, _) in enumerate(rows) if i is not None and s[k] and root(m) == root(k)]
        out.append((ident, len(s[k]), min(ids) if ids else ident))
    return sorted(out, key=str)


def check(spark, rows):
    docs = make_docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("node", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted((tuple(r) for r in j.similar_components(docs).collect()), key=str)
    assert got == brute(rows)


def family(rng, size, n, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], [f"e{rng.randrange(10**6)}"], [w[at], f"e{rng.randrange(10**6)}"]])
        out.append(" ".join(w))
    return out


def test_families_around_the_threshold(spark):
    rng = random.Random(4)
    texts = []
    for size in (5, 8, 11, 20, 40, 90, 250, 900):
        for _ in range(3):
            texts += family(rng, size, 8, max(1, size // 25))
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_odd_rows(spark):
    long = " ".join(f"t{k % 977}x{k}" for k in range(20_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "one"), (8, "ONE"), (None, "one"), (9, "one two"), (None, "alone here"), (3, "a a a a a a a a a"), (2, "a a a a"),
            (11, long), (10, long + " tail"), (12, " "), (13, "É"), (14, "é")]
    check(spark, rows)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(j, "MAX_BROADCAST", 0)
    rng = random.Random(9)
    check(spark, list(enumerate(family(rng, 60, 60, 4) + family(rng, 30, 20, 2))))


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**64 - 1, rng.integers(2, 400), dtype=np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) > 0.05], rng.integers(0, 2**64 - 1, 5, dtype=np.uint64)])
        words = int(rng.integers(1, 60))
        far = np.bitwise_count(j.sketch(a, words) ^ j.sketch(b, words)).sum()
        assert far <= len(np.setxor1d(a, b))


def test_similar_sets_share_a_key():
    """Pigeonhole: every pair at the threshold shares a key, whatever the sizes, more than the ones that may be left out."""
    rng = np.random.default_rng(2)
    for n in [*range(1, 60), 100, 333, 1000, 5000]:
        for _ in range(4):
            a = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            drop = int(rng.integers(0, 1 + len(a) * 15 // 100))
            b = a[np.sort(rng.permutation(len(a))[drop:])]
            if len(b) and 100 * len(b) >= 85 * len(a) and len(b) < len(a):
                x, y = ([(leave, set(k.tolist())) for _, leave, k in j.keys(v)] for v in (a, b))
                assert any(len(k & m) > max(g, h) for g, k in x for h, m in y), (n, drop)


def test_left_out_keys_are_not_shuffled():
    """Of P = D + 1 + s keys D + 1 stay, whatever the counters say, and pairs at the threshold still share one of them."""
    rng = np.random.default_rng(3)
    often = rng.integers(0, 30, j.SLOTS).astype(np.uint8)
    for n in [*range(7, 60), 100, 333, 1000, 5000]:
        for percent in (80, 85):
            a = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            kept = j.kept_keys(a, percent, often)
            for (which, leave, k), stays in zip(j.keys(a, percent), kept):
                words, spare = j.words_in(j.band_of(len(a), percent) - (which % 2 == 0), percent)
                assert len(stays) == len(k) - leave and (which > 1 or len(stays) <= words - spare)
            b = a[np.sort(rng.permutation(len(a))[int(rng.integers(0, 1 + len(a) * (100 - percent) // 100)):])]
            if len(b) and 100 * len(b) >= percent * len(a) and len(b) < len(a):
                mine, others = (set(np.concatenate(x).tolist()) for x in (kept, j.kept_keys(b, percent, often)))
                assert mine & others, (n, percent)


def test_node_tells_sets_apart():
    h = WordHashes()
    assert j.node_of(j.shingle_set(h, "a b c d e")) == j.node_of(j.shingle_set(h, "A  b c\nd E"))
    assert j.node_of(j.shingle_set(h, "a b c d e")) != j.node_of(j.shingle_set(h, "a b c d f"))


def test_one_of_each_group_stays(spark):
    texts = ["one two three four five", "one two three four five", "other words are standing here", None, "", "one two three four five"]
    docs = make_docs(spark, texts, [4, 4, 5, 6, None, None]).withColumn("n", F.lit(1)).withColumn("row", F.lit(2))
    kept = j.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(4, texts[0]), (5, texts[2]), (6, None), (None, "")], key=str)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(500, 500 + k) for k in range(1, 200)] + [(7, 7), (None, 3), (-5, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: -5 for k in [*range(100, 161), -5]}, **{500 + k: 500 for k in range(200)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_empty(spark):
    assert j.similar_components(make_docs(spark, [])).count() == 0


def test_many_texts_at_once_say_what_each_says(monkeypatch):
    """Words, sets, sketches and keys of texts laid end to end are those of each text alone, also if a text is cut into pieces."""
    rng = random.Random(21)
    texts = [None, "", " \t\n", "a", "A b", "é\x0bÉ\x0c\x85 \x1fx", *(" ".join(rng.choices(["ab", "B", "c,", "dé"], k=k)) for k in range(60)), *family(rng, 300, 3, 9), "x" * 3000 + " y"]
    h = WordHashes()
    for piece, size in ((1 << 17, 1 << 18), (7, 50), (1, 1)):
        monkeypatch.setattr(common, "PIECE", piece)
        monkeypatch.setattr(common, "CHUNK", size)
        cuts = list(common.chunks(texts))
        assert [k for x, y in cuts for k in range(x, y)] == list(range(len(texts)))
        assert list(common.chunks([])) == [] and [len(v) for v in common.text_hashes([])] == [0, 0]
        said = {}
        for x, y in cuts:
            words, counts = common.text_hashes(texts[x:y])
            want = [common.words_of(t) for t in texts[x:y]]
            assert counts.tolist() == [len(w) for w in want]
            for w, v in zip((w for ws in want for w in ws), words.tolist()):
                assert said.setdefault(w, v) == v
            s, sizes = j.sets_of(texts[x:y], 4)
            alone = [j.shingle_set(h, t) for t in texts[x:y]]
            assert sizes.tolist() == [len(v) for v in alone] and np.array_equal(s, np.concatenate(alone))
            for t in (1, 0):
                k, counts, leave, decide = j.table_keys(s, sizes, t, 85)
                one = [{a: (b, c) for a, b, c in j.keys(v)} for v in alone]
                assert np.array_equal(k, np.concatenate([o[t][1] if t in o else k[:0] for o in one]))
                assert {i: a.tolist() for i, a in decide} == {i: o[2 + t][1].tolist() for i, o in enumerate(one) if 2 + t in o}
        assert len(set(said.values())) == len(said)


def test_similar_sets_share_keys_enough():
    """Of the keys that stay, similar sets share ``SHARED`` or one that decides alone; one of the two has it in the table of its own band."""
    rng = np.random.default_rng(5)
    often = rng.integers(0, 2000, j.SLOTS).astype(np.uint16)
    for n in [*range(1, 120), 333, 1000, 5000]:
        for percent in (80, 85):
            for _ in range(6):
                a = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
                drop = int(rng.integers(0, 1 + len(a) * (100 - percent) // 100))
                b = a[np.sort(rng.permutation(len(a))[drop:])]
                more = 0
                while 100 * len(b) >= percent * (len(a) + more + 1):  # as many others as the threshold allows
                    more += 1
                b = np.unique(np.r_[b, rng.integers(0, 2**64 - 1, more if rng.random() < 0.5 else 0, dtype=np.uint64)])
                both = len(np.intersect1d(a, b))
                if not len(b) or 100 * both < percent * (len(a) + len(b) - both) or np.array_equal(a, b):
                    continue
                held = [[(t, k) for (t, _, _), k in zip(j.keys(v, percent), j.kept_keys(v, percent, often))] for v in (a, b)]
                score = max((sum(j.SHARED if k >= j.ALONE else 1 for k in set(x.tolist()) & set(y.tolist())) for t, x in held[0] for u, y in held[1] if t % 2 or u % 2), default=0)
                assert score >= j.SHARED, (n, percent)


def test_strangers_that_share_a_key_are_not_dealt_out(spark, monkeypatch):
    """Texts that share one phrase with another one each: their sketches are not sent for comparison, as they were."""
    rng = random.Random(6)
    rows = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(40)]
    for a, b in zip(rows[::2], rows[1::2]):
        b[:24] = a[:24]  # 21 of 57 shingles, so about one word of the sketch
    seen = []
    real = j._near_rows

    def counted(batches, percent):
        for b in batches:
            yield pd.DataFrame({"a": b["node"], "b": b["node"]})
    monkeypatch.setattr(j, "_near_rows", counted)
    monkeypatch.setattr(j, "components", lambda df, a, b: seen.append(df.count()) or components(df, a, b))
    j.similar_components(make_docs(spark, [" ".join(r) for r in rows])).count()
    assert real is not counted and seen[0] <= 12
