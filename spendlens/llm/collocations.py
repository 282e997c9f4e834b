"""Phrases of two and three words that occur together far more often than their parts: best-first branch and bound.

A phrase's score is the least, over its cuts into a first part and the rest, of ``floor(10^6 a*a / (l*r))`` with the
counts a of the phrase, l of the first part and r of the rest. Growth goes from words to pairs to triples:

1. Words are counted, then pairs of words that are frequent enough themselves (a pair is no more frequent than its words).
2. For a triple that begins with the pair ``w1 w2`` both ``a`` and ``r`` of its first cut are bounded by what is known of
   the prefix: its score is at most ``floor(10^6 f(w1 w2) / f(w1))``. These bounds are admissible, so pairs are expanded in
   the order of their bounds: a round expands, in each language, all pairs whose bound reaches a threshold (and all pairs
   whose own score does, on either side, for a pair falls when a longer candidate holds it often enough).
3. Then every candidate that scores the threshold or more is known, and whether it survives. When ``top`` of them survive in a
   language, or the threshold is 0, nothing below can change its report, ties included: it is settled. The threshold of
   the others falls to the score of a pair eight times as far down, and their texts are counted once more.

Texts are counted in tasks, about CHUNK words at once, so only different phrases of a chunk are shuffled; they are put into words
and looked up SLICE at a time, so a worker holds little beside the numbers of the chunk's words. Which words and
pairs may be skipped is told by bit sets of a fixed size (FILTER_BITS, two bits a key): a wrong "may count" costs a row of
shuffle, the joins that follow are exact. No table is broadcast but those bit sets.

Defined cases: A-Z in lower case; pieces end at ``.,;:!?`` and line ends (\\x0A to \\x0D), words at blanks and tabs; a null
language is ``und``, a null text is empty; repeated rows count each time; a language whose candidates are fewer than
``top`` reports them all; an empty table reports nothing. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, small_batches, table, written

TOP, LEAST, SHARE = 2000, 10, 50    # reported for each language; least count; a longer candidate with this share of a phrase's count drops it
CHUNK = 2_000_000                   # words counted at once in a task
SLICE = 50_000                      # phrases put into words at once
FILTER_BITS = 24                    # log2 of the bits of a bit set
FRONTIER, WIDER = 2, 8              # the first round's threshold lies at this many times ``top``; further rounds at WIDER times more

COUNTS = "lang string, phrase string, f bigint"
_ENDS = bytes(10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in range(256))
_EMPTY, _END, _FIRST = 0, 1, 2      # numbers of the empty string, the end of a piece, the first word


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def _word_numbers(text: bytes, words: _Words) -> np.ndarray:
    parts = text.lower().translate(_ENDS).replace(b"\n", b" \n ").split(b" ")
    found = np.fromiter(map(words.__getitem__, parts), np.int32, len(parts))
    return np.append(found[found != _EMPTY], np.int32(_END))


def _digests(lang: bytes, keys: list[bytes]) -> np.ndarray:
    head, digest = lang + b"\0", xxhash.xxh64_intdigest
    return np.fromiter((digest(head + k, 42) for k in keys), np.uint64, len(keys))


def _held(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bit set (all without one)."""
    out = np.ones(len(h), bool)
    if bits is None:
        return out
    for p in (h, h >> np.uint64(32)):
        p = (p & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
        out &= (bits[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return out


def _hits(bits: np.ndarray | None, lang: bytes, keys: list[bytes]) -> np.ndarray:
    """Which keys may be in the bit set."""
    return _held(bits, _digests(lang, keys))


def _join(words: pa.Array, *numbers: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*[words.take(pa.array(n)) for n in numbers], pa.scalar(b" ", pa.binary()))


def _slices(n: int) -> Iterator[slice]:
    return (slice(k, min(k + SLICE, n)) for k in range(0, n, SLICE))


def _phrases(ids: np.ndarray, words: pa.Array, lang: bytes, n: int, filters: dict) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Different phrases of ``n`` words in a chunk of one language, less those the bit sets rule out, and their counts, ``SLICE`` at a time."""
    if n == 1:
        counts = np.bincount(ids, minlength=len(words))
        counts[:_FIRST] = 0
        held = np.nonzero(counts)[0]
        for k in _slices(len(held)):
            yield words.take(pa.array(held[k])), counts[held[k]]
        return
    frequent = np.zeros(len(words), bool)
    frequent[ids] = True
    frequent[:_FIRST] = False
    used = np.nonzero(frequent)[0]
    for k in _slices(len(used)):
        frequent[used[k]] = _hits(filters.get("words"), lang, words.take(pa.array(used[k])).to_pylist())
    ok = frequent[ids]
    at = np.nonzero(ok[:-1] & ok[1:])[0]                   # places of pairs
    pairs = ids[at] * np.int64(len(words)) + ids[at + 1]
    if n == 2:
        pairs, counts = np.unique(pairs, return_counts=True)
        for k in _slices(len(pairs)):
            yield _join(words, pairs[k] // len(words), pairs[k] % len(words)), counts[k]
        return
    pairs, which = np.unique(pairs, return_inverse=True)
    first, second = (pairs // len(words)).astype(np.int32), (pairs % len(words)).astype(np.int32)
    known, grown, asked = (np.zeros(len(pairs), bool) for _ in range(3))
    for k in _slices(len(pairs)):
        h = _digests(lang, _join(words, first[k], second[k]).to_pylist())
        known[k] = _held(filters.get("pairs"), h)
        grown[k] = known[k] & _held(filters.get("prefixes"), h)
        asked[k] = known[k] & _held(filters.get("scored"), h)
    number = np.full(len(ids), -1, np.int32)
    number[at] = which
    del pairs, at, which
    left, right = number[:-2], number[1:-1]
    both = np.nonzero((left >= 0) & (right >= 0))[0]
    both = both[known[left[both]] & known[right[both]] & (grown[left[both]] | asked[right[both]])]
    triples, counts = np.unique(left[both] * np.int64(len(words)) + ids[both + 2], return_counts=True)
    for k in _slices(len(triples)):
        pair = triples[k] // len(words)
        yield _join(words, first[pair], second[pair], triples[k] % len(words)), counts[k]


def phrase_counts(docs: DataFrame, n: int, filters: dict | None = None, chunk: int = CHUNK) -> DataFrame:
    """lang, phrase, f: how often each phrase of ``n`` words occurs; for n = 1 a null phrase holds the number of all words."""
    sent = docs.sparkSession.sparkContext.broadcast(filters or {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, texts, held = _Words({b"": _EMPTY, b"\n": _END}), {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            listed = pa.array(list(words), pa.binary())
            words.clear()
            for lang in list(texts):
                ids = np.concatenate(texts.pop(lang))
                found = _phrases(ids, listed, lang, n, sent.value)
                for phrases, counts in chain(found, [(pa.nulls(1, pa.binary()), (ids >= _FIRST).sum(keepdims=True))] if n == 1 else []):
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.binary()), len(counts)).cast(pa.string()),
                                                      phrases.cast(pa.string()), pa.array(counts.astype(np.int64))],
                                                     names=["lang", "phrase", "f"])

        for b in batches:
            for lang, text in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids = _word_numbers(text, words)
                texts.setdefault(lang, []).append(ids)
                held += len(ids)
                if held >= chunk:
                    yield from flush()
                    words, texts, held = _Words({b"": _EMPTY, b"\n": _END}), {}, 0
        if held:
            yield from flush()

    return docs.mapInArrow(count, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bit_set(keys: DataFrame) -> np.ndarray:
    """Bit set of the (lang, phrase) rows, 2^FILTER_BITS bits whatever their number."""
    h = F.xxhash64(F.concat("lang", F.lit("\0"), "phrase"))
    mask = F.lit((1 << FILTER_BITS) - 1)
    places = keys.select(F.explode(F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask))).alias("p"))
    cells = (places.groupBy(F.shiftright("p", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("bits"))
             .toPandas())    # 2^(FILTER_BITS - 6) rows at most
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[cells["cell"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _score(a: str, l: str, r: str) -> str:
    return f"CAST(CAST(1000000 AS DECIMAL(7,0)) * (CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0))) div (CAST({l} AS DECIMAL(18,0)) * CAST({r} AS DECIMAL(18,0))) AS BIGINT)"


def scored_pairs(docs: DataFrame, words: DataFrame, least: int, filters: dict) -> DataFrame:
    """lang, phrase, w1, w2, a, l, r, score, bound of each pair that occurs ``least`` times."""
    pairs = (phrase_counts(docs, 2, filters).filter(F.col("f") >= least)
             .selectExpr("lang", "phrase", "substring_index(phrase, ' ', 1) AS w1", "substring_index(phrase, ' ', -1) AS w2", "f AS a"))
    one = words.filter("phrase IS NOT NULL")
    pairs = (pairs.join(one.selectExpr("lang", "phrase AS w1", "f AS l"), ["lang", "w1"])
             .join(one.selectExpr("lang", "phrase AS w2", "f AS r"), ["lang", "w2"]))
    return pairs.selectExpr("lang", "phrase", "w1", "w2", "a", "l", "r", f"{_score('a', 'l', 'r')} AS score",
                            "CAST(CAST(a AS DECIMAL(18,0)) * 1000000 div CAST(l AS DECIMAL(18,0)) AS BIGINT) AS bound")


def scored_triples(docs: DataFrame, pairs: DataFrame, least: int, filters: dict) -> DataFrame:
    """lang, phrase, its first and last two words, a, l, r, score of the triples that the bit sets let pass."""
    t = (phrase_counts(docs, 3, filters).filter(F.col("f") >= least)
         .selectExpr("lang", "phrase", "substring_index(phrase, ' ', 2) AS p1", "substring_index(phrase, ' ', -2) AS p2", "f AS a"))
    t = (t.join(pairs.selectExpr("lang", "phrase AS p1", "a AS f12", "l AS f1"), ["lang", "p1"])
         .join(pairs.selectExpr("lang", "phrase AS p2", "a AS f23", "r AS f3"), ["lang", "p2"])
         .selectExpr("*", f"{_score('a', 'f1', 'f23')} AS s1", f"{_score('a', 'f12', 'f3')} AS s2"))
    return t.selectExpr("lang", "phrase", "p1", "p2", "a", "IF(s1 <= s2, f1, f12) AS l", "IF(s1 <= s2, f23, f3) AS r", "least(s1, s2) AS score")


def thresholds(pairs: DataFrame, langs: DataFrame, rank: int) -> DataFrame:
    """lang, least_score: the score of the pair at ``rank``, 0 where there are fewer."""
    per_score = pairs.join(langs, "lang", "left_semi").groupBy("lang", "score").count()       # 1,000,001 rows a language at most
    reached = per_score.selectExpr("lang", "score", "sum(count) OVER (PARTITION BY lang ORDER BY score DESC) AS reached")
    found = reached.filter(F.col("reached") >= rank).groupBy("lang").agg(F.max("score").alias("s"))
    return langs.join(found, "lang", "left").select("lang", F.coalesce("s", F.lit(0)).alias("least_score"))


def survivors(pairs: DataFrame, triples: DataFrame, limits: DataFrame, share: int) -> DataFrame:
    """Candidates at or above their language's threshold that no longer candidate drops."""
    longer = (triples.select("lang", "a", F.explode(F.array("p1", "p2")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (pairs.join(limits, "lang").filter("score >= least_score").join(longer, ["lang", "phrase"], "left")
            .filter(f"longer IS NULL OR 100 * longer < {share} * a"))
    cols = ["lang", "phrase", "a", "l", "r", "score"]
    return kept.select(*cols).unionByName(triples.join(limits, "lang").filter("score >= least_score").select(*cols))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE, lang_col: str = "lang", text_col: str = "text",
                 frontier: int = FRONTIER, chunk: int = CHUNK) -> DataFrame:
    """The first ``top`` surviving phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = written(phrase_counts(docs, 1, chunk=chunk).filter(F.col("phrase").isNull() | (F.col("f") >= least)), "collocation-words")
    totals = words.filter("phrase IS NULL").selectExpr("lang", "f AS n")
    filters = {"words": bit_set(words.filter("phrase IS NOT NULL"))}
    pairs = written(scored_pairs(docs, words, least, filters), "collocation-pairs")
    filters["pairs"] = bit_set(pairs)
    open_, rank, settled = pairs.select("lang").distinct(), frontier * top, []
    while True:
        limits = written(thresholds(pairs, open_, rank), "collocation-limits")
        here = pairs.join(limits, "lang")
        filters |= {"prefixes": bit_set(here.filter("bound >= least_score")), "scored": bit_set(here.filter("score >= least_score"))}
        texts = docs.join(limits.select("lang"), "lang", "left_semi")
        triples = written(scored_triples(texts, pairs, least, filters), "collocation-triples")
        alive = survivors(pairs, triples, limits, share)
        enough = alive.groupBy("lang").count().filter(F.col("count") >= top).select("lang")
        done = written(limits.filter("least_score = 0").select("lang").union(enough).distinct(), "collocation-settled")
        settled.append(alive.join(done, "lang", "left_semi"))
        open_ = limits.select("lang").join(done, "lang", "left_anti")
        if open_.isEmpty():
            break
        rank *= WIDER
    found = reduce(DataFrame.unionByName, settled)
    ranked = found.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank").filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f1 AS (SELECT lang, w[i] AS p, count(*) AS f FROM places GROUP BY 1, 2),
f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM places WHERE i + 1 <= len(w) GROUP BY 1, 2, 3),
f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM places WHERE i + 2 <= len(w) GROUP BY 1, 2, 3, 4),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY 1),
two AS (
  SELECT x.lang, x.w1, x.w2, x.f AS a, l.f AS l, r.f AS r, CAST(x.f AS HUGEINT) * x.f * 1000000 // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM f2 x JOIN f1 l ON x.lang = l.lang AND x.w1 = l.p JOIN f1 r ON x.lang = r.lang AND x.w2 = r.p WHERE x.f >= 10),
three AS (
  SELECT *, CAST(a AS HUGEINT) * a * 1000000 // (CAST(l1 AS HUGEINT) * r1) AS s1, CAST(a AS HUGEINT) * a * 1000000 // (CAST(l2 AS HUGEINT) * r2) AS s2
  FROM (SELECT x.lang, x.w1, x.w2, x.w3, x.f AS a, l.f AS l1, q.f AS r1, p.f AS l2, r.f AS r2
        FROM f3 x JOIN f1 l ON x.lang = l.lang AND x.w1 = l.p JOIN f2 q ON x.lang = q.lang AND x.w2 = q.w1 AND x.w3 = q.w2
        JOIN f2 p ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 JOIN f1 r ON x.lang = r.lang AND x.w3 = r.p WHERE x.f >= 10)),
alive AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, a, l, r, score FROM two t
  WHERE NOT EXISTS (SELECT 1 FROM three h WHERE h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2 AND 100 * h.a >= 50 * t.a)
    AND NOT EXISTS (SELECT 1 FROM three h WHERE h.lang = t.lang AND h.w2 = t.w1 AND h.w3 = t.w2 AND 100 * h.a >= 50 * t.a)
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM three),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alive)
SELECT k.lang, CAST(k.rank AS BIGINT) AS rank, k.phrase, CAST(k.a AS BIGINT) AS a, CAST(k.l AS BIGINT) AS l, CAST(k.r AS BIGINT) AS r,
       CAST(n.n AS BIGINT) AS n, CAST(k.score AS BIGINT) AS score
FROM ranked k JOIN n ON k.lang = n.lang WHERE k.rank <= 2000"""
