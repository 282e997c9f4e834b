"""Katz backoff scores of texts: Good-Turing discounted bigram counts, exactly normalised backoff weights.

    P(w | v) = d(c(vw)) c(vw) / c(v)  if vw was seen,   alpha(v) P(w)  if only v was seen,   P(w)  otherwise
    P(w)     = d(c(w)) c(w) / N       if w was seen,    the rest of the mass  for all unseen words as one

d(r) is Katz's discount for r <= 5 from the counts of counts of the whole corpus (1 above; absolute discounting
where the counts of counts are too irregular for it). alpha(v) = (mass that the seen words leave) / (1 - sum of
their P(w)), so each context sums to one over the seen words and the unseen one. A context whose discounts
leave nothing counts one event more.

How it runs: a table of chunks holds the tokens of about ``CHUNK_TOKENS`` words each, as numbers of the chunk's own
word list, bucketed by chunk. The model is partitioned by word (unigrams) and by context (bigrams); every chunk
sends each partition one message with its different words or word pairs and their training counts, the
partition adds them up and replies with what the chunk needs: totals, and for each context the sums behind
alpha. So each different pair of a chunk travels once, the texts travel never, and a partition's memory is
set by ``spark.sql.shuffle.partitions``. A context with more than its share of all tokens is split by the next
word over several partitions; there are at most ``HOT`` such contexts for each partition, and their sums are
added up in a table of that size.

Edge cases: a null or empty text is the end token alone; a null id counts as training; rows with one id are
separate texts; without training tokens every token is unseen, with probability one; an empty table gives no
rows; other columns are not read. Words are told apart by 64-bit hashes (48 bits inside one context).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix, shared_dir, ship, table, words_of, written

CHUNK_TOKENS, K, HOT = 1_200_000, 5, 4
END = np.uint64(xxhash.xxh64_intdigest(b"\n end of text"))  # no word holds white space
START = np.uint64(xxhash.xxh64_intdigest(b"\n start of text"))
LOW48 = np.uint64((1 << 48) - 1)


def packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 3)


def unpacked(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def held_out(ident: int | None) -> bool:
    return ident is not None and zlib.crc32(str(ident).encode()) % 5 == 1


def _chunks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    ids, tokens, held = [], [], 0

    def chunk() -> pd.DataFrame:
        words, at = np.unique(np.concatenate(tokens), return_inverse=True)
        lengths = np.array([len(t) for t in tokens])
        train = np.repeat([not held_out(i) for i in ids], lengths)
        return pd.DataFrame({"ids": [ids], "starts": [np.r_[0, np.cumsum(lengths)[:-1]].astype("<i8").tobytes()], "words": [words.astype("<u8").tobytes()],
                             "counts": [packed(np.bincount(at[train], minlength=len(words)).astype("<u4"))], "tokens": [at.astype("<u4").tobytes()]})

    for b in batches:
        for ident, text in zip(b["id"].astype(object), b["text"]):
            ids.append(None if pd.isna(ident) else int(ident))
            tokens.append(np.append(hashes(words_of(text if isinstance(text, str) else "")), END))
            held += len(tokens[-1])
            if held >= size:
                yield chunk()
                ids, tokens, held = [], [], 0
    if held:
        yield chunk()


def chunk_table(docs: DataFrame, key: str, text: str, parts: int, size: int) -> DataFrame:
    """The chunks, bucketed by their number: what is later joined by chunk stays where it is."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(
        lambda it: _chunks(it, size), "ids array<long>, starts binary, words binary, counts binary, tokens binary")
    name = f"katz_chunks_{uuid.uuid4().hex[:12]}"
    (rows.withColumn("chunk", F.monotonically_increasing_id()).write.bucketBy(parts, "chunk").option("compression", "zstd")
     .option("path", f"{shared_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Monotone in the hash: a sorted list of hashes falls into slices."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def discounts(n: list[int]) -> np.ndarray:
    """d(0..K) from the numbers of events seen once, twice, ... K + 1 times."""
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.arange(1, K + 1)
        counts = np.array(n, float)
        common = (K + 1) * counts[K] / counts[0]
        d = ((r + 1) * counts[1:] / counts[:K] / r - common) / (1 - common)
    if not np.all((d > 0) & (d < 1)):
        less = counts[0] / (counts[0] + 2 * counts[1]) if counts[0] and counts[1] else 0.5
        d = (r - less) / r
    return np.r_[0.0, d]


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts <= K, d[np.minimum(counts, K).astype(np.int64)], 1.0) * counts


class Unigrams:
    """P(w) by the count of w; count 0: the unseen word."""

    def __init__(self, total: int, words: int, n: list[int]):
        self.total, self.words, self.d = total, words, discounts(n)
        left = float(sum((1 - self.d[r]) * r * n[r - 1] for r in range(1, K + 1)))
        self.of, self.unseen = (total, left / total) if left > 0 else (total + 1, 1 / (total + 1))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / self.of, self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.words + 1)))


def _word_messages(batches: Iterator[pd.DataFrame], parts: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for chunk, words, counts in zip(b["chunk"], b["words"], b["counts"]):
            w, c = np.frombuffer(words, "<u8"), unpacked(counts, "<u4")
            cuts = np.searchsorted(part_of(w, parts), np.arange(parts + 1))
            yield pd.DataFrame([(p, chunk, w[x:y].tobytes(), packed(c[x:y])) for p, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x],
                               columns=["part", "chunk", "words", "counts"])


def _word_totals(g: pd.DataFrame) -> pd.DataFrame:
    """All messages of one partition: totals for each sender, and once the partition's statistics."""
    words = [np.frombuffer(x, "<u8") for x in g["words"]]
    _, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([unpacked(x, "<u4") for x in g["counts"]])).astype("<u8")
    stats = [int(total.sum()), int((total > 0).sum()), *(int((total == r).sum()) for r in range(1, K + 2))]
    ends = np.cumsum([len(w) for w in words])
    return pd.DataFrame({"chunk": g["chunk"], "part": g["part"], "reply": [packed(total[at[e - len(w):e]]) for e, w in zip(ends, words)],
                         "stats": [stats] + [None] * (len(g) - 1)})


class Pairs:
    """The different word pairs of a chunk, in the order in which they are sent: by partition, context, next word."""

    def __init__(self, starts: bytes, words: bytes, tokens: bytes, totals: np.ndarray, total: int, parts: int):
        self.starts, w, t = np.frombuffer(starts, "<i8"), np.frombuffer(words, "<u8"), np.frombuffer(tokens, "<u4").astype(np.int64)
        before = np.r_[len(w), t[:-1]]
        before[self.starts] = len(w)
        pair, self.at = np.unique(before * (len(w) + 1) + t, return_inverse=True)
        context, self.word = pair // (len(w) + 1), pair % (len(w) + 1)
        texts = totals[np.searchsorted(w, END)]
        self.context_count = np.append(totals, texts)[context]
        self.word_count = totals[self.word]
        self.context, self.next = np.append(w, START)[context], w[self.word] & LOW48
        spread = 1 + (self.context_count * (HOT * parts / max(1, total))).astype(np.uint64)
        self.hot = spread > 1
        self.part = part_of(mix(self.context + mix(w[self.word] % spread)), parts)
        self.order = np.argsort(self.part, kind="stable")
        self.tokens = t

    def counts(self, train: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=train, minlength=len(self.part)).astype("<u4")

    def slices(self, parts: int) -> Iterator[tuple[int, np.ndarray]]:
        part = self.part[self.order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        for p, (x, y) in enumerate(zip(cuts, cuts[1:])):
            if y > x:
                yield p, self.order[x:y]


def _runs(x: np.ndarray) -> np.ndarray:
    """Where equal neighbours begin."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]])


def _train(ids: list, starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat([not held_out(None if pd.isna(i) else int(i)) for i in ids], np.diff(np.r_[starts, n]))


def _joined(replies: list, name: str, kind) -> np.ndarray:
    return np.concatenate([unpacked(r[name], kind) for r in sorted(replies, key=lambda r: r["part"])])


def _pair_messages(batches: Iterator[pd.DataFrame], uni: Unigrams, parts: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for r in b.itertuples():
            p = Pairs(r.starts, r.words, r.tokens, _joined(r.first, "reply", "<u8"), uni.total, parts)
            counts = p.counts(_train(r.ids, p.starts, len(p.tokens)))
            rows = []
            for part, k in p.slices(parts):
                runs = _runs(p.context[k])
                rows.append((part, r.chunk, p.context[k][runs].astype("<u8").tobytes(), packed(np.diff(np.r_[runs, len(k)]).astype("<u4")),
                             np.ascontiguousarray(p.next[k].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes(),
                             packed(p.word_count[k].astype("<u8")), packed(counts[k]), packed(p.hot[k][runs].astype("u1"))))
            yield pd.DataFrame(rows, columns=["part", "chunk", "contexts", "runs", "nexts", "word_counts", "counts", "hot"])


def _pair_totals(g: pd.DataFrame, uni: Unigrams) -> pd.DataFrame:
    """All messages of one partition: totals and the sums of the contexts for each sender; once the statistics and the hot contexts' sums."""
    contexts = [np.frombuffer(x, "<u8") for x in g["contexts"]]
    runs = [unpacked(x, "<u4") for x in g["runs"]]
    context = np.concatenate([np.repeat(c, r) for c, r in zip(contexts, runs)])
    raw = np.zeros((len(context), 8), np.uint8)
    raw[:, :6] = np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, 6) for x in g["nexts"]])
    key = mix(context ^ mix(raw.view("<u8")[:, 0]))
    _, first, at = np.unique(key, return_index=True, return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([unpacked(x, "<u4") for x in g["counts"]])).astype("<u4")
    word_count = np.concatenate([unpacked(x, "<u8") for x in g["word_counts"]])[first]
    names, of = np.unique(context[first], return_inverse=True)
    lower = np.bincount(of, weights=np.where(total > 0, uni(word_count), 0.0))
    seen = np.stack([np.bincount(of, weights=total == r) for r in range(1, K + 1)], axis=1).astype("<u4")
    stats = [int((total == r).sum()) for r in range(1, K + 2)]
    hot = np.unique(np.concatenate([c[unpacked(h, "u1") > 0] for c, h in zip(contexts, g["hot"])]))
    where = np.searchsorted(names, hot)
    ends = np.cumsum([int(r.sum()) for r in runs])
    rows = []
    for c, r, e, chunk, part in zip(contexts, runs, ends, g["chunk"], g["part"]):
        k = np.searchsorted(names, c)
        rows.append((chunk, part, packed(total[at[e - int(r.sum()):e]]), packed(lower[k]), packed(seen[k]), None, None))
    rows[0] = (*rows[0][:5], stats, [{"context": int(x.astype(np.int64)), "lower": float(lower[k]), **{f"s{r + 1}": int(v) for r, v in enumerate(seen[k])}} for x, k in zip(hot, where)])
    return pd.DataFrame(rows, columns=["chunk", "part", "counts", "lower", "seen", "stats", "hot"])


def _scores(batches: Iterator[pd.DataFrame], uni: Unigrams, d: np.ndarray, parts: int, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pd.DataFrame]:
    names, hot_lower, hot_seen = hot
    for b in batches:
        for r in b.itertuples():
            totals = _joined(r.first, "reply", "<u8")
            p = Pairs(r.starts, r.words, r.tokens, totals, uni.total, parts)
            n = len(p.part)
            counts, lower, seen = np.zeros(n, np.int64), np.zeros(n), np.zeros((n, K))
            replies = {x["part"]: x for x in r.second}
            for part, k in p.slices(parts):
                runs = _runs(p.context[k])
                lengths = np.diff(np.r_[runs, len(k)])
                counts[k] = unpacked(replies[part]["counts"], "<u4")
                lower[k] = np.repeat(unpacked(replies[part]["lower"], "<f8"), lengths)
                seen[k] = np.repeat(unpacked(replies[part]["seen"], "<u4").reshape(-1, K), lengths, axis=0)
            k = np.flatnonzero(p.hot)
            at = np.searchsorted(names, p.context[k])
            lower[k], seen[k] = hot_lower[at], hot_seen[at]
            of = p.context_count.astype(float)
            left = (seen * ((1 - d[1:]) * np.arange(1, K + 1))).sum(axis=1)
            none = left <= 0
            of[none], left[none] = of[none] + 1, 1.0
            single = uni(p.word_count)
            known = p.context_count > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                prob = np.where(counts > 0, discounted(counts, d) / of, np.where(known, left / of / (1 - lower) * single, single))
            score = np.add.reduceat(np.log10(prob)[p.at], p.starts)
            each = totals[p.tokens]
            yield pd.DataFrame({
                "id": pd.array([None if pd.isna(i) else int(i) for i in r.ids], "Int64"),
                "held_out": [held_out(None if pd.isna(i) else int(i)) for i in r.ids],
                "n_tokens": np.diff(np.r_[p.starts, len(each)]), "n_known": np.add.reduceat((each > 0).astype(np.int64), p.starts),
                "train_tokens": uni.total, "base_score": np.add.reduceat(uni.base(each.astype(float)), p.starts), "score": score})


def katz_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunk_table(docs, key, text, parts, chunk_tokens)
    messages = chunks.select("chunk", "words", "counts").mapInPandas(
        lambda it: _word_messages(it, parts), "part int, chunk long, words binary, counts binary")
    first = written(messages.groupBy("part").applyInPandas(_word_totals, "chunk long, part int, reply binary, stats array<long>"), "katz-unigrams")
    sums = first.where("stats is not null").agg(*[F.sum(F.col("stats")[k]) for k in range(K + 3)]).first()
    total, words, *n = [x or 0 for x in sums]
    uni = Unigrams(total, words, n)
    own = chunks.select("chunk", "ids", "starts", "words", "tokens").join(
        first.groupBy("chunk").agg(F.collect_list(F.struct("part", "reply")).alias("first")), "chunk")
    messages = own.mapInPandas(lambda it: _pair_messages(it, uni, parts),
                               "part int, chunk long, contexts binary, runs binary, nexts binary, word_counts binary, counts binary, hot binary")
    fields = ", ".join(f"s{r}: long" for r in range(1, K + 1))
    second = written(messages.groupBy("part").applyInPandas(
        lambda g: _pair_totals(g, uni),
        f"chunk long, part int, counts binary, lower binary, seen binary, stats array<long>, hot array<struct<context: long, lower: double, {fields}>>"), "katz-bigrams")
    sums = second.where("stats is not null").agg(*[F.sum(F.col("stats")[k]) for k in range(K + 1)]).first()
    d = discounts([x or 0 for x in sums])
    # at most HOT contexts for each partition have that large a share of the tokens
    rows = second.where("size(hot) > 0").select(F.explode("hot").alias("h")).groupBy("h.context").agg(
        F.sum("h.lower"), *[F.sum(f"h.s{r}") for r in range(1, K + 1)]).collect()
    rows = sorted(((np.int64(r[0]).astype(np.uint64), *r[1:]) for r in rows), key=lambda r: r[0])
    hot = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], float), np.array([r[2:] for r in rows], float).reshape(-1, K))
    both = own.join(second.groupBy("chunk").agg(F.collect_list(F.struct("part", "counts", "lower", "seen")).alias("second")), "chunk")
    return both.mapInPandas(lambda it: _scores(it, uni, d, parts, hot),
                            "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_katz(spark, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
