"""Quality scores by a factorisation machine over hashed words, word shapes, structure statistics and metadata.

``score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``; the pairwise part is computed in linear time as
half of ``(sum_i v_i x_i)^2 - sum_i (v_i x_i)^2`` in each of the RANK factors.

The features of a text, all from its whole length: which buckets its words fall into (A-Z in lower case; length 1
together), how its words are shaped (upper, lower, digit, sign; runs of three and more as two; the square roots of the
shapes' shares) and one bin for each statistic (lengths, shares of letters, digits and signs, repeated words and lines,
...). Metadata columns given by name (numbers) add a bin each, with one for null. Labels, languages, sources and ids
are no features.

The machine is fitted on at most FIT_ROWS labelled rows, those with the least hash of their id; only their feature
lists, bounded by the number of buckets, come to the driver. All rows are scored, in Arrow batches.

Defined cases: a null text is an empty one and is scored like all others. A label that is neither 0 nor 1 is not
learned from; of rows with one id the least text is learned from, once for each different label. Without any label every score is
0.5; with labels of one kind scores lean to it. Null ids have no label. Equal texts with equal metadata have equal scores.
Other columns of the tables are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table

FIT_ROWS = 12_000
RANK = 8
EPOCHS, BATCH, RATE, DECAY = 14, 256, 0.02, 2e-4
WORD_BUCKETS, SHAPE_BUCKETS = 4096, 512
KEEP_FROM = 0.7

_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUNS = re.compile(rb"(.)\1{2,}", re.S)
_SHARES = np.array([1e-9, .002, .005, .01, .02, .04, .07, .1, .15, .2, .25, .3, .4, .5, .6, .7, .8, .9, .97])
_SIZES = np.array([1, 2, 3, 5, 8, 12, 20, 35, 60, 100, 180, 320, 600, 1000, 1800, 3200, 6000, 10_000, 30_000, 100_000])
# statistic -> bin edges
STATISTICS = {
    "chars": _SIZES, "words": _SIZES, "lines": _SIZES, "line_length": _SIZES, "longest_word": _SIZES,
    "word_length": np.array([1.5, 2, 2.5, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 9, 10, 12, 15, 20, 40]),
    "upper": _SHARES, "digit": _SHARES, "space": _SHARES, "sign": _SHARES, "stop_sign": _SHARES, "not_ascii": _SHARES,
    "repeated_words": _SHARES, "top_word": _SHARES, "repeated_lines": _SHARES, "capital_words": _SHARES, "wordless": _SHARES,
    "top_shape": _SHARES,
}
BINS = 24                       # bins kept for each statistic and metadata column; the last one is for null
METADATA_EDGES = _SIZES


class _Buckets(dict):
    """Bucket of a word; emptied when it holds a million words, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        found = self[word] = xxhash.xxh32_intdigest(word) % WORD_BUCKETS
        return found


def features(texts: Sequence[str | None], metadata: Sequence[Sequence[float | None]] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, value, start of each row) of the texts' features; every row has some."""
    buckets, index, value, starts, at = _Buckets(), [], [], [], 0
    numbers = np.zeros((len(texts), len(STATISTICS)))
    fixed = len(STATISTICS) + len(metadata)
    for r, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.lower().split()
        shaped = raw.translate(_SHAPE)
        shapes = Counter(_RUNS.sub(rb"\1\1", shaped).split())
        counts = Counter(words)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        size, n = max(1, len(raw)), max(1, len(words))
        upper, lower, digit = shaped.count(b"A"), shaped.count(b"a"), shaped.count(b"0")
        space = raw.count(b" ") + raw.count(b"\n") + raw.count(b"\t") + raw.count(b"\r")
        plain = sum(map(raw.count, (b".", b",", b";", b":", b"'", b'"', b"-")))
        sign = len(raw) - upper - lower - digit - space
        wordless = sum(c for s, c in shapes.items() if b"a" not in s and b"A" not in s)
        capital = sum(c for s, c in shapes.items() if s[:2] == b"AA")
        numbers[r] = (len(text or ""), len(words), len(lines), len(raw) / max(1, len(lines)), max(map(len, counts), default=0),
                      (len(raw) - space) / n, upper / size, digit / size, space / size, (sign - plain) / size,
                      plain / size, (len(raw) - len(text or "")) / size, 1 - len(counts) / n, max(counts.values(), default=0) / n,
                      1 - len(set(lines)) / max(1, len(lines)), capital / n, wordless / n, max(shapes.values(), default=0) / n)
        held = sorted({0 if len(w) == 1 else buckets[w] for w in counts})
        starts.append(at)
        index += held
        value += [max(1, len(held)) ** -0.5] * len(held)
        for s, c in shapes.items():
            index.append(WORD_BUCKETS + xxhash.xxh32_intdigest(s) % SHAPE_BUCKETS)
            value.append((c / n) ** 0.5)
        index += [-1] * fixed                       # the bins, filled in below
        value += [fixed ** -0.5 * 2] * fixed
        at = len(index)
    index, value, starts = np.array(index, np.int32), np.array(value, np.float64), np.array(starts, np.int64)
    bins = np.empty((len(texts), fixed), np.int32)
    for k, edges in enumerate(STATISTICS.values()):
        bins[:, k] = np.searchsorted(edges, numbers[:, k], side="right")
    for k, column in enumerate(metadata):
        given = np.array([np.nan if v is None else float(v) for v in column])
        bins[:, len(STATISTICS) + k] = np.where(np.isnan(given), BINS - 1, np.searchsorted(METADATA_EDGES, given, side="right"))
    bins += WORD_BUCKETS + SHAPE_BUCKETS + BINS * np.arange(fixed, dtype=np.int32)
    index[index < 0] = bins.ravel()
    return index, value, starts


@dataclass
class Machine:
    bias: float
    weights: np.ndarray         # one for each feature
    factors: np.ndarray         # RANK for each feature

    def parts(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sum of each row before the sigmoid, v_i x_i of each entry, their sums in each row)."""
        vx = self.factors[index] * value[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        linear = np.add.reduceat(self.weights[index] * value, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), vx, sums

    def score(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return sigmoid(self.parts(index, value, starts)[0])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], width: int, seed: int = 7) -> Machine:
    """Logistic loss, Adam over shuffled batches; ``rows`` are (index, value, label)."""
    rng = np.random.default_rng(seed)
    labels = np.array([r[2] for r in rows], np.float64)
    share = (labels.sum() + 1) / (len(rows) + 2)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(width), rng.normal(0, 0.05, (width, RANK)) if rows else np.zeros((width, RANK)))
    state = [np.zeros(width), np.zeros(width), np.zeros((width, RANK)), np.zeros((width, RANK)), 0.0, 0.0]
    step = 0
    for epoch in range(EPOCHS if rows else 0):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            picked = [rows[i] for i in order[k:k + BATCH]]
            sizes = np.array([len(p[0]) for p in picked])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            index, value = np.concatenate([p[0] for p in picked]), np.concatenate([p[1] for p in picked])
            z, vx, sums = m.parts(index, value, starts)
            error = (sigmoid(z) - labels[order[k:k + BATCH]]) / len(picked)
            each = np.repeat(error, sizes) * value
            gw = np.bincount(index, each, width) + DECAY * m.weights
            spread = np.repeat(sums, sizes, axis=0) - vx
            gv = np.stack([np.bincount(index, each * spread[:, f], width) for f in range(RANK)], axis=1) + DECAY * m.factors
            step += 1
            rate = RATE * (0.5 if epoch > EPOCHS // 2 else 1) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for p, g, a, b in ((m.weights, gw, 0, 1), (m.factors, gv, 2, 3)):
                state[a] = 0.9 * state[a] + 0.1 * g
                state[b] = 0.999 * state[b] + 0.001 * g * g
                p -= rate * state[a] / (np.sqrt(state[b]) + 1e-8)
            g = error.sum()
            state[4], state[5] = 0.9 * state[4] + 0.1 * g, 0.999 * state[5] + 0.001 * g * g
            m.bias -= rate * state[4] / (state[5] ** 0.5 + 1e-8)
    return m


def held_out_rows(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          metadata: Sequence[str] = (), fit_rows: int = FIT_ROWS) -> Machine:
    """The machine fitted on at most ``fit_rows`` labelled rows."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)").distinct()
             .orderBy(F.xxhash64("id", "y"), "id", "y").limit(fit_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.struct(F.coalesce(text_col, F.lit("")).alias("t"), *[F.col(c).cast("double").alias(f"m{k}") for k, c in enumerate(metadata)]).alias("r"))
    # the labels are fit_rows narrow rows at most, so they are broadcast and no text is shuffled but theirs
    rows = rows.join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min("r").alias("r")).select("id", "y", "r.*")

    def lists(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for part in blocks(f["t"].tolist()):
                g = f.iloc[part]
                index, value, starts = features(g["t"].tolist(), [_column(g[f"m{k}"]) for k in range(len(metadata))])
                yield pd.DataFrame({"id": g["id"].array, "y": g["y"].array, "i": np.split(index, starts[1:]), "x": np.split(value.astype(np.float32), starts[1:])})

    id_type = rows.schema["id"].dataType.simpleString()
    got = rows.mapInPandas(lists, f"id {id_type}, y int, i array<int>, x array<float>").toPandas().sort_values(["id", "y"])
    width = WORD_BUCKETS + SHAPE_BUCKETS + BINS * (len(STATISTICS) + len(metadata))
    return fit([(np.asarray(i), np.asarray(x, np.float64), int(y)) for i, x, y in zip(got["i"], got["x"], got["y"])], width)


def blocks(texts: Sequence[str | None], size: int = 4_000_000) -> Iterator[slice]:
    """Runs of texts with about ``size`` characters, so the lists of their features stay small."""
    start = held = 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held >= size or k == len(texts) - 1:
            yield slice(start, k + 1)
            start, held = k + 1, 0


def _column(values: pd.Series) -> list[float | None]:
    return [None if v is None or v != v else v for v in values.tolist()]


def scorer(machine: Machine, metadata: int):
    """Column function of the text and the metadata columns: the machine's score."""
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        texts, rest = columns[0].tolist(), [_column(c) for c in columns[1:1 + metadata]]
        out = np.empty(len(texts))
        for part in blocks(texts):
            out[part] = machine.score(*features(texts[part], [c[part] for c in rest]))
        return pd.Series(out)
    return score


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, label: str = "quality", id_col: str = "doc_id",
                  text_col: str = "text", metadata: Sequence[str] = ("n_chars",), fit_rows: int = FIT_ROWS) -> DataFrame:
    """Every row of ``docs`` as id, held_out, score, predicted; labels of rows that ``held_out`` marks are not learned from."""
    ship(docs.sparkSession)
    held = held_out_rows(id_col) if held_out is None else held_out
    machine = learn(docs, labels.filter(~held), label, id_col, text_col, metadata, fit_rows)
    score = scorer(machine, len(metadata))
    return (docs.select(F.col(id_col), held.alias("held_out"), score(F.col(text_col), *[F.col(c).cast("double") for c in metadata]).alias("score"))
            .withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int")))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored as ``labels.quality`` marks them."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
