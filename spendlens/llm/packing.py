"""Packing tokenised documents into training sequences by cutting-stock column generation.

Every document is tokenised once and ended with ``END``; longer ones are cut at ``SEQUENCE`` ids. The
pieces, with their ids, are written to the shared folder. The histogram of piece lengths (one row for
each length up to ``SHORT`` and for each ``UNIT`` ids beyond, so at most ``SHORT + SEQUENCE / UNIT`` rows) comes to the driver, where a linear
program over patterns of classes is solved, one for short and one for longer pieces: a knapsack by dynamic programming prices new patterns
until none improves. Patterns are rounded down, the rest is packed first-fit decreasing. The pieces
of a class are ranked (rank inside a salt plus the salt's offset, so no class meets in one task), the
ranks are dealt to the patterns' slots, and prefix sums inside a sequence give the offsets.

The plan depends on the histogram alone; its size doesn't grow with the documents.

Edge cases: a null or empty text is the single id ``END``; rows with equal ids are separate documents; an
empty table gives no pieces; other columns are not read. The ids are those of the ``tokenizers`` library;
texts without the special string are encoded by ``tiktoken`` from the same vocabulary, which is faster.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import nullable, ship, table, written

SEQUENCE, UNIT, SHORT, END, SALTS = 2048, 8, 64, 1, 256   # beyond SHORT a class is UNIT ids wide, which costs under 7 ids in 64
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY):
    """text -> ids as an array of unsigned 32-bit numbers."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(plain.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(fast.encode_ordinary(text), "<u4")

    return encode


def _pieces(batches: Iterator[pd.DataFrame], vocabulary: str, sequence: int) -> Iterator[pd.DataFrame]:
    encode = encoder(vocabulary)
    for b in batches:
        rows = []
        for ident, text in zip(b["id"].astype(object), b["text"]):
            ids = np.append(encode(text if isinstance(text, str) else ""), np.uint32(END)).astype("<u4")
            ident = None if pd.isna(ident) else int(ident)
            rows += [(ident, a, min(sequence, len(ids) - a), len(ids), ids[a:a + sequence].tobytes()) for a in range(0, len(ids), sequence)]
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])
        out["doc_id"] = nullable([r[0] for r in rows])
        yield out


def tokenized(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, sequence: int = SEQUENCE) -> DataFrame:
    """``piece, doc_id, start, length, doc_tokens, ids`` (little-endian unsigned 32-bit), written."""
    ship(docs.sparkSession)

    def pieces(batches):
        return _pieces(batches, vocabulary, sequence)

    out = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(
        pieces, "doc_id long, start long, length long, doc_tokens long, ids binary")
    return written(out.withColumn("piece", F.monotonically_increasing_id()), "packing-pieces")


def knapsack(prices: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern (how often each width is taken) within the capacity."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fits = np.searchsorted(widths, np.arange(capacity + 1), "right")
    for c in range(int(widths[0]), capacity + 1):
        value = best[c - widths[:fits[c]]] + prices[:fits[c]]
        k = value.argmax()
        if value[k] > best[c - 1] + 1e-12:
            best[c], taken[c] = value[k], k
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(widths)), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            pattern[taken[c]] += 1
            c -= widths[taken[c]]
    return float(best[capacity]), pattern


def column_generation(widths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 5e-4) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one in each column) and how often the linear program uses them, within ``gap`` of its optimum (Farley's bound)."""
    n = len(widths)
    columns = np.diag(np.floor(capacity / widths))
    inverse = np.diag(1 / np.diag(columns))
    x = inverse @ demand
    kept, bound = inverse.sum(axis=0), 0.0  # the prices with the best lower bound so far
    weight = 0.8
    for _ in range(20 * n + 100):
        prices = inverse.sum(axis=0)
        # prices between the kept and the present ones: the program's own swing wildly at first
        asked = np.maximum(weight * kept + (1 - weight) * prices, 0)
        value, new = knapsack(asked, widths, capacity)
        if asked @ demand / max(value, 1) > bound:
            kept, bound = asked, asked @ demand / max(value, 1)
        if x.sum() <= bound * (1 + gap):
            break
        if prices @ new <= 1 + 1e-9:  # not better than the basis at its own prices
            if weight == 0:
                break
            weight = 0.0
            continue
        weight = 0.8
        step = inverse @ new
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        theta = max(0.0, ratio[out])
        x -= theta * step
        x[out] = theta
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        columns[:, out] = new
    return columns.astype(int), np.maximum(x, 0)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern: class -> count, number of sequences), together holding at least the histogram."""
    if not histogram:
        return []
    widths = np.array(sorted(histogram))
    demand = np.array([histogram[w] for w in widths], float)
    columns, x = column_generation(widths, demand, capacity)
    left = demand.astype(int)
    out = []
    for j in np.argsort(-x):
        taken = columns[:, j]
        times = int(x[j] + 1e-6)
        if times and taken.any():
            times = min([times, *(left[k] // taken[k] for k in np.nonzero(taken)[0])])
        if times > 0:
            out.append(({int(widths[k]): int(taken[k]) for k in np.nonzero(taken)[0]}, int(times)))
            left -= times * taken
    while left.any():  # first fit, by decreasing width
        pattern, room = np.zeros(len(widths), int), capacity
        for k in range(len(widths) - 1, -1, -1):
            pattern[k] = min(left[k], room // widths[k])
            room -= pattern[k] * widths[k]
        times = int(min(left[k] // pattern[k] for k in np.nonzero(pattern)[0]))
        out.append(({int(widths[k]): int(pattern[k]) for k in np.nonzero(pattern)[0]}, times))
        left -= times * pattern
    return out


def plans(histogram: dict[int, int], sequence: int, unit: int) -> list[tuple[dict[int, int], int]]:
    """Patterns of the short classes, exact to the id, and of the others, whose program counts in units: each is small."""
    short = {w: n for w, n in histogram.items() if w <= SHORT}
    long_ = plan({w // unit: n for w, n in histogram.items() if w > SHORT}, sequence // unit)
    return [({w * unit: c for w, c in p.items()}, times) for p, times in long_] + plan(short, sequence)


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each class the first rank of each run of slots, and the sequence that takes that rank; the next rank takes the next one."""
    runs: dict[int, list[tuple[int, int]]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        for width, count in pattern.items():
            for _ in range(count):
                at = filled.get(width, 0)
                runs.setdefault(width, []).append((at, sequence))
                filled[width] = at + times
        sequence += times
    return {w: (np.array([a for a, _ in r]), np.array([s for _, s in r])) for w, r in runs.items()}


def pack(pieces: DataFrame, sequence: int = SEQUENCE, unit: int = UNIT) -> DataFrame:
    """``sequence`` is a multiple of ``unit``. ``pieces`` without their ids, with ``sequence_id`` and ``offset``; ``ids_crc32`` is taken from the ids."""
    width = F.when(F.col("length") <= SHORT, F.col("length")).otherwise(F.ceil(F.col("length") / F.lit(unit)) * unit).cast("int").alias("width")
    rows = pieces.select("piece", "doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"), width)
    # the high bits of ``piece`` are the number of the task that wrote it
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(F.shiftright("piece", 12)), F.lit(SALTS)).cast("int"))
    per_salt = pieces.select(width,
                             F.pmod(F.xxhash64(F.shiftright("piece", 12)), F.lit(SALTS)).cast("int").alias("salt")).groupBy("width", "salt").count()
    histogram = {r["width"]: r["n"] for r in per_salt.groupBy("width").agg(F.sum("count").alias("n")).collect()}  # a row for each class
    dealt = slots(plans(histogram, sequence, unit))
    before = Window.partitionBy("width").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = per_salt.select("width", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    ranked = (rows.withColumn("at", F.row_number().over(Window.partitionBy("width", "salt").orderBy("piece")) - 1)
              .join(first, ["width", "salt"]).withColumn("rank", F.col("first") + F.col("at")).drop("first", "at", "salt"))

    @F.pandas_udf("long")
    def sequence_of(width: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.empty(len(width), np.int64)
        w, r = width.to_numpy(), rank.to_numpy()
        for k in np.unique(w):
            some = w == k
            starts, sequences = dealt[int(k)]
            run = np.searchsorted(starts, r[some], "right") - 1
            out[some] = sequences[run] + r[some] - starts[run]
        return pd.Series(out)

    placed = ranked.withColumn("sequence_id", sequence_of("width", "rank"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "piece")
    offset = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("offset", offset).drop("width", "rank")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, its ids and the first offset of each document in it."""
    both = placed.select("piece", "sequence_id", "offset").join(pieces.select("piece", "doc_id", "ids"), "piece")
    return both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(x["offset"].alias("offset"), x["doc_id"].alias("doc_id"))).alias("documents"))


def placements(docs: DataFrame) -> DataFrame:
    """Where each piece of each document lies: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    placed = pack(tokenized(docs))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return placements(table(spark, sf_dir, "documents"))
