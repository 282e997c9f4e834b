"""Shared helpers of the training-data operators: tables, written intermediates, word hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once for each application: they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="spendlens-"), "spendlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.join("spendlens", os.path.relpath(f, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where it is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    found = tempfile.mkdtemp(prefix="spendlens-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lost executors re-read it instead of recomputing it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TEXTS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Texts travel to Python workers in batches of ``TEXTS_PER_BATCH`` rows at most, so a batch of long texts stays small there and in Arrow's buffers; a smaller setting is kept."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "0")) <= TEXTS_PER_BATCH:
        spark.conf.set(name, str(TEXTS_PER_BATCH))


def nullable(values: list[int | None]) -> pd.api.extensions.ExtensionArray:
    """64-bit integers and nulls, without a detour by floats."""
    return pd.arrays.IntegerArray(np.array([v or 0 for v in values], np.int64), np.array([v is None for v in values], bool))


def ascii_lower(col) -> F.Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


class WordHashes:
    """64-bit hashes of byte words; the memo is emptied when it holds ``limit`` words, so memory stays bounded."""

    def __init__(self, limit: int = 150_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SAYS = np.arange(256, dtype=np.uint64)
_SAYS[65:91] += np.uint64(32)
_STEP = np.uint64(0x9E3779B97F4A7C15)
PIECE, CHUNK = 1 << 17, 1 << 18


def text_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of all texts, as ``words_of`` has them, laid end to end; how many each text has), without a Python object for each word."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data], dtype=np.int64)
    seen = np.frombuffer(b"".join(d + b" " for d in data), np.uint8)
    says = mix(_SAYS + np.uint64(1))
    found, starts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(seen):
        end = min(at + PIECE, len(seen))
        while not _BLANK[seen[end - 1]]:  # a piece ends behind a blank; the last byte is one
            blank = np.flatnonzero(_BLANK[seen[end:end + PIECE]])
            end = end + int(blank[0]) + 1 if len(blank) else min(end + PIECE, len(seen))
        piece = seen[at:end]
        word = ~_BLANK[piece]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        edge = np.r_[0, edge] if word[0] else edge
        first, sizes = edge[::2], edge[1::2] - edge[::2]
        if len(first):
            inside = np.flatnonzero(word)
            offsets = np.cumsum(sizes) - sizes
            power = np.cumprod(np.r_[np.uint64(1), np.full(int(sizes.max()) - 1, _STEP)])
            sums = np.add.reduceat(says[piece[inside]] * power[np.arange(len(inside)) - np.repeat(offsets, sizes)], offsets)
            found.append(mix(sums + sizes.astype(np.uint64) * _STEP))
            starts.append(first + at)
        at = end
    counts = np.diff(np.searchsorted(np.concatenate(starts), np.r_[0, ends])) if len(data) else np.zeros(0, np.int64)
    return np.concatenate(found), counts


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z in lower case, as UTF-8; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; a shorter, non-empty sequence is one shingle; in order of position."""
    if len(hashes) == 0:
        return hashes
    n = min(n, len(hashes))
    count = len(hashes) - n + 1
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + count])
    return out


def text_shingles(texts: Iterable[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the runs of ``n`` words of all texts, laid end to end; how many each text has): ``shingle_hashes`` of many texts at once."""
    words, counts = text_hashes(texts)
    ends = np.cumsum(counts)
    size = np.maximum(np.where(counts > 0, 1, 0), counts - n + 1)
    total = np.cumsum(size)
    first = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(ends - counts - (total - size), size)
    of = np.repeat(np.minimum(counts, n), size)  # words in each run
    out = of.astype(np.uint64)
    for k in range(n):
        there = of > k
        if there.all():
            out = mix(out * _STEP + words[first + k])
        else:
            out[there] = mix(out[there] * _STEP + words[first[there] + k])
    return out, size


def chunks(texts: Iterable[str | None]) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts of about ``CHUNK`` characters, which stay in the CPU's cache."""
    start, held, k = 0, 0, -1
    for k, t in enumerate(texts):
        held += len(t or "")
        if held > CHUNK:
            yield start, k + 1
            start, held = k + 1, 0
    if start <= k:
        yield start, k + 1
