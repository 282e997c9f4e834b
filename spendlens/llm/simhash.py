"""SimHash fingerprints and the search of all fingerprints within a Hamming radius.

Terms are runs of two words (a text of one word is one term), in ASCII lower case. Each different term
votes with weight 1 + log2(its count) on every one of 128 signed bits, by its hash; the signs are the
fingerprint, as 32 hex digits. A text without words has the fingerprint of all zeros.

Search: the bits are cut into blocks, so many that two fingerprints within the radius differ by at most one bit in one
block at least (for radii under 4: by none). Each table is keyed by one block, moved to the front; a query
looks up its block and all that differ from it by one bit, so all tables together find every
neighbour. Equal fingerprints are searched once. One replaced word moves 7 of the 128 bits or so in texts of 50 to
150 words and fewer in longer ones, hence the radius.

The neighbour in order of id (``with_next``) needs one shuffle of the texts: ranges of ids by quantiles, and the
first row of each range goes, as a guard, also to the range before. Only one id for each range comes to
the driver.

Edge cases: null text is the empty text; null ids come first; rows with one id are ordered by text;
repeated rows are separate rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, nullable, shingle_hashes, ship, table, words_of, written, WordHashes

BITS, TERM_WORDS, RADIUS = 128, 2, 12
SECOND = np.uint64(0x9E3779B97F4A7C15)


class Fingerprinter:
    def __init__(self):
        self.hashes = WordHashes()

    def __call__(self, text: str | None) -> bytes:
        """16 bytes, a function of the text alone."""
        terms = shingle_hashes(self.hashes(words_of(text)), TERM_WORDS)
        if len(terms) == 0:
            return bytes(BITS // 8)
        terms, counts = np.unique(terms, return_counts=True)
        votes = np.zeros(BITS)
        for a in range(0, len(terms), 1 << 14):  # a long text in pieces: memory stays bounded
            t = terms[a:a + (1 << 14)]
            bits = np.unpackbits(np.stack([mix(t), mix(t ^ SECOND)], axis=1).astype("<u8").view(np.uint8), axis=1)
            weights = 1 + np.log2(counts[a:a + (1 << 14)])
            votes += 2 * (weights @ bits) - weights.sum()
        return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of bits that agree."""
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def ranges_by_id(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(part, guard, id, text): every row in its range of ids, and each range's first row also as the guard of the one before."""
    least = -(2 ** 63)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("at"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(x) for x in rows.select(F.col("at").cast("double").alias("at")).approxQuantile("at", [i / parts for i in range(1, parts)], 0.2 / parts)}) if parts > 1 else []
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    rows = rows.withColumn("part", F.size(F.filter(bounds, lambda b: b <= F.col("at"))))
    firsts = sorted((r["part"], r["at"]) for r in rows.groupBy("part").agg(F.min("at").alias("at")).collect())  # a row for each range
    if not firsts:
        return rows.select("part", F.lit(False).alias("guard"), "id", "text", "at")
    before = F.create_map(*[x for k, (_, at) in enumerate(firsts) for x in (F.lit(at).cast("long"), F.lit(firsts[k - 1][0]))])
    copies = F.filter(F.array(F.struct("part", F.lit(False).alias("guard")),
                              F.struct(before[F.col("at")].alias("part"), F.lit(True).alias("guard"))), lambda x: x["part"].isNotNull())
    return (rows.select("id", "text", "at", F.explode(copies).alias("x")).select("x.part", "x.guard", "id", "text", "at")
            .repartition(len(firsts), "part").sortWithinPartitions("part", "guard", "at", "text"))


def _with_next(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    fp = Fingerprinter()
    last = None  # part, id, text, fingerprint of the row that waits for its next

    def row(now, nxt_text: str, nxt_fp: bytes) -> tuple:
        _, ident, text, mine = now
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt_text[:half]
        new = fp(edited) if edited != text else mine
        return (ident, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mine.hex(), new.hex(),
                likeness(mine, new), likeness(mine, nxt_fp))

    columns = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for b in batches:
        out = []
        for part, guard, ident, text in zip(b["part"], b["guard"], b["id"].astype(object), b["text"]):
            if guard and (last is None or last[0] != part):
                continue  # a second guard with the same id
            text = text if isinstance(text, str) else ""
            mine = fp(text)
            if last is not None and last[0] == part:
                out.append(row(last, text, mine))
            last = None if guard else (part, None if pd.isna(ident) else int(ident), text, mine)
        frame = pd.DataFrame(out, columns=columns)
        frame["id"] = nullable([r[0] for r in out])
        yield frame


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its text with the last half replaced from the next row, and their likeness."""
    ship(docs.sparkSession)
    return ranges_by_id(docs, key, text).mapInPandas(
        _with_next, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _blocks(radius: int) -> tuple[list[tuple[int, int]], int]:
    """(first bit, end) of each block, and the bits by which one of them differs at most if all differ by ``radius``."""
    off = 0 if radius < 4 else 1
    n = radius // (off + 1) + 1
    ends = [round(BITS * k / n) for k in range(n + 1)]
    return list(zip(ends, ends[1:])), off


def _front(hi: str, lo: str, a: int, b: int) -> F.Column:
    """The bits from a to b, the first bit counted from the left of ``hi``."""
    low = F.lit((1 << b - a) - 1)
    if b <= 64:
        return F.shiftrightunsigned(hi, 64 - b).bitwiseAND(low)
    right = F.shiftrightunsigned(lo, 128 - b)
    return (right if a >= 64 else F.shiftleft(hi, b - 64).bitwiseOR(right)).bitwiseAND(low)


def permuted_tables(fps: DataFrame, radius: int, probes: bool = False) -> DataFrame:
    """(table, front, hi, lo): in each table another block stands in front; ``probes``: with each front that differs from it by the bits allowed."""
    blocks, off = _blocks(radius)

    def fronts(table: int, a: int, b: int) -> F.Column:
        own = _front("hi", "lo", a, b)
        found = F.array(own, *[own.bitwiseXOR(F.lit(1 << k)) for k in range(b - a if probes and off else 0)])
        return F.transform(found, lambda x: F.struct(F.lit(table).alias("table"), x.alias("front")))

    half = lambda at: F.conv(F.substring("fingerprint", at, 16), 16, -10).cast("long")
    halves = fps.select(half(1).alias("hi"), half(17).alias("lo"))
    tables = F.flatten(F.array(*[fronts(k, a, b) for k, (a, b) in enumerate(blocks)]))
    return halves.select("hi", "lo", F.explode(tables).alias("x")).select("x.table", "x.front", "hi", "lo")


def near(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, distance) for all different fingerprints within the radius of a query's; the query itself is left out."""
    blocks, off = _blocks(radius)
    q = permuted_tables(queries.select("fingerprint").distinct(), radius, True).withColumnsRenamed({"hi": "q_hi", "lo": "q_lo", "table": "q_table", "front": "q_front"})
    a = permuted_tables(fps.select("fingerprint").distinct(), radius)
    far = F.bit_count(F.col("q_hi").bitwiseXOR(F.col("hi"))) + F.bit_count(F.col("q_lo").bitwiseXOR(F.col("lo")))
    agree = [F.bit_count(_front("q_hi", "q_lo", *x).bitwiseXOR(_front("hi", "lo", *x))) <= off for x in blocks]
    first = F.when(agree[0], 0)
    for k, x in enumerate(agree[1:], 1):
        first = first.when(x, k)
    # a pair that meets in several tables counts in the first; the planner sees the fingerprints but not their many probes, so it would broadcast them
    pairs = q.hint("merge").join(a, (F.col("q_table") == F.col("table")) & (F.col("q_front") == F.col("front")) & (far <= radius) & (far > 0) & (first == F.col("table")))
    text = lambda hi, lo: F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))
    return pairs.select(text("q_hi", "q_lo").alias("query"), text("hi", "lo").alias("fingerprint"), far.alias("distance"))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """With ``n_near``: how many other fingerprints lie within the radius, for the query set of ids divisible by 20."""
    fps = written(with_next(table(spark, sf_dir, "documents")), "simhash")
    counts = near(fps.where(F.col("id") % 20 == 0), fps).groupBy("query").agg(F.count("*").alias("n"))
    asked = fps.join(counts, F.col("fingerprint") == F.col("query"), "left")
    return asked.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                        "near_next", F.when(F.col("id") % 20 == 0, F.coalesce("n", F.lit(0))).cast("long").alias("n_near"))
