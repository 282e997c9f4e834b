"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

1. Every task adds up the products of its vectors as whole numbers; Spark sums them by entry of the matrix, in 30-bit
   limbs, so ``M = n * sum(y y') - S S'`` (n*n times the covariance) is exact whatever the order and size.
2. One row for each 31-bit prime: the tasks bring ``M`` modulo the prime into Hessenberg form and read off its
   characteristic polynomial; Chinese remaindering joins the residues (there are enough primes for the bound
   ``(1 + trace/d)^d`` on the coefficients).
3. All roots are real, so the sign changes of the polynomial moved by ``a`` count the roots above ``a`` exactly: the
   largest roots are isolated by bisection and refined to 2^-160 of their size.
4. One row for each isolated root: a task finds its null space by inverse iteration in 448-bit fixed point.
5. The vectors are projected in one pass, written, and the covariance of what was written is compared with the identity.

What passes the driver is bounded by the dimension d (the matrix, the polynomial, the components), never by the rows.

Defined cases: a vector that is null, empty, or holds null, NaN or infinite entries (or entries of 2^52 and more, whose
x would not fit) is dropped; so are vectors of another length than the most frequent one (of equally frequent ones the
longest), which have no covariance with the rest. Null and repeated ids are rows like all others. Components exist for
positive eigenvalues only: constant vectors, a single vector and an empty table give no rows. Of equal eigenvalues any
orthonormal basis is taken. ``deviation`` is null beyond 64 bits; ``deviation_text`` always holds it. Other columns of
the table are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, table, written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000   # x = floor(SCALE * entry) + SHIFT
LIMBS, LIMB_BITS = 6, 30
ROOT_BITS = 160                # a root is known to 2^-ROOT_BITS of its size
CLUSTER_BITS = 120             # roots closer than this are one root with a multiplicity
FIXED_BITS = 448               # fraction bits of the inverse iteration
LARGEST_ENTRY = 2.0 ** 52


# ---------------------------------------------------------------- integer vectors and their products
def integer_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``y`` = floor(1024 * entry) of each usable vector (x is y + 100000)."""
    bad = f"c IS NULL OR isnan(CAST(c AS DOUBLE)) OR abs(CAST(c AS DOUBLE)) >= {LARGEST_ENTRY!r}D"
    return (df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
            .filter(f"v IS NOT NULL AND size(v) > 0 AND NOT exists(v, c -> {bad})")
            .selectExpr("id", f"transform(v, c -> CAST(floor(CAST(c AS DOUBLE) * {SCALE}D) AS BIGINT)) AS y"))


def dimension(vectors: DataFrame) -> int:
    """The most frequent length; 0 without vectors."""
    top = vectors.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def matrix_of(column, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)


def add_products(total: np.ndarray, y: np.ndarray) -> None:
    """Add ``sum((1, y) (1, y)')`` to ``total``, a matrix of Python integers, without rounding."""
    wide = np.abs(y).max(axis=1) >= 2 ** 26
    small = np.hstack([np.ones((int((~wide).sum()), 1)), y[~wide].astype(np.float64)])
    if len(small):
        step = max(1, int(2 ** 53 // max(1, int(np.abs(small).max())) ** 2))  # float products and sums below 2^53 are whole
        for k in range(0, len(small), step):
            part = small[k:k + step]
            total += (part.T @ part).astype(np.int64).astype(object)
    if wide.any():
        big = np.hstack([np.ones((int(wide.sum()), 1), object), y[wide].astype(object)])
        total += big.T @ big


MOMENTS = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())]
                       + [T.StructField(f"l{k}", T.LongType()) for k in range(LIMBS)])


def moments(vectors: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, sums of products) of the vectors, exact."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d + 1, d + 1), object), False
        for b in batches:
            if b.num_rows:
                add_products(total, matrix_of(b.column(0), d))
                seen = True
        if seen:
            i, j = np.triu_indices(d + 1)
            left = total[i, j]
            limbs = []
            for _ in range(LIMBS - 1):
                limbs.append((left & ((1 << LIMB_BITS) - 1)).astype(np.int64))
                left = left >> LIMB_BITS
            limbs.append(left.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))] + [pa.array(x) for x in limbs],
                                             names=[f.name for f in MOMENTS])

    rows = (vectors.select("y").mapInArrow(partial, MOMENTS).groupBy("i", "j")
            .agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]).collect())  # (d+1)(d+2)/2 rows
    full = np.zeros((d + 1, d + 1), object)
    for r in rows:
        full[r["i"], r["j"]] = full[r["j"], r["i"]] = sum(r[f"l{k}"] << (LIMB_BITS * k) for k in range(LIMBS))
    return int(full[0, 0]), full[0, 1:].copy(), full[1:, 1:].copy()


# ---------------------------------------------------------------- the characteristic polynomial
def is_prime(p: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3,215,031,751."""
    if p % 2 == 0:
        return p == 2
    s = ((p - 1) & (1 - p)).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, (p - 1) >> s, p)
        if x in (0, 1, p - 1):
            continue
        for _ in range(s - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """Largest primes below 2^31 whose product has more than ``bits`` bits."""
    found, p, have = [], 2 ** 31 - 1, 0.0
    while have <= bits:
        if is_prime(p):
            found.append(p)
            have += math.log2(p)
        p -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of det(t - matrix) modulo the prime ``p``, by Hessenberg reduction."""
    d = len(matrix)
    h = np.array([[int(v) % p for v in row] for row in matrix], np.int64).reshape(d, d)
    for m in range(1, d - 1):
        below = np.nonzero(h[m:, m - 1])[0]
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m][None, :]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u[None, :] % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        weights, chain = np.zeros(k, np.int64), 1
        for i in range(k, 0, -1):           # polynomial of the first i - 1 rows times h[i, k] and the subdiagonal between
            weights[i - 1] = int(h[i - 1, k - 1]) * chain % p
            if i > 1:
                chain = chain * int(h[i - 1, i - 2]) % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Whole coefficients, constant first, of a positive semidefinite matrix; one Spark row for each prime."""
    d = len(matrix)
    trace = int(sum(matrix[i, i] for i in range(d)))
    bits = d * (trace // d + 2).bit_length() + 2       # the coefficients add up to (1 + trace/d)^d at most, with a sign
    primes = primes_for(bits)
    sent = spark.sparkContext.broadcast([[str(v) for v in row] for row in matrix])

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = np.array([[int(v) for v in row] for row in sent.value], object).reshape(d, d)
        for f in frames:
            yield pd.DataFrame({"p": f["p"], "c": [polynomial_mod(m, int(p)).tolist() for p in f["p"]]})

    parts = min(len(primes), 4 * max(1, spark.sparkContext.defaultParallelism))
    rows = (spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(parts)
            .mapInPandas(residues, "p bigint, c array<bigint>").collect())
    x, product = np.zeros(d + 1, object), 1
    for r in sorted(rows, key=lambda r: r["p"]):
        p, inverse = r["p"], pow(product, -1, r["p"])
        step = np.array([(c - int(v)) * inverse % p for c, v in zip(r["c"], x)], object)
        x, product = x + step * product, product * p
    return [int(v) - product if 2 * int(v) > product else int(v) for v in x]


# ---------------------------------------------------------------- its largest roots
def _scaled(poly: list[int], s: int) -> list[int]:
    """The polynomial whose roots are those of ``poly`` times 2^s."""
    d = len(poly) - 1
    return [c << (s * (d - i)) for i, c in enumerate(poly)]


def roots_above(poly: list[int], a: int, s: int) -> int:
    """Roots greater than a / 2^s, with multiplicity, of a polynomial with real roots only: sign changes after the move."""
    c = _scaled(poly, s)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, s: int) -> int:
    value, d = 0, len(poly) - 1
    for i in range(d, -1, -1):
        value = value * a + (poly[i] << (s * (d - i)))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], k: int) -> list[tuple[int, int, int]]:
    """(a, s, multiplicity): the roots a / 2^s in falling order until ``k`` positive ones are covered."""
    while len(poly) > 1 and poly[0] == 0:       # roots at zero
        poly = poly[1:]
    if len(poly) == 1:
        return []
    found, covered = [], 0
    top = max(1, abs(poly[-2])).bit_length() + 1          # all roots are below the trace
    open_ = [(0, 1 << top, 0, len(poly) - 1)]             # lower, upper, fraction bits, roots in between; greatest last
    while open_ and covered < k:
        lo, hi, s, count = open_.pop()
        narrow = lo > 0 and (hi - lo).bit_length() + CLUSTER_BITS <= lo.bit_length()
        if count > 1 and not narrow:
            lo, hi, s = 2 * lo, 2 * hi, s + 1
            mid = (lo + hi) // 2
            upper = roots_above(poly, mid, s) - roots_above(poly, hi, s)
            open_ += [(lo, mid, s, count - upper)] * (count > upper) + [(mid, hi, s, upper)] * (upper > 0)
            continue
        if count == 1:
            above = sign_at(poly, hi, s)
            while above and not (lo > 0 and (hi - lo).bit_length() + ROOT_BITS <= lo.bit_length()):
                lo, hi, s = 2 * lo, 2 * hi, s + 1
                mid = (lo + hi) // 2
                here = sign_at(poly, mid, s)
                if here == 0:
                    lo = hi = mid
                    break
                lo, hi = (lo, mid) if here == above else (mid, hi)
            if not above:
                lo = hi
        found.append((lo + hi, s + 1, count))
        covered += count
    return found


# ---------------------------------------------------------------- null spaces
def null_space(matrix: np.ndarray, a: int, s: int, m: int, bits: int = FIXED_BITS) -> np.ndarray:
    """``m`` orthonormal vectors (rows, double precision) that ``matrix`` multiplies by a / 2^s: inverse iteration in fixed point."""
    d = len(matrix)
    top = max(1, int(sum(abs(matrix[i, i]) for i in range(d)))).bit_length()
    b = np.array([[(int(v) << bits) >> top for v in row] for row in matrix], object).reshape(d, d)
    root = (a << bits) >> (top + s)
    for i in range(d):
        b[i, i] -= root
    order = list(range(d))
    for c in range(d):                                   # LU with row exchanges; factors stay below the diagonal
        r = c + max(range(d - c), key=lambda q: abs(b[c + q, c]))
        if r != c:
            b[[r, c]] = b[[c, r]]
            order[r], order[c] = order[c], order[r]
        if b[c, c] == 0:
            b[c, c] = 1
        if c + 1 < d:
            f = (b[c + 1:, c] << bits) // b[c, c]
            b[c + 1:, c + 1:] -= (f[:, None] * b[c, c + 1:][None, :]) >> bits
            b[c + 1:, c] = f
    y = np.array([[((i * 2654435761 + j * 40503 + 12345) % 65536 - 32768) << (bits - 16) for j in range(m)] for i in range(1, d + 1)], object)
    for _ in range(3):
        y = y[order]
        for c in range(d):
            y[c + 1:] -= (b[c + 1:, c][:, None] * y[c][None, :]) >> bits
        for c in range(d - 1, -1, -1):
            y[c] = (y[c] << bits) // b[c, c]
            y[:c] -= (b[:c, c][:, None] * y[c][None, :]) >> bits
        for j in range(m):                               # orthonormal again
            y[:, j] = unit(y[:, j], bits)
            for q in range(j):
                y[:, j] -= (y[:, q] * (sum(y[:, q] * y[:, j]) >> bits)) >> bits
            y[:, j] = unit(y[:, j], bits)
    out = np.array([[int(v) / (1 << bits) for v in y[:, j]] for j in range(m)])
    return out * np.sign(out[np.arange(m), np.abs(out).argmax(axis=1)])[:, None]


def unit(v: np.ndarray, bits: int) -> np.ndarray:
    """``v`` divided by its length, in fixed point."""
    length = math.isqrt(sum(int(x) * int(x) for x in v))
    return np.array([(int(x) << bits) // length if length else 0 for x in v], object)


def eigenvectors(spark: SparkSession, matrix: np.ndarray, roots: list[tuple[int, int, int]]) -> list[list[float]]:
    """Unit eigenvectors in the order of ``roots``; one Spark row for each root."""
    d = len(matrix)
    sent = spark.sparkContext.broadcast([[str(v) for v in row] for row in matrix])

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = np.array([[int(v) for v in row] for row in sent.value], object).reshape(d, d)
        for f in frames:
            yield pd.DataFrame({"k": f["k"], "v": [null_space(m, int(a), int(s), int(n)).tolist() for a, s, n in zip(f["a"], f["s"], f["n"])]})

    rows = (spark.createDataFrame([(i, str(a), s, n) for i, (a, s, n) in enumerate(roots)], "k int, a string, s int, n int")
            .repartition(len(roots), "k").mapInPandas(solve, "k int, v array<array<double>>").collect())
    return [list(v) for r in sorted(rows, key=lambda r: r["k"]) for v in r["v"]]


# ---------------------------------------------------------------- whitening
def _projected(vectors: DataFrame, id_type: T.DataType, d: int, n: int, sums: list[int], axes: np.ndarray) -> DataFrame:
    schema = T.StructType([T.StructField("id", id_type), T.StructField("deviation", T.LongType()), T.StructField("deviation_text", T.StringType()),
                           T.StructField("w", T.ArrayType(T.DoubleType()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = matrix_of(b.column(1), d)
            reach = n * (int(np.abs(y).max()) + 1) + max(abs(v) for v in sums)
            whole = reach * reach * d < 2 ** 63
            t = n * y - np.array(sums, np.int64) if whole else n * y.astype(object) - np.array(sums, object)[None, :]
            dev = [int(v) for v in (t * t).sum(axis=1)]
            centred = t / n if whole else (t / n).astype(np.float64)
            w = centred @ axes.T
            flat = pa.array(np.ascontiguousarray(w).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([v if v < 2 ** 63 else None for v in dev], pa.int64()), pa.array([str(v) for v in dev]), lists],
                names=schema.names)

    return vectors.select("id", "y").mapInArrow(project, schema)


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest absolute entry of (covariance of ``w``, divisor n, centred before multiplying) minus the identity."""
    mean = rows.agg(*[F.avg(F.get("w", F.lit(i))).alias(f"m{i}") for i in range(k)]).first()
    centred = [F.get("w", F.lit(i)) - F.lit(mean[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = rows.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(cov, pairs))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error, deviation_text."""
    spark = df.sparkSession
    ship(spark)
    vectors = integer_vectors(df, id_col, vector_col)
    id_type = vectors.schema["id"].dataType
    result = T.StructType([T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
                           T.StructField("deviation_text", T.StringType())])
    d = dimension(vectors)
    if not d:
        return spark.createDataFrame([], result)
    vectors = vectors.filter(F.size("y") == d)
    n, sums, products = moments(vectors, d)
    matrix = n * products - sums[:, None] * sums[None, :]
    common = math.gcd(*[int(v) for v in matrix.ravel()])
    if not common:
        return spark.createDataFrame([], result)
    matrix = matrix // common
    roots = largest_roots(characteristic_polynomial(spark, matrix), components)
    axes = eigenvectors(spark, matrix, roots)[:components]
    values = [(a * common, s) for a, s, m in roots for _ in range(m)][:components]    # eigenvalues of n * n * covariance
    trace = int(sum(matrix[i, i] for i in range(d))) * common
    explained = [a / (trace << s) for a, s in values]
    deviations = [math.sqrt(a / ((n * n) << s)) for a, s in values]
    scaled = np.array([np.array(v) / e for v, e in zip(axes, deviations)])
    rows = written(_projected(vectors, id_type, d, n, [int(v) for v in sums], scaled), "whitened")
    error = identity_error(rows, len(axes))
    shares = F.array(*[F.lit(e) for e in explained])
    return (rows.select("id", "deviation", "deviation_text", F.posexplode("w").alias("k", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
                    "deviation_text"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their 8 strongest components."""
    return whiten(table(spark, sf_dir, "embeddings"))
