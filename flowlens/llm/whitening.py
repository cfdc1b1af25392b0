"""Embedding whitening from the exact characteristic polynomial.

Entries become integers (``floor(64 * c) + 1000000``), so the scatter matrix
``n * sum(x x') - S S'`` of the distinct vectors is an integer matrix, n**2 times
their covariance, and every step up to the eigenvalues is exact:

1. scatter: each task multiplies its vectors as 20-bit limbs in floating point,
   where sums below 2**53 are exact, and gives base-2**40 digits that Spark sums;
2. characteristic polynomial modulo enough 31-bit primes (one batch of primes a
   task): Hessenberg form by similarity, then the recurrence over its leading
   minors; the coefficients follow by Chinese remaindering, their size being
   bounded by Maclaurin's inequality for a positive semi-definite matrix;
3. real roots: all roots are real, so the sign changes of p(x + a) count exactly
   the roots above a, with multiplicity; bisection on a grid of 2**-t, one root a
   task, gives each of the leading ones to :data:`ROOT_BITS` bits;
4. components: the null space of (matrix - root) by inverse iteration in
   fixed-point integers of :data:`FIXED_BITS` bits; roots closer than
   :data:`CLUSTER_BITS` bits are taken as a block, orthogonalised, and parted by
   the projected matrix;
5. projection of all rows, and of the distinct ones once more for
   ``identity_error``.

The driver sees matrices of the dimension only (its square in entries, one row
per prime and coefficient).  The distinct vectors are taken by a partial
aggregate, so a vector held by a third of all rows is one row a task.

Edge cases: rows whose vector is null, empty, or holds a null, NaN or infinity
are dropped, and so are vectors of another length than the commonest (the longer
one of a tie); 64 * c is held within 2**62 either way; null and repeated
``vec_id`` are rows of their own; components end at the rank of the scatter, so
equal vectors only, one vector or an empty table give no rows; ``deviation`` is
null where it is over a long; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LIMB, ROWS = 20, 1 << 12
DIGIT = 40
PRIMES_PER_TASK = 8
ROOT_BITS, FIXED_BITS, CLUSTER_BITS = 80, 384, 36
OUT = ("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


# ------------------------------------------------------------------ integers

def integers(emb: DataFrame) -> DataFrame:
    """``vec_id, x``: the remaining rows, entries as longs without the shift
    (which no result depends on)."""
    sound = F.forall("__e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = emb.select("vec_id", F.col("embedding").cast("array<double>").alias("__e"))
    rows = rows.where(F.col("__e").isNotNull()).where((F.size("__e") > 0) & sound)
    sizes = rows.groupBy(F.size("__e").alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    top = sizes.orderBy(F.desc("__n"), F.desc("__d")).limit(1).collect()
    dim = top[0]["__d"] if top else 0
    held = float(1 << 62)
    whole = F.transform("__e", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(held)), F.lit(-held))).cast("bigint"))
    return rows.where(F.size("__e") == dim).select("vec_id", whole.alias("x"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed limbs of LIMB bits, lowest first, as floats."""
    out, half = [], 1 << (LIMB - 1)
    while True:
        low = ((y + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(float))
        y = (y - low) >> LIMB
        if not y.any():
            return out


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            y = _matrix(b["x"].slice(at, ROWS))
            limbs = _limbs(np.concatenate([y, np.ones((len(y), 1), np.int64)], axis=1))
            if total is None:
                total = np.zeros((y.shape[1] + 1,) * 2, object)
            for i, p in enumerate(limbs):
                for j, q in enumerate(limbs):
                    total += (p.T @ q).astype(np.int64).astype(object) << LIMB * (i + j)
    if total is None:
        return
    digits = []
    while total.any():
        digits.append((total & ((1 << DIGIT) - 1)).astype(np.int64))
        total = total >> DIGIT
        if (total == -1).all() or all(v in (0, -1) for v in total.flat):
            digits[-1] += total.astype(np.int64) << DIGIT
            break
    d = len(total)
    i, j = np.divmod(np.arange(d * d, dtype=np.int32), d)
    for k, v in enumerate(digits):
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(np.full(d * d, k, np.int32)),
                                          pa.array(v.reshape(-1))], ["i", "j", "k", "v"])


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums and the integer scatter matrix of the fit list."""
    cells = (fit.mapInArrow(_scatter, "i int, j int, k int, v bigint").groupBy("i", "j", "k")
             .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())
    if not cells:
        return 0, [], []
    d = max(r["i"] for r in cells)
    q = [[0] * (d + 1) for _ in range(d + 1)]
    for r in cells:
        q[r["i"]][r["j"]] += int(r["v"]) << DIGIT * r["k"]
    n, s = q[d][d], q[d][:d]
    return n, s, [[n * q[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)]


# ---------------------------------------------------- characteristic polynomial

def primes(count: int) -> list[int]:
    """The largest primes under 2**31."""
    small = [2, 3, 5, 7]

    def prime(x: int) -> bool:
        d, r = x - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        for a in small:  # enough below 3.2e9
            v = pow(a, d, x)
            if v not in (1, x - 1) and all((v := v * v % x) != x - 1 for _ in range(r - 1)):
                return False
        return True
    out, x = [], (1 << 31) - 1
    while len(out) < count:
        if prime(x):
            out.append(x)
        x -= 2
    return out


def charpoly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - M) modulo p, constant first."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(1, d - 1):
        at = np.flatnonzero(h[k:, k - 1])
        if not len(at):
            continue
        i = k + int(at[0])
        if i != k:
            h[[k, i]] = h[[i, k]]
            h[:, [k, i]] = h[:, [i, k]]
        f = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - f[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * f % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(d):
        weight, run = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):  # h[i, k] times the subdiagonal below it
            weight[i] = int(h[i, k]) * run % p
            run = run * int(h[i, i - 1]) % p if i else run
        poly[k + 1, 1:] = poly[k, :-1]
        poly[k + 1] = (poly[k + 1] - (weight[:, None] * poly[:k + 1] % p).sum(axis=0)) % p
    return poly[d].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact polynomial of a positive semi-definite integer matrix."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bits = max(math.log2(math.comb(d, k)) + k * (math.log2(trace) - math.log2(d)) for k in range(d + 1)) if trace else 0
    ps = primes(int(bits + 8) // 30 + 1)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.array(shared.value, object)
        for b in batches:
            for p in b["p"].to_pylist():
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64()), "c": pa.array(
                    [charpoly_mod(m, p)], pa.list_(pa.int64()))})
    tasks = -(-len(ps) // PRIMES_PER_TASK)
    todo = spark.createDataFrame([(p,) for p in ps], "p bigint").repartition(tasks)
    found = todo.mapInArrow(run, "p bigint, c array<bigint>").collect()
    modulus = math.prod(ps)
    coefs = [0] * (d + 1)
    for r in found:
        part = modulus // r["p"]
        lift = part * pow(part, -1, r["p"])
        coefs = [(c + v * lift) % modulus for c, v in zip(coefs, r["c"])]
    return [c - modulus if c > modulus // 2 else c for c in coefs]


# ------------------------------------------------------------------- real roots

def above(poly: list[int], a: int) -> int:
    """How many roots of a real-rooted polynomial lie above ``a``: the sign
    changes of p(x + a), by repeated synthetic division."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(s != t for s, t in zip(signs, signs[1:]))


def scaled(poly: list[int], t: int) -> list[int]:
    """The polynomial whose roots are 2**t times those of ``poly``."""
    d = len(poly) - 1
    return [c << t * (d - i) for i, c in enumerate(poly)]


def root(poly: list[int], k: int, top: int) -> tuple[int, int]:
    """``a, t``: the k-th largest root (positive, at most ``top``) lies in
    (a, a + 1] / 2**t, with a of ROOT_BITS bits or more."""
    t, low, high = 0, 0, top
    while True:
        q = scaled(poly, t)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if above(q, mid) >= k else (low, mid)
        if low.bit_length() >= ROOT_BITS:
            return low, t
        more = ROOT_BITS - low.bit_length() + 1
        t, low, high = t + more, low << more, high << more


def roots(spark: SparkSession, poly: list[int], count: int, top: int) -> list[tuple[int, int]]:
    shared = spark.sparkContext.broadcast((poly, top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefs, most = shared.value
        for b in batches:
            for k in b["k"].to_pylist():
                a, t = root(coefs, k, most)
                yield pa.RecordBatch.from_pydict({"k": [k], "a": [str(a)], "t": [t]})
    todo = spark.createDataFrame([(k,) for k in range(1, count + 1)], "k bigint").repartition(count, "k")
    found = todo.mapInArrow(run, "k bigint, a string, t bigint").collect()
    return [(int(r["a"]), r["t"]) for r in sorted(found, key=lambda r: r["k"])]


# ------------------------------------------------------------------- components

def _factor(a: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """LU with partial pivoting of a fixed-point matrix; zero pivots become
    the least number."""
    a, order = a.copy(), []
    d = len(a)
    for k in range(d):
        i = max(range(k, d), key=lambda r: abs(a[r, k]))
        order.append(i)
        if i != k:
            a[[k, i]] = a[[i, k]]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < d:
            a[k + 1:, k] = (a[k + 1:, k] << FIXED_BITS) // a[k, k]
            a[k + 1:, k + 1:] -= (a[k + 1:, k:k + 1] * a[k:k + 1, k + 1:]) >> FIXED_BITS
    return a, order


def _solve(lu: np.ndarray, order: list[int], w: np.ndarray) -> np.ndarray:
    w = w.copy()
    d = len(w)
    for k, i in enumerate(order):
        if i != k:
            w[k], w[i] = w[i], w[k]
    # Rows were swapped as a whole, so all swaps come first.
    for k in range(d - 1):
        w[k + 1:] -= (lu[k + 1:, k] * w[k]) >> FIXED_BITS
    for k in range(d - 1, -1, -1):
        w[k] = (w[k] << FIXED_BITS) // lu[k, k]
        if k:
            w[:k] -= (lu[:k, k] * w[k]) >> FIXED_BITS
    return w


def _orthonormal(vectors: list[np.ndarray]) -> list[np.ndarray]:
    """Gram-Schmidt, twice, in fixed point."""
    out: list[np.ndarray] = []
    for v in vectors:
        for _ in range(2):
            length = max(1, math.isqrt(int((v * v).sum())))
            v = (v << FIXED_BITS) // length
            for u in out:
                v = v - ((u * (int((u * v).sum()) >> FIXED_BITS)) >> FIXED_BITS)
        length = max(1, math.isqrt(int((v * v).sum())))
        out.append((v << FIXED_BITS) // length)
    return out


def null_space(matrix: list[list[int]], a: int, t: int, size: int) -> list[list[float]]:
    """``size`` unit vectors, by falling eigenvalue, for the ``size`` roots that
    follow one another closely from a / 2**t down."""
    d = len(matrix)
    m = np.array(matrix, object)
    lean = (m << t) - a * np.eye(d, dtype=int).astype(object)
    bits = max(1, max(abs(v) for v in lean.flat).bit_length())
    fixed = lean << (FIXED_BITS - bits) if bits <= FIXED_BITS else lean >> (bits - FIXED_BITS)
    lu, order = _factor(fixed)
    rng = np.random.default_rng(d)
    block = [np.array([int(x) for x in rng.integers(1, 1 << 40, d)], object) << (FIXED_BITS - 40) for _ in range(size)]
    for _ in range(5):
        block = _orthonormal([_solve(lu, order, v) for v in block])
    if size > 1:  # part the block by the projected matrix
        q = np.stack(block)
        small = [[int(((q[i] @ fixed) * q[j]).sum() >> FIXED_BITS) for j in range(size)] for i in range(size)]
        unit = max(1, max(abs(v) for r in small for v in r))
        values, turn = np.linalg.eigh(np.array([[v / unit for v in r] for r in small]))
        turn = turn[:, np.argsort(-values)]
        mixed = [sum(q[i] * int(turn[i, j] * (1 << 60)) for i in range(size)) >> 60 for j in range(size)]
        block = _orthonormal(mixed)
    one = 1 << FIXED_BITS
    out = []
    for v in block:
        x = [int(c) / one for c in v]
        lead = max(range(d), key=lambda i: (abs(x[i]), -i))
        out.append([-c for c in x] if x[lead] < 0 else x)
    return out


def clusters(found: list[tuple[int, int]]) -> list[list[int]]:
    """Places of roots that follow one another within CLUSTER_BITS bits."""
    value = [Fraction(a, 1 << t) for a, t in found]
    out: list[list[int]] = []
    for k, v in enumerate(value):
        if k and value[k - 1] - v <= value[k - 1] / (1 << CLUSTER_BITS):
            out[-1].append(k)
        else:
            out.append([k])
    return out


def components(spark: SparkSession, matrix: list[list[int]], found: list[tuple[int, int]]) -> list[list[float]]:
    shared = spark.sparkContext.broadcast(matrix)
    groups = clusters(found)
    jobs = [(g[0], str(found[g[-1]][0]), found[g[-1]][1], len(g)) for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                vectors = null_space(shared.value, int(r["a"]), r["t"], r["size"])
                yield pa.RecordBatch.from_pydict({
                    "k": pa.array([r["k"] + i for i in range(len(vectors))], pa.int64()),
                    "v": pa.array(vectors, pa.list_(pa.float64()))})
    todo = spark.createDataFrame(jobs, "k bigint, a string, t bigint, size bigint").repartition(len(jobs), "k")
    rows = todo.mapInArrow(run, "k bigint, v array<double>").collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["k"])]


# ---------------------------------------------------------------------- model

class Whitening:
    """n, sums and the leading components of a fit list."""

    def __init__(self, n: int, sums: list[int], vectors: list[list[float]], roots_: list[Fraction], trace: int):
        self.n, self.sums = n, sums
        self.vectors = np.array(vectors, float).reshape(len(vectors), len(sums))
        self.scale = np.array([math.sqrt(r / (n * n)) for r in roots_])
        self.explained = [float(r / trace) for r in roots_]

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if most < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def apply(self, off: np.ndarray) -> np.ndarray:
        return (off.astype(float) / self.n) @ self.vectors.T / self.scale

    def deviation(self, off: np.ndarray) -> list[int | None]:
        most = int(np.abs(off).max(initial=0))
        wide = off if most * most * off.shape[1] < 1 << 63 else off.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (wide * wide).sum(axis=1)]


def fit(fit_list: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """The model of the distinct vectors, None if they have no spread."""
    spark = fit_list.sparkSession
    n, sums, matrix = scatter(fit_list)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return None
    poly = characteristic(spark, matrix)
    zeros = next(i for i, c in enumerate(poly) if c)
    found = roots(spark, poly[zeros:], min(count, len(poly) - 1 - zeros), trace + 1)
    vectors = components(spark, matrix, found)
    return Whitening(n, sums, vectors, [Fraction(2 * a + 1, 2 << t) for a, t in found], trace)


def _moments(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.value.vectors)
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                w = model.value.apply(model.value.offsets(_matrix(b["x"].slice(at, ROWS))))
                w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                total += w.T @ w
        i, j = np.divmod(np.arange((k + 1) ** 2, dtype=np.int32), k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "v"])
    return run


def identity_error(fit_list: DataFrame, model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus identity."""
    k = len(model.value.vectors)
    cells = fit_list.mapInArrow(_moments(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    q = np.zeros((k + 1, k + 1))
    for r in cells:
        q[r["i"], r["j"]] = r["v"]
    mean = q[:k, k] / q[k, k]
    return float(np.abs(q[:k, :k] / q[k, k] - np.outer(mean, mean) - np.eye(k)).max())


def _project(model, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k = len(m.vectors)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                if not part.num_rows:
                    continue
                off = m.offsets(_matrix(part["x"]))
                rows = np.repeat(np.arange(len(off)), k)
                total = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"].take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(off))),
                     pa.array(np.full(total, m.n, np.int64)),
                     pa.array(m.deviation(off), pa.int64()).take(pa.array(rows)), pa.array(m.apply(off).reshape(-1)),
                     pa.array(np.tile(m.explained, len(off))), pa.array(np.full(total, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(emb: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    spark = emb.sparkSession
    rows = integers(emb)
    fit_list = stored(rows.select("x").distinct(), "fit-list")
    schema = f"vec_id {emb.schema['vec_id'].dataType.simpleString()}, {OUT}"
    model = fit(fit_list, count)
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(_project(shared, identity_error(fit_list, shared)), schema)
