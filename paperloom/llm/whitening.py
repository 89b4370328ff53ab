"""Whitening by the exact characteristic polynomial of the integer scatter matrix.

The scatter is summed in whole numbers. Its characteristic polynomial is found
modulo many primes, each by a reduction to Hessenberg form, and put together by
the Chinese remainder theorem. All its roots are real, so the sign changes of
its coefficients around a point count the roots above that point exactly; the
eigenvalues are isolated by these counts and then narrowed down. Components
are null vectors of the scatter less the eigenvalue, by inverse iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.session import materialise, spread

SCALE = 64.0
COMPONENTS = 32
PRIME_TOP = 1 << 31  # products of two residues stay below 2**62
ROOT_BITS = 128  # the largest root has at least as many binary digits in front of the place where bisection ends
LIMB_BITS = 40  # exact sums travel as four bigint limbs; 2**23 partial sums add up without overflow
ENTRY_TOP = float(1 << 62)  # larger entries count as this, so that every one is a bigint
EXACT_DOUBLE = 1 << 53
BATCH_ROWS = 4096
CLOSE = 1e-9  # eigenvalues nearer than this share of the largest one: their vectors are kept at right angles
Real = np.longdouble


@dataclass(frozen=True)
class Whitening:
    """Fitted components of vectors of one length."""

    n: int
    sums: list[int]  # by dimension, of floor(64 c)
    axes: np.ndarray  # dimension x component, unit columns, by falling eigenvalue
    values: np.ndarray  # eigenvalues of the covariance
    shares: np.ndarray  # of its trace


def whole_entries(batch: pa.Array, dim: int) -> np.ndarray:
    """floor(64 c) of a list column as rows of int64; the constant added to each cancels in every difference."""
    entries = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.clip(np.floor(SCALE * entries), -ENTRY_TOP, ENTRY_TOP).astype("int64")


def exact_products(rows: np.ndarray) -> np.ndarray:
    """rows.T @ rows in Python's whole numbers, whatever their size."""
    largest = max(1, -int(rows.min(initial=0)), int(rows.max(initial=0)))
    fits = min(EXACT_DOUBLE // (largest * largest), BATCH_ROWS)
    if not fits:
        wide = rows.astype(object)
        return wide.T @ wide
    total = np.zeros((rows.shape[1], rows.shape[1]), object)
    for start in range(0, len(rows), fits):
        part = rows[start : start + fits].astype("float64")  # sums below 2**53 are exact in a double
        total = total + (part.T @ part).astype("int64").astype(object)
    return total


def scatter(vectors: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums by dimension and n^2 times the covariance, all exact; dim^2 numbers come to the driver."""
    mask = (1 << LIMB_BITS) - 1
    limbs = [f"l{k}" for k in range(4)]
    upper = np.triu_indices(dim + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            rows = whole_entries(batch.column(0), dim)
            for start in range(0, len(rows), BATCH_ROWS):
                part = rows[start : start + BATCH_ROWS]
                total = total + exact_products(np.column_stack([np.ones(len(part), "int64"), part]))
        sums = total[upper].tolist()
        parts = [pa.array([(v >> (LIMB_BITS * k)) & mask for v in sums], pa.int64()) for k in range(3)]
        parts.append(pa.array([v >> (3 * LIMB_BITS) for v in sums], pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *parts], ["i", "j", *limbs])

    partial = vectors.mapInArrow(add, "i int, j int, " + ", ".join(f"{c} long" for c in limbs))
    found = [[0] * (dim + 1) for _ in range(dim + 1)]
    for row in partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect():
        value = sum(row[c] << (LIMB_BITS * k) for k, c in enumerate(limbs))
        found[row["i"]][row["j"]] = found[row["j"]][row["i"]] = value
    n, sums = found[0][0], found[0][1:]
    spreads = [[n * found[i + 1][j + 1] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    return n, sums, spreads


def is_prime(number: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 3.2e9."""
    odd, twos = number - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, number)
        if x in (1, number - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % number
            if x == number - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2**31, from the top, whose product exceeds `bound`."""
    found, product, number = [], 1, PRIME_TOP - 1
    while product <= bound:
        if is_prime(number):
            found.append(number)
            product *= number
        number -= 2
    return found


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Characteristic polynomial modulo a prime, constant term first: Hessenberg form, then its recurrence."""
    dim = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], "int64")
    for k in range(1, dim - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    polys = np.zeros((dim + 1, dim + 1), "int64")  # row k: of the leading k x k part
    polys[0, 0] = 1
    for k in range(1, dim + 1):
        column = h[:k, k - 1].copy()
        chain = 1
        for i in range(k - 2, -1, -1):  # products of the entries below the diagonal
            chain = chain * int(h[i + 1, i]) % p
            column[i] = column[i] * chain % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (polys[:k] * column[:, None] % p).sum(axis=0)) % p
    return polys[dim].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, constant term first, of a positive semidefinite matrix; primes are shared among tasks.

    With eigenvalues that sum to the trace t, no coefficient exceeds the one
    for equal eigenvalues, comb(d, j) (t / d)^j.
    """
    dim, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    bound = max(comb(dim, j) * (trace // dim + 1) ** j for j in range(dim + 1))
    primes = primes_for(2 * bound + 1)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = [primes[i] for i in batch.column(0).to_pylist()]
            rests = pa.array([polynomial_modulo(matrix, p) for p in asked], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), rests], ["prime", "rests"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(reduce, "prime long, rests array<long>").collect()
    product = 1
    for p in primes:
        product *= p
    total = [0] * (dim + 1)
    for row in rows:
        p = row["prime"]
        others = product // p
        unit = others * pow(others % p, -1, p)
        total = [(t + unit * r) % product for t, r in zip(total, row["rests"])]
    return [t - product if 2 * t > product else t for t in total]


def roots_above(poly: list[int], point: int) -> int:
    """Roots greater than `point` of a polynomial with real roots only: sign changes of its expansion there."""
    shifted = poly[::-1]  # highest first
    size = len(shifted)
    for end in range(size, 1, -1):
        for i in range(1, end):
            shifted[i] += point * shifted[i - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_at(poly: list[int], point: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * point + c
    return value


def largest_roots(poly: list[int], wanted: int) -> tuple[list[tuple[int, int]], int]:
    """The `wanted` largest roots, falling, as (root, how often), and the binary places they are multiplied by.

    A root is the upper end of an interval of length one that holds it. Roots
    that share such an interval count as one root.
    """
    dim = len(poly) - 1
    top = max(1, -poly[-2])  # no root of a positive semidefinite matrix exceeds the trace
    places = max(ROOT_BITS // 2, ROOT_BITS - top.bit_length())
    scaled = [c << (places * (dim - j)) for j, c in enumerate(poly)]
    found: list[tuple[int, int]] = []
    waiting = [(-1, top << places, dim, 0)]  # (low, high], roots above either end; the highest interval is taken first
    while waiting:
        low, high, above_low, above_high = waiting.pop()
        if above_low == above_high or above_high >= wanted:
            continue
        if above_low - above_high == 1:
            while high - low > 1:  # beside its only root the sign tells on which side a point is
                mid = (low + high) // 2
                sign = value_at(scaled, mid)
                if not sign or (sign < 0) == bool(above_high % 2):
                    high = mid
                else:
                    low = mid
        if high - low == 1:
            found.append((high, above_low - above_high))
            continue
        mid = (low + high) // 2
        above = roots_above(scaled, mid)
        waiting += [(low, mid, above_low, above), (mid, high, above, above_high)]
    return found, places


def to_real(value: int) -> np.longdouble:
    """An integer as the widest float of the machine, correct beyond 64 bits."""
    drop = max(0, value.bit_length() - 106)
    kept = abs(value) >> drop
    real = Real(float(kept >> 53)) * Real(float(1 << 53)) + Real(float(kept & ((1 << 53) - 1)))
    return np.ldexp(-real if value < 0 else real, drop)


def null_vectors(matrix: np.ndarray, starts: np.ndarray, known: list[np.ndarray]) -> list[np.ndarray]:
    """Unit vectors that a nearly singular matrix sends to almost nothing, at right angles to `known`.

    Entries are shares of twice the trace at most, so a pivot below the machine's precision is none.
    """
    lu, dim = matrix.copy(), len(matrix)
    order = np.arange(dim)
    tiny = np.finfo(Real).eps
    for k in range(dim):
        pivot = k + int(np.argmax(np.abs(lu[k:, k])))
        if pivot != k:
            lu[[k, pivot]] = lu[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
        if abs(lu[k, k]) < tiny:
            lu[k, k] = tiny
        lu[k + 1 :, k] /= lu[k, k]
        lu[k + 1 :, k + 1 :] -= lu[k + 1 :, k : k + 1] * lu[k, k + 1 :]
    found: list[np.ndarray] = []
    for start in starts:
        x = start.astype(Real)
        for _ in range(4):
            x = x[order]
            for k in range(1, dim):
                x[k] -= (lu[k, :k] * x[:k]).sum()
            for k in range(dim - 1, -1, -1):
                x[k] = (x[k] - (lu[k, k + 1 :] * x[k + 1 :]).sum()) / lu[k, k]
            x /= np.abs(x).max()
            for _ in range(2):
                for other in known + found:
                    x -= (other * x).sum() * other
            x /= np.sqrt((x * x).sum())
        found.append(x if x[np.argmax(np.abs(x))] > 0 else -x)
    return found


def components(matrix: list[list[int]], poly: list[int], n: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Axes, eigenvalues of the covariance and their shares of its trace for the largest eigenvalues above zero."""
    dim = len(matrix)
    zeros = next(j for j, c in enumerate(poly) if c)  # exactly the eigenvalues that are zero
    wanted = min(limit, dim - zeros)
    trace = sum(row[i] for i, row in enumerate(matrix))
    found, places = largest_roots(poly, wanted) if wanted else ([], 0)
    size = trace.bit_length()
    real = np.array([[to_real(v) for v in row] for row in matrix], Real).reshape(dim, dim)
    real = np.ldexp(real, -size)
    axes: list[np.ndarray] = []
    values, shares = [], []
    rng = np.random.default_rng(0)
    for root, times in found:
        shifted = real.copy()
        for i in range(dim):
            shifted[i, i] = np.ldexp(to_real((matrix[i][i] << places) - root), -size - places)
        value = float(Fraction(root, (n * n) << places))
        near = [a for a, v in zip(axes, values) if v - value <= CLOSE * values[0]]
        axes += null_vectors(shifted, rng.standard_normal((times, dim)), near)
        values += [value] * times
        shares += [float(Fraction(root, trace << places))] * times
    held = np.array(axes[:wanted], "float64").reshape(-1, dim).T
    return held, np.array(values[:wanted]), np.array(shares[:wanted])


def fit_whitening(vectors: DataFrame, dim: int, limit: int = COMPONENTS) -> Whitening:
    """Fit the components of one column of vectors of length `dim`."""
    n, sums, spreads = scatter(vectors, dim)
    poly = characteristic_polynomial(vectors.sparkSession, spreads)
    axes, values, shares = components(spreads, poly, n, limit)
    return Whitening(n, sums, axes, values, shares)


def apply_whitening(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array) of rows (vec_id, v)."""
    dim, n = len(model.sums), model.n
    factors = model.axes / np.sqrt(model.values)
    largest_sum = max(map(abs, model.sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                y = whole_entries(part.column(1), dim)
                reach = n * max(-int(y.min(initial=0)), int(y.max(initial=0))) + largest_sum
                exact = y if reach < 1 << 62 else y.astype(object)
                centred = exact * n - np.array(model.sums, exact.dtype)
                wide = centred if reach * reach * dim < 1 << 62 else centred.astype(object)
                deviation = [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1).tolist()]
                z = (centred / n).astype("float64") @ factors
                lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype="int32") * z.shape[1], z.ravel())
                columns = [part.column(0), pa.array(deviation, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "white"])

    return rows.mapInArrow(project, "vec_id long, deviation long, white array<double>")


def identity_error(white: DataFrame, n: int, size: int) -> float:
    """Largest entry of the covariance of the whitened vectors less the identity, measured on all of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for start in range(0, len(z), BATCH_ROWS):
                part = z[start : start + BATCH_ROWS]
                part = np.column_stack([np.ones(len(part)), part])
                total += part.T @ part
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((size + 1, size + 1))
    for row in white.select("white").mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[row["i"], row["j"]] = row["v"]
    mean = total[0, 1:] / n  # nothing but rounding: the vectors were centred exactly
    return float(np.abs(total[1:, 1:] / n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", limit: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every vector: one row for each of its `limit` largest components.

    Entries are x = floor(64 c) + 1000000. Returns vec_id, component (from 1, by
    falling eigenvalue), n (vectors fitted), deviation (sum of (n x - S)^2 over
    the dimensions, exact; null where no bigint holds it), whitened, explained
    (share of the trace) and identity_error (one value for all rows of a length).

    Null vectors and vectors with a null or non-finite entry take no part;
    empty vectors have no components. Vectors of each length are a fit of their
    own. Eigenvalues that are exactly zero give no component, so vectors that
    are all alike, or one alone, give no rows. Components with equal
    eigenvalues are any orthonormal set of their space. Repeated rows and ids
    count as often as they occur; a null id stays null. An empty table gives no
    rows; other columns are not read. Entries beyond 2**62 / 64 count as that.
    """
    spark = rows.sparkSession
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = rows.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(~bad)
    picked = spread(usable.select(F.col(id_col).cast("long").alias("vec_id"), wide.alias("v")), "vec_id")
    lengths = [r["dim"] for r in picked.groupBy(F.size("v").alias("dim")).agg(F.lit(1)).collect()]
    parts = []
    for dim in sorted(lengths):
        own = picked.where(F.size("v") == dim)
        model = fit_whitening(own.select("v"), dim, limit)
        if not len(model.values):
            continue
        white = materialise(apply_whitening(own, model), "whitened")
        error = identity_error(white, model.n, len(model.values))
        shares = F.array(*[F.lit(float(s)) for s in model.shares])
        long = white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
        parts.append(
            long.select(
                "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                "deviation", "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"),
                F.lit(error).alias("identity_error"),
            )
        )
    if not parts:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
