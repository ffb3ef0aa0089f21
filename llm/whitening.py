"""Whitening of embeddings with the exact characteristic polynomial of their integer scatter matrix.

1. Each component c becomes the integer x = floor(1024 c) + 100000. Tasks sum the vectors, then the products of the
   vectors less the rounded means; all sums are whole numbers, exact. What the sums leave out of the centring
   is corrected exactly: scatter C = n * sum z z' - t t', t = sum z, is n^2 times the covariance.
2. The characteristic polynomial of C: per prime, one Spark row reduces C to Hessenberg form and runs the
   recurrence for its polynomial; the Chinese remainder theorem joins the residues to the integer coefficients.
3. All roots of it are real, so the sign changes of its coefficients after a shift by a count the roots above a
   exactly (Budan and Fourier). Bisection with that count isolates the largest roots, sign changes refine them.
4. Inverse iteration with the shifted matrix in decimal arithmetic gives each root's unit vector.

The driver holds the matrix (dimension squared), its polynomial and one residue vector per prime; vectors stay
in tasks. Primes needed: about dimension * log2(norm of C) / 31.

Defined results: vectors that are null, or hold null or non-finite components, are dropped, and so are those
whose length isn't the commonest one (the larger of equally common ones). Components with eigenvalue 0 can't be whitened and are left out,
so fewer than ``components`` come from few or equal vectors, and no rows at all from an empty table. Repeated rows
and ties count and return like any other row; only the named columns are read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
# Roots are isolated to this many bits beyond the largest one's, and components solved with these digits.
ROOT_BITS, DIGITS = 192, 120
LARGEST_PRIME = 2**31 - 1
EXACT_DOUBLE = 2**53


# --- sums over the vectors -----------------------------------------------------------------------


def cleaned(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of usable vectors, as doubles."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), v.alias("v"))
    usable = F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.coalesce(usable, F.lit(False)))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 as longs; a component too large for that is an error."""
    floored = np.floor(SCALE * values)
    if floored.size and np.abs(floored).max() >= 2**62:
        raise ValueError("a component doesn't fit a long")
    return floored.astype(np.int64) + OFFSET


def _product(a: np.ndarray) -> np.ndarray:
    """a' a of a whole-number matrix, exact: in doubles while every sum fits one, else in Python's integers."""
    if not len(a):
        return np.zeros((a.shape[1], a.shape[1]), object)
    largest = max(abs(int(a.max())), abs(int(a.min())), 1)
    rows = EXACT_DOUBLE // largest**2
    if rows < 16:
        exact = a.astype(object)
        return exact.T @ exact
    total = np.zeros((a.shape[1], a.shape[1]), object)
    for k in range(0, len(a), rows):
        part = a[k : k + rows].astype(np.float64)
        total += np.rint(part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(rows: DataFrame, function, dimension: int) -> dict[int, int]:
    """Adds up what ``function`` makes of a task's vectors: exact sums by place in its flat array."""
    arrow = pa.schema([("place", pa.int32()), ("part", pa.decimal128(38, 0))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = function(_whole(_matrix(batch.column(0), dimension))).ravel()
            total = part.astype(object) if total is None else total + part
        if total is not None:
            places = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([places, pa.array([Decimal(int(x)) for x in total], pa.decimal128(38, 0))], schema=arrow)

    parts = rows.select("v").mapInArrow(task, "place int, part decimal(38,0)")
    return {r["place"]: int(r["total"]) for r in parts.groupBy("place").agg(F.sum("part").alias("total")).collect()}


# --- characteristic polynomial ---------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # enough below 3,215,031,751
        x = pow(base, odd, n)
        if base % n == 0 or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds ``bound``."""
    found, product, n = [], 1, LARGEST_PRIME
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients mod p of det(xI - matrix), lowest first: Hessenberg form by similarity, then its recurrence."""
    a = np.array([[x % p for x in row] for row in matrix], np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[pivot, k + 1]] = a[[k + 1, pivot]]
            a[:, [pivot, k + 1]] = a[:, [k + 1, pivot]]
        factors = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factors[:, None] * a[k + 1] % p) % p
        # The inverse on the right: each column beyond k + 1 is added, times its factor, to column k + 1.
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factors % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for k in range(d):
        row = np.roll(polynomials[k], 1)
        row = (row - int(a[k, k]) * polynomials[k]) % p
        scale = 1
        for i in range(k - 1, -1, -1):
            scale = scale * int(a[i + 1, i]) % p
            row = (row - (scale * int(a[i, k]) % p) * polynomials[i]) % p
        polynomials[k + 1] = row
    return polynomials[d].tolist()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(xI - matrix), lowest first; each prime is a row of a Spark job."""
    norm = isqrt(sum(x * x for row in matrix for x in row)) + 1  # bounds every |eigenvalue|
    primes = primes_beyond(2 * (norm + 1) ** len(matrix))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"p": batch["p"], "residues": [polynomial_mod(matrix, p) for p in batch["p"].tolist()]})

    rows = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 64))
    residues = {r["p"]: r["residues"] for r in rows.mapInPandas(task, "p bigint, residues array<bigint>").collect()}
    modulus, values = 1, [0] * (len(matrix) + 1)
    for p in primes:
        inverse = pow(modulus % p, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, residues[p], strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


# --- roots -------------------------------------------------------------------------------------------


def roots_above(polynomial: list[int], a: int) -> int:
    """How many roots of a polynomial with real roots only exceed a, by the signs after the shift x + a."""
    c = list(polynomial)
    for start in range(len(c) - 1):
        for k in range(len(c) - 2, start - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs[:-1], signs[1:], strict=True))


def largest_roots(polynomial: list[int], number: int, bits: int = ROOT_BITS) -> list[Decimal]:
    """The largest positive roots in falling order, repeated by multiplicity, of a polynomial with real roots only.

    Positions are whole numbers of 2^-bits. The count isolates a root; then signs halve its interval down to
    one position or 2^-bits of its size. Roots that no position tells apart count as equal.
    """
    d = len(polynomial) - 1
    scaled = [c << bits * (d - i) for i, c in enumerate(polynomial)]
    counts: dict[int, int] = {}

    def above(y: int) -> int:
        if y not in counts:
            counts[y] = roots_above(scaled, y)
        return counts[y]

    def sign(y: int) -> int:
        value = 0
        for c in reversed(scaled):
            value = value * y + c
        return (value > 0) - (value < 0)

    high = 1 << bits
    while above(high):
        high <<= 1
    roots = []
    for place in range(min(number, above(0))):
        low, up = 0, high  # above(low) > place >= above(up)
        while up - low > 1 and above(low) - above(up) > 1:
            middle = (low + up) // 2
            low, up = (middle, up) if above(middle) > place else (low, middle)
        at_up = sign(up)
        if at_up == 0 and above(low) - above(up) == 1:
            low = up
        while up - low > 1 and (up - low) << bits > up:
            middle = (low + up) // 2
            at_middle = sign(middle)
            if at_middle == 0:
                low = up = middle
            else:
                low, up = (low, middle) if at_middle == at_up else (middle, up)
        roots.append(Decimal(low + up) / Decimal(1 << (bits + 1)))
    return roots


# --- components ------------------------------------------------------------------------------------


def _solver(matrix: np.ndarray):
    """Solves matrix x = b in the current decimal precision: elimination with the largest pivot of each column."""
    a, d, order = matrix.copy(), len(matrix), np.arange(len(matrix))
    tiny = max(max(abs(x) for x in a.ravel()), Decimal(1)).scaleb(10 - DIGITS)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[pivot, k]], order[[pivot, k]] = a[[k, pivot]], order[[k, pivot]]
        if abs(a[k, k]) < tiny:  # singular to all digits: what inverse iteration is after
            a[k, k] = tiny
        a[k + 1 :, k] /= a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for k in range(1, d):
            x[k] -= a[k, :k] @ x[:k]
        for k in range(d - 1, -1, -1):
            x[k] = (x[k] - (a[k, k + 1 :] @ x[k + 1 :] if k + 1 < d else 0)) / a[k, k]
        return x

    return solve


def unit_vectors(matrix: list[list[int]], roots: list[Decimal]) -> list[np.ndarray]:
    """Unit vectors of the roots by inverse iteration; those of equal roots are made orthogonal."""
    with localcontext() as context:
        context.prec = DIGITS
        whole = np.array([[Decimal(x) for x in row] for row in matrix], object)
        vectors: list[np.ndarray] = []
        for place, root in enumerate(roots):
            solve = _solver(whole - np.diag([root] * len(whole)).astype(object))
            equal = [v for v, r in zip(vectors, roots, strict=False) if abs(r - root) <= root.scaleb(-40)]
            start = random.Random(place)
            v = np.array([Decimal(start.randint(-(10**6), 10**6)) for _ in whole], object)
            for _ in range(3):
                for other in equal:
                    v = v - other * (other @ v)
                v = solve(v)
                v = v / (v @ v).sqrt()
            for other in equal:
                v = v - other * (other @ v)
            vectors.append(v / (v @ v).sqrt())
        return vectors


# --- whitening ----------------------------------------------------------------------------------------


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation decimal, whitened, explained, identity_error) per usable vector and component."""
    spark = vectors.sparkSession
    rows = cleaned(vectors, vec_id, embedding)
    commonest = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = commonest["d"] if commonest else 0
    rows = rows.where(F.size("v") == d)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    empty = f"vec_id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if d == 0:
        return spark.createDataFrame([], empty)

    total = _summed(rows, lambda x: np.concatenate([[len(x)], x.astype(object).sum(axis=0) if _large(x) else x.sum(axis=0)]).astype(object), d)
    n, sums = total[0], [total[k + 1] for k in range(d)]
    means = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    upper = np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        return _product(x - means)[upper]

    products_sum = _summed(rows, products, d)
    left = [s - n * int(m) for s, m in zip(sums, means, strict=True)]
    scatter = [[0] * d for _ in range(d)]
    for place, (i, j) in enumerate(zip(*upper, strict=True)):
        scatter[i][j] = scatter[j][i] = n * products_sum[place] - left[i] * left[j]

    roots = largest_roots(characteristic_polynomial(spark, scatter), components)
    if not roots:
        return spark.createDataFrame([], empty)
    directions = np.array([v.astype(np.float64) for v in unit_vectors(scatter, roots)])
    with localcontext() as context:
        context.prec = DIGITS
        deviations = np.array([float(r.sqrt() / n) for r in roots])
        trace = sum(scatter[i][i] for i in range(d))
        explained = [float(r / trace) for r in roots]
    rest, projection = np.array(left, np.float64) / n, (directions / deviations[:, None]).T

    @F.pandas_udf("deviation decimal(38,0), whitened array<double>")
    def project(column: pd.Series) -> pd.DataFrame:
        z = _whole(np.stack(column.to_numpy()).astype(np.float64)) - means if len(column) else np.empty((0, d), np.int64)
        squared = [Decimal(int(x)) for x in ((z.astype(object) * n - np.array(left, object)) ** 2).sum(axis=1)] if _large(z, n) else [
            Decimal(x) for x in ((z * n - np.array(left, np.int64)) ** 2).sum(axis=1).tolist()]
        return pd.DataFrame({"deviation": squared, "whitened": list((z - rest) @ projection)})

    wide = stored(rows.select("vec_id", project("v").alias("r")).select("vec_id", "r.*"), "whitened")
    pairs = [(i, j) for i in range(len(roots)) for j in range(i, len(roots))]
    found = wide.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{k}") for k, (i, j) in enumerate(pairs)]).first()
    error = max(abs(found[k] - (i == j)) for k, (i, j) in enumerate(pairs))
    shares = F.array(*map(F.lit, explained))
    return wide.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        shares[F.col("k")].alias("explained"), F.lit(error).alias("identity_error"),
    )


def _large(z: np.ndarray, n: int = 1) -> bool:
    """Whether sums of z, or of squares of n z when n is given, may not fit a long."""
    if not z.size:
        return False
    largest = max(abs(int(z.max())), abs(int(z.min()))) + 1
    return largest * len(z) >= 2**62 if n == 1 else (largest * n) ** 2 * z.shape[1] >= 2**62
