"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become integers, floor(`scale` * c) + `offset`. Their sums and products are added up exactly, in the tasks and then by
Spark, which leaves one matrix C = n * sum(x x') - S S', n squared times the covariance, in whole numbers. Its characteristic
polynomial is found modulo many primes, each by reduction to Hessenberg form, in tasks of their own; Chinese remaindering gives
the whole coefficients, as many primes as their bound asks for. All roots are real and none is negative, so the sign changes of
the shifted polynomial count the roots above a point exactly; intervals are halved until each holds one root, which is then
narrowed to `ROOT_BITS` bits of the trace, or one of several equal ones. A component is the null space of C minus its root, by
inverse iteration in decimals of `DIGITS` digits, orthogonal to those before it. Only sums as large as the matrix reach the
driver, and the rows are whitened where they are.

The polynomial takes about d**4 steps and more for d dimensions: meant for some hundred dimensions at most.

Defined cases: rows whose vector is null or has a null or non-finite entry take no part; neither do those of another length
than most rows have (the longer, if two lengths are as frequent). Each of several equal rows counts. A null id is passed on.
Components without variance (of few or of equal rows) have no whitened value, hence no rows; an empty table gives no rows.
Further columns do not matter, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from functools import reduce
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ddlscope.llm.groups import saved

ROOT_BITS, DIGITS, PRIMES_PER_TASK = 160, 90, 16
WHOLE = pa.decimal128(38, 0)


# Whole numbers out of rows.

def usable(embeddings: DataFrame, vector: str, identifier: str) -> DataFrame:
    """`id` and `vector` of the rows that take part, before their lengths are looked at."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = embeddings.select(F.col(identifier).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.filter(F.col("vector").isNotNull() & F.forall("vector", entry))


def whole(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    """floor(scale * c) of a batch's vectors, as int64 or, where that is too small, as Python's integers."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    floors = np.floor(values * scale)
    if not floors.size or np.abs(floors).max() < 2.0**62:
        return floors.astype(np.int64)
    return np.array([[int(x) for x in row] for row in floors.tolist()], object)


def largest(values: np.ndarray) -> int:
    return int(max(abs(values.max()), abs(values.min()))) if values.size else 0


def products(rows: np.ndarray) -> np.ndarray:
    """Exact sum of the outer products of the rows."""
    most = largest(rows)
    if most * most * len(rows) < 2**53:
        exact = rows.astype(np.float64)
        return (exact.T @ exact).astype(np.int64)
    exact = rows.astype(object)
    return exact.T.dot(exact)


def _sums(dims: int, scale: int):
    """One task's n, sums and upper triangle of products, as rows of place and number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, square = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            rows = whole(batch, dims, scale)
            n += len(rows)
            sums = sums + rows.astype(object).sum(axis=0) if largest(rows) * max(len(rows), 1) >= 2**63 else sums + rows.sum(axis=0)
            square = square + products(rows)
        if n:
            i, j = np.triu_indices(dims)
            values = [n, *sums.tolist(), *square[i, j].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-2, *[-1] * dims, *i.tolist()], pa.int32()), pa.array([0, *range(dims), *j.tolist()], pa.int32()),
                 pa.array([Decimal(int(v)) for v in values], WHOLE)], names=["i", "j", "value"])
    return run


def scatter(rows: DataFrame, dims: int, scale: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums, and C, of all rows; floors are without the offset, which C does not feel."""
    parts = rows.select("vector").mapInArrow(_sums(dims, scale), "i int, j int, value decimal(38,0)")
    found = {(r["i"], r["j"]): int(r["value"]) for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    n = found.get((-2, 0), 0)
    sums = [found.get((-1, k), 0) for k in range(dims)]
    return n, sums, [[n * found.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]


# The polynomial.

def is_prime(n: int) -> bool:
    """For odd n below 2**31: these bases leave no composite."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_below(top: int, bits: float) -> list[int]:
    """The largest primes below an even number whose product has more than so many bits."""
    out, have, n = [], 0.0, top - 1
    while have <= bits:
        if is_prime(n):
            out.append(n)
            have += log2(n) - 1e-9
        n -= 2
    return out


def polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients, the constant one first, of det(x - C) modulo each prime: C is brought to Hessenberg form by similar
    matrices, of which the polynomial follows column by column. All primes go through each step at once."""
    size, p = len(matrix), np.array(primes, np.int64)
    p1, p2 = p[:, None], p[:, None, None]
    h = np.array([[[x % q for x in row] for row in matrix] for q in primes], np.int64)
    for m in range(1, size - 1):
        for k in np.flatnonzero(h[:, m, m - 1] == 0):  # bring up a row that is not zero there, if there is one
            others = np.flatnonzero(h[k, m + 1:, m - 1])
            if len(others):
                o = m + 1 + others[0]
                h[k, [m, o]] = h[k, [o, m]]
                h[k, :, [m, o]] = h[k, :, [o, m]]
        inverse = np.array([pow(int(x), -1, q) if x else 0 for x, q in zip(h[:, m, m - 1], primes)], np.int64)
        factor = h[:, m + 1:, m - 1] * inverse[:, None] % p1
        h[:, m + 1:] = (h[:, m + 1:] - factor[:, :, None] * h[:, m:m + 1] % p2) % p2
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * factor[:, None, :] % p2).sum(axis=2)) % p1
    found = [np.zeros((len(primes), size + 1), np.int64)]
    found[0][:, 0] = 1
    for k in range(size):
        now = np.roll(found[k], 1, axis=1) - h[:, k, k][:, None] * found[k] % p1
        path = np.ones(len(primes), np.int64)
        for i in range(k - 1, -1, -1):
            path = path * h[:, i + 1, i] % p
            now -= (h[:, i, k] * path % p)[:, None] * found[i] % p1
        found.append(now % p1)
    return found[size]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The coefficients of det(x - C), the constant one first, for a C without negative roots."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # By Maclaurin's inequality no coefficient is above (1 + trace / size) ** size; one bit more for the sign.
    primes = primes_below(2**31, size * log2(1 + max(trace, 0) / size) + 3)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("prime").to_pylist()
            for low in range(0, len(some), PRIMES_PER_TASK):
                part = some[low:low + PRIMES_PER_TASK]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(polynomials(matrix, part).tolist(), pa.list_(pa.int64()))],
                                                 names=["prime", "residues"])

    dealt = spark.createDataFrame([(q,) for q in primes], "prime long").repartition(-(-len(primes) // PRIMES_PER_TASK))
    found = {r["prime"]: r["residues"] for r in dealt.mapInArrow(residues, "prime long, residues array<long>").collect()}
    product = reduce(lambda a, b: a * b, primes)
    units = [(q, (product // q) * pow(product // q, -1, q)) for q in primes]
    whole_ = [sum(found[q][k] * unit for q, unit in units) % product for k in range(size + 1)]
    return [c - product if c > product // 2 else c for c in whole_]


# Its roots.

def above(polynomial: list[int], point: int) -> int:
    """How many roots, with their multiplicity, are above the point: all are real, so the sign changes say it exactly."""
    shifted = list(polynomial)
    for low in range(len(shifted) - 1):
        for k in range(len(shifted) - 2, low - 1, -1):
            shifted[k] += point * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value(polynomial: list[int], point: int) -> int:
    return reduce(lambda total, c: total * point + c, reversed(polynomial), 0)


def top_roots(polynomial: list[int], wanted: int) -> tuple[list[int], int]:
    """The largest positive roots, falling, each as often as it occurs, in units of 2 to the power of minus the second result."""
    size = len(polynomial) - 1
    trace = -polynomial[size - 1]
    if trace <= 0:
        return [], 0
    shift = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << shift * (size - k) for k, c in enumerate(polynomial)]
    # The trace is no smaller than any root.
    parts, roots = [(0, trace << shift, above(scaled, 0), 0)], []
    while parts and len(roots) < wanted:
        low, high, more, fewer = parts.pop()  # roots above low, and above high
        if more == fewer:
            continue
        if high - low <= 1:
            roots += [high] * (more - fewer)
        elif more - fewer == 1:
            while high - low > 1:
                middle = (low + high) // 2
                v = value(scaled, middle)
                if v == 0:
                    low, high = middle - 1, middle
                elif (v > 0) == (fewer % 2 == 0):
                    high = middle
                else:
                    low = middle
            roots.append(high)
        else:
            middle = (low + high) // 2
            between = above(scaled, middle)
            parts += [(low, middle, more, between), (middle, high, between, fewer)]
    return roots[:wanted], shift


# Components.

def _solver(matrix: np.ndarray, tiny: Decimal):
    """Solves for many right sides, by elimination with pivots; a pivot below `tiny` becomes that."""
    a, size, order = matrix.copy(), len(matrix), []
    for k in range(size):
        pivot = k + max(range(size - k), key=lambda i: abs(a[k + i, k]))
        order.append(pivot)
        a[[k, pivot]] = a[[pivot, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1:, k] = a[k + 1:, k] / a[k, k]
        a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])

    def solve(right: np.ndarray) -> np.ndarray:
        x = right.copy()
        for k, pivot in enumerate(order):
            x[[k, pivot]] = x[[pivot, k]]
        for k in range(size):
            x[k + 1:] -= a[k + 1:, k] * x[k]
        for k in range(size - 1, -1, -1):
            x[k] = (x[k] - (a[k, k + 1:] * x[k + 1:]).sum()) / a[k, k]
        return x

    return solve


def components(matrix: list[list[int]], roots: list[int], shift: int) -> np.ndarray:
    """Unit vectors, one for each root, in rows; the largest entry of each is positive."""
    size, out = len(matrix), []
    with localcontext() as context:
        context.prec = DIGITS
        whole_ = np.array([[Decimal(x) for x in row] for row in matrix], object)
        tiny = Decimal(max(abs(x) for row in matrix for x in row)) * Decimal(10) ** (10 - DIGITS)
        for nth, root in enumerate(roots):
            shifted = whole_.copy()
            shifted[np.arange(size), np.arange(size)] -= Decimal(root) / Decimal(1 << shift)
            solve = _solver(shifted, tiny)
            x = np.array([Decimal(1 + (7 * i + 3 * nth) % 11) for i in range(size)], object)
            for _ in range(4):
                for other in out:  # also those of equal roots, so that the next direction of their space is found
                    x = x - other * (x * other).sum()
                x = solve(x / (x * x).sum().sqrt())
            for _ in range(2):
                for other in out:
                    x = x - other * (x * other).sum()
                x = x / (x * x).sum().sqrt()
            out.append(x)
        signed = [x if max(x, key=abs) > 0 else -x for x in out]
        return np.array([[float(v) for v in x] for x in signed]).reshape(-1, size)


# The whole.

@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, sums of the floors, components in rows, and their variances and shares of the whole."""

    dims: int
    scale: int
    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: list[float]


def fit(rows: DataFrame, wanted: int = 8, scale: int = 1024) -> Whitening | None:
    """Components of the rows of `usable`, as many of the wanted ones as have variance; None without any rows."""
    lengths = rows.groupBy(F.size("vector").alias("dims")).count().filter("dims > 0").orderBy(F.col("count").desc(), F.col("dims").desc()).first()
    if lengths is None:
        return None
    dims = lengths["dims"]
    n, sums, matrix = scatter(rows.filter(F.size("vector") == dims), dims, scale)
    roots, shift = top_roots(characteristic_polynomial(rows.sparkSession, matrix), wanted)
    trace = sum(matrix[i][i] for i in range(dims))
    with localcontext() as context:
        context.prec = DIGITS
        variances = np.array([float(Decimal(r) / Decimal(1 << shift) / Decimal(n) ** 2) for r in roots])
        shares = [float(Decimal(r) / Decimal(1 << shift) / Decimal(trace)) for r in roots]
    return Whitening(dims, scale, n, sums, components(matrix, roots, shift), variances, shares)


def _whitened(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = model.axes.T / np.sqrt(model.variances)
        sums = np.array(model.sums, object)
        small = max((abs(s) for s in model.sums), default=0) < 2**62
        for batch in batches:
            rows = whole(batch, model.dims, model.scale)
            if small and largest(rows) * model.n < 2**62:
                apart = rows.astype(np.int64) * model.n - sums.astype(np.int64)
            else:
                apart = rows.astype(object) * model.n - sums
            if largest(apart) ** 2 * model.dims < 2**63:
                deviation = pa.array((apart.astype(np.int64) ** 2).sum(axis=1)).cast(WHOLE)
            else:
                deviation = pa.array([Decimal(sum(int(x) ** 2 for x in row)) for row in apart.tolist()], WHOLE)
            values = (apart / model.n).astype(np.float64) @ axes
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, pa.array(list(values), pa.list_(pa.float64()))],
                                             names=["id", "deviation", "whitened"])
    return run


def whitened_rows(rows: DataFrame, model: Whitening) -> DataFrame:
    """id, deviation and `whitened`, an array with a number for each component."""
    kind = rows.schema["id"].dataType.simpleString()
    some = rows.filter(F.size("vector") == model.dims)
    return some.mapInArrow(_whitened(model), f"id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, size: int) -> float:
    """The largest entry, without sign, of the covariance of the whitened values minus the identity. Centred sums of tasks are merged."""
    at = lambda i: F.col("whitened")[i]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = whitened.agg(*(F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def whiten(embeddings: DataFrame, wanted: int = 8, scale: int = 1024, vector: str = "embedding", identifier: str = "vec_id") -> DataFrame:
    """For each usable row and component: the id, component (from 1), n, deviation, whitened, explained and identity_error. The offset of the
    entries moves S with x and so none of these."""
    rows = usable(embeddings, vector, identifier)
    model = fit(rows, wanted, scale)
    kind = rows.schema["id"].dataType.simpleString()
    if model is None or not len(model.axes):
        return rows.sparkSession.createDataFrame(
            [], f"`{identifier}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    made = saved(whitened_rows(rows, model), "whitened")
    error = identity_error(made, len(model.axes))
    each = made.select(F.col("id").alias(identifier), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*(F.lit(e) for e in model.explained))
    return each.select(identifier, (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
