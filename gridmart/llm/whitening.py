"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter n * sum(x x') - S S' (n squared times the
covariance) is an exact integer matrix. Its characteristic polynomial is made
modulo enough primes, each by a reduction to Hessenberg form, and put together by
Chinese remaindering. All its roots are real, so the number of roots above a point
is the number of sign changes of the polynomial shifted there (Descartes' rule is
exact then); bisection by that count isolates the largest roots, signs refine
them. Null-space inverse iteration with ``PRECISION`` digits gives the components.

On Spark: a pass that finds the dimension, one that adds up the moments (each task
its own, in exact limbs that Spark sums), one that projects. The primes and the
components are dealt out as tasks. The driver holds the moments, the polynomial
and the components: bounded by the dimension, never by the rows.

Edge cases: a row goes if its vector is null, holds a null or an entry that is not
finite or too large for a long (2**52 and beyond), or has another length than most
vectors (of equally frequent lengths the smaller one stays; a vector of length 0
has no entries to whiten); repeated rows and null ids are rows like any other; a
component without variance has no whitened value and is not returned, so vectors
that are all equal, or an empty table, give no rows; ``deviation`` is null where it
is beyond a long; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb, gcd, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Decimal digits of the inverse iteration, bits of a root next to the largest one.
PRECISION = 90
ROOT_BITS = 200
SCALE, SHIFT = 1024, 100_000
_LIMB = 40
_LARGEST = float(2**52)
_LONG = 2**63


def usable(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, v`` (array<double>) of the rows that take part."""
    rows = table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST)))
    # A row per length: lengths of vectors, not of the table.
    found = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").take(1)
    return rows.where(F.size("v") == (found[0]["d"] if found else -1))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """1024 * c, rounded down, a row per vector: whole numbers, exact as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(len(column), -1))


def _gram(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers: products of doubles as far as their sums stay exact."""
    top = max(1, int(np.abs(x).max(initial=0)))
    rows = 2**53 // (top * top)
    if rows < 64:
        whole = np.array([[int(c) for c in row] for row in x.tolist()], dtype=object)
        return whole.T @ whole
    return sum((x[i:i + rows].T @ x[i:i + rows]).astype(np.int64).astype(object) for i in range(0, len(x), rows))


def moments(rows: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and sums of products of floor(1024 c), exact (the shift changes no covariance)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, 0, 0
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                n, products = n + len(x), products + _gram(x)
                total = total + np.array([sum(map(int, c)) for c in x.T.tolist()], dtype=object)
        if n:
            d = len(total)
            entries = [(0, 0, n), *[(1, i, v) for i, v in enumerate(total.tolist())]]
            entries += [(2 + i, j, products[i, j]) for i in range(d) for j in range(i, d)]
            out = []
            for i, j, v in entries:  # v is the sum of part * 2**(40 limb), the last part with its sign
                for limb in range(4):
                    v, part = (0, v) if limb == 3 else divmod(v, 1 << _LIMB)
                    if part:
                        out.append((i, j, limb, part))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["i", "j", "limb", "part"])

    parts = rows.select("v").mapInArrow(add_up, "i long, j long, limb long, part long")
    found = parts.groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect()  # bounded by the dimension
    exact: dict[tuple[int, int], int] = {}
    for i, j, limb, part in found:
        exact[i, j] = exact.get((i, j), 0) + (part << (_LIMB * limb))
    if not exact:
        return 0, [], np.zeros((0, 0), dtype=object)
    d = max([j for _, j in exact], default=0) + 1
    d = max(d, rows.select(F.size("v")).first()[0])
    products = np.array([[exact.get((2 + min(i, j), max(i, j)), 0) for j in range(d)] for i in range(d)], dtype=object)
    return exact[0, 0], [exact.get((1, i), 0) for i in range(d)], products


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 2**32."""
    s = (n - 1 & 1 - n).bit_length() - 1
    for base in (2, 3, 5, 7):
        x = pow(base, n - 1 >> s, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes(beyond: int) -> list[int]:
    """The largest primes below 2**31 whose product goes beyond a bound."""
    out, product, n = [], 1, 2**31 - 1
    while product <= beyond:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def charpoly_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (lowest first) of det(x I - matrix) modulo a prime below 2**31."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), dtype=np.int64)  # row k: of the leading k x k block
    poly[0, 0] = 1
    for k in range(1, d + 1):
        own = -h[k - 1, k - 1] * poly[k - 1] % p
        own[1:] += poly[k - 1, :-1]
        run, weights = 1, np.zeros(k - 1, dtype=np.int64)
        for i in range(k - 2, -1, -1):
            run = run * int(h[i + 1, i]) % p
            weights[i] = run * int(h[i, k - 1]) % p
        poly[k] = (own - (weights[:, None] * poly[:k - 1] % p).sum(axis=0)) % p
    return poly[d]


def charpoly(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The exact characteristic polynomial (lowest coefficient first); a task per few primes."""
    d = len(matrix)
    mean = -(-int(np.trace(matrix)) // d)
    # The roots are not negative, so a coefficient is at most its value at d equal roots.
    moduli = primes(2 * max(comb(d, k) * mean**k for k in range(d + 1)))
    text = [[str(v) for v in row] for row in matrix.tolist()]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array([[int(v) for v in row] for row in text], dtype=object)
        for b in batches:
            ps = b.column("p").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ps, pa.int64()), pa.array([charpoly_mod(whole, p).tolist() for p in ps], pa.list_(pa.int64()))],
                names=["p", "c"])

    dealt = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(min(len(moduli), 4 * d))
    value, product = [0] * (d + 1), 1
    for p, c in dealt.mapInArrow(reduce, "p long, c array<long>").collect():
        inverse = pow(product, -1, p)
        value = [v + product * ((r - v) * inverse % p) for v, r in zip(value, c)]
        product *= p
    return [v - product if 2 * v > product else v for v in value]


def _above(poly: list[int], at: int) -> int:
    """Number of roots greater than ``at`` (with multiplicity) of a polynomial with real roots only."""
    c = list(poly)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], at: int) -> int:
    v = 0
    for c in reversed(poly):
        v = v * at + c
    return v


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int]]:
    """The ``count`` largest positive roots as (numerator, exponent): numerator / 2**exponent, falling.

    Roots that agree in all kept bits get the same numerator.
    """
    d = len(poly) - 1
    top = 1
    while _above(poly, top):
        top *= 2
    s = max(0, ROOT_BITS - top.bit_length())
    scaled = [c << (s * (d - k)) for k, c in enumerate(poly)]
    known = {0: _above(poly, 0), top << s: 0}
    out: list[tuple[int, int]] = []
    for k in range(1, min(count, known[0]) + 1):  # lo < root number k <= hi
        lo = max(a for a, n in known.items() if n >= k)
        hi = min(a for a, n in known.items() if n < k)
        while hi - lo > 1 and not (known[lo] == k and known[hi] == k - 1):
            mid = (lo + hi) // 2
            known[mid] = _above(scaled, mid)
            lo, hi = (mid, hi) if known[mid] >= k else (lo, mid)
        while hi - lo > 1:  # alone in its interval: a value's sign tells how many roots are above
            mid = (lo + hi) // 2
            v = _value(scaled, mid)
            lo, hi = (lo, mid) if v == 0 or (v > 0) == (k % 2 == 1) else (mid, hi)
        out.append((hi, s))
    return out


def null_vectors(matrix: np.ndarray, root: Decimal, count: int) -> list[list[float]]:
    """Unit vectors of the ``count``-fold eigenvalue ``root``, orthogonal, the largest entry positive."""
    d = len(matrix)
    with localcontext() as ctx:
        ctx.prec = PRECISION
        a = [[Decimal(int(v)) for v in row] for row in matrix.tolist()]
        size = max(abs(v) for row in a for v in row) or Decimal(1)
        for i in range(d):
            a[i][i] -= root
        tiny, order = size.scaleb(10 - PRECISION), list(range(d))
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[best] = a[best], a[k]
            order[k], order[best] = order[best], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            head = a[k]
            for row in a[k + 1:]:
                if row[k]:
                    f = row[k] = row[k] / head[k]
                    for j in range(k + 1, d):
                        row[j] -= f * head[j]

        def solve(b: list[Decimal]) -> list[Decimal]:
            x = [b[i] for i in order]
            for i in range(d):
                x[i] -= sum((a[i][j] * x[j] for j in range(i)), Decimal(0))
            for i in reversed(range(d)):
                x[i] = (x[i] - sum((a[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / a[i][i]
            return x

        def unit(x: list[Decimal]) -> list[Decimal]:
            big = max(map(abs, x))
            x = [v / big for v in x]
            norm = sum((v * v for v in x), Decimal(0)).sqrt()
            return [v / norm for v in x]

        found: list[list[Decimal]] = []
        start = np.random.default_rng(d)
        for _ in range(count):
            x = [Decimal(int(v)) for v in start.integers(1, 10**9, d)]
            for _ in range(4):
                x = unit(solve(unit(x)))
                for other in found * 2:
                    dot = sum((p * q for p, q in zip(x, other)), Decimal(0))
                    x = unit([p - dot * q for p, q in zip(x, other)])
            found.append(x)
        return [[float(v if max(x, key=abs) > 0 else -v) for v in x] for x in found]


@dataclass(frozen=True)
class Whitener:
    """Fitted on n vectors: sums of floor(1024 c), components by falling eigenvalue, shares of the variance."""

    n: int
    sums: list[int]
    components: np.ndarray  # a row per component, divided by its standard deviation
    explained: list[float]


def fit(rows: DataFrame, count: int = 8) -> Whitener:
    """Fit on all ``rows`` (of ``usable``)."""
    spark = rows.sparkSession
    n, sums, products = moments(rows)
    s = np.array(sums, dtype=object)
    scatter = n * products - np.outer(s, s) if n else products
    trace = int(np.trace(scatter)) if n else 0
    if not trace:
        return Whitener(n, sums, np.zeros((0, len(sums))), [])
    scale = gcd(*(int(v) for v in scatter.ravel()))
    matrix = scatter // scale
    roots = largest_roots(charpoly(spark, matrix), count)
    text = [[str(v) for v in row] for row in matrix.tolist()]

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array([[int(v) for v in row] for row in text], dtype=object)
        for b in batches:
            for first, times, root in zip(*(c.to_pylist() for c in b.columns)):
                vectors = null_vectors(whole, Decimal(root), times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first, first + times), pa.int64()), pa.array(vectors, pa.list_(pa.float64()))],
                    names=["k", "v"])

    tasks = []
    with localcontext() as ctx:
        ctx.prec = PRECISION
        for k, (top, bits) in enumerate(roots):
            if k == 0 or roots[k - 1] != (top, bits):
                # The root is in (top - 1, top]: its middle, but for whole numbers.
                at = Decimal(top) / (1 << bits) if bits == 0 else (Decimal(2 * top - 1) / 2) / (1 << bits)
                tasks.append((k, roots.count((top, bits)), str(at)))
    dealt = spark.createDataFrame(tasks, "k long, times long, root string").repartition(len(tasks))
    found = dict(dealt.mapInArrow(components, "k long, v array<double>").collect())
    # An eigenvalue of the covariance is scale * root / n**2; its square root, from 60 exact bits and more.
    deviations = [isqrt(scale * top << 120) / (1 << 60) / (1 << bits // 2) / n / (2 ** 0.5 if bits % 2 else 1)
                  for top, bits in roots]
    shares = [(scale * top << 64) // (trace << bits) / 2.0**64 for top, bits in roots]
    return Whitener(n, sums, np.array([np.array(found[k]) / deviations[k] for k in range(len(roots))]), shares)


def _centred(x: np.ndarray, w: Whitener) -> tuple[np.ndarray, list[int]]:
    """x - S/n as doubles, and the exact sum of (n x - S)**2 of each row."""
    top = int(np.abs(x).max(initial=0))
    most = w.n * top + max(map(abs, w.sums), default=0)
    if most * most * max(1, x.shape[1]) < _LONG:
        y = w.n * x.astype(np.int64) - np.array(w.sums, dtype=np.int64)
        return y / w.n, (y * y).sum(axis=1).tolist()
    y = w.n * np.array([[int(c) for c in r] for r in x.tolist()], dtype=object) - np.array(w.sums, dtype=object)
    return (y / w.n).astype(np.float64), (y * y).sum(axis=1).tolist()


def identity_error(rows: DataFrame, w: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    k = len(w.components)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                z = _centred(_matrix(b.column("v")), w)[0] @ w.components.T
                total, products = total + z.sum(axis=0), products + z.T @ z
        at = [(-1, j, total[j]) for j in range(k)] + [(i, j, products[i, j]) for i in range(k) for j in range(k)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*at), (pa.int64(), pa.int64(), pa.float64()))], names=["i", "j", "v"])

    found = rows.select("v").mapInArrow(add_up, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect()
    sums = {(i, j): v / w.n for i, j, v in found}
    return max(abs(sums[i, j] - sums[-1, i] * sums[-1, j] - (i == j)) for i in range(k) for j in range(k))


def whiten(table: DataFrame, count: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per usable vector and component: ``<key>, component, n, deviation, whitened, explained, identity_error``."""
    rows = usable(table, key, vector)
    w = fit(rows, count)
    k = len(w.components)
    error = identity_error(rows, w) if k else 0.0
    schema = T.StructType([
        T.StructField(key, table.schema[key].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    if not k:
        return table.sparkSession.createDataFrame([], schema)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                centred, deviation = _centred(_matrix(b.column("v")), w)
                m = b.num_rows * k
                fits = [v if v < _LONG else None for v in deviation]
                yield pa.RecordBatch.from_arrays([
                    b.column("id").take(pa.array(np.repeat(np.arange(b.num_rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(m, w.n)),
                    pa.array([v for v in fits for _ in range(k)], pa.int64()),
                    pa.array((centred @ w.components.T).ravel()),
                    pa.array(np.tile(w.explained, b.num_rows)), pa.array(np.full(m, error))], names=schema.names)

    return rows.mapInArrow(project, schema)
