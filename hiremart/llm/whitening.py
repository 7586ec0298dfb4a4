"""Operator 13: whitening by the exact characteristic polynomial.

Vectors become integers, so the scatter matrix ``M = n * sum(y y') - sum(y) sum(y)'``
of the distinct vectors is an exact integer matrix (n squared times the covariance).
Its characteristic polynomial is computed modulo many primes (Hessenberg form, one
task per prime) and put together by Chinese remaindering.  All its roots are real,
so Descartes' rule of signs counts the roots above any point exactly; halving
isolates the greatest roots to ``BITS`` bits.  Inverse iteration in fixed-point
integers, one task per root, gives the components.  What reaches the driver is
bounded by the number of dimensions, never by the rows.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from math import comb, isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart.llm.frames import keep, prepare

#: Relative accuracy of a root, and bits after the point in the inverse iteration.
BITS = 110
POINT = 320
#: Largest absolute integer of a vector.
LARGEST = 1 << 31
#: Rows handled at once in a task.
_ROWS = 4096

Poly = list[int]    # coefficients, the constant first


# ------------------------------------------------------------ the integers --
def integer_rows(table: DataFrame, factor: float = 64, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, y)``: ``floor(factor * entry)`` of the vectors without null or non-finite entries.

    Vectors of another length than the most frequent one (ties: the longer) are no vectors
    of this space and are left out.  A value beyond ``LARGEST`` is an error."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = table.where(F.coalesce(~bad, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    large = F.exists("v", lambda c: F.abs(F.lit(float(factor)) * c) > float(LARGEST))
    y = F.transform("v", lambda c: F.floor(F.lit(float(factor)) * c))
    return good.where(F.size("v") == (lengths["d"] if lengths else 0)).select("vec_id", F.when(
        large, F.raise_error(F.lit(f"a component beyond {LARGEST} / {factor}"))).otherwise(y).alias("y"))


def _matrix(col: pa.ListArray, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def _gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` as exact integers: float products whose sums stay below 2**53, of 16-bit halves if needed."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    high = y >> 16
    low = (y - (high << 16)).astype(np.float64)
    high = high.astype(np.float64)
    hh, hl, ll = ((a.T @ b).astype(np.int64).astype(object) for a, b in ((high, high), (high, low), (low, low)))
    return (hh << 32) + ((hl + hl.T) << 16) + ll


def scatter(distinct: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Of a table of vectors ``y``: their number, the sums of each dimension and the exact scatter matrix."""
    upper = np.triu_indices(dims)
    schema = pa.schema([("n", pa.int64()), ("s", pa.list_(pa.decimal128(38)))])

    def run(batches):
        n, total = 0, np.zeros(dims + len(upper[0]), object)
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                y = _matrix(b.column(0).slice(lo, _ROWS), dims)
                n += len(y)
                total[:dims] += y.sum(axis=0).astype(object)
                total[dims:] += _gram(y)[upper]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[Decimal(int(t)) for t in total]],
                                                                      pa.list_(pa.decimal128(38)))], schema=schema)

    parts = distinct.select("y").mapInArrow(run, "n long, s array<decimal(38,0)>")
    got = (parts.select("n", F.posexplode("s").alias("k", "s")).groupBy("k")
           .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())     # dims * (dims + 3) / 2 rows
    n, sums = (got[0]["n"] if got else 0), [0] * (dims + len(upper[0]))
    for r in got:
        sums[r["k"]] = int(r["s"])
    m = np.zeros((dims, dims), object)
    m[upper] = sums[dims:]
    m = m + np.triu(m, 1).T
    s = np.array(sums[:dims], object)
    return n, sums[:dims], n * m - np.outer(s, s)


# ---------------------------------------------------------- the polynomial --
def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 3e9."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The greatest primes below 2**31 whose product exceeds ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def modular_polynomial(m: np.ndarray, p: int) -> list[int]:
    """The characteristic polynomial of the integer matrix ``m`` modulo ``p`` (< 2**31), by its Hessenberg form."""
    h = (m % p).astype(np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        i = k + int(below[0])
        if i != k:
            h[[i, k]] = h[[k, i]]
            h[:, [i, k]] = h[:, [k, i]]
        u = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - u[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * u % p).sum(axis=1)) % p
    # polynomials of the leading parts, from the smaller ones and the subdiagonal's products
    c = np.zeros((d + 1, d + 1), np.int64)
    c[0, 0] = 1
    for k in range(1, d + 1):
        t, by = 1, [int(h[k - 1, k - 1])]
        for i in range(k - 1, 0, -1):
            t = t * int(h[i, i - 1]) % p
            by.append(t * int(h[i - 1, k - 1]) % p)
        c[k, 1:] = c[k - 1, :-1]
        c[k] = (c[k] - (np.array(by, np.int64)[:, None] * c[k - 1::-1][:k] % p).sum(axis=0)) % p
    return c[d].tolist()


def _spread(spark: SparkSession, items: list[tuple], item_schema: str, run, schema: str) -> list:
    """``run`` on each of a short list of items, each in a task of its own."""
    rows = spark.createDataFrame([(k, *x) for k, x in enumerate(items)], "task int, " + item_schema)
    return rows.repartitionById(len(items), F.col("task")).mapInPandas(run, schema).collect()


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> Poly:
    """The exact characteristic polynomial of a positive semidefinite integer matrix.

    Its coefficients are at most the binomials times powers of the mean eigenvalue
    (Maclaurin), which bounds the primes needed."""
    d, trace = len(m), int(np.trace(m))
    bound = max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_beyond(2 * bound)

    def run(frames):
        import pandas as pd
        for f in frames:
            yield pd.DataFrame({"p": f["p"], "c": [modular_polynomial(m, int(p)) for p in f["p"]]})

    found = _spread(spark, [(p,) for p in primes], "p long", run, "p long, c array<long>")
    c, product = [0] * (d + 1), 1
    for p, residues in sorted((r["p"], r["c"]) for r in found):
        inverse = pow(product, -1, p)
        c = [x + product * ((r - x) * inverse % p) for x, r in zip(c, residues)]
        product *= p
    return [x - product if 2 * x > product else x for x in c]


# ---------------------------------------------------------------- the roots --
def roots_above(poly: Poly, num: int, shift: int) -> int:
    """How many roots (with multiplicity) of a polynomial with real roots exceed ``num / 2**shift``:
    the sign changes of the polynomial moved there."""
    n = len(poly) - 1
    c = [x << (shift * (n - k)) for k, x in enumerate(poly)]
    for i in range(n):
        for k in range(n - 1, i - 1, -1):
            c[k] += num * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: Poly, num: int, shift: int) -> int:
    n, x = len(poly) - 1, 0
    for k in range(n, -1, -1):
        x = x * num + (poly[k] << (shift * (n - k)))
    return (x > 0) - (x < 0)


def greatest_roots(poly: Poly, count: int) -> list[tuple[Fraction, int]]:
    """The greatest positive roots of a polynomial with real roots, none negative, and their
    multiplicities, descending, until ``count`` are met; each accurate to ``BITS`` bits."""
    zeros = next(k for k, x in enumerate(poly) if x)
    poly = poly[zeros:]
    degree = len(poly) - 1
    if not degree or count <= 0:
        return []
    high = 1 << max(1, (-poly[degree - 1]).bit_length())     # the sum of the roots is below it
    out: list[tuple[Fraction, int]] = []
    todo = [(0, high, 0, degree, 0)]        # low, high (in units of 2**-shift), shift, roots above low, above high
    while todo and sum(m for _, m in out) < count:
        low, high, shift, over_low, over_high = todo.pop()
        held = over_low - over_high
        if not held:
            continue
        if low and (high - low) << BITS <= low:
            out.append((Fraction(low + high, 2 << shift), held))
            continue
        if (high - low) & 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        mid = (low + high) // 2
        if held == 1:       # a simple root: the sign tells its side
            sign = _sign(poly, mid, shift)
            over = over_high + (sign == (-1) ** (over_high + 1))
        else:
            over = roots_above(poly, mid, shift)
        todo.append((low, mid, shift, over_low, over))
        todo.append((mid, high, shift, over, over_high))
    return out


# ----------------------------------------------------------- the components --
def _eliminate(a: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """LU factors, in place, of a fixed-point matrix with row pivots (a zero pivot becomes one unit)."""
    d, order = len(a), []
    for k in range(d):
        i = k + max(range(d - k), key=lambda r: abs(a[k + r, k]))
        order.append(i)
        if i != k:
            a[[i, k]] = a[[k, i]]
        a[k, k] = a[k, k] or 1
        if k + 1 < d:
            a[k + 1:, k] = (a[k + 1:, k] << POINT) // a[k, k]
            a[k + 1:, k + 1:] -= (a[k + 1:, k, None] * a[k, k + 1:]) >> POINT
    return a, order


def _solve(lu: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    x, d = b.copy(), len(b)
    for k, i in enumerate(order):
        x[[k, i]] = x[[i, k]]
    for k in range(1, d):
        x[k] -= int((lu[k, :k] * x[:k]).sum()) >> POINT
    for k in range(d - 1, -1, -1):
        x[k] = ((x[k] << POINT) - int((lu[k, k + 1:] * x[k + 1:]).sum())) // lu[k, k]
    return x


def null_vectors(m: np.ndarray, root: Fraction, multiplicity: int) -> list[list[float]]:
    """Orthonormal vectors of ``m``'s eigenspace at ``root``, by inverse iteration in fixed point."""
    d = len(m)
    scale = max(int(np.trace(m)), 1).bit_length()      # entries near one, whatever the data's size
    a = (m << POINT) >> scale
    a[np.diag_indices(d)] -= (root.numerator << POINT) // (root.denominator << scale)
    lu, order = _eliminate(a)
    vs = [np.array([pow(3, 7 + i + 101 * j, 65537) - 32768 for i in range(d)], object) << POINT for j in range(multiplicity)]
    for _ in range(3):
        for j in range(multiplicity):
            v = _solve(lu, order, vs[j])
            for u in vs[:j]:
                v = v - (u * int((u * v).sum())) // int((u * u).sum())
            vs[j] = (v << POINT) // max(1, max(abs(x) for x in v))
    out = []
    for v in vs:
        size = isqrt(int((v * v).sum()))
        out.append([int(x) / size for x in v])
    return out


def components_of(spark: SparkSession, m: np.ndarray, count: int) -> tuple[list[Fraction], np.ndarray]:
    """The greatest eigenvalues of a positive semidefinite integer matrix, at most ``count`` and
    positive, and their unit eigenvectors as columns."""
    d = len(m)
    g = int(np.gcd.reduce(m.ravel())) if d else 0
    if not g:
        return [], np.zeros((d, 0))
    m = m // g
    found = greatest_roots(characteristic_polynomial(spark, m), min(count, d))

    def run(frames):
        import pandas as pd
        for f in frames:
            yield pd.DataFrame({"task": f["task"], "v": [null_vectors(m, Fraction(r), int(k))
                                                         for r, k in zip(f["root"], f["k"])]})

    got = _spread(spark, [(str(r), k) for r, k in found], "root string, k int", run, "task int, v array<array<double>>")
    values = [r * g for r, k in found for _ in range(k)][:count]
    vectors = [v for row in sorted(got, key=lambda r: r["task"]) for v in row["v"]][:count]
    return values, np.array(vectors).T


# ------------------------------------------------------------ the whitening --
def whiten(table: DataFrame, components: int = 16, factor: float = 64, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every
    remaining row and component.

    Rows whose vector is null, holds null or non-finite entries or has another length than
    most are left out.  The fit uses each distinct integer vector once.  Components without
    variance do not exist: with fewer than ``components`` positive eigenvalues there are
    fewer, and with one distinct vector, or none, no rows.  Rows with null or repeated ids
    are rows like others.  ``deviation`` is null where it exceeds a long.
    """
    spark = prepare(table.sparkSession)
    rows = integer_rows(table, factor, id_col, vector_col)
    fit = keep(rows.select("y").distinct(), "fit_list")
    one = fit.select(F.size("y").alias("d")).first()
    dims = one["d"] if one else 0
    n, sums, m = scatter(fit, dims) if dims else (0, [], np.zeros((0, 0), object))
    values, vectors = components_of(spark, m, components)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not values:
        return spark.createDataFrame([], out)
    trace, kept = int(np.trace(m)), len(values)
    project = vectors / np.array([sqrt(Fraction(e) / (n * n)) for e in values])
    centre = np.array(sums, object)

    def scaled(y: np.ndarray) -> np.ndarray:
        """n * y - sums, exact."""
        top = max(int(np.abs(y).max(initial=0)) * n, max(abs(s) for s in sums))
        return y * n - centre.astype(np.int64) if top < 1 << 61 else y.astype(object) * n - centre

    def whitened(z: np.ndarray) -> np.ndarray:
        return (z / n).astype(np.float64) @ project

    sum_schema = pa.schema([("s", pa.list_(pa.float64()))])

    def moments(batches):
        total = np.zeros(kept + kept * kept)
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                w = whitened(scaled(_matrix(b.column(0).slice(lo, _ROWS), dims)))
                total[:kept] += w.sum(axis=0)
                total[kept:] += (w.T @ w).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], schema=sum_schema)

    got = (fit.mapInArrow(moments, "s array<double>").select(F.posexplode("s").alias("k", "s")).groupBy("k")
           .agg(F.sum("s").alias("s")).collect())
    total = np.zeros(kept + kept * kept)
    for r in got:
        total[r["k"]] = r["s"] / n
    covariance = total[kept:].reshape(kept, kept) - np.outer(total[:kept], total[:kept])
    error = float(np.abs(covariance - np.eye(kept)).max())
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("w", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                part = b.slice(lo, _ROWS)
                z = scaled(_matrix(part.column(1), dims))
                largest = int(np.abs(z).max(initial=0))
                if largest * largest * dims >= 1 << 63:
                    z2 = z.astype(object)
                    deviation = [d if d < 1 << 63 else None for d in (z2 * z2).sum(axis=1).tolist()]
                else:
                    z2 = z.astype(np.int64)
                    deviation = np.einsum("ij,ij->i", z2, z2)
                w = whitened(z)
                off = pa.array(np.arange(len(w) + 1, dtype=np.int32) * kept)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(
                    off, pa.array(w.ravel()))], schema=schema)

    explained = F.array(*[F.lit(float(Fraction(e) / trace)) for e in values])
    done = rows.mapInArrow(run, "vec_id long, deviation long, w array<double>")
    return done.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))
