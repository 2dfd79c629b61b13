"""Embedding whitening by the exact characteristic polynomial of an integer scatter matrix.

Each entry c becomes the integer floor(1024 c) + 100000. With n vectors x and their sums S,

    A = n * sum z z' - Z Z',    z = x - floor(S / n),  Z = sum z

is an integer matrix, exactly n^2 times the covariance, and vectors are centred before they are
multiplied. Its products are summed exactly: inside a task in 64-bit integers with a checked bound
(beyond it in Python's integers), across tasks as halves of a decimal sum.

1. A's characteristic polynomial: modulo each of many 31-bit primes A is brought to Hessenberg form
   and the recurrence over its leading minors gives the coefficients. The primes are rows of a
   Spark table; there are as many as a bound of the coefficients asks for, and Chinese
   remaindering puts the coefficients together.
2. All its roots are real. The roots above a point are as many as the signs of the polynomial,
   shifted there, change; this count is exact with multiplicity. Bisection by it isolates each of the
   largest roots to 2^-FRACTION of one. Each root is a row of a Spark table.
3. Components by inverse iteration in fixed-point integers: (A - root) is factored once with
   partial pivoting, and a few solves turn a start vector into the null space, to far more digits
   than a double has. Roots closer than their brackets share a space; its vectors are made orthogonal.

Sizes: the matrix, d^2 numbers, and the polynomial, d + 1 coefficients, are held by the driver
and given to tasks; nothing there grows with the number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; d is the
longest length, and a shorter vector counts as if it held zeros behind its end; a null id stays; rows
that repeat are rows; an entry beyond the long range takes its end. Components of no variance (their
root is 0) have a null ``whitened`` and are not part of ``identity_error``; ``deviation`` is a
decimal, null beyond 38 digits; an empty table, or vectors of no entries, give no rows. Components of
equal variance are some basis of their space, the same for all rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentmatch.session import ship_package

SCALE, SHIFT = 1024, 100000
#: Bits after the point of a root's bracket, and of the fixed-point numbers of inverse iteration beyond the matrix's.
FRACTION = 64
_SOLVES = 4
_LONG = (1 << 63) - 1
_HALF = 1 << 64
_BATCH = 2000


# ---------------------------------------------------------------------------
# Integer vectors and their sums
# ---------------------------------------------------------------------------

def integers(batch: pa.RecordBatch, column: str, dims: int):
    """(rows, x): the places of the rows that stay, and their integer vectors (int64)."""
    values = batch.column(column)
    lengths = np.array([-1 if x is None else x for x in pc.list_value_length(values).to_pylist()])
    flat = pc.list_flatten(values)
    number = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)      # nulls are NaN
    there = np.maximum(lengths, 0)
    first = np.concatenate([[0], np.cumsum(there)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(number))])
    kept = np.flatnonzero((lengths >= 0) & (bad[first[1:]] == bad[first[:-1]]))
    x = np.full((len(kept), dims), SHIFT, dtype=np.int64)
    with np.errstate(over="ignore"):
        whole = np.floor(number * SCALE)
        inside = np.abs(whole) < float(1 << 62)
        made = np.where(inside, whole, 0).astype(np.int64) + SHIFT
        made[~inside & (number > 0)] = _LONG
        made[~inside & (number < 0)] = -_LONG - 1
    if (there[kept] == dims).all():
        return kept, made[first[kept][:, None] + np.arange(dims)]
    for i, r in enumerate(kept):
        n = min(int(there[r]), dims)
        x[i, :n] = made[first[r]:first[r] + n]
    return kept, x


def _slices(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, _BATCH):
        yield batch.slice(at, _BATCH)


def _halves(total: int) -> tuple[Decimal, Decimal]:
    return Decimal(total // _HALF), Decimal(total % _HALF)


_SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))])
SUMS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def _emit(totals: dict):
    rows = [(i, j, *_halves(v)) for (i, j), v in totals.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SUMS, strict=True)], schema=_SUMS)


def _collected(df: DataFrame) -> dict[tuple[int, int], int]:
    """Sums by place; as many rows as the matrix has."""
    rows = df.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r.i, r.j): int(r.high) * _HALF + int(r.low) for r in rows}


def _first_sums(column: str, dims: int):
    """Number of vectors at (-1, -1), sums at (-1, j)."""
    def run(batches):
        n, sums = 0, [0] * dims
        for batch in batches:
            for part in _slices(batch):
                kept, x = integers(part, column, dims)
                n += len(kept)
                # upper and lower halves keep a sum of up to 2^31 rows within 64 bits
                for j, (h, low) in enumerate(zip((x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist(), strict=True)):
                    sums[j] += (h << 32) + low
        if n:
            yield from _emit({(-1, -1): n} | {(-1, j): s for j, s in enumerate(sums)})
    return run


def centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x - middle: int64 if that is safe, else Python's integers."""
    m = np.array(middle, dtype=object)
    if not x.size or max(abs(int(x.max())), abs(int(x.min()))) < 1 << 61 and max(map(abs, middle)) < 1 << 61:
        return x - m.astype(np.int64)
    return x.astype(object) - m


def _products(column: str, dims: int, middle: list[int]):
    """sum z z' at (i, j), j >= i, and sum z at (-1, j)."""
    def run(batches):
        q, s = np.zeros((dims, dims), dtype=object), np.zeros(dims, dtype=object)
        any_row = False
        for batch in batches:
            for part in _slices(batch):
                kept, x = integers(part, column, dims)
                if not len(kept):
                    continue
                any_row = True
                z = centred(x, middle)
                largest = max(abs(int(z.max())), abs(int(z.min())))
                if z.dtype == object or largest * largest * len(kept) >= 1 << 62:
                    z = z.astype(object)
                elif largest * largest * len(kept) < 1 << 53:
                    # exact in doubles, whose product is the fast one
                    q += np.rint(z.T.astype(np.float64) @ z.astype(np.float64)).astype(np.int64).astype(object)
                    s += z.sum(axis=0).astype(object)
                    continue
                q += z.T.dot(z).astype(object)
                s += z.sum(axis=0).astype(object)
        if any_row:
            yield from _emit({(i, j): int(q[i, j]) for i in range(dims) for j in range(i, dims)} | {(-1, j): int(s[j]) for j in range(dims)})
    return run


# ---------------------------------------------------------------------------
# Characteristic polynomial
# ---------------------------------------------------------------------------

def primes_below(top: int, bits: int) -> list[int]:
    """Primes downward from ``top`` whose product has more than ``bits`` bits."""
    out, got, p = [], 0.0, top | 1
    while got <= bits + 1:
        p -= 2
        if _is_prime(p):
            out.append(p)
            got += math.log2(p)
    return out


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 3.2 * 10^9."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo the prime p (below 2^31), from t^0 up."""
    h = matrix.copy()
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        r = k + int(below[0])
        if r != k:
            h[[k, r]] = h[[r, k]]
            h[:, [k, r]] = h[:, [r, k]]
        factors = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        if not factors.any():
            continue
        # rows below lose their multiple of row k; the inverse change adds columns to column k
        h[k + 1:, k - 1:] = (h[k + 1:, k - 1:] - factors[:, None] * h[k, k - 1:][None, :]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors[None, :] % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        poly = np.zeros(d + 1, dtype=np.int64)
        poly[1:] = polys[k - 1, :-1]
        poly = (poly - int(h[k - 1, k - 1]) * polys[k - 1]) % p
        run = 1
        for i in range(1, k):
            run = run * int(h[k - i, k - i - 1]) % p
            if not run:
                break
            poly = (poly - (int(h[k - i - 1, k - 1]) * run % p) * polys[k - i - 1]) % p
        polys[k] = poly
    return polys[d].tolist()


def _residues(matrix: list[list[int]]):
    def run(batches):
        exact = np.array(matrix, dtype=object)
        for batch in batches:
            found = [polynomial_modulo((exact % p).astype(np.int64), p) for p in batch.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "residues"])
    return run


def remaindered(found: list[tuple[int, list[int]]]) -> list[int]:
    """The integers nearest to zero with the given residues, place by place (Chinese remainders)."""
    product, values = 1, [0] * len(found[0][1])
    for p, residues in found:
        inverse = pow(product % p, -1, p)
        values = [v + product * ((r - v) * inverse % p) for v, r in zip(values, residues, strict=True)]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits that no coefficient exceeds: those are sums of products of roots, none negative, of a given total."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    return max(math.comb(d, k) * mean ** k for k in range(d + 1)).bit_length() + 2


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix), t^0 first, of an integer matrix without negative roots."""
    primes = primes_below((1 << 31) - 1, coefficient_bits(matrix))
    # a task for a few primes each
    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(max(1, min(len(primes) // 4, spark.sparkContext.defaultParallelism)))
    rows = table.mapInArrow(_residues(matrix), "p long, residues array<long>").collect()
    return remaindered([(r.p, r.residues) for r in rows])


# ---------------------------------------------------------------------------
# Roots
# ---------------------------------------------------------------------------

def roots_above(coefficients: list[int], point: int) -> int:
    """Roots larger than an integer point of a polynomial (t^0 first) whose roots are all real: sign
    changes of the shifted polynomial."""
    c = list(coefficients)
    n = len(c)
    for i in range(n - 1):
        for k in range(n - 2, i - 1, -1):
            c[k] += point * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def kth_root(coefficients: list[int], k: int, top: int, fraction: int = FRACTION) -> int:
    """2^fraction * r, rounded up, for the k-th largest root r (k from 1), found between 0 and ``top``.

    With s bits behind the point, the polynomial of the scaled root has integer coefficients."""
    d = len(coefficients) - 1
    if roots_above(coefficients, 0) < k:
        return 0
    low, high = 0, top + 1      # the root is above low, and not above high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if roots_above(coefficients, middle) >= k else (low, middle)
    # the root is in (low, low + 1]: a few bits a step, each step in its own scale
    done = 0
    while done < fraction:
        step = min(32, fraction - done)
        done += step
        scaled = [c << (done * (d - i)) for i, c in enumerate(coefficients)]
        low, high = low << step, (low + 1) << step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if roots_above(scaled, middle) >= k else (low, middle)
    return high


def _roots(coefficients: list[int], top: int):
    """Roots as decimal text: they are wider than any column of numbers."""
    def run(batches):
        for batch in batches:
            found = [str(kth_root(coefficients, k, top)) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["k", "root"])
    return run


def largest_roots(spark: SparkSession, coefficients: list[int], count: int, top: int) -> list[int]:
    """The ``count`` largest roots times 2^FRACTION, falling; each is found by a task of its own."""
    table = spark.range(1, count + 1, 1, count).select(F.col("id").alias("k"))
    rows = table.mapInArrow(_roots(coefficients, top), "k long, root string").collect()
    return [int(r.root) for r in sorted(rows, key=lambda r: r.k)]


# ---------------------------------------------------------------------------
# Null spaces
# ---------------------------------------------------------------------------

def _factored(matrix: list[list[int]], root: int, bits: int) -> tuple[np.ndarray, list[int]]:
    """L and U (in one) of (matrix - root), fixed-point with ``bits``, rows exchanged."""
    d = len(matrix)
    m = np.array(matrix, dtype=object) * (1 << bits)
    for i in range(d):
        m[i, i] -= root << (bits - FRACTION)
    order = list(range(d))
    for k in range(d):
        r = max(range(k, d), key=lambda i: abs(m[i, k]))
        if r != k:
            m[[k, r]] = m[[r, k]]
            order[k], order[r] = order[r], order[k]
        if m[k, k] == 0:
            m[k, k] = 1          # a null space on the spot: the least of numbers stands for zero
        for i in range(k + 1, d):
            if m[i, k]:
                f = (m[i, k] << bits) // m[k, k]
                m[i, k] = f
                m[i, k + 1:] -= f * m[k, k + 1:] >> bits
    return m, order


def _solved(lu: np.ndarray, order: list[int], b: np.ndarray, bits: int) -> np.ndarray:
    d = len(b)
    x = b[order].copy()
    for i in range(1, d):
        x[i] -= int(np.dot(lu[i, :i], x[:i])) >> bits
    for i in range(d - 1, -1, -1):
        x[i] = ((x[i] - (int(np.dot(lu[i, i + 1:], x[i + 1:])) >> bits if i + 1 < d else 0)) << bits) // lu[i, i]
    return x


def _unit(x: np.ndarray, bits: int) -> np.ndarray:
    length = math.isqrt(int(np.dot(x, x)))
    return np.array([(int(v) << bits) // length for v in x], dtype=object)


def null_space(matrix: list[list[int]], root: int, count: int) -> list[np.ndarray]:
    """``count`` orthonormal vectors (doubles) of the space that belongs to a root and those that share its bracket."""
    d = len(matrix)
    bits = 2 * FRACTION + 2 * max(1, max(abs(x) for r in matrix for x in r)).bit_length()
    lu, order = _factored(matrix, root, bits)
    found: list[np.ndarray] = []
    for c in range(count):
        x = _unit(np.array([pow(3, 7 * (i + 1) + c + 1, 1000003) - 500001 for i in range(d)], dtype=object), bits)
        for _ in range(_SOLVES):
            x = _unit(_solved(lu, order, x, bits), bits)
            for _ in range(2):
                for f in found:
                    x = x - np.array([v * int(np.dot(f, x)) >> 2 * bits for v in f], dtype=object)
                x = _unit(x, bits)
        found.append(x)
    out = []
    for x in found:
        y = np.array([int(v) / (1 << bits) for v in x])
        y *= np.sign(y[np.argmax(np.abs(y))])
        out.append(y)
    return out


def _spaces(matrix: list[list[int]]):
    def run(batches):
        for batch in batches:
            rows = []
            for first, root, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(first + i, v.tolist()) for i, v in enumerate(null_space(matrix, int(root), count))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["k", "v"])
    return run


def components_of(spark: SparkSession, matrix: list[list[int]], roots: list[int]) -> list[np.ndarray]:
    """Unit vectors, one for each root; roots within a few units of their last bit share a space.
    Each space is found by a task of its own."""
    groups: list[list[int]] = []
    for k, r in enumerate(roots):
        if groups and roots[groups[-1][-1]] - r <= 4:
            groups[-1].append(k)
        else:
            groups.append([k])
    if not groups:
        return []
    table = spark.createDataFrame([(g[0], str(roots[g[0]]), len(g)) for g in groups], "k long, root string, n int").repartition(len(groups), "k")
    rows = table.mapInArrow(_spaces(matrix), "k long, v array<double>").collect()
    return [np.array(r.v) for r in sorted(rows, key=lambda r: r.k)]


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------

class Whitening:
    """A fitted whitening: n, sums (integers), components (rows), variances, shares of the whole variance."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, variances: list[float], explained: list[float]):
        self.n, self.sums, self.components, self.variances, self.explained = n, sums, components, variances, explained

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened vectors; NaN for components of no variance."""
        # the whole part of the mean is taken off as integers, the rest (below 1) as doubles
        whole = [s // self.n for s in self.sums]
        rest = np.array([s % self.n / self.n for s in self.sums])
        y = centred(x, whole).astype(np.float64) - rest
        scale = np.array([1 / math.sqrt(v) if v else np.nan for v in self.variances])
        return (y @ self.components.T) * scale


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = 8) -> Whitening | None:
    """The whitening of all vectors of ``rows``; None if there are none, or none has an entry."""
    spark = rows.sparkSession
    ship_package(spark)
    own = rows.select(F.col(vector_col).alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    dims = own.where(F.col("v").isNotNull() & whole).agg(F.max(F.size("v"))).first()[0] or 0
    if dims <= 0:
        return None
    first = _collected(own.mapInArrow(_first_sums("v", dims), SUMS))
    if (-1, -1) not in first:
        return None
    n, sums = first[-1, -1], [first[-1, j] for j in range(dims)]
    middle = [s // n for s in sums]
    found = _collected(own.mapInArrow(_products("v", dims, middle), SUMS))
    z = [found[-1, j] for j in range(dims)]
    a = [[n * found[min(i, j), max(i, j)] - z[i] * z[j] for j in range(dims)] for i in range(dims)]
    trace = sum(a[i][i] for i in range(dims))
    count = min(components, dims)
    if trace == 0:
        return Whitening(n, sums, np.eye(count, dims), [0.0] * count, [0.0] * count)
    divisor = math.gcd(*(x for r in a for x in r))
    a = [[x // divisor for x in r] for r in a]
    trace //= divisor
    polynomial = characteristic_polynomial(spark, a)
    roots = largest_roots(spark, polynomial, count, trace)
    vectors = components_of(spark, a, roots)
    scale = divisor / (n * n)
    return Whitening(n, sums, np.array(vectors), [r / (1 << FRACTION) * scale for r in roots], [r / (1 << FRACTION) / trace for r in roots])


def _moments(column: str, dims: int, model: Whitening):
    """Sums of whitened vectors and of their products, of one task."""
    k = len(model.components)

    def run(batches):
        n, s, q = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for part in _slices(batch):
                w = np.nan_to_num(model.project(integers(part, column, dims)[1]))
                n, s, q = n + len(w), s + w.sum(axis=0), q + w.T @ w
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([s.tolist()], pa.list_(pa.float64())), pa.array([q.ravel().tolist()], pa.list_(pa.float64()))], ["n", "s", "q"])
    return run


def identity_error(rows: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance (divisor n) minus the identity,
    over the components that have a variance."""
    dims, k = len(model.sums), len(model.components)
    parts = rows.select(F.col(vector_col).alias("v")).mapInArrow(_moments("v", dims, model), "n long, s array<double>, q array<double>")
    # a sum for each place, in Spark: as many rows as k^2
    places = parts.select(F.posexplode(F.concat("s", "q")).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    x = np.zeros(k + k * k)
    for r in places:
        x[r.i] = r.x
    mean = x[:k] / model.n
    live = np.flatnonzero(np.array(model.variances) > 0)
    if not len(live):
        return 0.0
    off = x[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)
    return float(np.abs(off[np.ix_(live, live)]).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over the dimensions of (n x - S)^2."""
    largest = max(abs(int(x.max())), abs(int(x.min())), 1) if x.size else 1
    bound = n * largest + max(map(abs, sums))
    if bound < 1 << 62:
        y = n * x - np.array(sums, dtype=np.int64)
        most = int(np.abs(y).max()) if y.size else 0
        if most * most * max(1, x.shape[1]) < 1 << 62:
            return (y * y).sum(axis=1).tolist()
        y = y.astype(object)
    else:
        y = n * x.astype(object) - np.array(sums, dtype=object)
    return [int(v) for v in (y * y).sum(axis=1)]


def _whitened(dims: int, model: Whitening, error: float):
    k = len(model.components)

    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                kept, x = integers(part, "v", dims)
                if not len(kept):
                    continue
                w = model.project(x)
                far = [Decimal(v) if v < 10 ** 38 else None for v in deviations(x, model.n, model.sums)]
                ids = part.column("id").take(pa.array(np.repeat(kept, k)))
                flat = w.ravel()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept))), pa.array(np.full(len(flat), model.n, dtype=np.int64)),
                     pa.array([v for v in far for _ in range(k)], pa.decimal128(38, 0)), pa.array(flat, mask=np.isnan(flat)),
                     pa.array(np.tile(np.array(model.explained), len(kept))), pa.array(np.full(len(flat), error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """Per remaining row and component: id, component (from 1), n, deviation, whitened, explained and
    identity_error, as fitted on all remaining rows."""
    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(rows, vector_col, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model, vector_col)
    own = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    return own.mapInArrow(_whitened(len(model.sums), model, error), schema)
