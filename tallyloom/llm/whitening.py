"""Embedding whitening from an exact characteristic polynomial.

Vectors become integers, so their scatter matrix is exact. Its characteristic
polynomial is computed modulo many primes by reduction to Hessenberg form, put
together by Chinese remaindering, and its real roots are isolated and refined in
integer arithmetic. Inverse iteration in fixed-point arithmetic gives the
components. All steps over rows and over primes and components are Spark tasks;
the driver holds d x d integers for vectors of d entries, whatever the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, with_columns, written

# Fixed values of the contract: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries are held within this, so that every x is a long.
LARGEST = 1 << 62
#: Components that are kept.
COMPONENTS = 32
#: Bits of sums that go through Spark in one long.
_LIMB = 30
#: Primes and components in a task.
_PRIMES_A_TASK, _COMPONENTS_A_TASK = 64, 4
#: Rows of a batch whose products are summed at once.
_ROWS = 4_096


class Whitening(NamedTuple):
    """What whitening needs: rows and sums of x, eigenvalues of x's covariance, unit eigenvectors as rows, its trace."""

    n: int
    sums: list[int]
    eigenvalues: list[float]
    components: np.ndarray
    explained: list[float]

    @property
    def dim(self) -> int:
        return len(self.sums)


# Integers from vectors.


def usable(df: DataFrame, column: str) -> DataFrame:
    """The rows whose vector is not NULL and holds no NULL, NaN or infinite entry."""
    finite = F.forall(col(column), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return df.where(F.coalesce(col(column).isNotNull() & finite, F.lit(False)))


def dimension(df: DataFrame, column: str) -> int:
    """Entries of the longest vector, 0 without rows; shorter vectors count as ending in zeros."""
    return df.agg(F.max(F.size(col(column)))).first()[0] or 0


def integers(vectors: pa.Array, dim: int) -> np.ndarray:
    """x of each vector as rows of longs; entries beyond 2^62 / 64 count as that."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    c = np.zeros((len(vectors), dim))
    c[np.arange(dim) < lengths[:, None]] = flat
    with np.errstate(over="ignore"):  # the largest doubles times 64 are infinite, and clipped
        scaled = np.floor(SCALE * c)
    return np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT


def _products(y: np.ndarray) -> np.ndarray:
    """Exact sum of outer products of rows, as Python integers; y is cut in digits so that doubles hold all partial sums."""
    top = int(max(abs(int(y.min())), abs(int(y.max())))) if y.size else 0
    if len(y) * top * top < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    width = (53 - max(1, len(y)).bit_length()) // 2
    digits, rest = [], y.copy()
    while np.any(rest):
        low = rest & ((1 << width) - 1)
        digits.append(low.astype(np.float64))
        rest = (rest - low) >> width
        if np.all(rest == -1):  # two's complement of what is left
            digits.append(np.full(y.shape, -1.0))
            break
        if len(digits) * width > 64:
            digits.append(rest.astype(np.float64))
            break
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(digits):
        for j, b in enumerate(digits):
            out += (a.T @ b).astype(np.int64).astype(object) * (1 << (width * (i + j)))
    return out


def _limbs(cell: int, value: int) -> Iterator[tuple[int, int, int]]:
    """(cell, limb, part) with value = sum of part * 2^(30 limb): sums of parts stay longs."""
    sign, rest, limb = (1, value, 0) if value >= 0 else (-1, -value, 0)
    while rest:
        yield cell, limb, sign * (rest & ((1 << _LIMB) - 1))
        rest >>= _LIMB
        limb += 1


def moments(df: DataFrame, column: str, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) of x - 1,000,000, exact. A batch sends d (d + 1) / 2 sums at most."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                y = integers(batch.column(0).slice(at, _ROWS), dim) - SHIFT
                n += len(y)
                sums = sums + y.astype(object).sum(axis=0) if np.abs(y).max(initial=0) > 1 << 50 else sums + y.sum(axis=0).astype(object)
                total = total + _products(y)
        if not n:
            return
        rows = [*_limbs(0, n)]
        for i in range(dim):
            rows += _limbs(1 + i, int(sums[i]))
            for j in range(i, dim):
                rows += _limbs(1 + dim + i * dim + j, int(total[i, j]))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["cell", "limb", "part"])

    found = df.select(col(column)).mapInArrow(partial, "cell long, limb long, part long")
    cells: dict[int, int] = {}
    for r in found.groupBy("cell", "limb").agg(F.sum("part").alias("part")).collect():
        cells[r["cell"]] = cells.get(r["cell"], 0) + (r["part"] << (_LIMB * r["limb"]))
    n = cells.get(0, 0)
    sums = [cells.get(1 + i, 0) for i in range(dim)]
    product = [[cells.get(1 + dim + min(i, j) * dim + max(i, j), 0) for j in range(dim)] for i in range(dim)]
    return n, sums, product


def scatter(n: int, sums: list[int], product: list[list[int]]) -> list[list[int]]:
    """n^2 times the covariance with divisor n, exact; a common shift of x cancels."""
    dim = len(sums)
    return [[n * product[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]


# The characteristic polynomial.


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 3 * 10^9."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_below(top: int, count: int) -> list[int]:
    """The `count` largest primes below `top`."""
    out, n = [], top - 1 - top % 2
    while len(out) < count:
        if _is_prime(n):
            out.append(n)
        n -= 2
    return out


def _inverses(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverse of each x modulo its prime, by Fermat; 0 gives 0."""
    out, base, e = np.ones_like(x), x % p, p - 2
    while np.any(e):
        out = np.where(e & 1, out * base % p, out)
        base = base * base % p
        e = e >> 1
    return out


def polynomials_modulo(residues: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients of det(t - A), lowest first, modulo each prime; residues: (primes, d, d).

    Each matrix is brought to Hessenberg form by similarity, all primes at once;
    the polynomials of its leading blocks then follow from each other.
    """
    h, d = residues.astype(np.int64).copy(), residues.shape[1]
    k, pp = np.arange(len(p)), p[:, None]
    for m in range(1, d - 1):
        pivot = m + np.argmax(h[:, m:, m - 1] != 0, axis=1)
        for axis in (1, 2):  # swap rows, then columns
            x = h if axis == 1 else h.transpose(0, 2, 1)
            held = x[k, pivot].copy()
            x[k, pivot] = x[:, m]
            x[:, m] = held
        factor = h[:, m + 1 :, m - 1] * _inverses(h[:, m, m - 1], p)[:, None] % pp
        h[:, m + 1 :] = (h[:, m + 1 :] - factor[:, :, None] * h[:, None, m] % pp[:, :, None]) % pp[:, :, None]
        gained = np.zeros((len(p), d), np.int64)
        for i in range(d - m - 1):  # one at a time: sums of products of residues would pass a long
            gained = (gained + factor[:, i, None] * h[:, :, m + 1 + i]) % pp
        h[:, :, m] = (h[:, :, m] + gained) % pp
    polys = np.zeros((d + 1, len(p), d + 1), np.int64)
    polys[0, :, 0] = 1
    for m in range(1, d + 1):
        new = -h[:, m - 1, m - 1, None] * polys[m - 1] % pp
        new[:, 1:] = (new[:, 1:] + polys[m - 1, :, :-1]) % pp
        chain = np.ones(len(p), np.int64)
        for i in range(m - 1, 0, -1):
            chain = chain * h[:, i, i - 1] % p
            new = (new - (h[:, i - 1, m - 1] * chain % p)[:, None] * polys[i - 1]) % pp
        polys[m] = new % pp
    return polys[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - A), lowest first, of a symmetric positive semidefinite integer matrix.

    Each is at most binomial(d, k) (trace / k)^k in size, which tells how many primes are needed;
    primes are dealt out over tasks.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return [0] * d + [1]
    bits = max((math.comb(d, k) * trace**k // k**k).bit_length() for k in range(1, d + 1)) + 2
    primes = primes_below(1 << 31, -(-bits // 30))
    held = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for at in range(0, len(own), _PRIMES_A_TASK):
                part = own[at : at + _PRIMES_A_TASK]
                a = np.array(held.value, object)
                residues = np.stack([(a % q).astype(np.int64) for q in part])
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(polynomials_modulo(residues, np.array(part)).tolist(), pa.list_(pa.int64()))], ["prime", "poly"])

    rows = spark.createDataFrame([(q,) for q in primes], "prime long").repartition(max(1, len(primes) // _PRIMES_A_TASK))
    found = {r["prime"]: r["poly"] for r in rows.mapInArrow(solve, "prime long, poly array<long>").collect()}
    return [_remaindered([(found[q][i], q) for q in primes]) for i in range(d + 1)]


def _remaindered(parts: list[tuple[int, int]]) -> int:
    """The integer of least size with these residues."""
    whole = math.prod(q for _, q in parts)
    value = sum(r * (whole // q) * pow(whole // q, -1, q) for r, q in parts) % whole
    return value - whole if value > whole // 2 else value


# Its roots. Polynomials are lists of integers, lowest first.


def _primitive(f: list[int]) -> list[int]:
    while f and not f[-1]:
        f = f[:-1]
    g = reduce(math.gcd, f, 0) or 1
    return [c // g for c in f]


def _derivative(f: list[int]) -> list[int]:
    return [i * c for i, c in enumerate(f)][1:]


def _divided(f: list[int], g: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder of f times a power of g's leading coefficient, by g."""
    f, out = list(f), []
    while len(f) >= len(g):
        lead = f[-1]
        f = [c * g[-1] for c in f]
        out = [lead, *(c * g[-1] for c in out)]
        at = len(f) - len(g)
        for i, c in enumerate(g):
            f[at + i] -= lead * c
        f.pop()
    return out, f


def _common(f: list[int], g: list[int]) -> list[int]:
    """Greatest common divisor, primitive."""
    f, g = _primitive(f), _primitive(g)
    while g:
        f, g = g, _primitive(_divided(f, g)[1])
    return f


def _is_square_free(f: list[int]) -> bool:
    """True if a prime proves that f has no repeated root; f is tested modulo a few."""
    for q in primes_below(1 << 31, 4):
        if f[-1] % q == 0 or len(f) - 1 >= q:
            continue
        a, b = [c % q for c in f], [c % q for c in _derivative(f)]
        while b and not b[-1]:
            b.pop()
        while b:
            inverse = pow(b[-1], -1, q)
            while len(a) >= len(b):
                k, at = a[-1] * inverse % q, len(a) - len(b)
                for i, c in enumerate(b):
                    a[at + i] = (a[at + i] - k * c) % q
                a.pop()
            while a and not a[-1]:
                a.pop()
            a, b = b, a
        if len(a) == 1:
            return True
    return False


def square_free_parts(f: list[int]) -> list[tuple[list[int], int]]:
    """(square-free factor, multiplicity of its roots), for roots other than 0."""
    while f and not f[0]:
        f = f[1:]
    f = _primitive(f)
    if len(f) <= 1:
        return []
    if _is_square_free(f):
        return [(f, 1)]
    out, k = [], 1
    shared = _common(f, _derivative(f))
    rest = _primitive(_divided(f, shared)[0])
    while len(rest) > 1:
        both = _common(rest, shared)
        own = _primitive(_divided(rest, both)[0])
        if len(own) > 1:
            out.append((own, k))
        rest, shared = both, _primitive(_divided(shared, both)[0])
        k += 1
    return out


def _sign_at(f: list[int], a: int, b: int) -> int:
    """Sign of f at a / 2^b."""
    value = 0
    for i, c in enumerate(reversed(f)):
        value = value * a + (c << (b * i))
    return (value > 0) - (value < 0)


def _above(f: list[int], a: int, b: int) -> int:
    """How many roots of f are above a / 2^b, if all roots are real: the sign changes of f shifted there."""
    g = [c << (b * (len(f) - 1 - i)) for i, c in enumerate(f)]
    for i in range(len(g) - 1):
        for j in range(len(g) - 2, i - 1, -1):
            g[j] += a * g[j + 1]
    signs = [c > 0 for c in g if c]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def isolated_roots(f: list[int]) -> list[tuple[int, int, int]]:
    """(low, high, b), falling: each root of f is alone in (low / 2^b, high / 2^b]; f is square-free, its roots real and above 0."""
    if len(f) == 1:
        return []
    # No root is beyond twice the largest k-th root of the k-th coefficient from the top.
    d, lead = len(f) - 1, abs(f[-1])
    top = 1 << (2 + max(-(-max(0, abs(f[d - k]).bit_length() - lead.bit_length() + 1) // k) for k in range(1, d + 1)))
    out, open_ = [], [(0, top, 0, _above(f, 0, 0), 0)]
    while open_:
        low, high, b, over, beyond = open_.pop()
        if over - beyond == 1:
            out.append((low, high, b))
        elif over - beyond > 1:
            low, high, b = 2 * low, 2 * high, b + 1
            mid = (low + high) // 2
            inner = _above(f, mid, b)
            open_ += [(low, mid, b, over, inner), (mid, high, b, inner, beyond)]
    return sorted(out, key=lambda r: Fraction(r[1], 1 << r[2]), reverse=True)


def refined(f: list[int], low: int, high: int, b: int, bits: int) -> tuple[int, int]:
    """(a, b): the one root of f in (low, high] / 2^b, above 0, lies in (a - 1, a] / 2^b, with a of `bits` bits or more, by bisection."""
    sign = _sign_at(f, high, b)
    if not sign:
        return high << bits, b + bits
    while high - low > 1 or abs(high).bit_length() <= bits:
        if high - low == 1:
            low, high, b = 2 * low, 2 * high, b + 1
        mid = (low + high) // 2
        here = _sign_at(f, mid, b)
        if not here:
            return mid << bits, b + bits
        if here == sign:
            high = mid
        else:
            low = mid
    return high, b


# Components.


def null_space(matrix: list[list[int]], root: Fraction, size: int, bits: int) -> np.ndarray:
    """`size` orthonormal rows that (A - root) sends to about 0, by inverse iteration in fixed-point arithmetic.

    The matrix is scaled to entries below 1 and `bits` bits are kept. Starts are fixed
    vectors, so the result depends on the matrix only. Its first non-zero entry is positive.
    """
    d = len(matrix)
    scale = max(abs(c) for row in matrix for c in row) + int(abs(root)) + 1
    one = 1 << bits
    shifted = np.array([[(c << bits) // scale for c in row] for row in matrix], object)
    for i in range(d):
        shifted[i, i] -= int(root * one / scale)
    order, lower = np.arange(d), np.zeros((d, d), object)
    for k in range(d):
        best = k + int(np.argmax([abs(x) for x in shifted[k:, k]]))
        if best != k:
            for x in (shifted, lower):
                x[[k, best]] = x[[best, k]]
            order[[k, best]] = order[[best, k]]
        pivot = shifted[k, k] = shifted[k, k] or 1
        for i in range(k + 1, d):
            if shifted[i, k]:
                factor = lower[i, k] = (shifted[i, k] << bits) // pivot
                shifted[i, k:] -= (factor * shifted[k, k:]) >> bits
    found = [np.array([((i * 40_503 + s * 30_011 + 7) * 2_654_435_761 % 65_537 - 32_768) << (bits - 16) for i in range(d)], object) for s in range(size)]
    for _ in range(3):
        solved = []
        for v in found:
            y = v[order].copy()
            for i in range(d):
                y[i] -= int((lower[i, :i] * y[:i]).sum() >> bits) if i else 0
            for i in range(d - 1, -1, -1):
                y[i] = ((y[i] - (int((shifted[i, i + 1 :] * y[i + 1 :]).sum()) >> bits if i < d - 1 else 0)) << bits) // shifted[i, i]
            largest = max(abs(int(c)) for c in y) or 1
            y = np.array([(int(c) << bits) // largest for c in y], object)
            for w in solved:
                y -= w * int((w * y).sum() >> bits) >> bits
            norm = math.isqrt(int((y * y).sum())) or 1
            solved.append(np.array([(int(c) << bits) // norm for c in y], object))
        found = solved
    rows = np.array([[float(Fraction(int(c), one)) for c in v] for v in found])
    for row in rows:
        if row[np.argmax(row != 0)] < 0:
            row *= -1.0
    return rows


def eigen(spark: SparkSession, matrix: list[list[int]], most: int) -> tuple[list[Fraction], np.ndarray]:
    """The `most` largest eigenvalues above 0, falling, and unit eigenvectors as rows; a repeated one has orthogonal ones."""
    d = len(matrix)
    parts = square_free_parts(characteristic_polynomial(spark, matrix))
    places = [(Fraction(r[1], 1 << r[2]), f, k, r) for f, k in parts for r in isolated_roots(f)]
    # Roots of different factors differ, so their intervals come apart once they are narrow.
    roots = []
    for _, f, k, (low, high, b) in places:
        a, at = refined(f, low, high, b, 128)
        roots.append((Fraction(a, 1 << at), f, k, (a - 1, a, at)))
    roots.sort(key=lambda r: r[0], reverse=True)
    gaps = [abs(x[0] - y[0]) / x[0] for x, y in zip(roots, roots[1:], strict=False)]
    close = max([0, *(-math.floor(math.log2(g)) if g else 4_096 for g in gaps)])
    bits = 128 + 2 * close
    jobs, held = [], 0
    for value, f, k, (low, high, b) in roots:
        if held >= most:
            break
        if close > 16:
            a, at = refined(f, low, high, b, bits)
            value = Fraction(a, 1 << at)
        jobs.append((len(jobs), str(value.numerator), str(value.denominator), k))
        held += k
    if not jobs:
        return [], np.zeros((0, d))
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job, a, b, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = null_space(shared.value, Fraction(int(a), int(b)), k, bits + 128)
                yield pa.RecordBatch.from_arrays([pa.array([job]), pa.array([rows.tolist()], pa.list_(pa.list_(pa.float64())))], ["job", "rows"])

    rows = spark.createDataFrame(jobs, "job long, a string, b string, k int").repartition(max(1, len(jobs) // _COMPONENTS_A_TASK))
    found = {r["job"]: r["rows"] for r in rows.mapInArrow(solve, "job long, rows array<array<double>>").collect()}
    values = [Fraction(int(a), int(b)) for _, a, b, k in jobs for _ in range(k)]
    vectors = np.array([v for job, *_ in jobs for v in found[job]])
    return values[:most], vectors[:most]


# Whitening.


def fit(df: DataFrame, column: str, most: int = COMPONENTS) -> Whitening | None:
    """Whitening of the usable rows' vectors; None without rows.

    Directions without variance have no component: with fewer than `most`
    directions of positive variance there are fewer components.
    """
    rows = usable(df, column)
    dim = dimension(rows, column)
    n, sums, product = moments(rows, column, dim)
    if not n:
        return None
    matrix = scatter(n, sums, product)
    shared = reduce(math.gcd, (c for row in matrix for c in row), 0) or 1
    values, vectors = eigen(df.sparkSession, [[c // shared for c in row] for row in matrix], most)
    trace = sum(matrix[i][i] for i in range(dim)) or 1
    real = [float(v * shared / n**2) for v in values]
    return Whitening(n, [s + n * SHIFT for s in sums], real, vectors, [float(v * shared / trace) for v in values])


def _projected(vectors: pa.Array, model: Whitening) -> tuple[list[int | None], np.ndarray]:
    """Deviation and whitened components of each vector; a deviation too large for a long is None."""
    x = integers(vectors, model.dim)
    largest = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * model.n + max(map(abs, model.sums), default=0)
    if model.dim * largest * largest < 1 << 63:
        centred = x * model.n - np.array(model.sums, np.int64)
        deviations = (centred * centred).sum(axis=1).tolist()
    elif largest < 1 << 63:
        centred = x * model.n - np.array(model.sums, np.int64)
        top = int(np.abs(centred).max(initial=0))
        squares = centred if model.dim * top * top < 1 << 63 else centred.astype(object)
        deviations = (squares * squares).sum(axis=1).tolist()
    else:
        centred = x.astype(object) * model.n - np.array(model.sums, object)
        deviations = (centred * centred).sum(axis=1).tolist()
    y = (centred / model.n).astype(np.float64)
    return [v if v < 1 << 63 else None for v in deviations], (y @ model.components.T) / np.sqrt(np.array(model.eigenvalues))


def whiten(df: DataFrame, model: Whitening | None, column: str) -> DataFrame:
    """The usable rows with `deviation` and `whitened`, an array with one number for each component.

    Map-only. Rows with a NULL or unusable vector are left out; repeated rows stay and get equal
    numbers; input columns named like the new ones, in any case, are replaced. `deviation` is NULL
    where it doesn't fit a long. Without a model there are no usable rows and the result is empty.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<deviation:long,whitened:array<double>>")
    def project(vectors: pa.Array) -> pa.Array:
        deviations, whitened = [], []
        for at in range(0, len(vectors), _ROWS):
            d, w = _projected(vectors.slice(at, _ROWS), held.value)
            deviations += d
            whitened += w.tolist()
        return pa.StructArray.from_arrays([pa.array(deviations, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))], ["deviation", "whitened"])

    rows = usable(df, column)
    if model is None:
        rows = rows.limit(0)
        return with_columns(rows, {"deviation": F.lit(None).cast("long"), "whitened": F.lit(None).cast("array<double>")})
    (name,) = fresh(rows, "__projected")
    found = rows.withColumn(name, project(col(column)))
    return with_columns(found, {"deviation": F.col(f"{name}.deviation"), "whitened": F.col(f"{name}.whitened")}).drop(name)


def identity_error(whitened: DataFrame, column: str = "whitened") -> float | None:
    """The largest entry, in size, of the covariance of these arrays minus the identity; None without components.

    Each batch is centred by its own mean before multiplying; the means' spread is added.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = np.array(batch.column(0).to_pylist(), dtype=np.float64)
                mean = w.mean(axis=0)
                inner, k = (w - mean).T @ (w - mean), w.shape[1]
                spread = inner + len(w) * np.outer(mean, mean)
                cells = np.concatenate([[len(w)], len(w) * mean, spread.ravel()])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(np.full(len(cells), k)), pa.array(cells)], ["cell", "k", "part"])

    found = whitened.select(col(column)).mapInArrow(partial, "cell long, k long, part double").groupBy("cell", "k").agg(F.sum("part").alias("part")).collect()
    if not found or not found[0]["k"]:
        return None
    k, cells = found[0]["k"], np.zeros(len(found))
    for r in found:
        cells[r["cell"]] = r["part"]
    n, mean = cells[0], cells[1 : 1 + k] / cells[0]
    covariance = cells[1 + k :].reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def components(df: DataFrame, model: Whitening | None, column: str, keep: list[str]) -> DataFrame:
    """One row for each usable row and component: `keep`, component (from 1), n, deviation, whitened, explained, identity_error.

    The whitened arrays are written once; the error is measured on what was written.
    """
    named = df.select(F.struct(*map(col, keep)).alias("kept"), col(column).alias("vector"))
    rows = written(whiten(named, model, "vector").select("kept", "deviation", "whitened"), "whitened")
    error = identity_error(rows) if model else None
    explained = F.array(*map(F.lit, model.explained)) if model and model.explained else F.array().cast("array<double>")
    long = rows.select("kept", "deviation", F.posexplode("whitened").alias("at", "value"))
    return long.select(
        *(F.col("kept").getField(c).alias(c) for c in keep),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else None).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
