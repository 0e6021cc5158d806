"""Principal components and whitening by an exact characteristic polynomial.

Entries become integers, x = floor(256 c). Over the distinct x vectors the scatter
M = n sum(x x') - S S' is an integer matrix, n^2 times the covariance. Its
characteristic polynomial comes out exactly: modulo each of enough primes M is
reduced to Hessenberg form and the recurrence of its leading minors gives the
polynomial's residues; Chinese remaindering joins them, the number of primes
following from a bound on the coefficients. All roots are real, so the sign
changes of the polynomial shifted by a count exactly the roots above a, with
multiplicity: bisection on exact integers isolates the leading roots, and one that
is alone in its interval is refined by the polynomial's sign. Inverse iteration in
decimal arithmetic of ``DIGITS`` digits gives the null space of M - root.

Scale. Distinct vectors are a groupBy on packed integers (a vector that a third of
the rows hold is merged before the shuffle). Each task sums outer products of its
vectors exactly; the sums are aggregated as limbs of 30 bits. The polynomial
modulo each prime is a row of a Spark job. Only d^2 sums, d + 1 residues per prime
and the moments of the whitened rows reach the driver; none grows with the rows
but by digits. Work on the polynomial grows with d^4.

Defined results: rows with a null or empty vector, or with null or non-finite
entries, are left out, as are those whose length is not the commonest (the
greater one, if equal); entries beyond a long saturate; repeated rows and equal
vectors give equal results and count once; null ids stay. Components of equal
roots are an orthonormal basis of their space. A root of zero has no whitened
value (null; explained 0, or null if all are zero). ``deviation`` is null where it
does not fit a long. Fewer than ``top`` dimensions give as many components. A table
without usable vectors gives no row; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import only, read, written

TOP = 4
SCALE = 256
LIMB = 30
DIGITS = 120
#: bits to which a root is found, relative to the largest
ROOT_BITS = 128


# ---- integer vectors ------------------------------------------------------

def pack(x: np.ndarray) -> bytes:
    """Integers of a vector, 2 bytes each if they fit, else 8."""
    return x.astype("<i2" if -32768 <= x.min() and x.max() <= 32767 else "<i8").tobytes()


def unpack(column: pa.Array, size: int) -> np.ndarray:
    rows = [np.frombuffer(b.as_buffer(), "<i2" if len(b.as_buffer()) == 2 * size else "<i8") for b in column]
    return np.stack(rows).astype(np.int64) if rows else np.zeros((0, size), np.int64)


def _lattice(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            x = np.floor(SCALE * c)
            whole = np.clip(x, -(2.0 ** 63), 2.0 ** 62).astype(np.int64)
            whole[x >= 2.0 ** 62] = np.array([min(int(v), 2 ** 63 - 1) if v < np.inf else 2 ** 63 - 1 for v in x[x >= 2.0 ** 62]], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(pack, whole), pa.binary())], names=["vec_id", "x"])
    return run


def integer_vectors(rows: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x packed) of the usable rows, and the length of a vector (0: none)."""
    own = only(rows, vec_id="long", embedding="array<double>")
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    own = own.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True)))
    sizes = own.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    return own.where(F.size("embedding") == size).mapInArrow(_lattice(size), "vec_id long, x binary"), size


# ---- exact sums -----------------------------------------------------------

def limbs(value: int) -> list[int]:
    """Base 2^LIMB, the last limb with the sign."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def outer_sums(x: np.ndarray) -> np.ndarray:
    """Exact sum of outer products of (1, x) as Python integers."""
    one = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)
    most = max(1, int(abs(one.min().astype(object))), int(one.max()))
    if most * most * max(1, len(x)) < 1 << 53:  # every partial sum is exact in double
        f = one.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    wide = one.astype(object)
    return wide.T @ wide


def _gram(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1), dtype=object)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total = total + outer_sums(unpack(b.column(0).slice(at, 4096), size))
        rows = [(i, j, k, v) for i in range(size + 1) for j in range(i + 1) for k, v in enumerate(limbs(int(total[i, j]))) if v]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([],) * 4,
                                                                         (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                                         names=["i", "j", "k", "v"])
    return run


def scatter(distinct: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n sum(x x') - S S') of packed vectors ``x``."""
    sums = (distinct.select("x").mapInArrow(_gram(size), "i int, j int, k int, v long")
            .groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect())
    g = [[0] * (size + 1) for _ in range(size + 1)]
    for r in sums:
        g[r["i"]][r["j"]] += r["v"] << (LIMB * r["k"])
    n, s = g[0][0], [g[i][0] for i in range(1, size + 1)]
    return n, s, [[n * g[max(i, j) + 1][min(i, j) + 1] - s[i] * s[j] for j in range(size)] for i in range(size)]


# ---- characteristic polynomial --------------------------------------------

def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients (constant first) of det(z - matrix) modulo a prime below 2^31."""
    h, size = matrix.copy() % p, len(matrix)
    for m in range(1, size - 1):
        pivots = np.flatnonzero(h[m:, m - 1])
        if not len(pivots):
            continue
        i = m + int(pivots[0])
        if i > m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        by = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - by[:, None] * h[m] % p) % p
        for k, u in enumerate(by):  # the inverse step on columns; one product at a time stays below 2^63
            if u:
                h[:, m] = (h[:, m] + u * h[:, m + 1 + k]) % p
    minors = np.zeros((size + 1, size + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, size + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - h[k - 1, k - 1] * minors[k - 1]) % p
        t = 1
        for i in range(1, k):
            t = t * int(h[k - i, k - i - 1]) % p
            if not t:
                break
            minors[k] = (minors[k] - t * int(h[k - i - 1, k - 1]) % p * minors[k - i - 1]) % p
    return minors[size].tolist()


def _is_prime(n: int) -> bool:
    if n < 2 or any(n % q == 0 for q in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):  # decides every n below 3.2 * 10^9
        y = pow(a, d, n)
        if y not in (1, n - 1) and not any((y := y * y % n) == n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_for(matrix: list[list[int]]) -> list[int]:
    """Primes below 2^31 whose product exceeds twice any coefficient: those of a
    positive semidefinite matrix are elementary symmetric in its roots, at most
    those of d equal roots (Maclaurin)."""
    size = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(size)) // size)
    bound = 2 * max(comb(size, k) * mean ** k for k in range(size + 1)) + 1
    found, product, at = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    return found


def _residues(matrix: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                own = np.array([[v % p for v in row] for row in matrix], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([polynomial_mod(own, p)], pa.list_(pa.int64()))],
                                                 names=["p", "c"])
    return run


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, constant first, of det(z - matrix)."""
    primes = primes_for(matrix)
    tasks = max(1, min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    rows = (spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
            .mapInArrow(_residues(matrix), "p long, c array<long>").collect())
    product = 1
    for p in primes:
        product *= p
    out = [0] * (len(matrix) + 1)
    for r in rows:
        rest = product // r["p"]
        lift = rest * pow(rest, -1, r["p"])
        out = [a + c * lift for a, c in zip(out, r["c"], strict=True)]
    return [c % product - (product if 2 * (c % product) > product else 0) for c in out]


# ---- roots ----------------------------------------------------------------

def roots_above(poly: list[int], a: int) -> int:
    """Roots greater than a, with multiplicity, of a polynomial with real roots
    only: sign changes of its coefficients after the shift by a."""
    c = list(poly)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def leading_roots(poly: list[int], top: int, trace: int) -> list[Fraction]:
    """The ``top`` greatest roots with multiplicity, falling, each to within
    2^-ROOT_BITS of the greatest."""
    size = len(poly) - 1
    if trace == 0:
        return [Fraction(0)] * min(top, size)
    shift = max(0, ROOT_BITS - (trace // size).bit_length())
    scaled = [c << (shift * (size - k)) for k, c in enumerate(poly)]

    def sign(a: int) -> int:
        value = 0
        for c in reversed(scaled):
            value = value * a + c
        return (value > 0) - (value < 0)

    known = {-1: size, (trace << shift) + 1: 0}  # roots above a point

    def above(a: int) -> int:
        if a not in known:
            known[a] = roots_above(scaled, a)
        return known[a]

    found = []
    for k in range(1, min(top, size) + 1):
        low = max(a for a, c in known.items() if c >= k)
        high = min(a for a, c in known.items() if c < k)
        while high - low > 1 and not (above(low) == k and above(high) == k - 1):
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        beyond = 1 if k % 2 else -1  # the sign between this root and the one above it
        while high - low > 1:  # one simple root in (low, high]: the sign changes there
            middle = (low + high) // 2
            low, high = (low, middle) if sign(middle) * beyond >= 0 else (middle, high)
        found.append(Fraction(max(high, 0), 1 << shift))
    return found


# ---- components -----------------------------------------------------------

def _solver(matrix: list[list[Decimal]], shift: Decimal, tiny: Decimal):
    """Solves (matrix - shift) y = b by elimination with row pivots; a pivot of zero becomes tiny."""
    size = len(matrix)
    a = [[v - shift if i == j else v for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    order = list(range(size))
    for k in range(size):
        i = max(range(k, size), key=lambda r: abs(a[r][k]))
        a[k], a[i], order[k], order[i] = a[i], a[k], order[i], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        for r in range(k + 1, size):
            f = a[r][k] / a[k][k]
            a[r][k] = f
            if f:
                row = a[k]
                a[r][k + 1:] = [v - f * w for v, w in zip(a[r][k + 1:], row[k + 1:])]

    def solve(b: list[Decimal]) -> list[Decimal]:
        y = [b[i] for i in order]
        for r in range(size):
            y[r] -= sum((a[r][k] * y[k] for k in range(r)), Decimal(0))
        for r in reversed(range(size)):
            y[r] = (y[r] - sum((a[r][k] * y[k] for k in range(r + 1, size)), Decimal(0))) / a[r][r]
        return y
    return solve


def components(matrix: list[list[int]], roots: list[Fraction]) -> list[list[float]]:
    """Unit vectors of the null spaces of matrix - root, orthogonal to each other."""
    size, out = len(matrix), []
    with localcontext(Context(prec=DIGITS, Emax=10 ** 9, Emin=-10 ** 9)):
        exact = [[Decimal(v) for v in row] for row in matrix]
        scale = max((abs(v) for row in exact for v in row), default=Decimal(1)) or Decimal(1)
        tiny = scale * Decimal(10) ** (10 - DIGITS)
        solvers: dict[Fraction, object] = {}
        for k, root in enumerate(roots):
            if root not in solvers:
                solvers[root] = _solver(exact, Decimal(root.numerator) / Decimal(root.denominator), tiny)
            draw = random.Random(k)
            v = [Decimal(draw.randint(1, 10 ** 9)) * draw.choice((1, -1)) for _ in range(size)]
            for _ in range(6):
                v = solvers[root](v)
                for _ in range(2):
                    for o in out:
                        dot = sum((x * y for x, y in zip(v, o)), Decimal(0))
                        v = [x - dot * y for x, y in zip(v, o)]
                    norm = sum((x * x for x in v), Decimal(0)).sqrt()
                    v = [x / norm for x in v]
            out.append(v)
        return [[float(x) for x in v] for v in out]


# ---- whitening ------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """What is learned: n distinct vectors, their sums, the leading components with
    their roots (of the covariance) and shares of the trace."""
    size: int
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: tuple[float, ...]
    explained: tuple[float | None, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, as int64 where all fit, else as Python integers."""
        most = max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
        if self.n * most + max(map(abs, self.sums)) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened coordinates, NaN for a root of zero."""
        roots = np.sqrt(np.array(self.values, dtype=float))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(roots > 0, (centred / self.n).astype(float) @ self.vectors.T / roots, np.nan)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        most = max((abs(int(v)) for v in (centred.min(), centred.max())), default=0) if centred.size else 0
        wide = centred if most * most * self.size < 1 << 63 else centred.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (wide * wide).sum(axis=1)]


def learn(distinct: DataFrame, size: int, top: int = TOP) -> Whitening | None:
    n, sums, matrix = scatter(distinct, size)
    if not n:
        return None
    trace = sum(matrix[i][i] for i in range(size))
    roots = leading_roots(characteristic_polynomial(distinct.sparkSession, matrix), top, trace)
    return Whitening(size, n, tuple(sums), np.array(components(matrix, roots)), tuple(float(r / n ** 2) for r in roots),
                     tuple(float(r / trace) if trace else None for r in roots))


def _moments(fitted: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                w = fitted.project(fitted.centred(unpack(b.column(0).slice(at, 4096), fitted.size)))
                one = np.concatenate([np.ones((len(w), 1)), w], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([(one.T @ one).ravel().tolist()], pa.list_(pa.float64()))], names=["m"])
    return run


def identity_error(distinct: DataFrame, fitted: Whitening) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity),
    over the components that have a whitened value."""
    width = len(fitted.values) + 1
    sums = (distinct.select("x").mapInArrow(_moments(fitted), "m array<double>")
            .select(*[F.sum(F.col("m")[k]).alias(f"m{k}") for k in range(width * width)]).first())
    m = np.array(sums, dtype=float).reshape(width, width)
    mean = m[0, 1:] / m[0, 0]
    off = np.abs(m[1:, 1:] / m[0, 0] - np.outer(mean, mean) - np.eye(width - 1))
    off = off[~np.isnan(off)]
    return float(off.max()) if off.size else None


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _apply(fitted: Whitening, error: float | None):
    count = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                centred = fitted.centred(unpack(part.column(1), fitted.size))
                rows = np.repeat(np.arange(part.num_rows), count)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, count + 1), part.num_rows), pa.int32()),
                     pa.array(np.full(len(rows), fitted.n), pa.int64()), pa.array(fitted.deviations(centred), pa.int64()).take(pa.array(rows)),
                     pa.array(fitted.project(centred).ravel(), pa.float64(), from_pandas=True),
                     pa.array(list(fitted.explained) * part.num_rows, pa.float64()), pa.array([error] * len(rows), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    ``rows`` (vec_id, embedding)."""
    spark = rows.sparkSession
    own, size = integer_vectors(rows)
    distinct = written(own.select("x").distinct(), "lattice") if size else None
    fitted = learn(distinct, size, top) if size else None
    if fitted is None:
        return spark.createDataFrame([], _OUT)
    return own.mapInArrow(_apply(fitted, identity_error(distinct, fitted)), _OUT)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
