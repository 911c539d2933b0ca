"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers x, so sums and products over all rows are exact:
A = n * sum(x x') - S S' is n^2 times their covariance. Tasks sum products of their
batches, Spark sums them by matrix place. The rest is as large as the matrix only:

* the characteristic polynomial of A modulo many primes, by reduction to
  Hessenberg form in Spark tasks, a few primes each; Chinese remaindering gives its
  whole coefficients (primes beyond twice Hadamard's bound of the coefficients);
* its largest roots: all roots are real, so the number above a point is the
  number of sign changes of the polynomial shifted there (Descartes' rule is exact then);
  bisection with whole numbers isolates each root, alone or with its
  multiplicity, and narrows it to ``BITS`` bits beyond the point;
* a component for each root: inverse iteration on A less the root in fixed-point
  whole numbers, from which the null space emerges; vectors of equal (or
  hardly different) roots are made orthogonal to each other.

Rows are projected by matrix products of a batch; a component's sign makes its
largest entry positive. Whitened values are written once, and their own covariance (centred) is measured from there.

Defined results: rows whose vector is null, empty or holds null, NaN, infinite
entries or entries beyond the range of a long are left out; so are vectors of other
lengths than the most frequent (the longest of those equally frequent). Directions without variance have
no component, so equal rows or a single one give no rows, as does an empty table. A
deviation beyond the range of a long is null. Repeated rows and null ids are rows like others. Only the two
named columns are read.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm.tables import map_batches, prepare, staged

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Bits of roots and vectors beyond the point; roots that agree to CLOSE bits of the largest share a space.
BITS, CLOSE = 256, 120
_LIMB = 10 ** 24


# -- exact sums -----------------------------------------------------------------------

def _vectors(batch: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: places of the usable rows and their entries as doubles."""
    batch = batch.cast(pa.list_(pa.float64()))
    sizes = np.asarray(batch.value_lengths().fill_null(0))
    flat = batch.flatten()
    entries = np.asarray(flat.fill_null(float("nan"))) if len(flat) else np.empty(0)
    with np.errstate(over="ignore"):
        bad = ~(np.abs(entries) * SCALE + SHIFT < 2.0 ** 63)  # NaN and infinite ones too
    ends = np.cumsum(sizes)
    before = np.insert(np.cumsum(bad), 0, 0)
    good = (before[ends] == before[ends - sizes]) & (sizes > 0)
    out = {}
    for size in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == size))
        out[size] = (rows, entries[(ends[rows] - size)[:, None] + np.arange(size)])
    return out


def _whole(entries: np.ndarray, shift: int = 0) -> np.ndarray:
    """floor(1024 c) + shift, as longs."""
    return np.floor(entries * SCALE).astype(np.int64) + shift


def _products(x: np.ndarray) -> np.ndarray:
    """Exact x' x: in doubles where they hold every sum, else in whole numbers of any size."""
    top = int(max(int(x.max()), -int(x.min())))
    if top * top * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64)
    y = x.astype(object)
    return y.T @ y


def _column_sums(x: np.ndarray) -> np.ndarray:
    small = int(max(int(x.max()), -int(x.min()))) * len(x) < 1 << 62
    return x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)


def _sums(vectors: DataFrame) -> DataFrame:
    """(size, i, j, n): exact sums of products of entries i <= j over all rows; i = -1: of
    entries j, and (-1, -1) counts rows. Unshifted entries: the scatter does not change."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for size, (_, entries) in _vectors(batch.column(0)).items():
                x = _whole(entries)
                own = held.setdefault(size, [0, np.zeros(size, object), np.zeros((size, size), object)])
                own[0] += len(x)
                own[1] = own[1] + _column_sums(x)
                own[2] = own[2] + _products(x)
        for size, (n, one, two) in held.items():
            i, j = np.triu_indices(size)
            at = [np.concatenate([[-1], np.full(size, -1), i]), np.concatenate([[-1], np.arange(size), j])]
            values = [n, *one.tolist(), *two[i, j].tolist()]
            for k in range(0, len(values), 10_000):
                part = [int(v) for v in values[k:k + 10_000]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * len(part), pa.int32()), pa.array(at[0][k:k + 10_000], pa.int32()),
                     pa.array(at[1][k:k + 10_000], pa.int32()),
                     pa.array([v // _LIMB for v in part], pa.decimal128(38)),
                     pa.array([v % _LIMB for v in part], pa.decimal128(38))], ["size", "i", "j", "high", "low"])

    parts = vectors.mapInArrow(run, "size int, i int, j int, high decimal(38,0), low decimal(38,0)")
    return parts.groupBy("size", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))


class Moments:
    """n, S and A = n * sum(x x') - S S' of the whole numbers x."""

    def __init__(self, size: int, n: int, sums: list[int], products: dict[tuple[int, int], int]):
        self.size, self.n = size, n
        self.sums = [s + SHIFT * n for s in sums]
        self.scatter = np.zeros((size, size), object)
        for (i, j), value in products.items():
            self.scatter[i, j] = self.scatter[j, i] = n * value - sums[i] * sums[j]


def moments(embeddings: DataFrame, vector: str = "embedding") -> Moments | None:
    """Of the vectors of the most frequent length; as many rows as a matrix has places reach the driver."""
    sums = staged(_sums(embeddings.select(embeddings[vector])), "scatter")
    counts = sums.where("i = -1 and j = -1").orderBy(F.desc("low"), F.desc("size")).limit(1).collect()
    if not counts:
        return None
    size, found = counts[0]["size"], {}
    for r in sums.where(F.col("size") == size).collect():
        found[r["i"], r["j"]] = int(r["high"]) * _LIMB + int(r["low"])
    n = found.pop((-1, -1))
    return Moments(size, n, [found.pop((-1, j)) for j in range(size)], found)


# -- characteristic polynomial -----------------------------------------------------------

def primes(bits: int, below: int = 1 << 31) -> list[int]:
    """The largest primes below ``below`` whose product has more than ``bits`` bits."""
    small = [p for p in range(3, math.isqrt(below) + 1, 2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2))]
    out, size, top = [], 0.0, below - 1
    while size <= bits:
        low = max(top - (1 << 16), 2)
        sieve = np.ones(top - low + 1, bool)
        sieve[(low % 2)::2] = False
        for q in small:
            sieve[(-low) % q::q] = False
        for p in (np.flatnonzero(sieve)[::-1] + low).tolist():
            out.append(p)
            size += math.log2(p) - 1e-9
            if size > bits:
                break
        top = low - 1
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(tI - matrix) modulo p, a prime below 2^31."""
    d = len(matrix)
    h = (matrix % p).astype(np.int64)
    for k in range(1, d - 1):  # to Hessenberg form by similar matrices
        rows = np.flatnonzero(h[k:, k - 1])
        if not len(rows):
            continue
        if rows[0]:
            r = k + rows[0]
            h[[k, r]] = h[[r, k]]
            h[:, [k, r]] = h[:, [r, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factor[:, None] * h[k] % p) % p
        below = h[:, k + 1:] * factor % p  # each below 2^31, so a long holds their sum
        h[:, k] = (h[:, k] + below.sum(axis=1)) % p
    found = np.zeros((d + 1, d + 1), np.int64)
    found[0, 0] = 1
    for k in range(1, d + 1):  # expansion along the last column of the leading k rows
        found[k, 1:] = found[k - 1, :-1]
        found[k] = (found[k] - int(h[k - 1, k - 1]) * found[k - 1]) % p
        chain = 1
        for i in range(1, k):
            chain = chain * int(h[k - i, k - i - 1]) % p
            if not chain:
                break
            found[k] = (found[k] - chain * int(h[k - i - 1, k - 1]) % p * found[k - i - 1]) % p
    return found[d]


def coefficient_bits(matrix: np.ndarray) -> int:
    """Bits that hold twice any coefficient: the coefficient of t^(d-k) is a sum of
    minors, each at most the product of its rows' lengths (Hadamard)."""
    return sum((max(1, math.isqrt(int((row * row).sum())) + 1)).bit_length() for row in matrix) + len(matrix) + 2


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Whole coefficients (constant first) of det(tI - matrix)."""
    moduli = primes(coefficient_bits(matrix))
    shared = spark.sparkContext.broadcast(matrix)  # as large as the scatter

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.column(0).to_pylist()
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()),
             pa.array([polynomial_modulo(shared.value, p).tolist() for p in own], pa.list_(pa.int64()))], ["p", "found"])

    tasks = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    residues = map_batches(spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks), run,
                           "p long, found array<long>")
    return remaindered({r["p"]: r["found"] for r in residues.collect()})  # a matrix row a prime


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The least whole numbers, of either sign, with these residues."""
    whole = math.prod(residues)
    weights = {p: whole // p * pow(whole // p, -1, p) for p in residues}
    out = []
    for k in range(len(next(iter(residues.values())))):
        value = sum(weights[p] * r[k] for p, r in residues.items()) % whole
        out.append(value - whole if 2 * value > whole else value)
    return out


# -- roots ---------------------------------------------------------------------------------

class Roots:
    """The largest roots of a polynomial whose roots are all real."""

    def __init__(self, coefficients: list[int]):
        self.c = coefficients

    def above(self, x: int, bits: int) -> int:
        """Roots above x / 2^bits, by multiplicity: sign changes after the shift."""
        shifted = [c << (bits * (len(self.c) - 1 - k)) for k, c in enumerate(self.c)]  # t -> t / 2^bits
        for k in range(len(shifted) - 1):
            for j in range(len(shifted) - 2, k - 1, -1):
                shifted[j] += x * shifted[j + 1]
        signs = [c > 0 for c in shifted if c]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def sign(self, x: int, bits: int) -> int:
        value = 0
        for k, c in enumerate(reversed(self.c)):
            value = value * x + (c << (bits * k))
        return (value > 0) - (value < 0)

    def largest(self, number: int, bits: int = BITS) -> list[int]:
        """Of the positive roots the ``number`` largest (each as often as it is one), times 2^bits, rounded up."""
        number = min(number, self.above(0, 0))
        top = 1
        while self.above(top, 0):
            top *= 2
        # Intervals (low, high] with the number of roots above each end.
        out: list[int] = []
        work = [(0, top, self.above(0, 0), 0, 0)]
        while work and len(out) < number:
            low, high, most, least, at = work.pop()
            if most == least:
                continue
            if most == least + 1:
                out.append(self._single(low, high, at, bits))
            elif at == bits and high - low == 1:
                out += [high] * (most - least)  # equal, or nearer than 2^-bits
            else:
                if high - low == 1:
                    low, high, at = 2 * low, 2 * high, at + 1
                middle = (low + high) // 2
                count = self.above(middle, at)
                work += [(low, middle, most, count, at), (middle, high, count, least, at)]
        return out[:number]

    def _single(self, low: int, high: int, at: int, bits: int) -> int:
        """The one root in (low, high] / 2^at: the sign changes there alone."""
        low, high = low << (bits - at), high << (bits - at)
        if self.sign(high, bits) == 0:
            return high
        up = self.sign(high, bits)
        while high - low > 1:
            middle = (low + high) // 2
            if self.sign(middle, bits) in (0, up):
                high = middle
            else:
                low = middle
        return high


# -- components ------------------------------------------------------------------------------

def _solver(matrix: np.ndarray, root: int, bits: int):
    """Triangular factors of matrix - root / 2^bits, in fixed point with partial pivoting."""
    d = len(matrix)
    a = matrix * (1 << bits)
    a[np.arange(d), np.arange(d)] -= root
    order = list(range(d))
    for k in range(d):
        r = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if r != k:
            a[[k, r]] = a[[r, k]]
            order[k], order[r] = order[r], order[k]
        if a[k, k] == 0:
            a[k, k] = 1  # 2^-bits: the matrix is singular to the last bit
        if k + 1 < d:
            factor = (a[k + 1:, k] << bits) // a[k, k]
            a[k + 1:, k + 1:] -= (factor[:, None] * a[k, k + 1:]) >> bits
            a[k + 1:, k] = factor

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[order]
        for k in range(1, d):
            y[k] -= int((a[k, :k] * y[:k]).sum()) >> bits
        for k in range(d - 1, -1, -1):
            rest = int((a[k, k + 1:] * y[k + 1:]).sum()) >> bits if k + 1 < d else 0
            y[k] = ((y[k] - rest) << bits) // a[k, k]
        return y

    return solve


def _unit(v: np.ndarray, bits: int) -> np.ndarray:
    length = math.isqrt(int((v * v).sum())) or 1
    return (v << bits) // length


def eigenvectors(matrix: np.ndarray, roots: list[int], bits: int = BITS, rounds: int = 4) -> list[np.ndarray]:
    """Unit vectors times 2^bits, one a root; those of roots that are (nearly) equal are orthogonal."""
    draw, found = random.Random(1), []
    for k, root in enumerate(roots):
        near = [j for j in range(k) if abs(roots[j] - root) << CLOSE <= roots[0]]
        solve = _solver(matrix, root, bits)
        v = np.array([draw.randrange(-(1 << bits), 1 << bits) for _ in range(len(matrix))], object)
        for _ in range(rounds):
            v = solve(_unit(v, bits))
            for j in near:
                v = _unit(v, bits)
                v = v - ((found[j] * (int((found[j] * v).sum()) >> bits)) >> bits)
            v = _unit(v, bits)
        largest = max(range(len(v)), key=lambda i: abs(v[i]))
        found.append(v if v[largest] > 0 else -v)
    return found


class Whitening:
    """Components of the fit list: unit vectors, eigenvalues of the covariance and their share."""

    def __init__(self, spark: SparkSession, fitted: Moments, components: int = COMPONENTS):
        self.n, self.sums, size = fitted.n, fitted.sums, fitted.size
        trace = sum(int(fitted.scatter[i, i]) for i in range(size))
        roots = Roots(characteristic_polynomial(spark, fitted.scatter)).largest(components) if trace else []
        one = 1 << BITS
        self.vectors = np.array([[x / one for x in v] for v in eigenvectors(fitted.scatter, roots)]).reshape(len(roots), size)
        self.values = [r / (one * self.n * self.n) for r in roots]
        self.explained = [r / (one * trace) for r in roots]
        # (n x - S) / n projected over the root of the eigenvalue
        self.projection = (self.vectors / np.sqrt(self.values)[:, None]).T / self.n if roots else np.empty((size, 0))

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """n x - S as doubles, and the exact sums of its squares (null beyond a long)."""
        y = x * self.n - np.array(self.sums) if self._fits(x) else x.astype(object) * self.n - np.array(self.sums, object)
        if y.dtype != object and int(max(int(y.max()), -int(y.min()))) ** 2 * y.shape[1] < 1 << 63:
            return y.astype(np.float64), (y * y).sum(axis=1).tolist()
        y = y.astype(object)
        squares = [int(s) for s in (y * y).sum(axis=1)]
        return y.astype(np.float64), [s if s < 1 << 63 else None for s in squares]

    def _fits(self, x: np.ndarray) -> bool:
        top = max(int(x.max()), -int(x.min())) * self.n + max(abs(s) for s in self.sums)
        return top < 1 << 62


def whiten(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    every usable row and component."""
    spark = prepare(embeddings.sparkSession)
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = moments(embeddings, vector)
    model = Whitening(spark, fitted, components) if fitted is not None else None
    if model is None or not model.values:
        return spark.createDataFrame([], empty)
    shared, size, number = spark.sparkContext.broadcast(model), fitted.size, len(model.values)  # size x components

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows, entries = _vectors(batch.column(1)).get(size, (None, None))
        if rows is None:
            return None
        y, squares = shared.value.centred(_whole(entries, SHIFT))
        made = y @ shared.value.projection
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)), pa.array(squares, pa.int64()),
             pa.FixedSizeListArray.from_arrays(made.ravel(), number).cast(pa.list_(pa.float64()))],
            ["vec_id", "deviation", "white"])

    given = embeddings.select(embeddings[key].cast("long").alias("vec_id"), embeddings[vector].alias("vector"))
    rows = staged(map_batches(given, run, "vec_id long, deviation long, white array<double>"), "whitened")
    pairs = [(i, j) for i in range(number) for j in range(i, number)]
    found = rows.agg(*[F.covar_pop(rows["white"][i], rows["white"][j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = F.array(*[F.lit(e) for e in model.explained])
    return rows.select("vec_id", "deviation", F.posexplode("white").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
