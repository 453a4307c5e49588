"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

1. Entries become whole numbers. Tasks add up the products of the distinct vectors, with a 1 before
   each, so one matrix holds their number n, the sums S and the products; sums of 32-bit digits of
   its cells are exact at any size. The scatter n * products - S S^T is n^2 times the covariance.
2. Its characteristic polynomial has whole coefficients. For each of many primes a task brings the
   scatter to Hessenberg form modulo the prime and reads off the coefficients; the Chinese remainder
   theorem joins them. There are as many primes as a bound of the coefficients asks for.
3. All roots are real, so the sign changes of the polynomial moved by a are exactly the roots above
   a. This isolates the largest roots, and halving refines them to PRECISION binary digits.
4. A component spans the null space of scatter - root: inverse iteration with that many digits finds
   it. Roots that agree in all these digits share a space, of which any basis will do.

Only matrices and polynomials of the vectors' width come to the driver, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleskeep.llm.common import columns, record_batch
from saleskeep.llm.topk import matrix, scaled
from saleskeep.workspace import Workspace

SCALE, COMPONENTS = 256, 4
#: Binary digits of a root, and of the numbers of inverse iteration.
PRECISION, WORKING = 192, 448
#: Binary digits of a part of a number whose products of CHUNK rows add up exactly in doubles.
PART_BITS, CHUNK = 20, 8_192
DIGIT_BITS, DIGITS = 32, 6


# --- exact sums of products


def parts(x: np.ndarray) -> list[np.ndarray]:
    """x as a sum of parts times powers of 2^PART_BITS, no part beyond half of that."""
    half, found = 1 << (PART_BITS - 1), []
    while not found or x.any():
        low = ((x + half) & (2 * half - 1)) - half if np.abs(x).max(initial=0) < 2**62 else (x & (2 * half - 1))
        found.append(low.astype(np.float64))
        x = (x - low) >> PART_BITS
    return found


def products(x: np.ndarray) -> np.ndarray:
    """x^T x in Python's whole numbers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for start in range(0, len(x), CHUNK):
        split = parts(x[start : start + CHUNK])
        for n, left in enumerate(split):
            for m, right in enumerate(split):
                total += (left.T @ right).astype(np.int64).astype(object) << (PART_BITS * (n + m))
    return total


def with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)


def sums(vectors: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sums and products of the vectors x (arrays of long of one width)."""
    digits = ", ".join(f"d{n} long" for n in range(DIGITS))
    schema = columns(f"cell long, {digits}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1), object)
        for batch in batches:
            total += products(with_one(matrix(batch.column("x"), width)))
        cells = np.flatnonzero(np.triu(np.ones(total.shape, bool)))
        rest, made = total.ravel()[cells], [cells]
        for n in range(DIGITS):
            made.append((rest & ((1 << DIGIT_BITS) - 1) if n < DIGITS - 1 else rest).astype(np.int64))
            rest = rest >> DIGIT_BITS
        yield record_batch(schema, made)

    added = vectors.select("x").mapInArrow(run, schema).groupBy("cell").agg(*(F.sum(f"d{n}").alias(f"d{n}") for n in range(DIGITS)))
    total = np.zeros((width + 1, width + 1), object)
    for cell, *found in added.collect():  # a row per cell of the matrix
        i, j = divmod(cell, width + 1)
        total[i, j] = total[j, i] = sum(d << (DIGIT_BITS * n) for n, d in enumerate(found))
    return int(total[0, 0]), total[0, 1:], total[1:, 1:]


# --- characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller and Rabin; these bases decide all n below 3,215,031,751."""
    if n < 9:
        return n in (2, 3, 5, 7)
    if n % 2 == 0:
        return False
    twos = ((n - 1) & (1 - n)).bit_length() - 1
    for base in (2, 3, 5, 7):
        power = pow(base, (n - 1) >> twos, n)
        if power in (1, n - 1) or base % n == 0:
            continue
        for _ in range(twos - 1):
            power = power * power % n
            if power == n - 1:
                break
        else:
            return False
    return True


def primes(product: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds a number."""
    found, total, n = [], 1, 2**31 - 1
    while total <= product:
        if is_prime(n):
            found.append(n)
            total *= n
        n -= 2
    return found


def coefficient_bound(scatter: np.ndarray) -> int:
    """No coefficient of the characteristic polynomial is larger: the k-th elementary symmetric
    function of d roots that are not negative is at most C(d, k) (trace / d)^k."""
    size, trace = len(scatter), int(np.trace(scatter))
    return max(math.comb(size, k) * trace**k // size**k + 1 for k in range(size + 1))


def polynomial_modulo(residues: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo a prime below 2^31, constant first."""
    h, size = residues.copy(), len(residues)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        times = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - times[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * times % p).sum(axis=1)) % p
    found = np.zeros((size + 1, size + 1), np.int64)
    found[0, 0] = 1
    for k in range(size):
        along, factors = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            along = along * int(h[i + 1, i]) % p
            factors[i] = along * int(h[i, k]) % p
        shifted = np.append(0, found[k, :-1])
        earlier = (factors[:, None] * found[:k] % p).sum(axis=0)
        found[k + 1] = (shifted - h[k, k] * found[k] % p - earlier) % p
    return found[size]


def join_residues(by_prime: list[tuple[int, np.ndarray]]) -> list[int]:
    """The numbers, from minus to plus half the product of the primes, with these residues."""
    total, value = 1, np.zeros(len(by_prime[0][1]), object)
    for p, residues in by_prime:
        step = (residues.astype(object) - value) % p * pow(total, -1, p) % p
        value, total = value + step * total, total * p
    return [int(v - total if 2 * v > total else v) for v in value]


def characteristic_polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """Coefficients of det(x - scatter), constant first; the primes are dealt to tasks."""
    chosen = primes(2 * coefficient_bound(scatter))
    shared, schema = spark.sparkContext.broadcast(scatter), columns("p long, residues binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("p").to_pylist()
            yield record_batch(schema, [of, [polynomial_modulo((shared.value % p).astype(np.int64), p).tobytes() for p in of]])

    table = spark.createDataFrame(pa.table({"p": pa.array(chosen, pa.int64())})).repartition(min(len(chosen), 64))
    rows = table.mapInArrow(run, schema).collect()  # a row per prime
    return join_residues(sorted((p, np.frombuffer(r, np.int64)) for p, r in rows))


# --- roots


def moved(polynomial: list[int], at: Fraction) -> list[int]:
    """Coefficients of a positive multiple of the polynomial of x / denominator + at."""
    scale, size = at.denominator, len(polynomial) - 1
    row = [c * scale ** (size - k) for k, c in enumerate(polynomial)]
    for first in range(size):
        for k in range(size - 1, first - 1, -1):
            row[k] += at.numerator * row[k + 1]
    return row


def roots_above(polynomial: list[int], at: Fraction) -> int:
    """With multiplicity, of a polynomial whose roots are all real."""
    signs = [c > 0 for c in moved(polynomial, at) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(polynomial: list[int], at: Fraction) -> int:
    value, scale = 0, 1
    for c in reversed(polynomial):
        value = value * at.numerator + c * scale
        scale *= at.denominator
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], count: int, precision: int = PRECISION) -> list[tuple[Fraction, int]]:
    """The largest positive roots, falling, until `count` of them are found: to `precision` binary
    digits, with the number of roots that agree in these."""
    top = Fraction(1 << max(1, abs(polynomial[-2]).bit_length() if len(polynomial) > 1 else 1))  # above the trace
    found, waiting = [], [(Fraction(0), top, roots_above(polynomial, Fraction(0)), 0)]
    while waiting and sum(m for _, m in found) < count:
        low, high, over_low, over_high = waiting.pop()
        inside = over_low - over_high
        if not inside:
            continue
        if inside == 1 or (high - low) * 2**precision <= low:
            found.append((_refined(polynomial, low, high, precision) if inside == 1 else (low + high) / 2, inside))
            continue
        middle = (low + high) / 2
        over = roots_above(polynomial, middle)
        waiting += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return found


def _refined(polynomial: list[int], low: Fraction, high: Fraction, precision: int) -> Fraction:
    """The one root above `low`, up to `high`."""
    above = sign_at(polynomial, high)
    if not above:
        return high
    while (high - low) * 2**precision > low:
        middle = (low + high) / 2
        sign = sign_at(polynomial, middle)
        if not sign:
            return middle
        low, high = (low, middle) if sign == above else (middle, high)
    return (low + high) / 2


# --- null spaces


def null_space(scatter: np.ndarray, root: Fraction, count: int, bits: int = WORKING) -> np.ndarray:
    """`count` orthonormal vectors (rows, double precision) of the null space of scatter - root, by
    inverse iteration in numbers with `bits` binary digits after the point."""
    size, one = len(scatter), 1 << bits
    a = scatter << bits
    a[np.diag_indices(size)] -= (root.numerator << bits) // root.denominator
    order, below = np.arange(size), np.zeros((size, size), object)
    for k in range(size):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        for x in (a, below, order):
            x[[k, pivot]] = x[[pivot, k]]
        if not a[k, k]:
            a[k, k] = 1
        below[k + 1 :, k] = (a[k + 1 :, k] << bits) // a[k, k]
        a[k + 1 :, k:] -= (below[k + 1 :, k][:, None] * a[k, k:]) >> bits
    start = np.random.default_rng(size).integers(1, 1 << 30, (count, size)).astype(object)
    basis = _orthonormal(start * one, one)
    for _ in range(4):
        solved = []
        for vector in basis:
            x = vector[order].copy()
            for k in range(size):
                x[k + 1 :] -= (below[k + 1 :, k] * x[k]) >> bits
            for k in range(size - 1, -1, -1):
                x[k] = (x[k] << bits) // a[k, k]
                x[:k] -= (a[:k, k] * x[k]) >> bits
            solved.append(x)
        basis = _orthonormal(np.array(solved, object), one)
    made = np.array([[v / one for v in row] for row in basis], np.float64)
    return made * np.where(made[np.arange(count), np.abs(made).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]


def _orthonormal(rows: np.ndarray, one: int) -> np.ndarray:
    """Gram and Schmidt, twice, on numbers of any size; the results are multiples of 1 / one."""
    made: list[np.ndarray] = []
    for row in rows:
        for _ in range(2):
            length = math.isqrt(int((row * row).sum())) or 1
            row = row * one // length
            for other in made:
                row = row - other * (int((row * other).sum()) // one) // one
        length = math.isqrt(int((row * row).sum())) or 1
        made.append(row * one // length)
    return np.array(made, object)


# --- whitening


@dataclass(frozen=True)
class Model:
    """n and S of the fit list; components as rows, the roots of the scatter they belong to as
    doubles, and each one's share of the trace."""

    count: int
    sums: np.ndarray
    components: np.ndarray
    roots: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        most = self.count * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums.tolist()), default=0)
        return x * self.count - self.sums.astype(np.int64) if most < 2**62 else x.astype(object) * self.count - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) @ self.components.T / np.sqrt(self.roots)

    def deviations(self, centred: np.ndarray) -> np.ndarray:
        """Sums of squares; those beyond 64 bits are an error."""
        most = max(map(abs, (int(centred.max(initial=0)), int(centred.min(initial=0)))))
        if most * most * max(1, centred.shape[1]) < 2**63:
            return (centred * centred).sum(axis=1)
        total = (centred.astype(object) ** 2).sum(axis=1)
        if any(t >= 2**63 for t in total):
            raise OverflowError("a deviation has more than 64 bits")
        return total.astype(np.int64)


def whole_vectors(embeddings: DataFrame, vector: str, scale: int, others: list[str]) -> tuple[DataFrame, int]:
    """`others` and x, and the width of x: rows with a usable vector, shorter ones filled with 0."""
    rows = embeddings.select(*(F.col(f"`{c}`") for c in others), scaled(F.col(f"`{vector}`"), scale).alias("x")).filter("x IS NOT NULL")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    return rows.withColumn("x", filled), width


def fit(vectors: DataFrame, width: int, count: int = COMPONENTS) -> Model | None:
    """From distinct vectors x; None where no direction has any variance."""
    n, total, squares = sums(vectors, width)
    scatter = squares * n - np.multiply.outer(total, total)
    trace = int(np.trace(scatter))
    if not trace:
        return None
    polynomial = characteristic_polynomial(vectors.sparkSession, scatter)
    components, roots = [], []
    for root, many in largest_roots(polynomial, count):
        components.append(null_space(scatter, root, many))
        roots += [root] * many
    roots = roots[:count]
    return Model(
        n, total, np.concatenate(components)[:count], np.array([float(r) for r in roots]), np.array([float(r / trace) for r in roots])
    )


def identity_error(vectors: DataFrame, model: Model) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    size = len(model.roots)
    schema = columns(", ".join(f"w{k} double" for k in range(size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = model.whitened(model.centred(matrix(batch.column("x"), len(model.sums))))
            yield record_batch(schema, list(made.T))

    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    found = vectors.select("x").mapInArrow(run, schema).agg(*(F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs)).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def whiten(
    embeddings: DataFrame,
    workspace: Workspace,
    count: int = COMPONENTS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The id column, component (from 1, by falling variance), n, deviation, whitened, explained and
    identity_error: a row for each row with a usable vector and each component.

    Vectors that are NULL or hold a NULL or non-finite entry take no part. Missing entries of
    shorter vectors count as 0. The fit list holds each distinct vector once; rows that repeat, and
    rows without an id, are whitened each. There are `count` components, or as many as there are
    directions with a variance above 0: none, and so no rows, for fewer than two different vectors.
    A deviation of more than 64 bits is an error."""
    spark = embeddings.sparkSession
    rows, width = whole_vectors(embeddings, vector, scale, [id_column])
    kind = rows.schema[id_column]
    schema = StructType([kind, *StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double"
    ).fields])
    vectors = workspace.keep(rows.select("x").distinct(), "fit") if width else None
    model = fit(vectors, width, count) if width else None
    if model is None:
        return spark.createDataFrame([], schema)
    error, size = identity_error(vectors, model), len(model.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = model.centred(matrix(batch.column("x"), width))
            many = batch.num_rows
            each = np.repeat(np.arange(many), size)
            yield record_batch(schema, [
                batch.column(0).take(pa.array(each)), np.tile(np.arange(1, size + 1, dtype=np.int32), many),
                np.full(many * size, model.count), model.deviations(centred)[each], model.whitened(centred).ravel(),
                np.tile(model.explained, many), np.full(many * size, error),
            ])

    return rows.mapInArrow(run, schema)
