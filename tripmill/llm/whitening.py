"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become integers, so sums and products of all distinct vectors are exact integers: M = n·Σxxᵀ − SSᵀ,
whose eigenvalues are n² times those of the covariance. Its characteristic polynomial comes from Hessenberg
reductions modulo primes below 2^31 (a Spark row per prime) and Chinese remaindering. All its roots are real, so the
sign changes of a shifted polynomial count the roots above a point without error (Descartes); bisection isolates the
largest roots and refines each to ``ROOT_BITS`` bits. Every root's eigenvectors come from inverse iteration
on the null space of M − λI in ``DIGITS`` decimal digits (a Spark row per root); roots closer than 2^-``GAP_BITS`` of
the largest share a space, of which any orthonormal basis is taken.

What passes through the driver is bounded by the number of dimensions: M, the polynomial and the components. Its time
grows with the fourth power of the dimensions (64: seconds). Distinct vectors are found by a
shuffle of their integers in the fewest bytes, equal ones merged before it.

Defined cases: a vector that is null or holds a null, NaN or infinite entry is dropped; a shorter vector counts as
filled up with zeros; 64 times an entry saturates at ±2^62; copies count once in the fit and are whitened each; a null id is
kept; directions without variance give no component, so equal vectors, a single vector or an empty table give no rows;
``deviation`` is null where it exceeds a long, ``deviation_exact`` where it exceeds 38 digits; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, written

#: Production parameters: components at most, entries per unit, bits of a root, of the least gap, digits of an elimination.
COMPONENTS, UNITS = 16, 64
ROOT_BITS, GAP_BITS, DIGITS = 200, 80, 75
_SATURATED = float(1 << 62)
#: Bits of a limb: products of two, summed over 2^17 rows, are exact in a double.
_LIMB, _ROWS = 18, 1 << 17
#: Bits of the parts in which big integers travel through Spark's sums.
_PART = 40


def integers(entries: np.ndarray) -> np.ndarray:
    """floor(64c); the constant added to every entry changes neither scatter nor deviation."""
    return np.floor(np.clip(entries * UNITS, -_SATURATED, _SATURATED)).astype(np.int64)


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integers of the vectors of each length."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = integers(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, entries[starts[rows][:, None] + np.arange(length)]


def to_bytes(matrix: np.ndarray) -> list[bytes]:
    """Each row without zeros at its end, in the fewest bytes an entry (the first byte): equal rows, equal bytes."""
    n, d = matrix.shape
    if not d:
        return [b"\x01"] * n
    kept = np.where(matrix.any(1), d - (matrix[:, ::-1] != 0).argmax(1), 0)
    largest = np.maximum(matrix.max(1), -matrix.min(1))
    width = 1 << ((largest > 0x7F).astype(int) + (largest > 0x7FFF) + (largest > 0x7FFFFFFF))
    out: list[bytes] = [b""] * n
    for k, w in {*zip(kept.tolist(), width.tolist())}:
        rows = np.flatnonzero((kept == k) & (width == w))
        raw = np.ascontiguousarray(matrix[rows, :k]).astype(f"<i{w}").tobytes()
        for at, row in enumerate(rows.tolist()):
            out[row] = bytes([w]) + raw[at * k * w : (at + 1) * k * w]
    return out


def from_bytes(raws: list[bytes]) -> list[np.ndarray]:
    """Matrices of the rows of equal length and width."""
    alike = defaultdict(list)
    for raw in raws:
        alike[raw[0], len(raw)].append(raw[1:])
    return [
        np.frombuffer(b"".join(rows), f"<i{w}").astype(np.int64).reshape(len(rows), (size - 1) // w)
        for (w, size), rows in alike.items()
    ]


def _resized(matrix: np.ndarray, d: int) -> np.ndarray:
    return np.pad(matrix[:, :d], ((0, 0), (0, max(0, d - matrix.shape[1]))))


def _zeros(*shape: int) -> np.ndarray:
    """Of Python integers, which do not overflow."""
    return np.zeros(shape, dtype=object)


def scatter(matrix: np.ndarray) -> np.ndarray:
    """Exact XᵀX as Python integers."""
    total = _zeros(matrix.shape[1], matrix.shape[1])
    largest = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
    parts = max(1, -(-(largest.bit_length() + 1) // _LIMB))
    for start in range(0, len(matrix), _ROWS):
        rest, limbs = matrix[start : start + _ROWS], []
        for k in range(parts):
            limbs.append((rest & ((1 << _LIMB) - 1) if k + 1 < parts else rest).astype(np.float64))
            rest = rest >> _LIMB
        for a, left in enumerate(limbs):
            for b, right in enumerate(limbs):
                total += (left.T @ right).astype(np.int64).astype(object) * (1 << _LIMB * (a + b))
    return total


def _moments(batches) -> Iterator[pa.RecordBatch]:
    """The task's count (-1, -1), sums (i, -1) and products (i, j ≥ i), in parts that Spark can add."""
    n, sums, products = 0, _zeros(0), _zeros(0, 0)
    for batch in batches:
        for matrix in from_bytes(batch.column(0).to_pylist()):
            d, had = matrix.shape[1], len(sums)
            if d > had:
                sums, old, products = np.r_[sums, _zeros(d - had)], products, _zeros(d, d)
                products[:had, :had] = old
            n += len(matrix)
            sums[:d] += matrix.astype(object).sum(0)
            products[:d, :d] += scatter(matrix)
    found = [(-1, -1, n)] + [(i, -1, v) for i, v in enumerate(sums)]
    found += [(i, j, products[i, j]) for i in range(len(sums)) for j in range(i, len(sums))]
    rows = []
    for i, j, value in found:
        sign, value, k = (-1 if value < 0 else 1), abs(int(value)), 0
        while value:
            rows.append((i, j, k, sign * (value & ((1 << _PART) - 1))))
            value, k = value >> _PART, k + 1
    for start in range(0, len(rows), 1 << 16):
        columns = list(zip(*rows[start : start + (1 << 16)]))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["i", "j", "k", "part"])


def moments(fit_list: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and products of the fit list, exact."""
    parts = (
        fit_list.mapInArrow(_moments, "i int, j int, k int, part long")
        .groupBy("i", "j", "k").agg(F.sum(F.col("part").cast("decimal(28,0)")).alias("part"))
        .toArrow().to_pylist()
    )
    values: dict[tuple[int, int], int] = defaultdict(int)
    for row in parts:
        values[row["i"], row["j"]] += int(row["part"]) << _PART * row["k"]
    d = 1 + max((i for i, _ in values), default=-1)
    products = np.array([[values.get((min(i, j), max(i, j)), 0) for j in range(d)] for i in range(d)], dtype=object)
    return values.get((-1, -1), 0), [values.get((i, -1), 0) for i in range(d)], products


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(xI − A) modulo p, the leading one first."""
    a = np.array(matrix % p, dtype=np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        swap = k + 1 + int(below[0])
        a[[k + 1, swap]] = a[[swap, k + 1]]
        a[:, [k + 1, swap]] = a[:, [swap, k + 1]]
        times = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - times[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * times % p).sum(1)) % p
    minors = np.zeros((d + 1, d + 1), dtype=np.int64)  # of the leading blocks, constant term first
    minors[0, 0] = 1
    for k in range(1, d + 1):
        factor, weights = 1, [0] * k
        for m in range(k - 1, -1, -1):
            weights[m] = int(a[m, k - 1]) * factor % p
            factor = factor * int(a[m, m - 1]) % p if m else factor
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (np.array(weights, dtype=np.int64)[:, None] * minors[:k] % p).sum(0)) % p
    return minors[d, ::-1].tolist()


def primes() -> Iterator[int]:
    """Primes below 2^31, falling."""
    small = [q for q in range(3, 46341, 2) if all(q % r for r in range(3, int(q**0.5) + 1, 2))]
    return (p for p in range((1 << 31) - 1, 1 << 30, -2) if all(p % q for q in small))


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(xI − M) for a positive semidefinite M, the leading one first."""
    d, trace = len(matrix), int(np.trace(matrix))
    # Of numbers ≥ 0 with a given sum, equal ones have the largest symmetric functions.
    bound = max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    chosen, product = [], 1
    for p in primes():
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    held = spark.sparkContext.broadcast(matrix)

    def run(batches):
        for batch in batches:
            found = [polynomial_modulo(held.value, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    rows = spark.createDataFrame([(p,) for p in chosen], "p long")
    tasks = min(len(chosen), spark.sparkContext.defaultParallelism)
    residues = {r["p"]: r["c"] for r in rows.repartition(tasks).mapInArrow(run, "p long, c array<long>").toArrow().to_pylist()}
    out, done = [0] * (d + 1), 1
    for p in chosen:
        inverse = pow(done, -1, p)
        out = [c + done * ((r - c) * inverse % p) for c, r in zip(out, residues[p])]
        done *= p
    return [c - done if 2 * c > done else c for c in out]


def roots_above(coefficients: list[int], at: int) -> int:
    """Roots above ``at``, with multiplicity, of a polynomial whose roots are all real."""
    c = list(coefficients)
    for end in range(len(c), 1, -1):
        for j in range(1, end):
            c[j] += at * c[j - 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(coefficients: list[int], most: int) -> tuple[list[tuple[int, int, int]], int]:
    """(rank of the first, how many, value) of the ``most`` largest positive roots, values in units of 2^-scale; scale.

    Roots that stay together below the least gap are one entry.
    """
    c = list(coefficients)
    while len(c) > 1 and not c[-1]:
        c.pop()
    if len(c) == 1:
        return [], 0
    top = -c[1]  # the sum of the roots
    scale = max(0, ROOT_BITS - top.bit_length())
    c = [v << scale * k for k, v in enumerate(c)]
    top <<= scale
    least = max(1, top >> GAP_BITS)
    open_, out = [(0, top, len(c) - 1, 0)], []
    while open_:
        low, high, upto, before = open_.pop()  # roots before + 1 to upto lie in (low, high]
        if before >= min(most, upto):
            continue
        n = upto - before
        while high - low > 1 and (n == 1 or high - low <= least):
            middle = (low + high) // 2
            if n == 1:
                value = 0
                for v in c:
                    value = value * middle + v
                above = before + (value != 0 and (value > 0) != (before % 2 == 0))
            else:
                above = roots_above(c, middle)
            if above == before:
                high = middle
            elif above == upto:
                low = middle
            else:
                break
        if high - low <= 1 or (n > 1 and high - low <= least):
            out.append((before, n, high))
            continue
        middle = (low + high) // 2
        above = roots_above(c, middle)
        open_ += [(low, middle, upto, above), (middle, high, above, before)]
    return sorted(out), scale


def null_vectors(matrix: np.ndarray, value: Fraction, count: int) -> np.ndarray:
    """Orthonormal eigenvectors (rows) of the ``count`` eigenvalues at ``value``, by inverse iteration."""
    d = len(matrix)
    with localcontext(prec=DIGITS):
        root = Decimal(value.numerator) / Decimal(value.denominator)
        a = np.array([[Decimal(int(v)) for v in row] for row in matrix], dtype=object).reshape(d, d)
        a[np.diag_indices(d)] -= root
        tiny = (abs(root) + 1) * Decimal(10) ** (5 - DIGITS)
        rows, columns = np.arange(d), np.arange(d)
        for k in range(d):
            if k < d - count:
                at = divmod(int(np.argmax(np.abs(a[k:, k:]))), d - k)
                for axis, order, other in ((0, rows, k + at[0]), (1, columns, k + at[1])):
                    picked = [k, other]
                    order[picked] = order[picked[::-1]]
                    if axis:
                        a[:, picked] = a[:, picked[::-1]]
                    else:
                        a[picked] = a[picked[::-1]]
            if k >= d - count or not a[k, k]:
                a[k:, k:] = Decimal(0)
                a[np.arange(k, d), np.arange(k, d)] = tiny
                break
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solve(right: np.ndarray, forward: bool) -> np.ndarray:
            x = right.copy()
            if forward:
                x = x[rows]
                for k in range(d):
                    x[k + 1 :] -= a[k + 1 :, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] /= a[k, k]
                x[:k] -= a[:k, k] * x[k]
            out = np.empty(d, dtype=object)
            out[columns] = x
            return out

        starts = [np.array([Decimal(int(i == d - 1 - k)) for i in range(d)], dtype=object) for k in range(count)]
        # The first step starts at what elimination leaves of a unit vector, so it is one back substitution.
        found = [solve(s, False) for s in starts]
        for step in range(2):
            basis: list[np.ndarray] = []
            for v in found:
                for _ in range(2):
                    for b in basis:
                        v = v - b * (v * b).sum()
                    v = v / (v * v).sum().sqrt()
                basis.append(v)
            found = [solve(v, True) for v in basis] if not step else basis
    out = np.array(found, dtype=np.float64)
    return out * np.where(np.take_along_axis(out, np.abs(out).argmax(1)[:, None], 1) < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """A fitted transform: ``axes`` are unit eigenvectors by falling eigenvalue of the covariance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centred(self, matrix: np.ndarray) -> np.ndarray:
        """n·x − S, exact: 64-bit where they hold it, else Python integers."""
        matrix = _resized(matrix, len(self.sums))
        largest = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)), 1)
        kind = np.int64 if (largest * self.n + max(map(abs, self.sums), default=0)) < 1 << 62 else object
        return matrix.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.axes.T / np.sqrt(self.eigenvalues)


def deviations(centred: np.ndarray) -> list[int]:
    """Exact squared lengths."""
    largest = max(int(centred.max(initial=0)), -int(centred.min(initial=0)))
    if largest * largest * max(1, centred.shape[1]) >= 1 << 63:
        centred = centred.astype(object)
    return [int(v) for v in (centred * centred).sum(1)]


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """id and vector of the rows that are whitened."""
    has_columns(vectors, key, column)
    vector = F.col(column).cast("array<double>")
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.select(F.col(key).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & ~bad
    )


def fit_list(rows: DataFrame) -> DataFrame:
    """Every distinct integer vector once."""

    def run(batches):
        for batch in batches:
            found: list[bytes] = []
            for _, matrix in _matrices(batch.column(0)):
                found += to_bytes(matrix)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["x"])

    return rows.select("vector").mapInArrow(run, "x binary").distinct()


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The transform of a fit list as ``fit_list`` gives it."""
    spark = distinct.sparkSession
    n, sums, products = moments(distinct)
    d = len(sums)
    s = np.array(sums, dtype=object)
    matrix = n * products - np.multiply.outer(s, s) if d else products
    roots, scale = largest_roots(characteristic_polynomial(spark, matrix), components) if d else ([], 0)
    if not roots:
        return Whitening(n, sums, np.zeros((0, d)), np.zeros(0), np.zeros(0))
    held = spark.sparkContext.broadcast(matrix)

    def run(batches):
        for batch in batches:
            out = []
            for first, count, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                axes = null_vectors(held.value, Fraction(int(value), 1 << scale), count)
                out += [(first + k, axis.tolist()) for k, axis in enumerate(axes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.float64()))],
                names=["k", "axis"],
            )

    rows = spark.createDataFrame([(a, b, str(v)) for a, b, v in roots], "first int, n int, value string")
    tasks = min(len(roots), spark.sparkContext.defaultParallelism)
    found = rows.repartition(tasks).mapInArrow(run, "k int, axis array<double>").toArrow().to_pylist()
    axes = [r["axis"] for r in sorted(found, key=lambda r: r["k"])][:components]
    values = [Fraction(v, 1 << scale) for _, b, v in roots for _ in range(b)][:components]
    trace = int(np.trace(matrix))
    return Whitening(
        n, sums, np.array(axes), np.array([float(v / (n * n)) for v in values]), np.array([float(v / trace) for v in values])
    )


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    held, k = distinct.sparkSession.sparkContext.broadcast(model), len(model.axes)

    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            for matrix in from_bytes(batch.column(0).to_pylist()):
                rows = held.value.whitened(held.value.centred(matrix))
                total += np.vstack([rows.T @ rows, rows.sum(0)])
        i, j = np.divmod(np.arange(total.size), k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], names=["i", "j", "v"])

    if not k:
        return 0.0
    sums = np.zeros((k + 1, k))
    for row in distinct.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pylist():
        sums[row["i"], row["j"]] = row["v"] / model.n
    return float(np.abs(sums[:k] - np.multiply.outer(sums[k], sums[k]) - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """A row for each usable row and component."""
    held, k = rows.sparkSession.sparkContext.broadcast(model), len(model.axes)

    def run(batches):
        of = held.value
        for batch in batches if k else ():
            for at, matrix in _matrices(batch.column(1)):
                centred = of.centred(matrix)
                lengths = deviations(centred)
                exact = [Decimal(v) if v < 10**38 else None for v in lengths]
                short = pa.array([v if v < 1 << 63 else None for v in lengths], pa.int64())
                each = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        short.take(each),
                        pa.array(exact, pa.decimal128(38, 0)).take(each),
                        pa.array(of.whitened(centred).reshape(-1)),
                        pa.array(np.tile(of.explained, len(at))),
                    ],
                    names=["id", "component", "deviation", "deviation_exact", "whitened", "explained"],
                )

    kinds = "id long, component int, deviation long, deviation_exact decimal(38,0), whitened double, explained double"
    return rows.mapInArrow(run, kinds)


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, deviation_exact, whitened, explained, identity_error."""
    rows = usable(vectors, key, column)
    distinct = written(fit_list(rows), "fit-list")
    model = fit(distinct, components)
    error = identity_error(distinct, model)
    return transform(rows, model).withColumns({"n": F.lit(model.n).cast("long"), "identity_error": F.lit(error)})


def op11_whitening(spark, sf_dir):
    """All usable embeddings on the 16 first components of their distinct integer vectors."""
    out = whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id").select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"
    )
