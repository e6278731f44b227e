"""Whitening of embeddings by shifted CholeskyQR.

Rows are centred exactly, in integers. Each pass sums a Gram matrix over all rows, and its Cholesky factor
turns the rows towards orthogonal ones by a triangular solve; the first pass shifts the matrix, so that it always
has such a factor. The factors' product is the R of a QR decomposition of the centred
rows, and its singular value decomposition gives the components. No pass moves a row: tasks give one Gram matrix each,
whose entries are added up by place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import staged

#: How an entry becomes an integer.
SCALE, OFFSET = 64, 1_000_000

#: Entries beyond have no integer of 64 bits.
LARGEST = 2.0**56

#: The driver holds a few square matrices of this width at most.
MAX_WIDTH = 2048

#: Passes end when Gram matrices are this close to the identity, or after so many.
CLOSE, MAX_PASSES = 1e-9, 5

#: Directions whose deviation is smaller than this share of the largest have no variance that doubles can show.
LEAST_SHARE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A fit: number of vectors, sums per dimension, and components (rows) by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace

    @property
    def projection(self) -> np.ndarray:
        """Turns centred rows into whitened ones; one column per component."""
        return (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as integers, of vectors without null or non-finite entries.

    An entry of 2^56 or more stops the job.
    """
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    whole = lambda c: F.when(F.abs(c) < LARGEST, F.floor(c * SCALE) + OFFSET).otherwise(
        F.raise_error(F.lit("an entry of a vector is too large for a long"))
    )
    x = F.transform(vector, lambda c: whole(c.cast("double")))
    return vectors.where(vector.isNotNull() & finite).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def fit(rows: DataFrame, limit: int = 32, max_width: int = MAX_WIDTH) -> Whitening | None:
    """Components of the rows of :func:`whole_vectors`, up to ``limit``; None if there is no row.

    Vectors of another length than the most frequent one (the longer of equally frequent ones) don't belong to the
    same space and are left out. Directions without variance have no
    component: a single row, or rows that are all alike, have none.
    """
    totals = staged(rows.select("x").mapInArrow(_totals, "width int, n long, sums array<long>"), "vector-sums")
    width = totals.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if width is None:
        return None
    n, d = width["n"], width["width"]
    if d > max_width:
        raise ValueError(f"vectors have {d} entries; the driver's matrices are bounded to {max_width}")
    sums = [0] * d
    by_place = totals.where(F.col("width") == d).select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x"))
    for at, total in by_place.collect():
        sums[at] = total
    _, deviations, components = np.linalg.svd(_r_factor(of_width(rows, d), n, sums))
    seen = deviations > LEAST_SHARE * deviations.max(initial=0)
    e = deviations**2 / n
    return Whitening(n, tuple(sums), _signed(components[seen][:limit]), e[seen][:limit], float(e.sum()))


def of_width(rows: DataFrame, width: int) -> DataFrame:
    return rows.where(F.size("x") == width)


def whiten(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id, deviation (exact, as a decimal) and whitened (array, one entry per component) of the rows of the fitted width."""
    n, sums, projection = fitted.n, fitted.sums, fitted.projection
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = _moved(_matrix(batch, "x", len(sums)), n, sums)
            white = (moved.astype(np.float64) / n) @ projection
            ends = np.arange(len(white) + 1, dtype=np.int32) * projection.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))
            names = ["vec_id", "deviation", "whitened"]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _deviations(moved), lists], names=names)

    shape = f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>"
    return of_width(rows, len(sums)).mapInArrow(project, shape)


def identity_error(whitened: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity.

    Means of whitened rows are rounding errors, as rows were centred exactly; they are taken off all the same.
    """
    k = len(fitted.eigenvalues)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, gram = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            white = _matrix(batch, "whitened", k)
            total += white.sum(axis=0)
            gram += white.T @ white
        yield _as_row(np.concatenate([total, gram[np.triu_indices(k)]]))

    found = _added(whitened.select("whitened").mapInArrow(sums, "entries array<double>"), k + k * (k + 1) // 2)
    mean = found[:k] / fitted.n
    return float(np.abs(_square(found[k:], k) / fitted.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _r_factor(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows: the product of the factors of all passes."""
    factors: list[np.ndarray] = []
    for number in range(1, MAX_PASSES + 1):
        gram = _gram(rows, n, sums, factors)
        if not gram.any():
            return gram
        values, vectors = np.linalg.eigh(gram)
        orthogonal = bool(factors) and np.abs(values - 1).max(initial=0) < CLOSE
        if orthogonal or number == MAX_PASSES:
            # its symmetric root is a factor too, even if some directions have no variance
            root = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
            break
        factors.append(_factor(gram, n, shifted=not factors))
    product = root
    for factor in reversed(factors):
        product = product @ factor
    return product


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper Cholesky factor, of the shifted matrix at first and where it has none without a shift."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * (np.finfo(float).eps / 2) * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def _gram(rows: DataFrame, n: int, sums: list[int], factors: list[np.ndarray]) -> np.ndarray:
    d = len(sums)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d))
        for batch in batches:
            q = _moved(_matrix(batch, "x", d), n, sums).astype(np.float64) / n
            for factor in factors:
                q = _solved(q, factor)
            gram += q.T @ q
        yield _as_row(gram[np.triu_indices(d)])

    return _square(_added(rows.select("x").mapInArrow(grams, "entries array<double>"), d * (d + 1) // 2), d)


def _solved(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """y with y r = q, where r is upper triangular: one column after the other, for all rows at once."""
    y = np.empty_like(q)
    for j in range(len(r)):
        y[:, j] = (q[:, j] - y[:, :j] @ r[:j, j]) / r[j, j]
    return y


def _added(parts: DataFrame, length: int) -> np.ndarray:
    """Sum of the tasks' arrays, place by place."""
    total = np.zeros(length)
    added = parts.select(F.posexplode("entries").alias("at", "x")).groupBy("at").agg(F.sum("x"))
    for at, x in added.collect():
        total[at] = x
    return total


def _square(upper: np.ndarray, d: int) -> np.ndarray:
    whole = np.zeros((d, d))
    whole[np.triu_indices(d)] = upper
    return whole + np.triu(whole, 1).T


def _signed(components: np.ndarray) -> np.ndarray:
    """The largest entry of a component is positive."""
    if not components.size:
        return components
    largest = np.take_along_axis(components, np.abs(components).argmax(axis=1)[:, None], axis=1)
    return components * np.where(largest < 0, -1.0, 1.0)


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _moved(x: np.ndarray, n: int, sums: tuple[int, ...] | list[int]) -> np.ndarray:
    """n x - S, exactly."""
    largest = max(int(np.abs(x).max(initial=0)), *map(abs, sums), 1)
    kind = np.int64 if 2 * n * largest < 2**62 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def _deviations(moved: np.ndarray) -> pa.Array:
    """Sums of squares, exactly."""
    largest = int(abs(moved).max(initial=0))
    if largest**2 * moved.shape[1] < 2**63:
        squares = (moved.astype(np.int64) ** 2).sum(axis=1)
        return pa.array(squares, pa.int64()).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in moved], pa.decimal128(38, 0))


def _as_row(entries: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([entries], pa.list_(pa.float64()))], names=["entries"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length: number of vectors and their sums; given out early if lengths are many."""
    found: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        x = batch.column("x")
        widths = np.diff(x.offsets.to_numpy())
        values, begins = x.values.to_numpy(), x.offsets.to_numpy()[:-1]
        for width in np.unique(widths):
            rows = begins[widths == width]
            matrix = values[rows[:, None] + np.arange(width)]
            n, sums = found.get(int(width), (0, [0] * int(width)))
            kind = np.int64 if int(np.abs(matrix).max(initial=0)) * len(rows) < 2**62 else object
            added = matrix.astype(kind).sum(axis=0)
            found[int(width)] = (n + len(rows), [a + int(b) for a, b in zip(sums, added, strict=True)])
        if len(found) > 64:
            yield _totals_batch(found)
            found = {}
    if found:
        yield _totals_batch(found)


def _totals_batch(found: dict[int, tuple[int, list[int]]]) -> pa.RecordBatch:
    if any(abs(s) >= 2**63 for _, sums in found.values() for s in sums):
        raise OverflowError("the sum of a dimension passes 64 bits")
    columns = [
        pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()),
        pa.array([s for _, s in found.values()], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["width", "n", "sums"])


def whitened_rows(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", limit: int = 32
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries are left out, as are those of another length than the most
    frequent one. Repeated rows and null ids stay row by row; other columns are ignored. No vector, or none that
    differs, gives no row.
    """
    rows = whole_vectors(vectors, id_col, vector_col)
    fitted = fit(rows, limit)
    if fitted is None:
        fitted = Whitening(0, (), np.zeros((0, 0)), np.zeros(0), math.nan)
    white = whiten(rows, fitted)
    error = identity_error(white, fitted) if len(fitted.eigenvalues) else 0.0
    shares = F.array(*map(F.lit, fitted.explained.tolist())).cast("array<double>")
    each = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
