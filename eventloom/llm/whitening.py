"""Whitening of embeddings by polarisation covariance.

Vectors are fitted as integers. Two passes gather sums: first the count and each dimension's sum,
then the squares of every centred dimension and of every sum of two centred dimensions. With
V(i + j) the variance of such a sum, cov(i, j) = (V(i + j) - V(i) - V(j)) / 2, so covariances
come from squares alone. Centring takes off the integer next to the mean; what is left of the mean is
taken off exactly afterwards, in whole numbers, so that the covariance matrix is rounded once.

Each task folds its rows into one row per dimension or pair, in limbs of 40 bits that Spark adds up.
The driver gets d sums, d (d + 1) / 2 sums of squares and k * (k + 1) sums of the check, however
many vectors there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMB_BITS, LIMBS = 40, 6
LIMB_MASK = (1 << LIMB_BITS) - 1
SAFE = 1 << 62  # integer arithmetic below this bound fits in 64 bits
ROWS = 512  # vectors handled at once in a task
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_LIMB_COLUMNS = [f"l{k}" for k in range(LIMBS)]
_SUMS = "dims int, i int, j int, rows long, " + ", ".join(f"{c} long" for c in _LIMB_COLUMNS)


@dataclass(frozen=True)
class Whitening:
    """The fitted transform: ``n`` vectors with sums ``S``, eigenvalues and unit eigenvectors."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray  # one column per component
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else np.zeros_like(self.values)

    @property
    def usable(self) -> np.ndarray:
        """Components with variance; the others cannot be scaled to one."""
        least = len(self.sums) * np.finfo(float).eps * (self.values[0] if len(self.values) else 0.0)
        return self.values > least


def usable_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is neither null nor empty and holds no null or non-finite entry."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(~bad)


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000, held within 64 bits."""
    scaled = np.floor(values * 1024.0) + 100000.0
    if scaled.size and np.abs(scaled).max() >= 2.0**52:  # doubles no longer hold the sum
        whole = [min(max(int(np.floor(v * 1024.0)) + 100000, LEAST), MOST) if np.isfinite(v * 1024.0)
                 else (MOST if v > 0 else LEAST) for v in values.ravel()]
        return np.array(whole, dtype=object).reshape(values.shape)
    return scaled.astype(np.int64)


def _blocks(batch: pa.RecordBatch, vector: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of at most ``ROWS`` rows of one dimension each."""
    column = batch.column(vector)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        for at in range(0, len(rows), ROWS):
            part = rows[at: at + ROWS]
            with np.errstate(over="ignore"):
                yield part, _integers(flat[starts[part][:, None] + np.arange(dims)])


def _largest(x: np.ndarray) -> int:
    return int(max(abs(x.max()), abs(x.min()))) if x.size else 0


def _column_sums(x: np.ndarray) -> np.ndarray:
    if x.dtype != object and _largest(x) * len(x) < SAFE:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def _square_sums(y: np.ndarray) -> np.ndarray:
    """Sums of the squares of every dimension and of every sum of two, in ``np.triu`` order."""
    if y.dtype == object or 4 * _largest(y) ** 2 * len(y) >= SAFE:
        y = y.astype(object)
    out = []
    for i in range(y.shape[1]):
        pairs = y[:, i:i + 1] + y[:, i:]
        pairs[:, 0] = y[:, i]
        out.append((pairs * pairs).sum(axis=0))
    return np.concatenate(out).astype(object)


def _limb_rows(dims: int, rows: int, at: list[tuple[int, int]], sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Exact integers as limbs of a two's complement number."""
    for a in range(0, len(at), 1 << 16):
        part, ij = sums[a: a + (1 << 16)], np.array(at[a: a + (1 << 16)])
        limbs = [pa.array([int(s) >> (LIMB_BITS * k) if k == LIMBS - 1 else (int(s) >> (LIMB_BITS * k)) & LIMB_MASK for s in part], pa.int64()) for k in range(LIMBS)]
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([dims] * n, pa.int32()), pa.array(ij[:, 0], pa.int32()), pa.array(ij[:, 1], pa.int32()),
             pa.array([rows] * n, pa.int64()), *limbs],
            ["dims", "i", "j", "rows", *_LIMB_COLUMNS],
        )


def _added(df: DataFrame, fold: Callable) -> DataFrame:
    """One row per task, dimension and entry, added up over the tasks."""
    parts = df.mapInArrow(fold, _SUMS)
    return parts.groupBy("dims", "i", "j").agg(*[F.sum(c).alias(c) for c in ("rows", *_LIMB_COLUMNS)])


def _exact(row) -> int:
    return sum(row[c] << (LIMB_BITS * k) for k, c in enumerate(_LIMB_COLUMNS))


def _fold_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, int] = {}
    for batch in batches:
        for rows, x in _blocks(batch, 0):
            d = x.shape[1]
            sums[d] = sums.get(d, 0) + _column_sums(x)
            counts[d] = counts.get(d, 0) + len(rows)
    for d, s in sums.items():
        yield from _limb_rows(d, counts[d], [(i, i) for i in range(d)], s)


def _fold_squares(d: int, centre: np.ndarray) -> Callable:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, 0
        for batch in batches:
            for rows, x in _blocks(batch, 0):
                if x.shape[1] == d:
                    squares = _square_sums(x - centre)
                    total = squares if total is None else total + squares
                    count += len(rows)
        if total is not None:
            yield from _limb_rows(d, count, [(i, j) for i in range(d) for j in range(i, d)], total)

    return fold


def fit(vectors: DataFrame, vector: str, components: int = 8) -> Whitening | None:
    """The whitening of all usable vectors of the table's most frequent dimension (the larger one
    of two as frequent); None if there are none."""
    column = usable_vectors(vectors, vector).select(vector)
    sums = _added(column, _fold_sums).persist()
    try:
        top = sums.where("i = 0").orderBy(F.desc("rows"), F.desc("dims")).first()
        if top is None:
            return None
        d, n = top["dims"], top["rows"]
        by_dim = {r["i"]: _exact(r) for r in sums.where(F.col("dims") == d).collect()}
    finally:
        sums.unpersist()
    totals = [by_dim[i] for i in range(d)]
    centre = [s // n for s in totals]
    rest = [s - n * m for s, m in zip(totals, centre)]
    wide = max(map(abs, centre)) >= SAFE  # then a difference may not fit in 64 bits
    fold = _fold_squares(d, np.array(centre, dtype=object if wide else np.int64))
    squares = {(r["i"], r["j"]): _exact(r) for r in _added(column, fold).collect()}
    # n * n * V of a dimension, and of a sum of two.
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    cov = np.empty((d, d))
    for i in range(d):
        cov[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            cov[i, j] = cov[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: min(components, d)]
    chosen = basis[:, order]
    # Either sign is right: the largest entry of a component is made positive.
    lead = chosen[np.abs(chosen).argmax(axis=0), np.arange(len(order))]
    chosen = chosen * np.where(lead < 0, -1.0, 1.0)
    return Whitening(n, tuple(totals), np.maximum(values[order], 0.0), chosen, float(np.trace(cov)))


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S as whole numbers."""
    sums = np.array(model.sums, dtype=object)
    if x.dtype != object and (_largest(x) * model.n + max(map(abs, model.sums))) < SAFE:
        return x * model.n - sums.astype(np.int64)
    return x.astype(object) * model.n - sums


def _project(centred: np.ndarray, model: Whitening) -> np.ndarray:
    whole = (centred.astype(np.float64) / model.n) @ model.vectors
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(model.usable, whole / np.sqrt(model.values), np.nan)


def _squares_of(centred: np.ndarray) -> np.ndarray:
    if centred.dtype != object and _largest(centred) ** 2 * centred.shape[1] < SAFE:
        return (centred * centred).sum(axis=1)
    centred = centred.astype(object)
    return (centred * centred).sum(axis=1)


def identity_error(vectors: DataFrame, vector: str, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' own covariance minus the identity."""
    keep = np.flatnonzero(model.usable)
    k = len(keep)
    if k == 0:
        return 0.0

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _blocks(batch, 0):
                if x.shape[1] == len(model.sums):
                    z = _project(_centred(x, model), model)[:, keep]
                    total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k + 1), k), pa.int32()), pa.array(np.tile(np.arange(k), k + 1), pa.int32()),
             pa.array(total.ravel(), pa.float64())], ["i", "j", "part"],
        )

    parts = usable_vectors(vectors, vector).select(vector).mapInArrow(fold, "i int, j int, part double")
    total = np.zeros((k + 1, k))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():
        total[r["i"], r["j"]] = r["part"]
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


_OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """One row per usable vector and component: ``key, component, n, deviation, whitened,
    explained, identity_error``.

    Rows whose vector is null or empty, holds a null or non-finite entry or has another dimension than the
    table's most frequent one are left out. A null key stays null; repeated rows count and are
    returned as often as they stand; other columns are not looked at. Integers beyond 64 bits are
    held at its ends. A component without variance has a null ``whitened``. ``deviation`` is null where its exact
    value has more than 38 digits. A table without usable vectors gives no rows.
    """
    model = fit(vectors, vector, components)
    kept = usable_vectors(vectors, vector).select(F.col(vector), F.col(key))
    key_type = kept.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, {_OUT}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, vector, model)
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _blocks(batch, 0):
                if x.shape[1] != len(model.sums):
                    continue
                centred = _centred(x, model)
                deviation = _squares_of(centred)
                if deviation.dtype == object:
                    deviation = pa.array([int(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
                else:
                    deviation = pa.array(deviation).cast(pa.decimal128(38, 0))
                m = len(rows)
                each = pa.array(np.repeat(np.arange(m), k))
                z = _project(centred, model).ravel()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array([model.n] * (m * k), pa.int64()), deviation.take(each),
                     pa.array(z, pa.float64(), mask=np.isnan(z)), pa.array(np.tile(model.explained, m)),
                     pa.array([error] * (m * k), pa.float64())],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return kept.mapInArrow(project, schema)
