"""Whitening of embeddings: principal components of unit variance.

Spark adds up the covariance of the distinct vectors, exactly centred; its leading eigenvectors come
from spectral divide and conquer (``qdwh``); the projection, a matrix of a few columns, goes to all
tasks and whitens every vector where it is.

What is collected grows with the length of the vectors alone: a sum per component, and a
covariance matrix of its square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.qdwh import leading_eigenvectors
from saleslake.llm.tables import slices, written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Scaled entries beyond this are held there, so that sums of a batch stay within 64 bits.
REACH = 2**40
#: Variances under this part of the greatest are rounding, not components.
RANK = 1e-11
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id, x``: ``floor(scale * c) + offset`` of every entry c, as long.

    A vector that is null or holds a null, NaN or infinite entry is left out; so are vectors of
    another length than the commonest (of equally common ones the greatest), which lie in no common
    space, and empty ones. Rows that repeat an id, a vector or both stay, as do null ids. Other
    columns are ignored, whatever their names.
    """
    c = F.col(vector)
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    held = lambda e: F.greatest(F.lit(-float(REACH)), F.least(F.lit(float(REACH)), F.lit(float(scale)) * e.cast("double")))
    x = F.transform(c, lambda e: F.floor(held(e)).cast("long") + offset)
    kept = rows.filter(c.isNotNull() & ~bad & (F.size(c) > 0)).select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x"))
    lengths = kept.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return kept.filter(F.size("x") == (commonest["length"] if commonest else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as rows."""
    x = batch.column("x")
    return np.asarray(x.flatten(), dtype=np.int64).reshape(batch.num_rows, -1)


def _added(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of matrices ``part(vectors as rows)``: one matrix a task, then one group a row of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, 2048):
            if batch.num_rows:
                made = part(_matrix(batch))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        rows = np.array(table["row"].to_pylist(), dtype=np.float64)
        return pa.table({"i": table["i"].slice(0, 1), "row": pa.array([rows.sum(axis=0)], pa.list_(pa.float64()))})

    parts = fit.select("x").mapInArrow(run, "i int, row array<double>")
    summed = parts.groupBy("i").applyInArrow(add, "i int, row array<double>")
    return np.array([r["row"] for r in sorted(summed.collect(), key=lambda r: r["i"])], dtype=np.float64)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of every component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in slices(batches, 2048):
            if batch.num_rows:
                made = _matrix(batch).sum(axis=0).astype(object)
                n, total = n + batch.num_rows, made if total is None else total + made
        if total is not None:
            # In two halves, so that whole numbers of any size add up exactly.
            columns = [range(len(total)), [n] * len(total), [int(t) >> 40 for t in total], [int(t) & (2**40 - 1) for t in total]]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["i", "n", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "i long, n long, high long, low long")
    rows = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).orderBy("i").collect()
    return (rows[0]["n"] if rows else 0), [(r["high"] << 40) + r["low"] for r in rows]


@dataclass(frozen=True)
class Whitening:
    """A fitted projection. ``base`` and ``rest`` are quotient and remainder of the sums by ``n``."""

    n: int
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: whole numbers as far as they go, so that no digit is lost."""
        return (x - self.base).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of ``(n * x - S) ** 2``, None where it needs more than 64 bits."""
        y = x - self.base
        widest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if x.shape[1] * widest * widest >= 2**63:
            y = y.astype(object)
        sums = ((self.n * y - self.rest) ** 2).sum(axis=1)
        return [int(s) if s < 2**63 else None for s in sums]


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of the distinct vectors of ``vectors`` (column ``x``, of one length).

    At most so many; those whose variance is none but for rounding are left out. None where there
    are no vectors, or all are equal. Equal variances give any basis of their space.
    """
    fit = written(vectors.select("x").distinct(), "fit")
    n, sums = _sums(fit)
    if not n:
        return None
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    centre = Whitening(n, base, rest, np.zeros(0), np.zeros((len(sums), 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        return c.T @ c

    covariance = _added(fit, products) / n
    values, axes = leading_eigenvectors(covariance, components)
    there = values > max(RANK * values[0], 0.0)
    if not there.any():
        return None
    model = Whitening(n, base, rest, values[there], axes[:, there], float(np.trace(covariance)))

    def check(x: np.ndarray) -> np.ndarray:
        z = model.whitened(x)
        return z.T @ z

    error = np.abs(_added(fit, check) / n - np.eye(len(model.values))).max()
    return Whitening(n, base, rest, model.values, model.vectors, model.trace, float(error))


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector (``vec_id, x``) and component of the model."""
    m = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            k = batch.num_rows
            if not k:
                continue
            x = _matrix(batch)
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(k), m)))
            deviation = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(k), m)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)),
                    pa.array(np.full(k * m, model.n, dtype=np.int64)),
                    deviation,
                    pa.array(model.whitened(x).reshape(-1)),
                    pa.array(np.tile(explained, k)),
                    pa.array(np.full(k * m, model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select("vec_id", "x").mapInArrow(run, OUT)


def whitened_embeddings(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every remaining row and component with its whitened value; no rows where no component exists
    (an empty table, or vectors that are all equal)."""
    vectors = integer_vectors(rows)
    model = fit_whitening(vectors, components)
    return rows.sparkSession.createDataFrame([], OUT) if model is None else whiten(vectors, model)
