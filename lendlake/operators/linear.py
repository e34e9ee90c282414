"""Linear models from sufficient statistics.

One pass over the rows gives the centred cross products of all columns and the
target; every penalty and every polynomial degree is then solved from that
small matrix on the driver, and a sweep reads the rows once to fit and once to
score all of its models together.

A task centres its own rows before it multiplies, and the parts are combined
by the exact formula for pooled cross products, so columns need no scaling to
keep their digits.  The matrix has one row per column; rows are combined apart
from each other, and only the combined matrix (``MAX_WIDTH`` squared numbers
at most) goes to the driver.  A wider matrix is refused: such designs are for
the iterative solvers in ``models``.

Ridge and ordinary least squares solve the normal equations (of several
solutions the shortest).  The lasso goes down the coordinates, from one alpha
to the next smaller one, until the duality gap is below ``GAP`` of the null
loss.  ``certificate`` tells how far a solution is from optimal.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.session import ship_package

MAX_WIDTH = 4096
GAP = 1e-12
MAX_SWEEPS = 100_000
CHUNK_VALUES = 1 << 19  # numbers of expanded rows held at once


@dataclass(frozen=True)
class Design:
    """Which columns a model sees: ``kept`` ones of the feature vector, and products of up to ``degree`` of ``expanded`` ones.

    Products come first, by degree, so the columns of a lower degree are the
    first of a higher one; the kept columns follow.
    """

    kept: tuple[int, ...]
    expanded: tuple[int, ...] = ()
    degree: int = 1

    @property
    def terms(self) -> list[tuple[int, ...]]:
        return [t for d in range(1, self.degree + 1) for t in combinations_with_replacement(self.expanded, d)]

    @property
    def width(self) -> int:
        return comb(len(self.expanded) + self.degree, self.degree) - 1 + len(self.kept)

    def apply(self, x: np.ndarray) -> np.ndarray:
        products = [x[:, list(t)].prod(axis=1)[:, None] for t in self.terms]
        return np.concatenate([*products, x[:, list(self.kept)]], axis=1)

    def columns(self, degree: int) -> list[int]:
        """Places of the columns that the same design of a lower degree has."""
        total = len(self.terms)
        return [i for i, t in enumerate(self.terms) if len(t) <= degree] + list(range(total, total + len(self.kept)))


@dataclass
class Moments:
    """Counts, means and centred cross products of a design's columns (``x``) and the target (``y``)."""

    n: int
    x_mean: np.ndarray
    y_mean: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    def only(self, columns: Sequence[int]) -> Moments:
        at = np.asarray(columns, int)
        return Moments(self.n, self.x_mean[at], self.y_mean, self.xx[np.ix_(at, at)], self.xy[at], self.yy)


@dataclass
class Linear:
    coefficients: np.ndarray
    intercept: float


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    values = batch.column(column)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    size = max(1, CHUNK_VALUES // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def pooled(parts: list[tuple[int, np.ndarray, np.ndarray]], at: int) -> tuple[int, float, np.ndarray]:
    """Row ``at`` of the pooled cross products from ``(n, means, that row)`` of each part."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    row = sum(p[2] + p[0] * (p[1][at] - mean[at]) * (p[1] - mean) for p in parts)
    return n, mean[at], row


def moments(rows: DataFrame, design: Design, features: str = "features", label: str = "label") -> Moments:
    """One pass over the rows with a label; rows without one are left out.  An empty table raises."""
    width = design.width
    if width > MAX_WIDTH:
        raise ValueError(f"{width} columns are too many for the normal equations (at most {MAX_WIDTH})")
    ship_package(rows.sparkSession)
    schema = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("row", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, cross = 0, np.zeros(width + 1), np.zeros((width + 1, width + 1))
        for batch in _chunks(batches, width):
            z = np.concatenate([design.apply(_rows(batch, "x")), batch.column("y").to_numpy()[:, None]], axis=1)
            m = z.mean(axis=0)
            c = z - m
            total = n + len(z)
            cross += c.T @ c + np.outer(m - mean, m - mean) * (n * len(z) / total)
            mean += (m - mean) * (len(z) / total)
            n = total
        if n:
            k = width + 1
            values = [pa.array(range(k), pa.int32()), pa.array([n] * k, pa.int64())]
            lists = [pa.array([mean] * k, pa.list_(pa.float64())), pa.array(list(cross), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*values, *lists], schema=schema)

    def combine(part: pa.Table) -> pa.Table:
        i = part.column("i")[0].as_py()
        parts = [(n.as_py(), np.asarray(m.values), np.asarray(r.values)) for n, m, r in zip(*[part.column(c) for c in ("n", "mean", "row")])]
        n, mean, row = pooled(parts, i)
        return pa.table({"i": pa.array([i], pa.int32()), "n": pa.array([n]), "m": pa.array([float(mean)]), "row": pa.array([row], pa.list_(pa.float64()))})

    data = rows.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    partial = data.mapInArrow(run, "i int, n bigint, mean array<double>, row array<double>")
    found = partial.groupBy("i").applyInArrow(combine, "i int, n bigint, m double, row array<double>").collect()  # width + 1 rows
    if not found:
        raise ValueError("no rows to fit")
    found.sort(key=lambda r: r["i"])
    cross = np.array([r["row"] for r in found])
    cross = (cross + cross.T) / 2
    mean = np.array([r["m"] for r in found])
    return Moments(found[0]["n"], mean[:-1], float(mean[-1]), cross[:-1, :-1], cross[:-1, -1], float(cross[-1, -1]))


def ridge(m: Moments, alpha: float) -> Linear:
    """Least |y - Xb|^2 + alpha |b|^2; with alpha 0 the shortest of all least-squares solutions."""
    if alpha > 0:
        b = np.linalg.solve(m.xx + alpha * np.eye(len(m.xy)), m.xy)
    else:
        # In units of one standard deviation, so that small columns do not count as zero.
        scale = np.sqrt(np.diag(m.xx))
        scale[scale == 0] = 1.0
        b = np.linalg.pinv(m.xx / np.outer(scale, scale), rcond=1e-10, hermitian=True) @ (m.xy / scale) / scale
    return Linear(b, m.y_mean - float(b @ m.x_mean))


def lasso(m: Moments, alphas: Sequence[float]) -> dict[float, Linear]:
    """Least |y - Xb|^2 / 2n + alpha |b|_1 for every alpha, each started from the next larger one."""
    out, b = {}, np.zeros(len(m.xy))
    diagonal = np.diag(m.xx).copy()
    live = np.flatnonzero(diagonal > 0)
    for alpha in sorted(alphas, reverse=True):
        gradient, limit = m.xy - m.xx @ b, alpha * m.n
        for _ in range(MAX_SWEEPS):
            for j in live:
                old = b[j]
                pull = gradient[j] + diagonal[j] * old
                b[j] = np.sign(pull) * max(abs(pull) - limit, 0.0) / diagonal[j]
                if b[j] != old:
                    gradient -= m.xx[j] * (b[j] - old)
            gradient = m.xy - m.xx @ b
            if duality_gap(m, b, alpha) <= GAP * m.yy:
                break
        else:
            raise RuntimeError(f"the lasso with alpha {alpha} did not reach its duality gap in {MAX_SWEEPS} sweeps")
        out[alpha] = Linear(b.copy(), m.y_mean - float(b @ m.x_mean))
    return out


def residual_sum(m: Moments, b: np.ndarray) -> float:
    """Sum of squared residuals on the fitted rows, without reading them again."""
    return max(0.0, float(m.yy - 2 * b @ m.xy + b @ m.xx @ b))


def duality_gap(m: Moments, b: np.ndarray, alpha: float) -> float:
    """How far the lasso's objective (times n) can lie above its least value."""
    limit, rss, gradient = alpha * m.n, residual_sum(m, b), m.xy - m.xx @ b
    # The residuals, shrunk until they satisfy the dual constraints, are a dual point.
    worst = float(np.abs(gradient).max(initial=0.0))
    shrink = 1.0 if worst <= limit else limit / worst
    ry = float(m.yy - b @ m.xy)
    return rss / 2 * (1 + shrink**2) + limit * float(np.abs(b).sum()) - shrink * ry


def certificate(m: Moments, model: Linear, alpha: float, penalty: str) -> float:
    """Distance from the optimality conditions, as a share of the largest |X'y|.

    ``l2``: the normal equations.  ``l1``: the gradient equals the penalty with
    the coefficient's sign where there is one, and stays within it elsewhere.
    """
    gradient = m.xy - m.xx @ model.coefficients
    if penalty == "l2":
        off = np.abs(gradient - alpha * model.coefficients)
    else:
        limit, b = alpha * m.n, model.coefficients
        off = np.where(b != 0, np.abs(gradient - limit * np.sign(b)), np.maximum(np.abs(gradient) - limit, 0.0))
    return float(off.max(initial=0.0) / max(float(np.abs(m.xy).max(initial=0.0)), np.finfo(float).tiny))


def predictions(rows: DataFrame, design: Design, models: Sequence[Linear], features: str = "features", out: str = "predictions") -> DataFrame:
    """``rows`` (with no other vector column) without the features, with ``out``: one number for each model, in one pass."""
    ship_package(rows.sparkSession)
    weights = np.array([m.coefficients for m in models]).T
    intercepts = np.array([m.intercept for m in models])
    shared = rows.sparkSession.sparkContext.broadcast((weights, intercepts))
    keep = [c for c in rows.columns if c not in (features, out)]
    data = rows.select(*keep, vector_to_array(features).alias("__x"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.drop("__x").schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercepts = shared.value
        for batch in _chunks(batches, len(weights)):
            if batch.num_rows:
                y = design.apply(_rows(batch, "__x")) @ weights + intercepts
                columns = [batch.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(y), pa.list_(pa.float64()))], names=[*keep, out])

    return data.mapInArrow(run, f"{schema}, `{out}` array<double>")
