"""Embedding whitening by shifted CholeskyQR.

The entries of a vector become integers, ``floor(64 * c) + 1000000``; the fit
list holds each distinct integer vector once.  With n vectors of d entries,
centred by their exact integer sums, A is the n x d matrix that is never held
anywhere as a whole:

1. *Shifted pass.*  Every task adds up the Gram matrix of its centred rows;
   the sum G = A'A gets the shift that keeps it positive definite in floating
   point, and its Cholesky factor is R1.
2. *Further passes.*  Rows are orthogonalised by triangular solves with all
   factors so far (``A inv(R1) inv(R2)``), their Gram matrix gives the next
   factor.  Three passes make the columns orthonormal to working precision, also
   where the Gram matrix itself would have lost the small directions.
3. *Components.*  A = Q R with R = R3 R2 R1, so the right singular vectors of
   the d x d matrix R are the eigenvectors of the covariance, and its singular
   values squared, divided by n, are the eigenvalues.

A pass moves one d x d matrix from each task, pre-summed by Spark before the
driver reads one of them; d is the length of a vector and does not grow with the
rows.  The fit list is written once as Parquet in the shared folder.

Defined results: rows whose vector is null, empty, or holds a null, NaN or
infinite entry give no rows, nor do those with an entry of 2**46 or more in size
(their integers are not exact in doubles); of vectors of several lengths, those of
the commonest length (ties: the longer) are used.  A null id keeps its row,
repeated rows count once for the fit and each give rows.  Components whose
variance is below 1e-13 of the largest are no components: a table of equal
vectors, or an empty one, gives no rows.  Equal eigenvalues (ties) may come in any
order.  ``deviation`` is null where the exact sum does not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import materialize

SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 46)
PASSES = 3
COMPONENTS = 16
NO_VARIANCE = 1e-13


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the integer vectors of all usable rows."""
    v = F.col("v")
    usable = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    named = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    named = named.where(F.coalesce(usable, F.lit(False)))
    x = F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long") + F.lit(OFFSET))
    return named.select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of an Arrow column of equally long lists as an int64 matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _sum_matrices(fit: DataFrame, shape: tuple[int, int], of_batch: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``of_batch(x)``, matrices of one shape: each task sends one, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += of_batch(_matrix(batch.column(0)))
        i, j = np.divmod(np.arange(total.size), shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    cells = fit.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(shape)
    out[cells["i"], cells["j"]] = cells["v"]
    return out


def _solve_lower(r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """``a inv(r)`` for an upper triangular r, by substitution over its columns."""
    out = np.array(a)
    for j in range(r.shape[0]):
        out[:, j] -= out[:, :j] @ r[:j, j]
        out[:, j] /= r[j, j]
    return out


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix; shifted in the first pass and where it is singular."""
    d = len(gram)
    gram = (gram + gram.T) / 2
    norm = max(float(np.linalg.norm(gram, 2)), np.finfo(float).tiny)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * norm
    if not first:
        # full rank to working precision: the plain factor; otherwise the shift keeps it defined
        shift = 0.0 if np.linalg.eigvalsh(gram)[0] > 1e-8 * norm else max(shift, 1e-10 * norm)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


@dataclass
class Whitening:
    """A fitted transform: exact sums of the fit list, components (columns) and their eigenvalues."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.eigenvalues)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S/n``: the whole part of the mean is taken off exactly, in integers."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``x`` (column ``x``); None if there is no variance."""
    found = materialize(x.select("x").dropDuplicates(), "whitening")
    lengths = found.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    d, n = int(lengths["d"]), int(lengths["n"])
    rows = found.where(F.size("x") == d)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, dtype=object)
        for batch in batches:
            total += _matrix(batch.column(0)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array([str(v) for v in total])], names=["j", "s"])

    per = rows.select("x").mapInArrow(partial_sums, "j long, s string").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = np.zeros(d, dtype=np.int64)
    for row in per.collect():
        sums[row["j"]] = int(row["s"])

    factors: list[np.ndarray] = []
    trace = 0.0
    for k in range(PASSES):

        def gram(x: np.ndarray) -> np.ndarray:
            a = _centred(x, n, sums)
            for r in factors:
                a = _solve_lower(r, a)
            return a.T @ a

        g = _sum_matrices(rows, (d, d), gram)
        if k == 0:
            trace = float(np.trace(g))
            if trace <= 0:
                return None
        factors.append(_factor(g, n, first=k == 0))
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    _, s, vt = np.linalg.svd(r)
    keep = min(components, int((s**2 > NO_VARIANCE * s[0] ** 2).sum()), max(n - 1, 0))
    model = Whitening(n, sums, vt[:keep].T.copy(), s[:keep] ** 2 / n, trace / n, 0.0)

    def check(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    moments = _sum_matrices(rows, (keep + 1, keep), check) / n
    mean = moments[-1]
    model.identity_error = float(np.abs(moments[:-1] - np.outer(mean, mean) - np.eye(keep)).max())
    return model


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact ``sum (n*x - S)**2`` of each row."""
    whole = sums // n
    y = x - whole
    biggest = max(float(np.abs(y).max(initial=0)) + 1.0, 1.0) * n
    if biggest * biggest * x.shape[1] < float(1 << 62):
        diff = n * y - (sums - whole * n)
        return (diff * diff).sum(axis=1).tolist()
    diff = n * y.astype(object) - (sums - whole * n).astype(object)
    return [v if v < 1 << 63 else None for v in (diff * diff).sum(axis=1)]


def whiten(x: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, n, deviation, whitened``: the whitened vector of every row of ``x`` (vec_id, x)."""
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(1))
            flat = pa.array(model.whiten(m).ravel())
            width = len(model.eigenvalues)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.n] * len(m), pa.int64()), pa.array(_deviation(m, model.n, model.sums), pa.int64()), lists],
                names=["vec_id", "n", "deviation", "whitened"],
            )

    ident = x.schema["vec_id"].dataType.simpleString()
    return x.where(F.size("x") == d).mapInArrow(run, f"vec_id {ident}, n long, deviation long, whitened array<double>")


LONG = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_components(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable row of ``rows`` and component: the long form of :func:`whiten`."""
    x = integer_vectors(rows, id_col, vector_col)
    model = fit(x, components)
    if model is None or not len(model.eigenvalues):
        return rows.sparkSession.createDataFrame([], LONG.format(x.schema["vec_id"].dataType.simpleString()))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    out = whiten(x, model).select("vec_id", "n", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return out.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
