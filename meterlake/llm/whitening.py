"""Embedding whitening by shifted CholeskyQR.

The centred rows are the matrix Y. Each distributed pass solves its rows through
the triangular factors found so far and adds up their Gram matrix; its Cholesky
factor (of the shifted Gram matrix, while that is needed to keep it positive) is
the next factor. When the solved rows are orthonormal, the product R of the
factors has Y's singular values and right singular vectors, and the SVD of the
small R gives the whitening components. Rows stay where they are: a pass sends
one matrix per task into a sum by cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.session import ship_package

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000   # an entry c counts as floor(SCALE * c) + OFFSET
LARGEST = float(1 << 20)        # entries must be smaller: sums and products then fit 64 bits
MAX_PASSES = 6
SETTLED = 1e-6                  # largest distance of the Gram matrix from the identity at which the last factor is taken
NO_RANK = 1e-13                 # singular values at most this share of the largest count as zero


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n rows with per-dimension sums, unit components (rows) and their variances."""

    n: int
    sums: object
    components: object
    variances: object
    total: float
    passes: int

    @property
    def dim(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows whose vector is whole: not null, every entry a finite number below ``LARGEST``."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))   # NaN is above every number
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0) & whole))


def _matrix(np, column, dim):
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def _whole_numbers(np, column, dim):
    return np.floor(SCALE * _matrix(np, column, dim)).astype(np.int64) + OFFSET


def _solve(np, y, factors):
    """Y R^-1 for the product R of upper triangular factors, column by column."""
    for r in factors:
        q = np.empty_like(y)
        for j in range(y.shape[1]):
            q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        y = q
    return y


def _summed(rows: DataFrame, part, kind: str, size: int):
    """Element sums of the arrays that ``part`` (batches to one array of ``size``) gives for each task."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([part(np, batches)], pa.list_(pa.int64() if kind == "long" else pa.float64()))], ["a"])

    cells = (rows.mapInArrow(run, f"a array<{kind}>").select(F.posexplode("a").alias("cell", "x"))
             .groupBy("cell").agg(F.sum("x").alias("x")).toArrow())   # one row a cell
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    out[cells.column("cell").to_numpy()] = cells.column("x").to_numpy()
    return out


def _gram(rows: DataFrame, n: int, sums, factors):
    dim = len(sums)

    def part(np, batches):
        total = np.zeros((dim, dim))
        for b in batches:
            q = _solve(np, (n * _whole_numbers(np, b.column(0), dim) - sums) / n, factors)
            total += q.T @ q
        return total.ravel()

    return _summed(rows, part, "double", dim * dim).reshape(dim, dim)


def _factor(np, gram, n: int, shifted: bool):
    """(upper Cholesky factor, whether a shift was needed)."""
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T, False
        except np.linalg.LinAlgError:
            pass
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps * np.linalg.norm(gram, 2)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T, True


def fit(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
        vector_col: str = "embedding") -> Whitening | None:
    """Components of all usable rows; None without any.

    Rows whose length is not the commonest one (the longer, if equally common)
    take no part. What comes to the driver has the size of one d x d matrix.
    """
    import numpy as np

    ship_package(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    first = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return None
    dim, n = first["d"], first["n"]
    rows = rows.where(F.size("v") == dim).select("v")

    def count(np, batches):
        total = np.zeros(dim, np.int64)
        for b in batches:
            total += _whole_numbers(np, b.column(0), dim).sum(0)
        return total

    sums = _summed(rows, count, "long", dim)
    factors, passes = [], 0
    while passes < MAX_PASSES:
        gram = _gram(rows, n, sums, factors)
        passes += 1
        if not gram.any():        # all rows are equal
            return Whitening(n, sums, np.zeros((min(components, dim), dim)), np.zeros(min(components, dim)), 0.0, passes)
        settled = bool(factors) and np.abs(gram - np.eye(dim)).max() <= SETTLED
        r, shifted = _factor(np, gram, n, shifted=not factors)
        factors.append(r)
        if settled and not shifted:
            break
    whole = np.eye(dim)
    for r in factors:
        whole = r @ whole
    _, s, vt = np.linalg.svd(whole)
    sign = np.where(vt[np.arange(dim), np.abs(vt).argmax(1)] < 0, -1.0, 1.0)
    kept = np.where(s > NO_RANK * s[0], s, 0.0)
    return Whitening(n, sums, (vt * sign[:, None])[:components], (kept**2 / n)[:components], float((kept**2).sum() / n), passes)


def _project(np, model: Whitening, x):
    """Whitened coordinates of rows of whole numbers; NaN where a component has no variance."""
    y = (model.n * x - model.sums) / model.n
    with np.errstate(divide="ignore"):
        scale = np.where(model.variances > 0, 1 / np.sqrt(model.variances), np.nan)
    return (y @ model.components.T) * scale


def identity_error(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> float | None:
    """Largest entry of the whitened rows' covariance minus the identity, over components that have variance."""
    import numpy as np

    dim, on = model.dim, np.flatnonzero(model.variances > 0)
    if not len(on):
        return None
    k = len(on)

    def part(np, batches):
        total = np.zeros(k + k * k)
        for b in batches:
            w = _project(np, model, _whole_numbers(np, b.column(0), dim))[:, on]
            total[:k] += w.sum(0)
            total[k:] += (w.T @ w).ravel()
        return total

    rows = usable(vectors, id_col, vector_col).where(F.size("v") == dim).select("v")
    got = _summed(rows, part, "double", k + k * k) / model.n
    cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    return float(np.abs(cov - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable row and component.

    Fitted on all usable rows of ``vectors`` and applied to them. Rows with a
    null vector, an empty one, or a null, non-finite or huge (2**20 or more)
    entry take no part, nor do rows of another length than the commonest.
    Repeated rows and null ids stay. ``deviation`` is exact (null beyond 64 bits).
    A component without variance (fewer independent rows than components, or all
    rows equal) has a null ``whitened``; with no variance at all ``explained`` and
    ``identity_error`` are null. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(vectors, components, id_col, vector_col)
    if model is None:
        return spark.createDataFrame([], kinds)
    error = identity_error(vectors, model, id_col, vector_col)
    dim, k = model.dim, len(model.variances)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            x = _whole_numbers(np, b.column(1), dim)
            gap = model.n * x - model.sums
            if float(np.abs(gap).max(initial=0)) ** 2 * dim < 2**62:
                deviation = pa.array(np.repeat((gap * gap).sum(1), k))
            else:
                exact = [sum(int(c) ** 2 for c in row) for row in gap]
                deviation = pa.array([d if d < 2**63 else None for d in exact for _ in range(k)], pa.int64())
            rows = len(x)
            share = model.variances / model.total if model.total else np.full(k, np.nan)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, model.n)), deviation, pa.array(_project(np, model, x).ravel(), from_pandas=True),
                 pa.array(np.tile(share, rows), from_pandas=True), pa.array([error] * (rows * k), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable(vectors, id_col, vector_col).where(F.size("v") == dim).mapInArrow(run, kinds)
