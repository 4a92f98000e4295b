"""Whitening of embeddings by shifted Cholesky QR.

An entry c becomes the whole number floor(1024 * c) + 100000. The rows, centred by their exact
sums, are orthogonalised in passes over the table: a pass solves the rows against the triangular
factors found so far and adds up their Gram matrix; its Cholesky factor (of the first pass, and
wherever the matrix is not numerically definite, with a shift on the diagonal) becomes the next
factor. Once the Gram matrix of the solved rows is the identity but for 1e-3, one more factor makes
them orthonormal to double precision. The product R of the factors has the same right singular
vectors as the centred rows, and its singular values are theirs: SVD of R gives the eigenvectors of
the covariance without ever squaring the condition number of the final factor.

Plan: every pass is one scan of a staged two-column table; a task emits one partial sum per cell of
its Gram matrix, and the cells are added by a grouped aggregate, so the driver receives
dimension ** 2 numbers whatever the number of tasks. ``LARGEST_DIMENSION`` bounds them.

Cases: a vector that is null, empty, or holds a null or non-finite entry gives no row, and neither
does one whose length is not the most frequent (of equally frequent ones the largest). Entries
beyond +-2**40 count as 2**40. Repeated rows count as often as they occur. Components without
variance (relative to the largest, below 1e-13) have ``whitened`` null. An empty table gives an
empty result. Columns other than the vector and the keys are not read, so no name can clash.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelloom.llm.common import map_batches, slices, staged

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST_DIMENSION = 4096
PASSES = 6
UNIT = 2.0 ** -53
LIMIT = float(1 << 40)


def usable(df, vector="embedding", keys=("vec_id",)):
    """(keys, ``__v``) of the rows whose vector can be used, staged; and the dimension."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.filter(v.isNotNull() & (F.size(v) > 0) & finite).select(
        *[F.col(f"`{k}`") for k in keys], F.col(f"`{vector}`").alias("__v"))
    rows = staged(rows)
    sizes = rows.groupBy(F.size("__v").alias("d")).agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return rows, 0
    if best["d"] > LARGEST_DIMENSION:
        raise ValueError(f"vectors of {best['d']} entries; the limit is {LARGEST_DIMENSION}")
    return rows.filter(F.size("__v") == best["d"]), best["d"]


def whole(column, d):
    """The whole numbers of an Arrow list column as an int64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64) + OFFSET).reshape(-1, d)


def solved(rows, factors):
    """``rows`` times the inverse of each upper triangular factor in turn, by forward substitution."""
    for r in factors:
        q = np.empty_like(rows)
        for j in range(r.shape[0]):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


class Centre:
    """Exact count and sums; rows are centred as whole numbers first, so no digit is lost."""

    def __init__(self, n, sums):
        self.n, self.sums = n, [int(s) for s in sums]
        near = [s // n for s in self.sums]
        self.near = np.array(near, np.int64)
        self.rest = [s - n * c for s, c in zip(self.sums, near)]  # 0 <= rest < n
        self.part = np.array([r / n for r in self.rest])

    def centred(self, x):
        return (x - self.near).astype(np.float64) - self.part

    def deviations(self, x):
        """Per row the exact sum of (n * x - sums) ** 2."""
        y = (x - self.near).astype(object)
        e = y * self.n - np.array(self.rest, object)
        return (e * e).sum(axis=1) if len(x) else []


def _sums(batches, d):
    total, n = np.zeros(d, object), 0
    for batch in slices(batches, rows=8192):
        x = whole(batch.column(0), d)
        total = total + x.sum(axis=0).astype(object)
        n += len(x)
    if n:
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array(range(-1, d), pa.int32()),
            "value": pa.array([Decimal(int(v)) for v in [n, *total]], pa.decimal128(38, 0))})


def _gram(batches, d, prepare):
    total, n = 0.0, 0
    for batch in slices(batches, rows=8192):
        q = prepare(whole(batch.column(0), d))
        total = total + q.T @ q
        n += len(q)
    if n:
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(len(flat)), pa.int32()), "value": pa.array(flat)})


def _added(rows, fn, kind, width):
    """Partial cells of all tasks added by Spark; the cells as a list on the driver."""
    cells = map_batches(rows.select("__v"), fn, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    found = {r["cell"]: r["value"] for r in cells.collect()}
    return [found.get(i, 0) for i in range(*width)]


def gram(rows, d, prepare, width=None):
    """Gram matrix of the prepared rows; ``prepare`` maps a matrix of whole numbers to one of doubles."""
    k = width or d
    return np.array(_added(rows, lambda it: _gram(it, d, prepare), "double", (k * k,)), np.float64).reshape(k, k)


def factor(g, shift):
    """Upper triangular F with F' F = g + shift."""
    return np.linalg.cholesky(g + shift * np.eye(len(g))).T


class Whitening:
    """Centre, eigenvalues of the covariance by falling value and unit eigenvectors as rows."""

    def __init__(self, centre, values, vectors):
        self.centre, self.values, self.vectors = centre, values, vectors
        total = values.sum()
        self.explained = values / total if total > 0 else np.zeros(len(values))
        self.used = values > 1e-13 * max(values[0], 1e-300) if len(values) else np.zeros(0, bool)

    def whiten(self, x, components):
        w = self.centre.centred(x) @ self.vectors[:components].T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.used[:components], w / np.sqrt(self.values[:components]), np.nan)


def fit(rows, d):
    """The whitening of all rows of (``__v``), or None if there are none."""
    n, *sums = _added(rows, lambda it: _sums(it, d), "decimal(38,0)", (-1, d)) if d else (0,)
    n = int(n)
    if not n:
        return None
    centre = Centre(n, sums)
    factors = []
    for k in range(PASSES):
        g = gram(rows, d, lambda x: solved(centre.centred(x), factors))
        scale = np.trace(g) or 1.0
        shift = 11 * (n * d + d * (d + 1)) * UNIT * scale
        near = k > 0 and np.abs(g - np.eye(d)).max() < 1e-3
        if k == PASSES - 1 and not near:
            # directions without variance keep the matrix singular: its root has the same product
            values, vectors = np.linalg.eigh(g)
            factors.append((vectors * np.sqrt(np.maximum(values, 0))).T)
            break
        try:
            factors.append(factor(g, 0.0 if k else shift))
        except np.linalg.LinAlgError:
            factors.append(factor(g, min(shift, 1e-2 * scale)))
        if near:
            break
    r = np.eye(d)
    for f in factors:
        r = f @ r
    _, s, vt = np.linalg.svd(r)
    # the same sign wherever the largest entry of a vector is clear
    at = np.abs(vt).argmax(axis=1)
    vt = vt * np.where(vt[np.arange(d), at] < 0, -1.0, 1.0)[:, None]
    return Whitening(centre, s ** 2 / n, vt)


def identity_error(rows, d, model, components=COMPONENTS):
    """Largest absolute entry of the covariance of all whitened rows minus the identity, measured."""
    k = int(model.used[:components].sum())
    if not k:
        return 0.0

    def prepare(x):
        return np.column_stack([model.whiten(x, k), np.ones(len(x))])

    g = gram(rows, d, prepare, k + 1) / model.centre.n
    return float(np.abs(g[:k, :k] - np.outer(g[k, :k], g[k, :k]) - np.eye(k)).max())


def _applied(batches, d, model, components):
    limit = 10 ** 38
    for batch in slices(batches, rows=4096):
        x = whole(batch.column(batch.num_columns - 1), d)
        w = model.whiten(x, components)
        values = pa.array(w.reshape(-1), mask=np.isnan(w).reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32()), values)
        exact = pa.array([Decimal(int(e)) if e < limit else None for e in model.centre.deviations(x)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], exact, lists], [*batch.schema.names[:-1], "deviation", "whitened"])


def whiten(df, vector="embedding", keys=("vec_id",), components=COMPONENTS):
    """``keys``, ``deviation`` decimal(38,0) (null beyond) and ``whitened`` array per usable row, and the model."""
    rows, d = usable(df, vector, keys)
    model = fit(rows, d)
    k = min(components, d)
    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keys)
    schema = kinds + "deviation decimal(38,0), whitened array<double>"
    if model is None:
        return df.sparkSession.createDataFrame([], schema), None, 0.0
    out = map_batches(rows, lambda it: _applied(it, d, model, k), schema)
    return out, model, identity_error(rows, d, model, k)
