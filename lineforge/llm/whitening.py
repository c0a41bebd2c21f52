"""Whitening of embeddings: eigenvectors of their covariance by pivoted Cholesky and one-sided Jacobi.

Three passes over the vectors, each with a bounded sum per task:

1. the number of rows and the exact sums of their integer entries;
2. the scatter matrix of the entries less the integer next to their mean.  These are small
   integers, so their products and sums are exact; the rest of the mean (under one half) is taken
   off afterwards, in whole numbers, so nothing is lost to the offset that all entries share;
3. the rows themselves: deviation and whitened coordinates.

The fit is of the dimensions' size alone.  The scatter is factorised with pivoting, V = L L' with
L's columns those of a permuted triangular matrix, which stops at the numerical rank; rotations from
the right make the columns of L orthogonal, one pair after the other (all disjoint pairs of a round
at once).  V is then (L W)(L W)': the columns' squared norms are its eigenvalues, the normalised
columns its eigenvectors, each to the precision of its own size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
EXACT = 2 ** 53      # up to here doubles hold all integers
MOST = 2 ** 61       # products with the scale beyond it are held to it
ROWS = 4096          # worked on at a time
SWEEPS = 60


def integers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id",
             vec_col: str = "embedding") -> DataFrame:
    """(_id, x): floor(scale * c) + shift of each entry c as a double; rows whose vector is null,
    empty or holds a null or non-finite entry are left out.  scale * c is held to 2^61 in size, as
    no long could hold the sums of much more."""
    c = F.col(vec_col)
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    x = F.transform(c, lambda e: F.floor(F.greatest(F.least(
        F.lit(float(scale)) * e.cast("double"), F.lit(float(MOST))), F.lit(float(-MOST)))).cast("long") + F.lit(shift))
    return vectors.where(c.isNotNull() & (F.size(c) > 0) & fine).select(F.col(id_col).alias("_id"), x.alias("x"))


def _by_length(column: pa.ListArray):
    """(length, rows, matrix) for the vectors of each length, ``ROWS`` at a time."""
    off = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    off = off - off[0]
    size = np.diff(off)
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        for a in range(0, len(rows), ROWS):
            some = rows[a:a + ROWS]
            yield int(dim), some, flat[off[some][:, None] + np.arange(dim)]


def _whole(values) -> list[str]:
    return [str(int(v)) for v in values]


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int], int]]:
    """{length: (n, exact sum of each entry, spread)}; spread: the largest entry less the smallest.
    A task sends one row for each length that it meets."""
    def partial(batches):
        held: dict[int, list] = {}
        for b in batches:
            for dim, _, x in _by_length(b.column("x")):
                low, high = x & 0xFFFFFFFF, x >> 32  # halves add up without overflow
                s = low.sum(0).astype(object) + high.sum(0).astype(object) * 2 ** 32
                old = held.get(dim)
                ends = int(x.min()), int(x.max())
                held[dim] = (len(x), s, *ends) if old is None else (old[0] + len(x), old[1] + s, min(old[2], ends[0]), max(old[3], ends[1]))
        for dim, (n, s, least, most) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n]), pa.array([least]), pa.array([most]),
                                              pa.array([_whole(s)], pa.list_(pa.string()))], names=["dim", "n", "least", "most", "s"])

    each = rows.select("x").mapInArrow(partial, "dim int, n long, least long, most long, s array<string>")
    added = (each.select("dim", "n", "least", "most", F.posexplode("s").alias("i", "v")).groupBy("dim", "i")
             .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                  F.sum(F.col("v").cast("decimal(38,0)")).cast("string").alias("v")))
    out: dict[int, tuple[int, list[int], int]] = {}
    for r in added.orderBy("dim", "i").collect():  # one row for each entry of a vector
        out.setdefault(r.dim, (r.n, [], r.most - r.least))[1].append(int(r.v))
    return out


def scatter(rows: DataFrame, centre: dict[int, list[int]], exact: dict[int, bool]) -> dict[int, np.ndarray]:
    """{length: sums of the products of (x - centre)}: whole numbers where ``exact``, else doubles.

    A task adds up its matrix and sends the upper half of it."""
    def partial(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, x in _by_length(b.column("x")):
                if exact[dim]:
                    d = x - np.array(centre[dim], np.int64)
                    if float(np.abs(d).max()) ** 2 * len(d) < EXACT:
                        f = d.astype(np.float64)
                        m = (f.T @ f).astype(np.int64).astype(object)
                    else:
                        m = d.astype(object).T @ d.astype(object)
                else:
                    d = x.astype(np.float64) - np.array(centre[dim], np.float64)
                    m = d.T @ d
                held[dim] = held[dim] + m if dim in held else m
        for dim, m in held.items():
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                pa.array(_whole(m[i, j]) if exact[dim] else [None] * len(i), pa.string()),
                pa.array(m[i, j].astype(np.float64))], names=["dim", "i", "j", "whole", "real"])

    each = rows.select("x").mapInArrow(partial, "dim int, i int, j int, whole string, real double")
    added = each.groupBy("dim", "i", "j").agg(F.sum(F.col("whole").cast("decimal(38,0)")).cast("string").alias("whole"),
                                              F.sum("real").alias("real"))
    out = {dim: np.zeros((dim, dim), object if exact[dim] else np.float64) for dim in centre}
    for r in added.collect():  # half a matrix of the dimensions' size
        out[r.dim][r.i, r.j] = out[r.dim][r.j, r.i] = int(r.whole) if exact[r.dim] else r.real
    return out


def pivoted_cholesky(v: np.ndarray, tol: float = 1e-15) -> np.ndarray:
    """L with v = L L' (d x r): the largest remaining diagonal entry is taken next, until none is
    over ``tol`` times the first."""
    d = len(v)
    rest, cols, first = v.copy(), [], max(float(np.diag(v).max(initial=0.0)), 0.0)
    open_ = np.ones(d, bool)
    for _ in range(d):
        diag = np.where(open_, np.diag(rest), -np.inf)
        p = int(diag.argmax())
        if not diag[p] > tol * first:
            break
        col = np.where(open_, rest[:, p], 0.0) / math.sqrt(diag[p])
        cols.append(col)
        rest -= np.outer(col, col)
        open_[p] = False
    return np.array(cols).T if cols else np.zeros((d, 0))


def one_sided_jacobi(a: np.ndarray) -> np.ndarray:
    """``a`` with its columns rotated until they are orthogonal.

    A round rotates disjoint pairs of columns, all at once; the rounds of a sweep (a tournament's
    order) bring every pair together once."""
    a = a.copy()
    r = a.shape[1]
    order = list(range(r + r % 2))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(order) - 1):
            half = len(order) // 2
            pairs = [(i, j) for i, j in zip(order[:half], order[:half - 1:-1]) if i < r and j < r]
            order = [order[0], order[-1], *order[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx * yy)
            turn = np.abs(xy) > 1e-16 * size
            worst = max(worst, float((np.abs(xy[turn]) / size[turn]).max(initial=0.0)))
            z = (yy - xx) / (2 * np.where(turn, xy, 1.0))
            t = np.where(turn, np.copysign(1.0, z) / (np.abs(z) + np.hypot(1.0, z)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a[:, i], a[:, j] = c * x - s * y, s * x + c * y
        if worst < 1e-15:
            break
    return a


def principal(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a covariance, the largest ``most``, falling; only
    those over the rounding of the largest."""
    factor = one_sided_jacobi(pivoted_cholesky(v))
    norm = np.sqrt((factor * factor).sum(0))
    order = np.argsort(-norm, kind="stable")
    order = order[norm[order] ** 2 > len(v) * 1e-15 * (norm.max(initial=0.0) ** 2)][:most]
    return norm[order] ** 2, factor[:, order] / norm[order]


def fit(rows: DataFrame, most: int = COMPONENTS) -> dict[int, dict]:
    """{length: model} of the vectors in ``rows`` (:func:`integers`): n, S, eigenvalues, eigenvectors
    and the covariance's trace."""
    models, found = {}, sums(rows)
    centre = {dim: [(2 * s + n) // (2 * n) for s in whole] for dim, (n, whole, _) in found.items()}
    exact = {dim: n * (spread + 1) ** 2 < 10 ** 37 for dim, (n, _, spread) in found.items()}  # a decimal holds it
    products = scatter(rows, centre, exact)
    for dim, (n, whole, _) in found.items():
        if exact[dim]:
            rest = np.array([s - n * c for s, c in zip(whole, centre[dim])], object)  # sums of the shifted entries
            square = n * products[dim] - np.outer(rest, rest)  # n^2 times the covariance, in whole numbers
            v = np.array([int(e) / (n * n) for e in square.ravel()], np.float64).reshape(dim, dim)
        else:
            rest = np.array([s / n - c for s, c in zip(whole, centre[dim])])
            v = products[dim] / n - np.outer(rest, rest)
        values, vectors = principal(v, most)
        models[dim] = {"n": n, "sums": whole, "spread": int(found[dim][2]), "values": values, "vectors": vectors,
                       "trace": float(np.trace(v))}
    return models


def whiten(vectors: DataFrame, components: int = COMPONENTS, **columns) -> tuple[DataFrame, dict[int, dict]]:
    """(rows, models): rows (vec_id, dim, n, deviation, whitened) of every usable vector; whitened: the
    vector less the mean, projected on the components, each over the root of its eigenvalue.

    Vectors of each length are fitted and whitened on their own.  Components that do not vary (an
    eigenvalue within the rounding of the largest) are left out: equal vectors have none, and an
    empty array.  deviation (the exact sum of (n x - S)^2) is null where no long can hold it.

    Nulls and odd input: see :func:`integers`; null and repeated ids and equal rows are kept row by
    row.  An empty table gives no rows and no model.  Other columns are not read."""
    rows = materialise(integers(vectors, **columns), "integers")
    models = fit(rows, components)
    shared = rows.sparkSession.sparkContext.broadcast(models)  # of the dimensions' size

    def out(batches):
        known = shared.value
        for b in batches:
            deviation, projected = np.zeros(b.num_rows, object), [None] * b.num_rows
            dims, n = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int64)
            for dim, at, x in _by_length(b.column("x")):
                m = known[dim]
                size, total = m["n"], m["sums"]
                low = [v // size for v in total]                            # S = n low + rest, 0 <= rest < n
                rest = [v - size * k for v, k in zip(total, low)]
                if m["spread"] < 2 ** 52:  # differences are small: exact in longs and doubles
                    d = x - np.array(low, np.int64)
                    centred = d.astype(np.float64) - np.array([v / size for v in rest])
                else:
                    d = x.astype(object) - np.array(low, object)
                    centred = ((d * size - np.array(rest, object)) / size).astype(np.float64)
                if (m["spread"] + 1) * max(size, m["spread"] + 1) * dim >= 2 ** 63:
                    d = d.astype(object)
                # sum of (n d - rest)^2
                one, two = (d * d).sum(1).astype(object), (d * np.array(rest, d.dtype)).sum(1).astype(object)
                deviation[at] = one * (size * size) - two * (2 * size) + sum(v * v for v in rest)
                w = centred @ m["vectors"] / np.sqrt(m["values"])
                dims[at], n[at] = dim, size
                for k, row in zip(at, w):
                    projected[k] = row
            yield pa.RecordBatch.from_arrays([
                b.column("_id"), pa.array(dims), pa.array(n),
                pa.array([int(d) if d < 2 ** 63 else None for d in deviation], pa.int64()),
                pa.array(projected, pa.list_(pa.float64()))], names=["_id", "dim", "n", "deviation", "whitened"])

    kind = rows.schema["_id"].dataType.simpleString()
    whitened = rows.mapInArrow(out, f"_id {kind}, dim int, n long, deviation long, whitened array<double>")
    return whitened.withColumnRenamed("_id", columns.get("id_col", "vec_id")), models


def identity_errors(whitened: DataFrame) -> DataFrame:
    """(dim, identity_error): how far the covariance of the whitened vectors of a length is from the
    identity, the largest entry of the difference, as measured over all rows."""
    def partial(batches):
        held: dict[int, list] = {}
        for b in batches:
            dims = b.column("dim").to_numpy(zero_copy_only=False)
            for k, at, w in _by_length(b.column("whitened")):
                for dim in np.unique(dims[at]):
                    x = w[dims[at] == dim]
                    n, s, p = held.get(int(dim), (0, 0.0, 0.0))
                    held[int(dim)] = (n + len(x), s + x.sum(0), p + x.T @ x)
        for dim, (n, s, p) in held.items():
            i, j = np.triu_indices(len(s))
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim] * len(i), pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                "n": pa.array([n] * len(i), pa.int64()), "si": pa.array(s[i]), "sj": pa.array(s[j]), "p": pa.array(p[i, j])})

    each = whitened.where(F.size("whitened") > 0).select("dim", "whitened").mapInArrow(
        partial, "dim int, i int, j int, n long, si double, sj double, p double")
    added = each.groupBy("dim", "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "p")])
    off = F.col("p") / F.col("n") - F.col("si") / F.col("n") * F.col("sj") / F.col("n") - (F.col("i") == F.col("j")).cast("double")
    return added.groupBy("dim").agg(F.max(F.abs(off)).alias("identity_error"))


def whitening_query(spark, sf_dir: str) -> DataFrame:
    """A row for each usable vector and component; see :func:`whiten`."""
    rows, models = whiten(table(spark, sf_dir, "embeddings"))
    rows = materialise(rows, "whitened")
    # a few numbers for each length of vectors
    shares = spark.createDataFrame([(dim, [float(e / m["trace"]) for e in m["values"]]) for dim, m in models.items()],
                                   "dim int, explained array<double>")
    known = shares.join(identity_errors(rows), "dim")
    out = rows.join(F.broadcast(known), "dim")
    return out.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("k", "whitened_")).select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", F.col("whitened_").alias("whitened"),
        F.element_at("explained", F.col("k") + 1).alias("explained"), "identity_error")
