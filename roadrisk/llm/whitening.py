"""Embedding whitening (PCA whitening of scaled integer vectors) with eigenvectors
refined from single precision.

1. A vector becomes x = floor(scale * c) per entry. The fit list holds each distinct
   x once (one shuffle, combined on the map side, written to the shared folder).
2. Sums S, then the covariance, are distributed: each Arrow batch gives one partial
   matrix of centred integers z = x - round(S / n), multiplied exactly (float64
   products of entries cut to at most 16 bits, in slices whose sums stay below 2^53),
   and Spark adds the partial entries as decimals. The exact remainder of the centre
   is taken off in whole numbers, so the covariance is right to the last bit whatever
   the order of the rows.
3. The d x d matrix is solved on the driver: eigenvectors in float32, corrected by
   Ogita and Aishima's iterations in extended precision (matrix products only). With
   X near orthogonal, R = I - X'X and S = X'VX give the eigenvalues s_ii / (1 - r_ii)
   and the correction X (I + E), e_ij = (s_ij + l_j r_ij) / (l_j - l_i). Eigenvalues
   nearer to each other than the error bound 2 (|S - D| + |V| |R|) form a cluster,
   whose e_ij is r_ij / 2; the cluster is then solved by itself: the small matrix
   B'(V - m I)B holds the differences within the cluster at full precision. The
   iterations converge quadratically and end when nothing improves.
4. One more pass over the fit list measures the covariance of the whitened vectors,
   and one over all rows returns the results. Nothing but sums passes the driver, and
   its d x d matrices don't grow with the rows.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry
are dropped, and so are vectors of another length than the commonest one of the fit
list (ties: the longer). A component without variance (as many as the rank lacks) has
a null ``whitened``; ``identity_error`` covers the others and is null when there are
none. ``explained`` is null when nothing varies. ``deviation`` is null where it exceeds
64 bits. Entries beyond 2^63 / scale are cut to the range of long; when entries
differ from their mean by 2^31 or more, the covariance is summed in double precision. Repeated rows and null ids each give
their own rows; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.common import arrow_map, stored

SCALE = 256
COMPONENTS = 4
EXACT_BELOW = 2 ** 31       # centred entries below it are multiplied as whole numbers
LOW_BITS = 16
SLICE = 4096                # rows multiplied at once: sums of products of 16-bit parts stay below 2^53
NO_VARIANCE = 1e-15         # of the trace

_RESULT = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def integer_vectors(df: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``df`` with the column ``_x`` (array of long); rows without a usable vector are dropped."""
    v = F.col(column)
    finite = F.forall(v, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return (df.filter(v.isNotNull() & (F.size(v) > 0) & finite)
            .withColumn("_x", F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))))


def _matrix(batch, dim: int) -> np.ndarray:
    return batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Rows, exact sums per dimension and the largest absolute entry."""
    def make():
        def work(batch):
            x = _matrix(batch, dim)
            big = max(int(x.max()), -int(x.min()))
            if big >= 2 ** 40:
                x = x.astype(object)
            yield {"j": list(range(dim)), "s": [Decimal(int(v)) for v in x.sum(axis=0)], "n": [len(x)] * dim, "big": [Decimal(big)] * dim}
        return work

    parts = arrow_map(fit, "j int, s decimal(38,0), n long, big decimal(38,0)", make)
    rows = parts.groupBy("j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("big").alias("big")).orderBy("j").collect()
    return rows[0].n, [int(r.s) for r in rows], max(int(r.big) for r in rows)


def exact_products(z: np.ndarray) -> np.ndarray:
    """z'z of whole numbers below 2^31, exactly, as Python integers."""
    total = np.zeros((z.shape[1], z.shape[1]), dtype=object)
    for at in range(0, len(z), SLICE):
        part = z[at:at + SLICE]
        if np.abs(part).max(initial=0) < 2 ** LOW_BITS:
            total += (lambda f: f.T @ f)(part.astype(np.float64)).astype(np.int64)
            continue
        high, low = (part >> LOW_BITS).astype(np.float64), (part & (2 ** LOW_BITS - 1)).astype(np.float64)
        cross = high.T @ low
        for matrix, bits in (((high.T @ high), 2 * LOW_BITS), (cross + cross.T, LOW_BITS), (low.T @ low, 0)):
            total += matrix.astype(np.int64).astype(object) << bits
    return total


def _extended(number: int) -> np.longdouble:
    """A whole number of any length, rounded to extended precision."""
    cut = max(0, abs(number).bit_length() - 63)
    value = np.ldexp(np.longdouble(np.int64(abs(number) >> cut)), cut)
    return -value if number < 0 else value


def covariance(fit: DataFrame, n: int, total: list[int], biggest: int) -> np.ndarray:
    """The covariance of the fit list (divisor n), in extended precision."""
    dim = len(total)
    centre = [(2 * s + n) // (2 * n) for s in total]  # round(S / n)
    exact = biggest + max(abs(c) for c in centre) < EXACT_BELOW
    kind = "decimal(38,0)" if exact else "double"

    def make():
        def work(batch):
            x = _matrix(batch, dim)
            if exact:
                products = exact_products(x - np.array(centre, dtype=np.int64))
                cells = [[Decimal(int(v)) for v in row] for row in products]
            else:
                z = x.astype(np.float64) - np.array([float(s) / n for s in total])
                cells = (z.T @ z).tolist()
            yield {"i": list(range(dim)), "cells": cells}
        return work

    parts = arrow_map(fit, f"i int, cells array<{kind}>", make)
    rows = (parts.select("i", F.posexplode("cells").alias("j", "v")).filter("i <= j")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    out = np.zeros((dim, dim), dtype=np.longdouble)
    left = [s - n * c for s, c in zip(total, centre)]  # sums of z
    for i, j, v in rows:
        if exact:
            value = _extended(n * int(v) - left[i] * left[j]) / _extended(n) / _extended(n)
        else:
            value = np.longdouble(v) / np.longdouble(n)
        out[i, j] = out[j, i] = value
    return out


def eigen_refined(matrix: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, in extended precision."""
    a = np.asarray(matrix, dtype=np.longdouble)
    unit = np.abs(a).max(initial=0)
    if not unit > 0:
        return np.zeros(len(a), dtype=np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / unit
    norm = np.sqrt((a * a).sum())
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    tiny = np.finfo(np.longdouble).eps
    last, best, kept = np.inf, np.inf, x
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        error = np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum())
        if error < best:
            best, kept = error, x
        bound = max(2 * error, 8 * tiny * norm)
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > bound
        x = x + x @ np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = _solve_clusters(a, x, values, bound)
        if error <= 4 * tiny * norm or (error > last / 2 and error < 1e-12):
            break
        last = error
    x = kept
    values = np.diag(x.T @ (a @ x)) / (x * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(axis=0))[order]
    largest = np.abs(x).argmax(axis=0)
    return values[order] * unit, x * np.sign(x[largest, np.arange(len(a))])


def _solve_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, bound) -> np.ndarray:
    """Turn the vectors of each cluster of near eigenvalues to the eigenvectors of the matrix
    between them, from which the cluster's mean eigenvalue is taken off in high precision."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > bound) + 1
    x = x.copy()
    for members in np.split(order, breaks):
        if len(members) > 1:
            basis = x[:, members]
            mean = values[members].mean()
            small = basis.T @ (a @ basis - mean * basis)
            small = (small + small.T) / 2
            size = np.abs(small).max()
            if size > 0:
                turn = np.linalg.eigh((small / size).astype(np.float64))[1]
                basis = basis @ turn.astype(np.longdouble)
                # the turn is orthogonal in double precision only
                x[:, members] = basis + basis @ (np.eye(len(members), dtype=np.longdouble) - basis.T @ basis) / 2
    return x


class Whitener:
    """A fitted model: small arrays that every task gets."""

    def __init__(self, n: int, total: list[int], biggest: int, matrix: np.ndarray, components: int = COMPONENTS):
        values, vectors = eigen_refined(matrix)
        trace = np.trace(matrix)
        k = min(components, len(total))
        self.n, self.total, self.biggest = n, total, biggest
        self.mean = np.array([float(_extended(s) / _extended(n)) for s in total])
        self.varies = [bool(values[i] > NO_VARIANCE * trace) for i in range(k)]
        self.values = values[:k].astype(np.float64)
        self.vectors = vectors[:, :k].astype(np.float64)
        self.explained = [float(values[i] / trace) if trace > 0 else None for i in range(k)]
        root = np.array([float(np.sqrt(v)) if ok else 1.0 for v, ok in zip(values[:k], self.varies)])
        self.directions = self.vectors / root

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.mean) @ self.directions

    def deviations(self, x: np.ndarray) -> list[int | None]:
        most = self.n * self.biggest + max(abs(s) for s in self.total)
        if most < 2 ** 62 and most * most * len(self.total) < 2 ** 63:
            gaps = x * np.int64(self.n) - np.array(self.total, dtype=np.int64)
            return (gaps * gaps).sum(axis=1).tolist()
        gaps = x.astype(object) * self.n - np.array(self.total, dtype=object)
        return [d if d < 2 ** 63 else None for d in (gaps * gaps).sum(axis=1).tolist()]


def identity_error(fit: DataFrame, model: Whitener) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    use = [i for i, ok in enumerate(model.varies) if ok]
    if not use:
        return None
    dim = len(model.total)

    def make():
        def work(batch):
            w = model.whiten(_matrix(batch, dim))[:, use]
            p = w.T @ w
            yield {"i": np.repeat(np.arange(len(use)), len(use)).tolist(), "j": np.tile(np.arange(len(use)), len(use)).tolist(),
                   "p": p.ravel().tolist()}
        return work

    parts = arrow_map(fit, "i int, j int, p double", make)
    rows = parts.groupBy("i", "j").agg(F.sum("p").alias("p")).collect()
    return max(abs(r.p / model.n - (1.0 if r.i == r.j else 0.0)) for r in rows)


def fit_list(vectors: DataFrame) -> tuple[DataFrame, int | None]:
    """Each distinct integer vector of the commonest length, stored, and that length."""
    distinct = stored(vectors.select("_x").distinct(), "whitening-fit")
    lengths = distinct.groupBy(F.size("_x").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if lengths is None:
        return distinct, None
    return distinct.filter(F.size("_x") == lengths.d), lengths.d


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitener, float | None] | None:
    """The model of a table of integer vectors and its measured identity error; None for an empty table."""
    rows, dim = fit_list(vectors)
    if dim is None:
        return None
    n, total, biggest = sums(rows, dim)
    model = Whitener(n, total, biggest, covariance(rows, n, total, biggest), components)
    return model, identity_error(rows, model)


def whitened(df: DataFrame, vec_id: str = "vec_id", column: str = "embedding", components: int = COMPONENTS,
             scale: int = SCALE) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = df.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, {_RESULT}"
    vectors = integer_vectors(df.select(F.col(vec_id).alias("vec_id"), F.col(column).alias("embedding")), "embedding", scale)
    fitted = fit(vectors, components)
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    model, error = fitted
    dim, k = len(model.total), len(model.varies)

    def make():
        def work(batch):
            import pyarrow as pa

            x = _matrix(batch, dim)
            w = model.whiten(x).ravel()
            missing = np.tile(~np.array(model.varies), len(x))
            yield {"vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                   "component": np.tile(np.arange(1, k + 1), len(x)).tolist(), "n": [model.n] * (k * len(x)),
                   "deviation": [d for d in model.deviations(x) for _ in range(k)],
                   "whitened": pa.array(w, mask=missing), "explained": model.explained * len(x),
                   "identity_error": [error] * (k * len(x))}
        return work

    return arrow_map(vectors.filter(F.size("_x") == dim).select("vec_id", "_x"), schema, make)
