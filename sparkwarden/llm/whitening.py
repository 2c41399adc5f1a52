"""Embedding whitening: eigenpairs kept up to date by rank-one updates, merged as spectra, polished by a Rayleigh-Ritz pass.

Each partition keeps ``(n, mean, eigenvalues, eigenvectors)`` of the scatter of the rows it has seen; a row changes the
scatter by a multiple of ``(x - mean)(x - mean)^T``, whose new eigenvalues are the roots of a secular equation.  Spectra
of partitions are merged in blocks, level by level: the second one enters the first as one rank-one update for each of
its eigenpairs and one for the distance of the means.  What is left of rounding errors goes in one pass over all rows
that forms the covariance in the basis found (d x d numbers a partition) and diagonalises it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.llm import workers
from sparkwarden.storage import discard, written

EPS = np.finfo(float).eps
#: Spectra that one task merges; levels = log of the number of partitions to this base.
BLOCK = 16
#: What is added to each scaled entry, and the scale.
SHIFT, SCALE = 100_000, 1024
#: An eigenvalue below this share of the trace is zero: its component has nothing to whiten.
ZERO = 1e-12


def _roots(poles: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (poles - t))``, one right of each pole: index of the nearest pole and distance from it.

    ``poles`` ascend strictly, ``z2`` is positive.  Steps fit two poles (the root's neighbours) and a constant; where a
    step would leave the bracket the bracket is halved.
    """
    k = len(poles)
    right = np.append(poles[1:], poles[-1] + z2.sum())
    gap = right - poles
    middle = poles[:, None] - (poles + gap / 2)[None, :]  # [pole, root]
    with np.errstate(divide="ignore", invalid="ignore"):
        past = 1 + (z2[:, None] / middle).sum(0) < 0  # the root lies in the right half
    past[-1] = False
    index = np.arange(k)
    origin = index + past
    delta = poles[:, None] - poles[origin][None, :]
    end = np.append(poles, right[-1])[index + 1] - poles[origin]
    low, high = np.where(past, -gap / 2, 0.0), np.where(past, 0.0, np.where(index == k - 1, gap, gap / 2))
    out = (low + high) / 2
    # Each pass works on the roots that are not settled: those whose sum differs from 0 by more than rounding.
    live, tau = index, out
    mask = (index[:, None] <= index[None, :]).astype(float)
    for _ in range(80):
        d = delta - tau
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            terms = z2[:, None] / d
            f = 1 + terms.sum(0)
            slope = terms / d
            below = (slope * mask).sum(0)
            total = slope.sum(0)
            low, high = np.where(f < 0, tau, low), np.where(f >= 0, tau, high)
            d0, d1 = d[live, np.arange(len(live))], end - tau
            c = f - d0 * below - d1 * (total - below)
            a = (d0 + d1) * f - d0 * d1 * total
            b = d0 * d1 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            to = tau + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        to = np.where((to > low) & (to < high), to, (low + high) / 2)
        go = (np.abs(f) > 4 * EPS * (1 + np.abs(terms).sum(0))) & (np.abs(to - tau) > 2 * EPS * np.abs(to))
        out[live] = np.where(go, to, tau)
        if not go.any():
            break
        if not go.all():
            live, to, low, high, end, delta, mask = live[go], to[go], low[go], high[go], end[go], delta[:, go], mask[:, go]
        tau = to
    return origin, out


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``vectors diag(values) vectors^T + weight v v^T`` (weight > 0); values ascend.

    Deflation: parts of ``v`` that vanish in the basis leave their pairs alone; of equal eigenvalues all but one are
    turned out of ``v``'s way.
    """
    z = vectors.T @ v * np.sqrt(weight)
    scale = max(abs(values[-1]), abs(values[0]), float(z @ z))
    if scale == 0:
        return values, vectors
    small = 8 * EPS * scale
    # Runs of equal eigenvalues: one reflection leaves one of each run with a part in v.
    cut = np.flatnonzero(np.diff(values) > small) + 1
    if len(cut) + 1 < len(values):
        vectors = vectors.copy()
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(values)], strict=True):
            norm = np.linalg.norm(z[lo:hi])
            if hi - lo > 1 and norm > 0:
                u = z[lo:hi].copy()
                u[-1] += np.copysign(norm, u[-1])
                u /= np.linalg.norm(u)
                part = vectors[:, lo:hi]
                vectors[:, lo:hi] = part - 2 * np.outer(part @ u, u)
                last = -np.copysign(norm, z[hi - 1])
                z[lo:hi] = 0
                z[hi - 1] = last
    on = np.flatnonzero(np.abs(z) * np.sqrt(scale) > small)
    if not len(on):
        return values, vectors
    poles, part = values[on], z[on]
    origin, tau = _roots(poles, part * part)
    away = (poles[origin][None, :] - poles[:, None]) + tau[None, :]  # [pole, root]: root - pole, without cancellation
    # The z for which these roots are exact (Loewner's formula): so the vectors come out orthogonal.
    k = len(on)
    between = poles[None, :] - poles[:, None]
    if k > 1:
        left, at = np.arange(k)[None, :-1], np.arange(k)[:, None]
        ratio = away[:, :-1] / np.where(left < at, between[:, :-1], between[:, 1:])
        exact = np.sqrt(np.abs(np.prod(ratio, axis=1) * away[:, -1]))
    else:
        exact = np.sqrt(np.abs(away[:, -1]))
    turn = -np.copysign(exact, part)[:, None] / away
    turn /= np.linalg.norm(turn, axis=0)
    values, vectors = values.copy(), vectors.copy()
    values[on] = poles[origin] + tau
    vectors[:, on] = vectors[:, on] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the scatter (sum of centred outer products) of the rows seen."""

    def __init__(self, d: int, n: int = 0, mean: np.ndarray | None = None, values: np.ndarray | None = None, vectors: np.ndarray | None = None):
        self.n = n
        self.mean = np.zeros(d) if mean is None else mean
        self.values = np.zeros(d) if values is None else values
        self.vectors = np.eye(d) if vectors is None else vectors

    def add(self, x: np.ndarray) -> None:
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, x - self.mean, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + (x - self.mean) / self.n

    def merge(self, other: Spectrum) -> None:
        """Successive rank-one updates by the other's eigenpairs and by the distance of the means."""
        if not other.n or not self.n:
            if other.n:
                self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        n = self.n + other.n
        apart = other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * other.n / n)
        self.mean = self.mean + apart * (other.n / n)
        self.n = n

    def row(self, at: int) -> dict:
        return {"at": [at], "n": [self.n], "mean": [self.mean], "vals": [self.values], "vecs": [self.vectors.ravel()]}


_SPECTRUM = "at long, n long, mean array<double>, vals array<double>, vecs array<double>"


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column of whole numbers, all of length ``d``."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _spectra(d: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = Spectrum(d)
        for batch in batches:
            for x in _matrix(batch.column("x"), d).astype(float):
                found.add(x)
        if found.n:
            yield pa.RecordBatch.from_pydict(found.row(TaskContext.get().partitionId()))

    return run


def _merged(d: int) -> Callable:
    def run(rows):
        import pandas as pd

        total = Spectrum(d)
        for r in rows.sort_values("at").itertuples():
            total.merge(Spectrum(d, int(r.n), np.array(r.mean), np.array(r.vals), np.array(r.vecs).reshape(d, d)))
        return pd.DataFrame(total.row(int(rows["at"].min()) // BLOCK))

    return run


def _sums(d: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, np.int64), 0
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            total, n = total + x.sum(0), n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(d, dtype=np.int32), "s": total, "n": np.full(d, n)})

    return run


def _products(d: int, mean: np.ndarray, basis: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per partition, sums of ``y`` and of ``y y^T`` for ``y = basis^T (x - mean)``, as rows of (dim, array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = basis.shape[1]
        total, seen = np.zeros((k + 1, k)), False
        for batch in batches:
            y = (_matrix(batch.column("x"), d) - mean) @ basis
            total[:k] += y.T @ y
            total[k] += y.sum(0)
            seen = seen or len(y) > 0
        if seen:
            yield pa.RecordBatch.from_pydict({"i": np.repeat(np.arange(k + 1, dtype=np.int32), k), "j": np.tile(np.arange(k, dtype=np.int32), k + 1), "s": total.ravel()})

    return run


def _moments(rows: DataFrame, d: int, mean: np.ndarray, basis: np.ndarray, n: int) -> np.ndarray:
    """Covariance (divisor n) of the rows in a basis; k x k sums come to the driver, whatever the number of rows."""
    k = basis.shape[1]
    sums = np.zeros((k + 1, k))
    for r in rows.select("x").mapInArrow(workers.lean(_products(d, mean, basis)), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        sums[r.i, r.j] = r.s
    off = sums[k] / n
    out = sums[:k] / n - np.outer(off, off)
    return (out + out.T) / 2


def scaled(vector: Column) -> Column:
    """Entries as whole numbers: ``floor(1024 c) + 100000``."""
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * F.lit(float(SCALE))) + F.lit(SHIFT)).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor empty nor with an entry that is null or not finite."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector.cast("array<double>"), bad), F.lit(False))


def fit(rows: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """``n``, exact sums per dimension, eigenvalues (falling) and unit eigenvectors (columns) of the rows' covariance."""
    sums = rows.select("x").mapInArrow(workers.lean(_sums(d)), "dim int, s long, n long").groupBy("dim").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    n, exact = sums[0].n, np.array([r.s for r in sums], dtype=object)
    spectra = written(rows.select("x").mapInArrow(workers.lean(_spectra(d)), _SPECTRUM), "spectra")
    while spectra.agg(F.count(F.lit(1))).first()[0] > 1:
        more = written(spectra.groupBy(F.floor(F.col("at") / BLOCK).alias("block")).applyInPandas(_merged(d), _SPECTRUM), "spectra")
        discard(spectra)
        spectra = more
    found = spectra.first()
    discard(spectra)
    mean = np.array([float(s / n) for s in exact])
    # Rayleigh-Ritz over the whole basis: orthonormal again first, then the covariance in it is all but diagonal.
    basis, _ = np.linalg.qr(np.array(found.vecs).reshape(d, d)[:, ::-1])
    values, turn = np.linalg.eigh(_moments(rows, d, mean, basis, n))
    return n, exact, np.maximum(values[::-1], 0.0), basis @ turn[:, ::-1]


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``components`` rows for each usable row of ``vectors``: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or empty, or has a null, NaN or infinite entry, are dropped; so are vectors of another
    length than most (of lengths equally frequent the larger counts).  Rows count as they stand: repeated and missing
    ids are rows like others.  Vectors of fewer entries than ``components`` have as many components as entries.  A
    component without variance (all rows alike in it) has ``whitened`` 0 and does not count in ``identity_error``;
    ``explained`` is 0 where there is no variance at all.  ``deviation`` is exact; it is null where it does not fit a
    long.  No usable row: an empty result.  Other columns are not looked at.
    """
    own = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    clean = own.where(usable(F.col("v"))).select("vec_id", scaled(F.col("v")).alias("x"))
    rows = written(clean, "scaled")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    kinds = f"{id_col} {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], kinds)
    d = lengths.d
    rows = rows.where(F.size("x") == d)
    n, exact, values, axes = fit(rows, d)
    k = min(components, d)
    trace = float(values.sum())
    mean = np.array([float(s / n) for s in exact])
    alive = values[:k] > ZERO * trace
    maps = np.where(alive, axes[:, :k] / np.sqrt(np.where(alive, values[:k], 1.0)), 0.0)
    error = np.abs(_moments(rows, d, mean, maps, n) - np.diag(alive.astype(float)))
    explained = values[:k] / trace if trace > 0 else np.zeros(k)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = (_matrix(batch.column("x"), d) - mean) @ maps
            white = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * k, pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("deviation"), white], ["vec_id", "deviation", "white"])

    s = F.array(*[F.lit(int(v)) for v in exact])
    squares = F.zip_with("x", s, lambda x, t: (F.lit(n).cast("decimal(19,0)") * x.cast("decimal(19,0)") - t.cast("decimal(20,0)")).cast("decimal(18,0)"))
    deviation = F.aggregate(squares, F.lit(0).cast("decimal(38,0)"), lambda acc, x: (acc + x * x).cast("decimal(38,0)"))
    out = rows.select("vec_id", "x", deviation.try_cast("long").alias("deviation"))
    out = out.mapInArrow(workers.lean(projected), f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, white array<double>")
    out = out.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return out.select(
        F.col("vec_id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(float(v)) for v in explained]), F.col("at") + 1).alias("explained"), F.lit(float(error.max())).alias("identity_error"),
    )
