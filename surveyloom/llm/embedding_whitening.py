"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers, ``floor(256 * c)``, and every distinct vector counts once in the fit.

1. **Spectra of partitions.** Each partition of distinct vectors keeps a mean and the spectrum of
   its scatter matrix, and takes more vectors in by centred rank-one updates: in the basis of the
   present eigenvectors the update of a diagonal matrix by ``z z'`` is an eigenproblem whose values
   are the roots of a secular equation, one between each pair of neighbours. Components of ``z`` that
   are nought, and equal eigenvalues, are deflated first. A block of vectors is centred about its
   own mean and reduced by a QR factorisation to at most as many rows as there are dimensions, with
   the same scatter; these rows are the updates, and one more carries the step between means. So a
   vector costs a share of a factorisation, and the number of updates depends on blocks alone.
2. **Combination.** Spectra are put together in groups, level by level: each eigenvector of one,
   times the root of its eigenvalue, is a rank-one update of the other, and the step between the two
   means is one more. Only spectra travel, dimension squared numbers each; no task or driver holds
   more than ``FAN_IN`` of them.
3. **Refinement.** With the combined eigenvectors as a basis, each partition projects its centred
   vectors and adds up their products; the sum is the covariance in that basis, all but diagonal,
   and its eigenvectors turn the basis into the final components (Rayleigh-Ritz on the full space).
   A further pass does the same for whitened vectors and thus measures what they fall short of.

Sums of entries are exact. All results of a fit depend on the distinct vectors; the fit list is
written once, so that each pass and each repeated task reads the same rows.

**Odd rows.** Null vectors and those with a null, NaN or infinite entry are dropped, as are vectors
of another length than the commonest (of several, the longest); without entries none is left.
Entries beyond a long saturate, as ``floor`` does. Repeated rows and ids, null ids included, each give
their results. A component without variance (eigenvalue below ``NO_VARIANCE`` of the trace) whitens
to 0, and ``identity_error`` then says 1. Fewer dimensions than components give fewer components.
``deviation`` is null where the exact number is beyond a long. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.sources.workspace import written

SCALE = 256
COMPONENTS = 4
#: Numbers in the block of vectors that is reduced before it becomes rank-one updates (8 MB).
BLOCK_NUMBERS = 1 << 20
#: Spectra that one task puts together.
FAN_IN = 16
NO_VARIANCE = 1e-13

SPECTRUM = "n long, mean array<double>, vals array<double>, vecs array<double>"
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z_i^2 / (d_i - x))`` as (pole, distance): ``x_k = d[pole_k] + distance_k``.

    ``d`` rises strictly and no ``z`` is nought. Root k lies between ``d_k`` and ``d_{k+1}``, the last
    one within ``z'z`` above the last pole. Distances are from the nearer pole, so that differences
    to poles keep their digits. A step fits one pole on each side; where it leaves the bracket the
    bracket is halved.
    """
    n, zz = len(d), z * z
    total = zz.sum()
    right = np.append(d[1:], d[-1] + total)
    gap = right - d
    own = np.arange(n)
    left_side = own[None, :] <= own[:, None]  # [k, i]: pole i is at most root k's left pole
    half = gap / 2
    at_half = 1 + (zz / ((d[None, :] - d[:, None]) - half[:, None])).sum(1)
    nearer_left = (at_half >= 0) | (own == n - 1)
    pole = np.where(nearer_left, own, np.minimum(own + 1, n - 1))
    shift = d[None, :] - d[pole][:, None]  # poles seen from each root's origin
    low = np.where(nearer_left, 0.0, -half)
    high = np.where(nearer_left, np.where(own == n - 1, gap, half), 0.0)
    lower, upper = d - d[pole], right - d[pole]
    x = (low + high) / 2
    for _ in range(80):
        delta = shift - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            term = zz / delta
            slope = term / delta
            psi = np.where(left_side, term, 0.0).sum(1)
            phi = np.where(left_side, 0.0, term).sum(1)
            f = 1 + psi + phi
            positive = f > 0
            high = np.where(positive, x, high)
            low = np.where(positive, low, x)
            dpsi = np.where(left_side, slope, 0.0).sum(1)
            dphi = np.where(left_side, 0.0, slope).sum(1)
            a1, a2 = lower - x, upper - x
            c = f - a1 * dpsi - a2 * dphi
            a = (a1 + a2) * f - a1 * a2 * (dpsi + dphi)
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
        new = np.where(np.isfinite(new) & (new > low) & (new < high), new, (low + high) / 2)
        done = np.abs(f) <= 8 * n * np.finfo(float).eps * (1 + np.abs(psi) + np.abs(phi))
        still = ~done & (np.abs(new - x) > 2 * np.finfo(float).eps * np.abs(x))
        x = np.where(done, x, new)
        if not still.any():
            break
    return pole, x


def rank_one_update(
    values: np.ndarray, vectors: np.ndarray, row: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``Q diag(values) Q' + row row'``; values rise, vectors are columns."""
    z = vectors.T @ row
    size = float(z @ z)
    if not size > 0:
        return values, vectors
    tolerance = 8 * np.finfo(float).eps * max(float(np.abs(values).max(initial=0.0)), size)
    d, z, q = values.copy(), z.copy(), vectors.copy()
    # Equal eigenvalues: turn their plane so that one of them is not touched.
    last = -1
    for i in range(len(d)):
        if abs(z[i]) * np.sqrt(size) <= tolerance:
            z[i] = 0.0
            continue
        if last >= 0 and d[i] - d[last] <= tolerance:
            r = np.hypot(z[last], z[i])
            cosine, sine = z[i] / r, z[last] / r
            z[i], z[last] = r, 0.0
            old = q[:, last].copy()
            q[:, last] = cosine * old - sine * q[:, i]
            q[:, i] = sine * old + cosine * q[:, i]
        last = i
    active = np.flatnonzero(z)
    if len(active) == 0:
        return values, vectors
    da, za = d[active], z[active]
    pole, x = secular_roots(da, za)
    # [i, k]: root k minus pole i
    distance = (da[pole] - da[:, None]) + x[None, :]
    m = len(da)
    # The vector of which these roots are exact gives orthogonal eigenvectors.
    if m > 1:
        others = da[None, :] - da[:, None]
        below = np.arange(m)[None, :] < np.arange(m)[:, None]
        paired = np.where(below, others, np.roll(others, -1, axis=1))
        ratio = np.ones((m, m))
        ratio[:, :-1] = distance[:, :-1] / paired[:, :-1]
        exact = np.abs(distance[:, -1] * ratio.prod(1))
    else:
        exact = np.abs(distance[:, 0])
    zhat = np.copysign(np.sqrt(exact), za)
    with np.errstate(divide="ignore", invalid="ignore"):
        w = zhat[:, None] / (-distance)
    w = np.where(np.isfinite(w), w, 0.0)
    norm = np.linalg.norm(w, axis=0)
    w = w / np.where(norm > 0, norm, 1.0)
    d[active] = da[pole] + x
    q[:, active] = q[:, active] @ w
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigendecomposition of the scatter matrix of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        """Take in ``n`` vectors whose scatter about their ``mean`` is ``rows' rows``."""
        for row in rows:
            self.values, self.vectors = rank_one_update(self.values, self.vectors, row)
        step = mean - self.mean
        if self.n and n:
            weight = np.sqrt(self.n * n / (self.n + n))
            self.values, self.vectors = rank_one_update(self.values, self.vectors, weight * step)
        self.mean = self.mean + step * (n / (self.n + n))
        self.n += n

    def add_vectors(self, block: np.ndarray) -> None:
        mean = block.mean(0)
        centred = block - mean
        rows = np.linalg.qr(centred, mode="r") if len(block) > block.shape[1] else centred
        self.add(len(block), mean, rows)

    def merge(self, other: Spectrum) -> None:
        """The other spectrum by successive rank-one updates, one for each eigenvector."""
        rows = (np.sqrt(np.maximum(other.values, 0)) * other.vectors).T
        self.add(other.n, other.mean, rows)

    def batch(self) -> pa.RecordBatch:
        columns = {
            "n": pa.array([self.n], pa.int64()), "mean": pa.array([self.mean.tolist()]),
            "vals": pa.array([self.values.tolist()]),
            "vecs": pa.array([self.vectors.ravel().tolist()]),
        }
        return pa.RecordBatch.from_pydict(columns)

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int) -> Spectrum:
        mean, values, vectors = (
            np.array(batch.column(name)[row].as_py(), dtype=float)
            for name in ("mean", "vals", "vecs")
        )
        return cls(batch.column("n")[row].as_py(), mean, values, vectors.reshape(len(mean), -1))


def whole_vectors(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id, x``: usable vectors as whole numbers, all of one length; and that length."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    given = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("v"),
    ).where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)
    lengths = given.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    commonest = lengths.agg(F.max(F.struct("rows", "size")).alias("top")).first()["top"]
    size = commonest["size"] if commonest else 0
    whole = given.where(F.size("v") == size).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x")
    )
    return whole, size


def matrix_of(batch: pa.RecordBatch, size: int) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, size)


@dataclass
class Fit:
    """What whitening needs; its size depends on the dimension alone."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def kept(self) -> int:
        return min(COMPONENTS, len(self.sums))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``, with the digits that a difference of large numbers would lose."""
        return self.scaled(x).astype(float) / self.n

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: longs where they hold it, else whole numbers of Python."""
        largest = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
        if largest * 2 * self.n < 1 << 62:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        out = self.centred(x) @ self.vectors[:, : self.kept]
        values = self.values[: self.kept]
        live = values > NO_VARIANCE * self.trace
        return np.where(live, out / np.sqrt(np.where(live, values, 1.0)), 0.0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        scaled = self.scaled(x)
        largest = max(int(scaled.max(initial=0)), -int(scaled.min(initial=0)))
        if largest**2 * x.shape[1] < 1 << 63:
            return (scaled.astype(np.int64) ** 2).sum(1).tolist()
        exact = (scaled.astype(object) ** 2).sum(1).tolist()
        return [int(v) if v < 1 << 63 else None for v in exact]


def block_rows(size: int) -> int:
    return max(BLOCK_NUMBERS // size, 1)


def exact_sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension, as whole numbers of Python.

    A long is cut into two halves whose sums stay in a long for two thousand million vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = matrix_of(batch, size)
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(np.arange(size, dtype=np.int32)),
            "n": pa.array(np.full(size, n, np.int64)), "high": pa.array(high), "low": pa.array(low),
        })

    parts = vectors.select("x").mapInArrow(run, "place int, n long, high long, low long")
    totals = parts.groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")
    ).orderBy("place").collect()
    sums = [(r["high"] << 32) + r["low"] for r in totals]
    return (totals[0]["n"] if totals else 0), sums


def partition_spectra(vectors: DataFrame, size: int) -> DataFrame:
    """One spectrum for each partition that has vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, waiting, rows, most = Spectrum.empty(size), [], 0, block_rows(size)
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                waiting.append(matrix_of(batch.slice(start, most), size).astype(float))
                rows += len(waiting[-1])
                if rows >= most:
                    spectrum.add_vectors(np.concatenate(waiting))
                    waiting, rows = [], 0
        if rows:
            spectrum.add_vectors(np.concatenate(waiting))
        if spectrum.n:
            yield spectrum.batch()

    return vectors.select("x").mapInArrow(run, SPECTRUM)


def combine(spectra: DataFrame, size: int) -> Spectrum:
    """All spectra in one, in groups of about ``FAN_IN``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Spectrum.empty(size)
        for batch in batches:
            for row in range(batch.num_rows):
                whole.merge(Spectrum.read(batch, row))
        if whole.n:
            yield whole.batch()

    now = written(spectra, "spectra")
    while (left := now.count()) > 1:
        now = written(
            now.repartition(-(-left // FAN_IN)).mapInArrow(run, SPECTRUM), "spectra"
        )
    row = now.first()
    if row is None:
        return Spectrum.empty(size)
    vectors = np.array(row["vecs"]).reshape(size, size)
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["vals"]), vectors)


def _summed(vectors: DataFrame, size: int, project) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the projected vectors and of their products, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = products = None
        most = block_rows(size)
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                y = project(matrix_of(batch.slice(start, most), size))
                first, second = y.sum(0), y.T @ y
                total = first if total is None else total + first
                products = second if products is None else products + second
        if total is not None:
            flat = np.concatenate([total, products.ravel()])
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array(np.arange(len(flat), dtype=np.int32)), "part": pa.array(flat)}
            )

    parts = vectors.select("x").mapInArrow(run, "place int, part double")
    rows = parts.groupBy("place").agg(F.sum("part").alias("part")).orderBy("place").collect()
    flat = np.array([r["part"] for r in rows])
    width = int((np.sqrt(1 + 4 * len(flat)) - 1) / 2 + 0.5)
    return flat[:width], flat[width:].reshape(width, width)


def _covariance(total: np.ndarray, products: np.ndarray, n: int) -> np.ndarray:
    """Of vectors that are centred already, but for rounding."""
    mean = total / n
    return products / n - np.outer(mean, mean)


def fit_whitening(vectors: DataFrame, size: int) -> Fit | None:
    """Mean and components of distinct vectors ``x`` of a length; None without any."""
    n, sums = exact_sums(vectors, size)
    if not n:
        return None
    rough = combine(partition_spectra(vectors, size), size)
    fit = Fit(n, sums, rough.vectors[:, ::-1], rough.values[::-1] / n, 1.0)
    basis, _ = np.linalg.qr(fit.vectors)
    projected = _covariance(*_summed(vectors, size, lambda x: fit.centred(x) @ basis), n)
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    values, turn = np.maximum(values[::-1], 0.0), turn[:, ::-1]
    final = Fit(n, sums, basis @ turn, values, float(values.sum()))
    white = _covariance(*_summed(vectors, size, final.whitened), n)
    final.identity_error = float(np.abs(white - np.eye(final.kept)).max())
    return final


def whiten(embeddings: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row."""
    spark = embeddings.sparkSession
    vectors, size = whole_vectors(embeddings)
    fit = fit_whitening(written(vectors.select("x").distinct(), "fit-list"), size) if size else None
    if fit is None:
        return spark.createDataFrame([], RESULT)
    kept = fit.kept
    explained = fit.values[:kept] / fit.trace if fit.trace > 0 else np.zeros(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = block_rows(size)
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                x, rows = matrix_of(part, size), part.num_rows
                each = np.repeat(np.arange(rows), kept)
                deviations = pa.array(fit.deviations(x), pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id").take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * kept, fit.n, dtype=np.int64)),
                    "deviation": deviations.take(pa.array(each)),
                    "whitened": pa.array(fit.whitened(x).ravel()),
                    "explained": pa.array(np.tile(explained, rows)),
                    "identity_error": pa.array(np.full(rows * kept, fit.identity_error)),
                })

    return vectors.mapInArrow(run, RESULT)
