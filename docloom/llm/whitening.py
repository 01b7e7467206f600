"""Whitening of embeddings along their principal components, by matrix-free block Lanczos with full reorthogonalisation.

The covariance is never formed: each step multiplies a block of directions by it in one distributed pass over the centred vectors, in which every task adds up its
own d x block products. The driver holds the basis only (d x d numbers at most). A block that loses rank is filled up with random directions orthogonal to all
before, and the steps end when the residuals of the wanted components no longer exceed TOLERANCE of the largest eigenvalue, or the basis spans the whole space.
The trace comes from the exact deviations, so that explained shares need no further eigenvalues.

Defined cases: rows whose vector is null or holds a null or non-finite entry are left out; vectors shorter than the longest are filled up with zeros; entries whose
256-fold is beyond a long stand at the end of its range; repeated vectors count once in the fit and are all returned; components without variance are not returned
(so one distinct vector gives no rows); components of equal eigenvalues are some orthonormal basis of their space, the same for all rows; a deviation beyond a
long stops the query, and is exact as a decimal in `whiten`; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stash

COMPONENTS, BLOCK, SCALE = 4, 8, 256
#: Residual of a component, relative to the largest eigenvalue. Beyond STALLED steps without a smaller one, rounding is all that is left of it.
TOLERANCE, STALLED, SEED = 1e-14, 3, 13
#: A component below this share of the largest is rounding, not variance.
NOTHING = 1e-12


def whole(vectors: DataFrame, embedding: str, vec_id: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floors of the scaled entries, of rows without null or non-finite ones."""
    e = F.col(embedding)
    fine = e.isNotNull() & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(F.coalesce(fine, F.lit(False))).select(F.col(vec_id).alias("vec_id"), F.transform(e, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"))


def matrix(col: pa.Array, d: int) -> np.ndarray:
    """Rows of d longs; shorter ones are filled up with zeros."""
    offs = col.offsets.to_numpy()
    flat, n = col.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]], np.diff(offs)
    if len(n) and (n == d).all():
        return flat.reshape(len(n), d)
    out = np.zeros((len(n), d), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], n)] = flat
    return out


def added_up(x: DataFrame, d: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of a matrix of that shape: each task adds up its own, and Spark adds up the tasks' by row and column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += part(matrix(batch.column(0), d))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(shape[0]), shape[1])), pa.array(np.tile(np.arange(shape[1]), shape[0])), pa.array(total.ravel())], names=["i", "j", "v"])

    out = np.zeros(shape)
    for r in x.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # d x block numbers
        out[r["i"], r["j"]] = r["v"]
    return out


def orthonormal(y: np.ndarray, basis: np.ndarray, scale: float) -> tuple[np.ndarray, int]:
    """An orthonormal basis of what y holds beside the basis, and the number of columns that hold nothing (to rounding)."""
    kept: list[np.ndarray] = []
    lost = 0
    for v in y.T:
        before = np.column_stack([basis, *kept])
        for _ in range(2):  # twice is enough
            v = v - before @ (before.T @ v)
        n = float(np.linalg.norm(v))
        if n <= scale:
            lost += 1
            continue
        v = v / n
        v = v - before @ (before.T @ v)
        kept.append(v / np.linalg.norm(v))
    return np.column_stack(kept) if kept else np.zeros((len(y), 0)), lost


def block_lanczos(multiply: Callable[[np.ndarray], np.ndarray], d: int, k: int, block: int = BLOCK, tolerance: float = TOLERANCE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues (falling) and unit eigenvectors (columns) of a symmetric d x d operator that is given by its products with blocks of columns only."""
    rng = np.random.default_rng(seed)
    k, basis, images = min(k, d), np.zeros((d, 0)), np.zeros((d, 0))
    new, _ = orthonormal(rng.standard_normal((d, min(block, d))), basis, 0.0)
    best, stalled, chain = np.inf, 0, 0  # chain: the basis' first column since the last breakdown
    while True:
        image = multiply(new)
        basis, images = np.column_stack([basis, new]), np.column_stack([images, image])
        e, ritz, residual = ritz_pairs(basis, images, k)
        size = max(abs(float(e[0])), np.finfo(float).tiny)
        best, stalled = (residual, 0) if residual < best / 2 else (best, stalled + 1)
        settled = len(e) == k and (residual <= tolerance * size or (stalled >= STALLED and residual <= 1e3 * tolerance * size))
        room = d - basis.shape[1]
        new, lost = orthonormal(image, basis, size * 1e-13)
        if chain:  # what was found before is complete, but what lies beside it must be known to be no larger
            top, _, far = ritz_pairs(basis[:, chain:], images[:, chain:], 1)
            settled = settled and far <= 1e-6 * size and top[0] <= e[-1] + 1e-10 * size
        else:
            settled = settled and not lost
        if settled or not room:
            return e, ritz / np.linalg.norm(ritz, axis=0)
        new, chain = new[:, :room], basis.shape[1] if lost else chain
        while lost and new.shape[1] < min(block, room):  # a breakdown: go on in directions that nothing has led to so far
            more, _ = orthonormal(rng.standard_normal((d, min(block, room) - new.shape[1])), np.column_stack([basis, new]), 1e-8)
            new = np.column_stack([new, more])


def ritz_pairs(basis: np.ndarray, images: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest Ritz values, their vectors, and the largest residual of them."""
    small = basis.T @ images
    e, s = np.linalg.eigh((small + small.T) / 2)
    e, s = e[::-1][:k], s[:, ::-1][:, :k]
    ritz = basis @ s
    return e, ritz, float(np.linalg.norm(images @ s - ritz * e, axis=0).max())


class Fit:
    """n, sums S, eigenvalues, components, shares and the error of the identity, of the distinct vectors."""

    def __init__(self, x: DataFrame, k: int, block: int, tolerance: float):
        listed = stash(x.select("x").distinct(), "fit")
        sizes = listed.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).first()
        self.n, self.d, self.most = sizes["n"], sizes["d"] or 0, sizes["most"] or 0
        self.sums, self.values, self.vectors, self.shares, self.error = [0] * self.d, np.zeros(0), np.zeros((self.d, 0)), np.zeros(0), 0.0
        if not self.n or not self.d:
            return
        per = listed.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
        for r in per.collect():  # one number for each dimension
            self.sums[r["i"]] = int(r["s"])
        d, n, mean = self.d, self.n, np.array([s / self.n for s in self.sums])
        deviations = self.deviations()
        self.trace = added_up(listed, d, (1, 1), lambda m: np.array([[float(sum(map(float, deviations(m))))]]))[0, 0] / n**3
        if self.trace <= 0:
            return

        def multiply(v: np.ndarray) -> np.ndarray:
            def part(m: np.ndarray) -> np.ndarray:
                c = m - mean
                return c.T @ (c @ v)

            return added_up(listed, d, v.shape, part) / n

        e, u = block_lanczos(multiply, d, k, block, tolerance)
        there = e > NOTHING * e[0]
        self.values, self.vectors = e[there], u[:, there]
        self.shares = self.values / self.trace
        map_ = self.vectors / np.sqrt(self.values)
        m = map_.shape[1]

        def products(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ map_
            return np.vstack([w.T @ w, w.sum(axis=0)])

        got = added_up(listed, d, (m + 1, m), products) / n
        self.error = float(np.abs(got[:m] - np.outer(got[m], got[m]) - np.eye(m)).max())

    def deviations(self) -> Callable[[np.ndarray], np.ndarray]:
        """Exact sums over the dimensions of (n * x - S)^2: in longs where no vector of the table can exceed them, else in Python's integers."""
        n, d, sums = self.n, self.d, self.sums
        kind = np.int64 if d * (2 * n * self.most) ** 2 < 2**63 else object
        s = np.array(sums, kind)

        def of(m: np.ndarray) -> np.ndarray:
            return ((n * m.astype(kind) - s) ** 2).sum(axis=1)

        return of


def whiten(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS, block: int = BLOCK, tolerance: float = TOLERANCE) -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation (decimal), whitened, explained, identity_error."""
    x = whole(vectors, embedding, vec_id)
    fit = Fit(x, components, block, tolerance)
    n, d, deviations, shares, error, m = fit.n, fit.d, fit.deviations(), fit.shares.tolist(), fit.error, len(fit.values)
    mean = np.array([s / n for s in fit.sums])
    map_ = fit.vectors / np.sqrt(fit.values)
    kind = x.schema["vec_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column(1), d)
            dev, white = deviations(own).tolist(), ((own - mean) @ map_).ravel()
            at = np.repeat(np.arange(len(own)), m)
            cols = [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(own))), pa.array(np.full(len(at), n)), pa.array([int(v) for v in dev], pa.decimal128(38, 0)).take(pa.array(at)), pa.array(white), pa.array(shares * len(own), pa.float64()), pa.array(np.full(len(at), error))]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, f"vec_id {kind.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("deviation", F.col("deviation").cast("long"))
