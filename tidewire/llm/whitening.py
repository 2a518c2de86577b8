"""Whitening of embeddings: matrix-free block Lanczos with full reorthogonalisation.

The covariance is never formed: each step of the iteration is one distributed pass that multiplies
the centred rows with a block of vectors and adds the products up per dimension. The driver keeps
bases of a bounded number of vectors, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import small_batches, written

COMPONENTS = 8
#: Vectors of a block, and vectors of the basis at which the iteration restarts from its best ones.
BLOCK, MOST_VECTORS = 16, 256
#: A component has converged when its residual is below this part of the largest eigenvalue.
RESIDUAL = 1e-13
MAX_PASSES = 1000
#: Eigenvalues below this part of the trace are rounding, not variance; such components are left out.
LEAST_SHARE = 1e-13
SCALE, SHIFT = 1024, 100_000


@dataclass(frozen=True)
class Spectrum:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int


def leading(multiply: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, block: int = BLOCK, most: int = MOST_VECTORS, seed: int = 0) -> Spectrum:
    """The ``wanted`` largest eigenpairs of the symmetric operator ``multiply`` (a pass for each block of columns).

    Every new block is orthogonalised twice (before and after scaling) against all vectors so far. Directions that vanish by it
    (breakdown: the block found an invariant subspace) are replaced by new random ones, so that no
    eigenvector is missed for being orthogonal to the start. When ``most`` vectors are kept, the
    iteration goes on from the best Ritz vectors and the newest block. It ends when the residuals of
    all wanted pairs are small, or when the basis spans the whole space.
    """
    random, wanted = np.random.default_rng(seed), min(wanted, size)
    # a block of fewer columns than pairs wanted would see only so many of an eigenvalue's copies
    block = min(max(block, wanted), size)
    most = max(most, 4 * block + 2 * wanted)
    basis, images = np.empty((size, 0)), np.empty((size, 0))
    new, passes = _orthonormal(random.standard_normal((size, block)), basis, random), 0
    while True:
        image = multiply(new)
        passes += 1
        basis, images = np.hstack([basis, new]), np.hstack([images, image])
        small = basis.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        best = turns[:, :wanted]
        vectors = basis @ best
        residuals = np.linalg.norm(images @ best - vectors * values[:wanted], axis=0)
        done = len(values) >= wanted and bool(np.all(residuals <= RESIDUAL * max(abs(values[0]), abs(values[-1]))))
        if done or basis.shape[1] == size or passes >= MAX_PASSES:
            return Spectrum(values[:wanted], np.linalg.qr(vectors)[0] if vectors.size else vectors, residuals, passes)
        new = _orthonormal(image, basis, random)[:, : size - basis.shape[1]]
        if basis.shape[1] + new.shape[1] > most:
            turns = turns[:, : wanted + block]
            basis, images = basis @ turns, images @ turns


def _orthonormal(block: np.ndarray, basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Orthonormal columns, orthogonal to ``basis``, that span ``block``; random ones take the place of those that vanish."""
    out, scale = np.empty((len(block), 0)), np.linalg.norm(block, axis=0).max(initial=0)

    def against(column: np.ndarray) -> np.ndarray:
        column = column - basis @ (basis.T @ column)
        return column - out @ (out.T @ column)

    for column in block.T:
        if basis.shape[1] + out.shape[1] == len(block):
            break
        floor = 1e-13 * scale
        while True:
            column = against(column)
            if (length := np.linalg.norm(column)) > floor:
                break
            column, floor = random.standard_normal(len(block)), 1e-6
        column = against(column / length)
        out = np.hstack([out, (column / np.linalg.norm(column))[:, None]])
    return out


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold only finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def rows_of(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


class Fit:
    """Passes over the fit list: ``vectors`` has a column ``x`` of long arrays, all of ``size`` entries."""

    def __init__(self, vectors: DataFrame, size: int) -> None:
        self.vectors, self.size = vectors, size
        # each half of a long adds up exactly: a batch has far fewer than 2^31 rows
        halves = self._summed(lambda x: np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), np.full(size, len(x))], 1), "long", 3)
        self.n = int(halves[0][2]) if len(halves) else 0
        self.sums = [(int(a) << 32) + int(b) for a, b, _ in halves]
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.empty(0)

    def _summed(self, part: Callable[[np.ndarray], np.ndarray], kind: str, width: int) -> list:
        """``part`` of each batch, a row of ``width`` numbers per dimension, added up over all batches."""
        size, names = self.size, [f"v{k}" for k in range(width)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if len(batch):
                    own = part(rows_of(batch.column(0), size))
                    total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *[pa.array(np.ascontiguousarray(total[:, k])) for k in range(width)]], ["i", *names])

        # a task's partial sums cannot pass a long: below 2^31 rows of 32 bits; across tasks they are decimals
        parts = self.vectors.select("x").mapInArrow(run, "i int, " + ", ".join(f"{v} {kind}" for v in names))
        summed = parts.groupBy("i").agg(*[F.sum(F.col(v).cast("decimal(38,0)") if kind == "long" else v).alias(v) for v in names])
        return [r[1:] for r in sorted(summed.collect())]

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        return centring(self.sums, self.n)

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``, in one pass."""
        centre, n = self.centred(), self.n

        def part(x: np.ndarray) -> np.ndarray:
            z = centre(x)
            return z.T @ (z @ block)

        return np.array(self._summed(part, "double", block.shape[1])) / n

    def trace(self) -> float:
        """From the rows' squared deviations from the mean."""
        centre = self.centred()
        return float(sum(v for (v,) in self._summed(lambda x: (centre(x) ** 2).sum(0)[:, None], "double", 1))) / self.n

    def moments(self, project: np.ndarray) -> np.ndarray:
        """The covariance of the rows' projections, centred before multiplying."""
        centre, k = self.centred(), project.shape[1]

        def of(shift: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
            def part(x: np.ndarray) -> np.ndarray:
                w = centre(x) @ project - shift
                return np.hstack([w.T @ w, w.sum(0)[:, None]])

            return part

        mean = np.array([r[k] for r in self._summed(of(np.zeros(k)), "double", k + 1)]) / self.n
        return np.array(self._summed(of(mean), "double", k + 1))[:, :k] / self.n


def centring(sums: list[int], n: int) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n from whole numbers, rounded once where n * x fits a long."""
    mean = np.array([s / n for s in sums])
    within = [(1 << 62) // n, np.array([s if abs(s) < 1 << 62 else 0 for s in sums], np.int64), all(abs(s) < 1 << 62 for s in sums)]

    def centre(x: np.ndarray) -> np.ndarray:
        if within[2] and np.abs(x).max(initial=0) <= within[0]:
            return (x * n - within[1]) / n
        return x - mean

    return centre


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None where it passes a long."""
    rough = np.abs(x - np.array([s / n for s in sums])) * n
    # what fits a long is exact in arithmetic modulo 2^64, whatever passes it in between
    fits = (rough**2).sum(1) < 2.0**62
    wrapped = np.array([s & 0xFFFFFFFFFFFFFFFF for s in sums], np.uint64).astype(np.int64)
    with np.errstate(over="ignore"):
        d = x * np.int64(n) - wrapped
        total = (d * d).sum(1).tolist()
    for i in np.flatnonzero(~fits):
        exact = sum((n * v - s) ** 2 for v, s in zip(x[i].tolist(), sums, strict=True))
        total[i] = exact if exact < 1 << 63 else None
    return total


def whiten(vectors: DataFrame, key: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries are dropped. All must have one length:
    that of most of the usable vectors (of ties the larger); others are dropped too. Entries become
    longs floor(1024 c) + 100000 (1024 c held within 2^62). Components without variance (fewer
    dimensions or different rows than components) are left out, so a table of equal rows or an empty
    one gives no rows. A deviation that passes a long is null. Repeated rows, ties and null keys
    count and come back as any other; other columns are ignored. Where eigenvalues are equal their
    components are any basis of the shared space.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    limit = F.lit(2.0**62)
    x = F.transform(F.col(f"`{vector}`"), lambda c: F.floor(F.greatest(F.least(F.lit(float(SCALE)) * c.cast("double"), limit), -limit)) + F.lit(SHIFT).cast("long"))
    clean = written(vectors.where(usable(F.col(f"`{vector}`"))).select(F.col(f"`{key}`").alias("key"), x.alias("x")), "vectors")
    sizes = clean.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).take(1)
    size = sizes[0]["size"] if sizes else 0
    one_length = clean.where(F.size("x") == size)
    schema = StructType([StructField("key", clean.schema["key"].dataType), StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
    kinds = dict(zip(names, ("int", "long", "long", "double", "double", "double"), strict=True))
    empty = spark.createDataFrame([], StructType([StructField(key, clean.schema["key"].dataType)])).select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in names])
    if not size:
        return empty
    fit = Fit(one_length, size)
    trace = fit.trace()
    found = leading(fit.product, size, components) if trace > 0 else None
    good = found.values > LEAST_SHARE * trace if found else np.zeros(0, bool)
    if not good.any():
        return empty
    values = found.values[good]
    project = found.vectors[:, good] / np.sqrt(values)
    error = float(np.abs(fit.moments(project) - np.eye(len(values))).max())
    n, sums, centre = fit.n, fit.sums, fit.centred()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = rows_of(batch.column(1), size)
            w = np.ascontiguousarray(centre(rows) @ project)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(rows, sums, n), pa.int64()), lists], schema.names)

    each = one_length.mapInArrow(run, schema).select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    return each.select(
        F.col("key").alias(key), (F.col("at") + 1).cast(IntegerType()).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
