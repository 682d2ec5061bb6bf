"""Whitening of embeddings on the largest components of their covariance.

1. Entries become integers. Their sums over all vectors are exact.
2. Tasks add up centred outer products (Gram matrices of their batches); a matrix
   row goes to one task, which adds the tasks' parts. The covariance, dimension x
   dimension whatever the number of vectors, reaches the driver.
3. The largest components come from contour integration (``feast``), whose inertia
   counts verify that none is missed.
4. Tasks project every centred vector and scale it. The covariance of the written
   result, centred once more, is compared with the identity.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.common import stage
from runway.llm.feast import largest

SCALE, SHIFT = 1024, 100_000  # an entry c becomes floor(SCALE * c) + SHIFT
COMPONENTS = 8
MAX_DIMENSION = 8192  # bounds the matrix on the driver: 0.5 GB
BOUND = float(1 << 43)  # entries beyond it do not stay exact in what follows
WIDEST = 10 ** 38  # deviations from here on are null
FLAT = 1e-12  # share of the largest eigenvalue below which a component has no variance
ROWS = 4096  # vectors multiplied at a time


def integers(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as integers, for every vector that takes part."""
    v = F.col(f"`{column}`")
    # a null vector, or a null among its entries, makes the condition null
    rows = embeddings.where((F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < BOUND)))
    x = F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + SHIFT)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums by dimension, as Python integers."""
    def run(batches):
        n, total = 0, np.zeros(d, dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            for lo in range(0, len(x), ROWS):  # 2^12 entries of 2^43
                total += x[lo:lo + ROWS].sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0))], names=["i", "n", "s"])

    found = rows.select("x").mapInArrow(run, "i int, n long, s decimal(38, 0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # a row a dimension
    found.sort(key=lambda r: r.i)
    return (found[0].n if found else 0), np.array([int(r.s) for r in found], dtype=object)


class Centre:
    """The mean of integer vectors as a whole and a fraction, so that differences lose nothing."""

    def __init__(self, n: int, total: np.ndarray):
        self.n = n
        self.whole = np.array([s // n for s in total], dtype=np.int64)
        self.rest = np.array([s % n for s in total], dtype=object)  # of the sum, below n
        self.part = np.array([float(r) / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact: n (x - mean) is n (x - whole) - rest."""
        far = x - self.whole
        size = int(np.abs(far).max(initial=0)) + 1
        if (self.n * size) ** 2 * x.shape[1] < 1 << 62:  # machine integers hold it
            y = self.n * far - self.rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * far.astype(object) - self.rest
        return (y * y).sum(axis=1).tolist()


def covariance(rows: DataFrame, centre: Centre) -> np.ndarray:
    """Covariance of the integer vectors (divisor n), centred before multiplying."""
    d = len(centre.whole)

    def parts(batches):
        gram = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            for lo in range(0, len(x), ROWS):
                c = centre.centred(x[lo:lo + ROWS])
                gram += c.T @ c
        for i in range(d):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([gram[i]], pa.list_(pa.float64()))], names=["i", "g"])

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, g in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), d)):
                total[i] = total[i] + g if i in total else g.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["i", "g"])

    schema = "i int, g array<double>"
    whole = rows.select("x").mapInArrow(parts, schema).repartition("i").mapInArrow(added, schema)
    out = np.zeros((d, d))
    for r in whole.toLocalIterator():  # d rows of d numbers
        out[r.i] = r.g
    return (out + out.T) / (2 * centre.n)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """Every vector on the ``components`` largest components of the covariance.

    Returns per vector and component: vec_id, component (from 1, by falling
    eigenvalue), n (vectors), deviation (decimal: squared distance from the mean,
    times n^2, exact; null from 10^38 on), whitened, explained (share of the trace) and identity_error
    (largest absolute entry of the whitened covariance minus the identity).

    Vectors that are null or empty or hold null, NaN or infinite entries, or
    entries of 2^33 or more, take no part. The dimension is that of most vectors
    (the larger on a tie); others take no part. Fewer dimensions give fewer
    components, and so do directions without variance: equal vectors, or a single
    one, give no rows, as does an empty table. A null vec_id is kept; repeated
    rows count as often as they occur. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38, 0), whitened double, explained double, identity_error double"
    rows = integers(embeddings, column)
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    d = sizes.d
    if d > MAX_DIMENSION:
        raise ValueError(f"{d} dimensions; MAX_DIMENSION is {MAX_DIMENSION}")
    rows = rows.where(F.size("x") == d)
    n, total = sums(rows, d)
    centre = Centre(n, total)
    matrix = covariance(rows, centre)
    values, vectors = largest(matrix, min(components, d))
    kept = int((values > FLAT * max(values[0], 0.0)).sum())
    if not kept:
        return spark.createDataFrame([], schema)
    values, vectors = values[:kept], vectors[:, :kept]
    explained = (values / np.trace(matrix)).tolist()

    def project(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            at = 0
            while at < len(x):
                part = x[at:at + ROWS]
                white = (centre.centred(part) @ vectors) / np.sqrt(values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array([Decimal(v) if v < WIDEST else None for v in centre.deviation(part)], pa.decimal128(38, 0)),
                     pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), kept).cast(pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])
                at += len(part)

    made = stage(rows.select("vec_id", "x").mapInArrow(project, "vec_id long, deviation decimal(38, 0), w array<double>"), "whitened")
    pairs = [(i, j) for i in range(kept) for j in range(i, kept)]
    # Spark merges co-moments about running means, which is centred
    moments = made.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(m - (i == j)) for m, (i, j) in zip(moments, pairs))
    shares = F.array(*[F.lit(e) for e in explained])
    out = made.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
