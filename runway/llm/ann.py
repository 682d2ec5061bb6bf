"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, where Euclidean order is cosine order. Each of
``TABLES`` tables hashes a vector by ``PROJECTIONS`` Gaussian projections, each
cut into cells of one width. A query visits the buckets around its own (-1, 0
or +1 in every projection) in the order of their estimated success: the
smallest sum of squared distances from the query's projections to the cells.
The number of probes is the smallest of ``PROBES`` that reaches the wanted
recall on a bounded sample; every vector is indexed.

A bucket and its queries meet in blocks of bounded size, so a bucket that
holds a third of all vectors is spread over many tasks. Equal vectors stand
together first: the ``k + 1`` smallest ids of a vector are all that any answer
can hold, so the rest of a hot vector's rows never reach a bucket. Each block
returns the best ``k`` of each of its queries by exact cosine on the original
vectors; these are merged by query.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runway.llm.common import stage

TABLES, PROJECTIONS, WIDTH = 4, 6, 2.0  # width in standard deviations of a projection
PROBES = (16, 32, 64, 96, 128, 192, 256, 384, 729)
SAMPLE_ROWS, SAMPLE_QUERIES, SAMPLE_RECALL = 20_000, 256, 0.96
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096
_STEPS = np.array(list(itertools.product((-1, 0, 1), repeat=PROJECTIONS)), dtype=np.int64)


@dataclass(frozen=True)
class Index:
    """Projections and cells: bucket = floor((x @ planes + shift) / width)."""
    planes: np.ndarray  # table, dimension, projection
    shift: np.ndarray  # table, projection
    width: float
    probes: int

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        place = (x @ self.planes[t] + self.shift[t]) / self.width
        low = np.floor(place)
        return low.astype(np.int64), place - low

    @staticmethod
    def key(cells: np.ndarray) -> np.ndarray:
        """One long for the cells of a bucket."""
        return ((cells & 0x3FF) << (10 * np.arange(PROJECTIONS))).sum(axis=-1)

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        return self.key(self.cells(x, t)[0])

    def probe(self, x: np.ndarray, t: int, probes: int | None = None) -> np.ndarray:
        """Buckets to visit for each row of ``x``, likeliest first."""
        low, rest = self.cells(x, t)
        to_cell = np.stack([rest, np.zeros_like(rest), 1 - rest], axis=-1) ** 2  # below, own, above
        cost = np.zeros((len(x), len(_STEPS)))
        for m in range(PROJECTIONS):
            cost += to_cell[:, m, _STEPS[:, m] + 1]
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes or self.probes]
        return self.key(low[:, None, :] + _STEPS[order])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _nearest(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """(query position, row position, cosine) of each query's best rows that are not its own."""
    unit_q, unit_r = _unit(queries), _unit(rows)
    for lo in range(0, len(unit_q), 512):
        s = unit_q[lo:lo + 512] @ unit_r.T
        s[q_ids[lo:lo + 512, None] == ids[None, :]] = -np.inf
        n = min(k, s.shape[1])
        edge = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
        # all that may tie with the k-th; the smaller ids among them are chosen exactly below
        q, r = np.nonzero((s >= edge[:, None] - 1e-9) & np.isfinite(s))
        exact = (queries[lo + q] * rows[r]).sum(axis=1) / (
            np.linalg.norm(queries[lo + q], axis=1) * np.linalg.norm(rows[r], axis=1))
        order = np.lexsort((ids[r], -exact, q))
        q, r, exact = q[order], r[order], exact[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        best = nth < k
        yield lo + q[best], r[best], exact[best]


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part: not null, not
    zero, without null or non-finite components, of the table's dimension
    (that of most of them; at a tie, of the smallest id among those)."""
    df = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("embedding").cast("array<double>").alias("embedding"))
    df = df.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(
        ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).where(
        F.exists("embedding", lambda x: x != 0))
    sizes = df.groupBy(F.size("embedding").alias("n")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("id"))
    most = sizes.orderBy(F.desc("rows"), "id", "n").first()
    return df.where(F.size("embedding") == F.lit(most["n"] if most else 0))


def fit(vectors: DataFrame, queries: DataFrame, k: int, seed: int = 11) -> Index | None:
    """Draw the planes; set width and probes on a bounded, hash-ordered sample."""
    def sample(df: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect()  # bounded
        return (np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float))

    ids, x = sample(vectors, SAMPLE_ROWS)
    if not len(ids):
        return None
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((TABLES, x.shape[1], PROJECTIONS))
    unit = _unit(x)
    spread = float(np.std(np.concatenate([(unit @ p).ravel() for p in planes]))) or 1.0
    width = WIDTH * spread
    index = Index(planes, rng.random((TABLES, PROJECTIONS)) * width, width, PROBES[-1])
    q_ids, q = sample(queries, SAMPLE_QUERIES)
    if not len(q_ids):
        return index
    truth = [set() for _ in q_ids]
    for a, b, _ in _nearest(q, q_ids, x, ids, k):
        for i, j in zip(a.tolist(), b.tolist()):
            truth[i].add(j)
    own = [index.buckets(unit, t) for t in range(TABLES)]
    visits = [index.probe(_unit(q), t) for t in range(TABLES)]
    for probes in PROBES:
        found = total = 0
        for i, rows in enumerate(truth):
            rows = np.array(sorted(rows), dtype=np.int64)
            hit = np.zeros(len(rows), dtype=bool)
            for t in range(TABLES):
                hit |= np.isin(own[t][rows], visits[t][i, :probes])
            found, total = found + int(hit.sum()), total + len(rows)
        if found >= SAMPLE_RECALL * total:
            break
    return Index(planes, index.shift, width, probes)


def _blocks(rows: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both sides block numbers: a bucket of many rows or queries becomes a
    grid of blocks, each row going to one line of it and each query to one column."""
    n_rows = rows.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n_rows"))
    n_probes = probes.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n_probes"))
    grid = n_rows.join(n_probes, ["t", "bucket"]).select(
        "t", "bucket", F.ceil(F.col("n_rows") / BLOCK_ROWS).cast("int").alias("lines"),
        F.ceil(F.col("n_probes") / BLOCK_QUERIES).cast("int").alias("columns"))
    line = F.pmod(F.xxhash64("vec_id", "t"), F.col("lines")).cast("int")
    column = F.pmod(F.xxhash64("query_id", "t"), F.col("columns")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = rows.join(grid, ["t", "bucket"]).select("t", "bucket", "vec_id", "embedding", line.alias("i"), every("columns").alias("j"))
    probes = probes.join(grid, ["t", "bucket"]).select("t", "bucket", "query_id", "query", column.alias("j"), every("lines").alias("i"))
    return rows, probes


def _search(rows: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each query in each block."""
    rows, probes = _blocks(rows, probes)
    keys = ["t", "bucket", "i", "j"]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, q_ids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            for q, r, s in _nearest(_matrix(right["query"]), q_ids, _matrix(left["embedding"]), ids, k):
                out.append(pd.DataFrame({"query_id": q_ids[q], "vec_id": ids[r], "score": s}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return rows.groupBy(keys).cogroup(probes.groupBy(keys)).applyInPandas(meet, "query_id long, vec_id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, query_mod: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest of every vector whose id is divisible by ``query_mod``.

    Returns query_id, rank (from 1), vec_id, score (cosine in double
    precision), ties to the smaller id. A query that finds fewer than ``k`` in
    its buckets is compared with all rows, in blocks. Invalid vectors (see
    ``valid``) take no part; rows that repeat an id and its vector count once;
    an id with several vectors is found by its best; no valid vectors give no
    rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    order = W.partitionBy("embedding").orderBy("vec_id")
    usable = stage(valid(vectors).distinct(), "vectors")
    index_rows = usable.withColumn("_n", F.dense_rank().over(order)).where(F.col("_n") <= k + 1).drop("_n")
    queries = usable.where(F.col("vec_id") % query_mod == 0).select("vec_id", "embedding")
    index = fit(usable, queries, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def to_buckets(batches):
        for df in batches:
            unit = _unit(_matrix(df["embedding"]))
            for t in range(TABLES):
                yield pd.DataFrame({"t": np.int32(t), "bucket": index.buckets(unit, t), "vec_id": df["vec_id"],
                                    "embedding": df["embedding"]})

    def to_probes(batches):
        for df in batches:
            for lo in range(0, len(df), 256):
                part = df.iloc[lo:lo + 256]
                unit = _unit(_matrix(part["embedding"]))
                for t in range(TABLES):
                    visits = index.probe(unit, t)
                    n = visits.shape[1]
                    yield pd.DataFrame({"t": np.int32(t), "bucket": visits.ravel(),
                                        "query_id": np.repeat(part["vec_id"].to_numpy(), n),
                                        "query": part["embedding"].repeat(n).to_numpy()})

    rows = index_rows.mapInPandas(to_buckets, "t int, bucket long, vec_id long, embedding array<double>")
    probes = queries.mapInPandas(to_probes, "t int, bucket long, query_id long, query array<double>")
    found = stage(_top(_search(rows, probes, k), k), "neighbours")
    short = queries.join(found.groupBy("query_id").count().where(F.col("count") >= k),
                         F.col("vec_id") == F.col("query_id"), "left_anti")
    if short.isEmpty():
        return found
    # too few in the visited buckets: these queries meet all rows, in blocks
    one = [F.lit(0).alias("t"), F.lit(0).cast("long").alias("bucket")]
    rest = _search(index_rows.select(*one, "vec_id", "embedding"),
                   short.select(*one, F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), k)
    return _top(found.select("query_id", "vec_id", "score").unionByName(rest), k)
