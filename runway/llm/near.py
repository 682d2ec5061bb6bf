"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text's shingle set gets a fingerprint, ``BANDS`` band hashes of
   ``ROWS`` minima each, and a signature of one byte a minimum. Texts with one
   set form a class; from here on a class is one row.
2. Classes that share a band hash are candidates. First every class of a bucket
   meets the bucket's smallest class only, which links most copies without
   emitting a bucket's pairs. Buckets that still hold several components then
   tell which components to compare (a spanning forest of the candidates), and
   the classes of a cluster of components meet, in blocks of bounded size.
3. A candidate's signatures are compared a batch at a time. As soon as the
   posterior probability that its similarity reaches the threshold falls below
   the chosen miss probability, it is pruned.
4. Survivors are verified on the full shingle sets of their texts. Pairs of a
   cluster are compared where the block is held; only links leave it.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.bpe import slices
from runway.llm.common import few_tasks, giving_back, small_batches, stage
from runway.llm.components import components
from runway.llm.shingles import mix, shingle_sets

ROWS, BANDS = 5, 35
HASHES = ROWS * BANDS
BATCH = 25  # hashes compared at a time
MISS = 1e-7  # posterior probability below which a candidate is pruned
BLOCK = 2048  # classes of a bucket that meet in one block
CLUSTER_BLOCK = 1024  # classes of a cluster that meet, with their sets, in one block

_rng = np.random.default_rng(5)
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 64, HASHES, dtype=np.uint64)


def minima(x: np.ndarray) -> np.ndarray:
    """The MinHash values of a set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(x), 256):
        best = np.minimum(best, (x[lo:lo + 256] * _A[:, None] + _B[:, None]).min(axis=1))
    return best


@functools.lru_cache(maxsize=8)
def needed(percent: int, miss: float = MISS) -> tuple[int, ...]:
    """Least matches after each batch that keep a candidate.

    With a uniform prior, m matches of n give the agreement p the posterior
    Beta(m + 1, n - m + 1); a byte also agrees by chance, p = s + (1 - s) / 256.
    """
    p = (np.arange(20000) + 0.5) / 20000
    s = percent / 100
    above = p >= s + (1 - s) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            w = np.exp(log - log.max())
            if w[above].sum() / w.sum() >= miss:
                break
        out.append(m)
    return tuple(out)


def survive(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which of the signature pairs are not pruned."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int64)
    for k, least in enumerate(needed(percent)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, HASHES)


def profiles(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint (two longs), signature, band hashes and the text's hash."""
    def run(batches):
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in slices(batch.column(1).to_pylist()):
                n, f1, f2, sig, bands = [], [], [], [], []
                for x in shingle_sets(texts, k):
                    n.append(len(x))
                    print_ = np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), dtype=np.int64)
                    f1.append(int(print_[0]))
                    f2.append(int(print_[1]))
                    if not len(x):
                        sig.append(None)
                        bands.append([])
                        continue
                    m = minima(x)
                    sig.append((mix(m) >> np.uint64(56)).astype(np.uint8).tobytes())
                    h = np.arange(BANDS, dtype=np.uint64)
                    for column in m.reshape(BANDS, ROWS).T:
                        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + column)
                    bands.append(h.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                     pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64())), batch.column(2).slice(at, len(texts))],
                    names=["doc_id", "n_shingles", "f1", "f2", "sig", "bands", "of_text"])
                at += len(texts)

    text = F.col("text").cast("string")
    return small_batches(docs).select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("of_text")).mapInArrow(
        giving_back(run), "doc_id long, n_shingles long, f1 long, f2 long, sig binary, bands array<long>, of_text long")


def _close(percent: int):
    """Sizes that a pair over the threshold can have."""
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def _pruned(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures survive the sequential test."""
    def run(batches):
        for b in batches:
            keep = survive(_signatures(b.column(2)), _signatures(b.column(3)), percent)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep))], names=["a", "b"])

    own = reps.select("rep", "sig")
    both = pairs.select("a", "b").join(own.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").join(
        own.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    def run(batches):
        last: tuple[int, np.ndarray] | None = None
        for batch in batches:
            a, b, keep = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            left, right = batch.column(2), batch.column(3)
            for i, x in enumerate(a):
                if last is None or last[0] != x:  # rows of one hub follow each other
                    last = x, shingle_sets([left[i].as_py()], k)[0]
                other = shingle_sets([right[i].as_py()], k)[0]
                common = len(np.intersect1d(last[1], other, assume_unique=True))
                if 100 * common >= percent * (len(last[1]) + len(other) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())],
                                             names=["a", "b"])

    both = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _blocks(rows: DataFrame, keys: list[str], members: str, block: int) -> DataFrame:
    """Deal each group over a grid of blocks: a row goes to one line and meets every other."""
    lines = F.ceil(F.col(members) / block).cast("int")
    rows = rows.withColumn("line", F.pmod(F.xxhash64("rep"), lines).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), lines - 1)))
    rows = rows.withColumn("i", F.least("line", "other")).withColumn("j", F.greatest("line", "other")).drop("other", members)
    return rows.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _whole_groups(batches, keys: list[str]):
    """Tables of whole groups from batches in which groups follow each other."""
    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if carry is None else pa.concat_tables([carry, t])
        key = np.stack([t[c].to_numpy() for c in keys])
        other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0  # the last group may go on in the next batch
        carry = t.slice(cut)
        if cut:
            yield t.slice(0, cut)
    if carry is not None:
        yield carry


class _Sets:
    """Union-find over whatever is united."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def unite(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


FOREST, MEMBER = 0, 1


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Which components a bucket suggests to compare, without its pairs: a row
    (FOREST, a, b) for two components that no earlier row of the task connects,
    and a row (MEMBER, class, component) for each class with a surviving pair."""
    keys = ["bucket", "i", "j"]

    def compare(t: pa.Table, joined: _Sets, known: set):
        block = np.stack([t[c].to_numpy() for c in keys])
        new = np.ones(t.num_rows, dtype=bool)
        new[1:] = (block[:, 1:] != block[:, :-1]).any(axis=0)
        group = np.cumsum(new) - 1
        rest = np.bincount(group)[group] - 1 - (np.arange(t.num_rows) - np.flatnonzero(new)[group])
        line, rep, hub, n, comp = (t[c].to_numpy() for c in ("line", "rep", "hub", "n", "comp"))
        two = block[1] != block[2]
        sig = _signatures(t["sig"].combine_chunks())
        out = []
        at, d = np.flatnonzero(rest >= 1), 1
        while len(at):
            x, y = at, at + d
            ok = (comp[x] != comp[y]) & (rep[x] != hub[x]) & (rep[y] != hub[y]) & (~two[x] | (line[x] != line[y]))
            ok &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
            x, y = x[ok], y[ok]
            if len(x):
                keep = survive(sig[x], sig[y], percent)
                x, y = x[keep], y[keep]
                for k in np.unique(np.concatenate([x, y])).tolist():
                    if (r := int(rep[k])) not in known:
                        known.add(r)
                        out.append((MEMBER, r, int(comp[k])))
                for a, b in set(zip(comp[x].tolist(), comp[y].tolist())):
                    if joined.unite(a, b):
                        out.append((FOREST, a, b))
            d += 1
            at = at[rest[at] >= d]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64()))],
                                             names=["kind", "a", "b"])

    def run(batches):
        joined, known = _Sets(), set()
        for t in _whole_groups(batches, keys):
            yield from compare(t, joined, known)

    return _blocks(rows, ["bucket"], "members", BLOCK).mapInArrow(giving_back(run), "kind int, a long, b long")


def _linked(rows: DataFrame, percent: int, k: int) -> DataFrame:
    """Links between components, verified on the full sets inside each block of a
    cluster: a class meets the others whose signatures survive, unless a link
    already joins their components. A block returns fewer links than components."""
    keys = ["cluster", "i", "j"]

    def verify(t: pa.Table):
        two = t["i"][0].as_py() != t["j"][0].as_py()
        line, rep, n, comp = (t[c].to_numpy() for c in ("line", "rep", "n", "comp"))
        sig = _signatures(t["sig"].combine_chunks())
        sets = shingle_sets(t["text"].to_pylist(), k)
        lens = np.array([len(x) for x in sets])
        words, ids = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(lens) - lens
        joined, out = _Sets(), []
        root = comp.copy()
        for i in range(len(rep)):
            j = np.arange(i + 1, len(rep))
            ok = (root[j] != root[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))
            if two:
                ok &= line[j] != line[i]
            j = j[ok]
            if not len(j):
                continue
            j = j[survive(sig[np.full(len(j), i)], sig[j], percent)]
            if not len(j):
                continue
            mark = np.zeros(len(words), dtype=np.int64)
            mark[ids[starts[i]:starts[i] + lens[i]]] = 1
            common = np.array([mark[ids[starts[x]:starts[x] + lens[x]]].sum() for x in j.tolist()])
            for x in j[100 * common >= percent * (lens[i] + lens[j] - common)].tolist():
                if joined.unite(int(comp[i]), int(comp[x])):
                    out.append((int(rep[i]), int(rep[x])))
                    root = np.array([joined.find(c) for c in comp.tolist()])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    def run(batches):
        for t in _whole_groups(batches, keys):
            key = np.stack([t[c].to_numpy() for c in keys])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), t.num_rows]):
                if hi - lo > 1:
                    yield from verify(t.slice(lo, hi - lo))

    return _blocks(rows, ["cluster"], "members", CLUSTER_BLOCK).mapInArrow(giving_back(run), "a long, b long").distinct()


def groups(docs: DataFrame, percent: int = 80, k: int = 2) -> DataFrame:
    """Near-duplicate groups of every document.

    Two documents are linked when 100 * |intersection| >= ``percent`` *
    |union| of their sets of ``k``-word shingles (words are split at white
    space, A-Z is lower-cased). Returns doc_id, n_shingles, component_id (the
    smallest doc_id reachable, itself included), kept (doc_id = component_id).

    A null or empty text, or one without words, has an empty set and is linked
    with nothing. A null doc_id is returned with a null component, not kept.
    Rows that share a doc_id are one document: their groups are joined. Other
    columns are ignored.
    """
    made = stage(profiles(docs, k), "profiles")
    tasks = few_tasks(made)
    some = made.where("doc_id IS NOT NULL AND n_shingles > 0")
    # a class is named by a number of its own; one of its texts, by id and hash, stands for it
    classes = some.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "of_text")).alias("own"))
    classes = stage(classes.select("f1", "f2", F.col("own.doc_id").alias("least"), F.col("own.of_text").alias("least_text"),
                                   F.monotonically_increasing_id().alias("rep")), "classes", tasks)
    reps = some.join(classes, ["f1", "f2"]).where("doc_id = least AND of_text = least_text").dropDuplicates(["rep"])
    reps = stage(reps.select("rep", "least", "least_text", F.col("n_shingles").alias("n"), "sig", "bands"), "representatives", tasks)

    banded = reps.select("rep", "n", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count(F.lit(1)).alias("members")).where(
        "members > 1")
    mates = stage(banded.join(hubs, "bucket").select(
        "bucket", "members", "rep", "n", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")), "mates", tasks)
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("least"), F.xxhash64(text).alias("least_text"), text.alias("text")).join(
        reps.select("rep", "least", "least_text").join(mates.select("rep").distinct(), "rep"), ["least", "least_text"]).select(
        "rep", "text").dropDuplicates(["rep"])
    texts = stage(texts, "mate-texts", tasks)

    stars = mates.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"), F.col("hub_n").alias("na"),
                                             F.col("n").alias("nb")).where(_close(percent)).distinct()
    links = stage(_verified(stage(_pruned(stars, reps, percent), "star-pairs", tasks), texts, percent, k), "star-links", tasks)
    roots = stage(components(links, tasks), "roots", tasks)

    placed = mates.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "bucket", "members", "rep", "n", "hub", F.coalesce("root", "rep").alias("comp"))
    placed = stage(placed, "placed", tasks)
    split = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    open_ = placed.join(split, "bucket").join(reps.select("rep", "sig"), "rep")
    found = stage(_candidates(open_, percent), "candidates", tasks)
    clusters = components(found.where(F.col("kind") == FOREST).select("a", "b"), tasks)
    members = found.where(F.col("kind") == MEMBER).select(F.col("a").alias("rep"), F.col("b").alias("comp")).distinct().join(
        clusters.select(F.col("node").alias("comp"), F.col("root").alias("cluster")), "comp")
    members = stage(members, "members", tasks)
    sizes = stage(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")), "cluster-sizes", tasks)
    rows = members.join(sizes, "cluster").join(reps.select("rep", "n", "sig"), "rep").join(texts, "rep")
    more = stage(_linked(rows, percent, k), "cluster-links", tasks)
    # a document whose rows have several texts joins the groups of all of them
    same = some.join(classes, ["f1", "f2"]).select("doc_id", "rep").distinct()
    first = same.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    several = same.join(first, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))
    roots = stage(components(links.unionAll(more).unionAll(several), tasks), "components", tasks)
    # a component is named by its smallest document
    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep").groupBy("root").agg(F.min("least").alias("component"))
    of_class = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(named, "root", "left").select(
        "f1", "f2", F.coalesce("component", "least").alias("component"))

    own = made.join(of_class, ["f1", "f2"], "left")
    member = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(member, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    found = own.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
