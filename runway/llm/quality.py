"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text come from one byte histogram and its word and line
lists. Trees are grown on the driver from a bounded, hash-ordered sample of
labelled rows (statistics only, never texts), then flattened into arrays
(feature, threshold, children, value) that every task walks for all rows of a
batch at once with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.common import crc_mod, small_batches

SAMPLE_ROWS = 20_000  # labelled rows that the trees are grown from
BINS, TREES, DEPTH, RATE, LEAF_ROWS, RIDGE = 48, 60, 4, 0.15, 10, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "newline", "comma_stop", "bang_query", "symbol",
    "other_punct", "high_byte", "letter_entropy", "distinct_words", "distinct_lines", "line_words", "top_word",
    "capital_words", "short_words", "long_words", "punct_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>~^=+_@\\/{}[]"]] = True
_OTHER = np.zeros(256, bool)
_OTHER[[ord(c) for c in "\"'();:-`"]] = True


def statistics(text: str | None) -> tuple[float, ...]:
    """The FEATURES of a whole text; zeros for an empty or null one."""
    if not text:
        return (0.0,) * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    hist = np.bincount(raw, minlength=256)
    n = len(raw)
    words = text.split()
    n_words = max(1, len(words))
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = text.split("\n")
    letters = hist[_UPPER].sum() + hist[_LOWER].sum() + hist[128:].sum()
    p = hist[hist > 0] / n
    lens = list(map(len, words))
    return (
        np.log1p(n), np.log1p(len(words)), (n - hist[32] - hist[10]) / n_words, hist[_UPPER].sum() / max(1, letters),
        hist[_DIGIT].sum() / n, hist[32] / n, hist[10] / n, (hist[44] + hist[46]) / n_words, (hist[33] + hist[63]) / n_words,
        hist[_SYMBOL].sum() / n, hist[_OTHER].sum() / n, hist[128:].sum() / n, float(-(p * np.log2(p)).sum()),
        len(seen) / n_words, len(set(lines)) / len(lines), len(words) / len(lines), max(seen.values(), default=0) / n_words,
        sum(map(str.isupper, words)) / n_words, sum(x <= 2 for x in lens) / n_words, sum(x >= 12 for x in lens) / n_words,
        sum(not w[-1].isalnum() for w in words) / n_words)


@dataclass(frozen=True)
class Forest:
    """Flattened trees: node k of tree t is row t, column k of each array."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray  # the right child is left + 1; a leaf points to itself
    value: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, t, l, v in zip(self.feature, self.threshold, self.left, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                child = l[at]
                at = np.where(child >= 0, child + (x[rows, f[at]] > t[at]), at)
            total += v[at]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees under logistic loss on binned statistics.

    Without rows, or with one class only, the forest is its smoothed base rate.
    """
    n, width = x.shape
    rate = (y.sum() + 1) / (n + 2)
    bias = float(np.log(rate / (1 - rate)))
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.zeros((TREES, nodes), dtype=np.int64)
    threshold, value = np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    left = np.full((TREES, nodes), -1, dtype=np.int64)
    if n == 0 or y.min() == y.max():
        return Forest(feature[:0], threshold[:0], left[:0], value[:0], bias)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(n, bias)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        free, level = 1, {0: np.arange(n)}
        for depth in range(DEPTH + 1):
            below: dict[int, np.ndarray] = {}
            for node, rows in level.items():
                g, h = grad[rows].sum(), hess[rows].sum()
                best = (1e-6, -1, -1)
                if depth < DEPTH and len(rows) >= 2 * LEAF_ROWS:
                    for j in range(width):
                        b = binned[rows, j]
                        gl = np.cumsum(np.bincount(b, grad[rows], BINS))[:-1]
                        hl = np.cumsum(np.bincount(b, hess[rows], BINS))[:-1]
                        nl = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
                        gain = gl ** 2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g ** 2 / (h + RIDGE)
                        gain[(nl < LEAF_ROWS) | (len(rows) - nl < LEAF_ROWS)] = -1
                        k = int(gain.argmax())
                        if gain[k] > best[0] and k < len(cuts[j]):
                            best = (float(gain[k]), j, k)
                if best[1] < 0:
                    value[t, node] = RATE * g / (h + RIDGE)
                    margin[rows] += value[t, node]
                    continue
                _, j, k = best
                feature[t, node], threshold[t, node], left[t, node] = j, cuts[j][k], free
                side = binned[rows, j] > k
                below[free], below[free + 1] = rows[~side], rows[side]
                free += 2
            level = below
    return Forest(feature, threshold, left, value, bias)


def _with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, (label) and the statistics of each text as one array."""
    rest = [c for c in docs.columns if c != "text"]
    schema = ", ".join([f"{c} long" for c in rest] + ["x array<double>"])

    def run(batches):
        for b in batches:
            x = [statistics(t) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in rest]
                                             + [pa.array(x, pa.list_(pa.float64()))], names=[*rest, "x"])

    return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Grow the forest from at most ``sample_rows`` labelled rows outside the
    held-out fold, the first by hash of the id. Null labels and ids are left out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").where(crc_mod(F.col("doc_id"), 3) != 1)
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _with_statistics(texts.join(F.broadcast(known), "doc_id")).select("label", "x").collect()  # bounded
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return grow(x, np.array([r["label"] for r in rows], dtype=float))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text.

    A null or empty text is scored from zero statistics. Repeated rows score
    alike; a null doc_id is kept and not held out; other columns are ignored.
    """
    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in b.column(1).to_pylist()], dtype=float).reshape(-1, len(FEATURES))
            p = forest.score(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(crc_mod(F.col("doc_id").cast("long"), 3) == 1, F.lit(False))
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held.alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
