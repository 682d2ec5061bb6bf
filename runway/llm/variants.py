"""Spelling variants: words one edit apart, and the form each goes back to.

1. Words are counted by task and then by word.
2. Near words of the vocabulary are found by blocked Gram matrices. Two words one
   edit apart have lengths that differ by one at most, and agree outside one of
   ``PARTS`` parts: so a word meets the words of its own and of the adjacent
   length with which it shares all parts but one. A block's letter counts are
   multiplied by numpy; products give the squared distances of all its pairs,
   which are at most two for near words; pairs that pass are verified.
3. A block of many words is dealt over a grid of tiles.
4. A word's form is its most frequent near word, if that is ``RATIO`` times as
   frequent or more. Following forms doubles the reach each round.

All joins shuffle: every table grows with the vocabulary, whose file is a few bytes a
word, and Spark sizes what is made of it (six rows a word, maps over batches) by it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.common import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
MIN_LENGTH, MIN_COUNT = 5, 3
RATIO = 2  # a form is at least so many times as frequent
SLIP = 97  # one in so many distinct words of a document loses a letter
PARTS = 3  # near words agree outside one of so many parts
TILE = 2048  # words of one length that one tile of a block holds
GATHER = 512  # words of small blocks that one matrix product takes together
HELD = 200_000  # distinct words a task counts before it passes them on
PIECE = 1 << 22  # characters of a text looked at together

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[ord("a"):ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:] = 26 + np.arange(64)


def runs(text: str) -> Counter:
    """Maximal letter runs of a text, A-Z in lower case, with their counts."""
    found: Counter = Counter()
    if len(text) <= PIECE:
        found.update(RUN.findall(text))
    else:
        at = 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text) and (m := RUN.match(text, end)):  # the piece ends with a run
                end = m.end()
            found.update(RUN.findall(text, at, end))
            at = end
    out: Counter = Counter()
    for run, n in found.items():
        out[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return out


def slipped(doc_id, run: str) -> str:
    """The run, or what is left of it when this document drops one of its letters."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: words of at least ``MIN_LENGTH`` letters that occur ``MIN_COUNT`` times or more."""
    def count(batches):
        held: Counter = Counter()

        def rows():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for run, n in runs(text.as_py() or "").items():
                    word = slipped(doc_id, run)
                    if len(word) >= MIN_LENGTH:
                        held[word] += n
                if len(held) >= HELD:
                    yield from rows()
        if held:
            yield from rows()

    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def shares(word: str, base: int) -> list[str]:
    """What a word keeps when its 1st, 2nd ... part is the edited one, as a member of the
    block of words with ``base`` letters and those with one more."""
    cuts = [base * k // PARTS for k in range(PARTS + 1)]
    longer = len(word) - base
    return [word[:cuts[k]] + "\n" + word[cuts[k + 1] + longer:] for k in range(PARTS)]


def _keyed(words: DataFrame) -> DataFrame:
    """A row for each block that a word is in: as one of its length (long_ 0) or of the length above (1)."""
    def run(batches):
        for batch in batches:
            word, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(word), 20_000):
                keys, longer, of, count = [], [], [], []
                for w, c in zip(word[lo:lo + 20_000], n[lo:lo + 20_000]):
                    for more in (0, 1):
                        base = len(w) - more
                        for k, kept in enumerate(shares(w, base)):
                            keys.append(xxhash.xxh3_64_intdigest(f"{base}:{k}:{kept}"))
                            longer.append(more)
                            of.append(w)
                            count.append(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(longer, pa.int32()), pa.array(of, pa.string()),
                     pa.array(count, pa.int64())], names=["block", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "block long, longer int, word string, n long")


def counts(words: list[str]) -> np.ndarray:
    """Letter counts, a row for each word."""
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = _COLUMN[np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)]
    at = np.repeat(np.arange(len(words)), lens) * LETTERS + letters
    # single precision holds the products exactly up to 2^24
    kind = np.float32 if len(words) == 0 or lens.max() < 2048 else np.float64
    return np.bincount(at, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(kind)


def one_edit(u: str, v: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes v of u."""
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    at = next((i for i, (a, b) in enumerate(zip(u, v)) if a != b), len(u))
    return u[at + (len(u) == len(v)):] == v[at + 1:]


def near_pairs(block: np.ndarray, line: np.ndarray, longer: np.ndarray, words: list[str], i: np.ndarray, j: np.ndarray):
    """Indexes (a, b) of the near words among members of one block, each pair of the
    input found once: a has the block's length, b the same length or one more."""
    x = counts(words)
    size = (x * x).sum(axis=1)
    base, other = np.flatnonzero(longer == 0), np.arange(len(words))
    for lo in range(0, len(base), GATHER):
        a = base[lo:lo + GATHER]
        # blocks follow each other: only the rows of these blocks can meet
        first, last = np.searchsorted(block, [block[a[0]], block[a[-1]] + 1])
        for start in range(int(first), int(last), 4 * GATHER):
            b = other[start:min(int(last), start + 4 * GATHER)]
            gram = x[a] @ x[b].T
            at, to = np.nonzero(size[a][:, None] + size[b] - 2 * gram <= 2)
            at, to = a[at], b[to]
            # a tile off the diagonal compares one line with the other
            ok = (block[at] == block[to]) & ((i[at] == j[at]) | (line[at] != line[to])) & ((longer[to] == 1) | (at < to))
            for p, q in zip(at[ok].tolist(), to[ok].tolist()):
                u, v = words[p], words[q]
                if one_edit(u, v):
                    yield p, q


def _near(tiles: DataFrame) -> DataFrame:
    """word, other, n (of other) for every near pair, both ways."""
    def look(t: pa.Table):
        if t.num_rows < 2:
            return
        key = np.stack([t[c].to_numpy() for c in ("block", "i", "j")])
        fresh = np.ones(t.num_rows, dtype=np.int64)
        fresh[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        block = np.cumsum(fresh)
        words, n = t["word"].to_pylist(), t["n"].to_pylist()
        out = []
        for p, q in near_pairs(block, t["line"].to_numpy(), t["longer"].to_numpy(), words, key[1], key[2]):
            u, v = words[p], words[q]
            # blocks that the two share: only the first one tells
            same = [a == b for a, b in zip(shares(u, len(u)), shares(v, len(u)))]
            if xxhash.xxh3_64_intdigest(f"{len(u)}:{same.index(True)}:{shares(u, len(u))[same.index(True)]}") == int(key[0, p]) % (1 << 64):
                out.append((u, v, n[q]))
                out.append((v, u, n[p]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))],
                                             names=["word", "other", "n"])

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            key = np.stack([held[c].to_numpy() for c in ("block", "i", "j")])
            other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last tile may go on in the next batch
            if cut:
                yield from look(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield from look(held)

    dealt = tiles.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "longer")
    return dealt.select("block", "i", "j", "line", "longer", "word", "n").mapInArrow(run, "word string, other string, n long")


def near_words(words: DataFrame) -> DataFrame:
    """word, other, n (of other): all pairs one edit apart, both ways."""
    keyed = _keyed(words)
    sizes = keyed.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.count_if(F.col("longer") == 0).alias("own"))
    # a block without two words, or without one of its own length, has no pair
    some = sizes.where("members > 1 AND own > 0").select("block", F.ceil(F.col("members") / TILE).cast("int").alias("lines"))
    placed = keyed.join(some.hint("merge"), "block").withColumn("line", F.pmod(F.xxhash64("word"), F.col("lines")).cast("int"))
    tiles = placed.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("lines") - 1))).select(
        "block", F.least("line", "to").alias("i"), F.greatest("line", "to").alias("j"), "line", "longer", "word", "n")
    return _near(tiles)


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms reached from each word that has one.

    Frequencies at least double from form to form, so there are no circles, and
    the rounds are at most the logarithm of a chain's length.
    """
    jump = stage(forms.select("word", F.col("form").alias("root")), "jumps")
    while True:
        up = jump.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        there = jump.join(up.hint("merge"), "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        there = stage(there, "jumps")
        if there.where("_moved").isEmpty():
            return there.select("word", "root")
        jump = there.select("word", "root")


def group(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """The vocabulary with near-word counts, forms and roots.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case; a
    run whose checksum with its document's id is divisible by ``SLIP`` loses a
    letter. Returns word, form (the most frequent word one edit away, ties to the
    smallest, if at least ``ratio`` times as frequent; else null), root (the last
    form reached, the word itself without one), n, n_near and form_n.

    Null and empty texts have no words, a null doc_id counts as an empty one,
    repeated rows count as often as they occur; no words give no rows. Other
    columns are ignored.
    """
    words = stage(vocabulary(docs), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("best"))
    joined = words.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                     F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best")).alias("best"))
    joined = stage(joined.select("word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.n")).alias("form_n")), "forms")
    ends = roots(joined.where("form IS NOT NULL"))
    return joined.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
