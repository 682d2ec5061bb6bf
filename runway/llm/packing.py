"""Packing token sequences by linear grouping.

Documents become ids plus an end id; those over ``capacity`` are cut into
full pieces, the first piece being the short one. Only the histogram of piece
lengths (at most ``capacity`` rows, whatever the input) reaches the driver,
where the plan is made:

1. lengths above ``small`` are sorted and put into groups of equal cardinality,
   each rounded up to its longest member;
2. configurations of these few sizes are chosen one after another: the longest
   size left, with the subset that fills the rest best, as often as the counts
   allow;
3. actual lengths are substituted for the rounded ones, which leaves runs of
   sequences with equal room;
4. small lengths go to the run with the least sufficient room (best fit).

The plan is a list of runs ``(length, first rank, count, first sequence,
offset)``: the r-th piece of a length finds its sequence by rank. Ranks come
from per-task counters plus a running sum of per-task counts, so no length,
however frequent, is numbered in one task.
"""

from __future__ import annotations

import bisect
import functools
import json
import zlib
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runway.llm.bpe import PATTERN, SLICE_BYTES, bpe, byte_alphabet, default_tokenizer
from runway.llm.common import gathered, giving_back, stage

CAPACITY = 1024
END_ID = 2
GROUPS = 640  # cardinality groups of the large lengths
SMALL = 1 / 5  # lengths up to this share of the capacity are small

STRIDE = 500  # a text with such a stretch of characters without a space, or of white space alone, goes another way

Run = tuple[int, int, int, int, int]  # length, first rank, count, first sequence, offset


class Ids:
    """Ids of texts by merge ranks, read from a byte-level tokenizer file.

    The rank of a token is the place of its merge, which the rank encoder
    turns into the ids that the file's own library gives; single bytes come
    first. Its time grows with the square of a word, so a text with a very long
    run goes through the operator of ``llm/bpe.py``, and so does one that holds
    an added token. Both ways give the same ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_alphabet(), spec["model"]["vocab"]
        tokens = list(letters)
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            tokens.append(left + right)
        ranks: dict[bytes, int] = {}
        for rank, token in enumerate(tokens):
            ranks.setdefault(bytes(letters[c] for c in token), rank)
        self.path = path
        self.id_of = np.array([vocab[t] for t in tokens], dtype="<u4")
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = [t["content"] for t in spec.get("added_tokens", [])]

    def odd(self, text: str) -> bool:
        """True for every run of twice ``STRIDE``, which fills one of the stretches looked at."""
        return any(t in text for t in self.added) or any(
            text.find(" ", at, at + STRIDE) < 0 or text[at:at + STRIDE].isspace()
            for at in range(0, len(text) - STRIDE + 1, STRIDE))

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.odd(text):
            return bpe(self.path).encode_many([text])[0]
        return self.id_of[np.frombuffer(array("I", self.encode(text)), dtype=np.uint32)].tobytes()


@functools.lru_cache(maxsize=2)
def ids_by(path: str) -> Ids:
    """One encoder per worker process and file."""
    return Ids(path)


def cut_lengths(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be short."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def group_large(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Equal-cardinality groups, longest first: (rounded size, [(length, count)])."""
    total = sum(counts.values())
    each = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                if not out or out[-1][0] != length:  # an equal size goes on in its group
                    out.append((length, []))
                room = each
            take = min(left, room)
            out[-1][1].append((length, take))
            left, room = left - take, room - take
    return out


def _fill(room: int, sizes: list[int], left: list[int]) -> list[tuple[int, int]]:
    """(index, copies) of sizes whose sum is the largest that ``room`` holds."""
    reach, states = 1, []
    mask = (1 << room + 1) - 1
    for i, size in enumerate(sizes):
        if not left[i] or size > room:
            continue
        before = reach
        n = min(left[i], room // size)
        step = reach
        for _ in range(n):
            step = step << size & mask
            reach |= step
        states.append((i, before, n))
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for i, before, n in reversed(states):
        k = 0
        while not before >> at & 1:
            at -= sizes[i]
            k += 1
        if k:
            chosen.append((i, k))
    return chosen


def configurations(sizes: list[int], left: list[int], capacity: int) -> Iterable[tuple[list[int], int]]:
    """(slots as size indexes, times) until no size is left; ``sizes`` descend."""
    left = list(left)
    for first in range(len(sizes)):
        while left[first]:
            left[first] -= 1
            chosen = dict(_fill(capacity - sizes[first], sizes, left))
            left[first] += 1
            chosen[first] = chosen.get(first, 0) + 1
            times = min(left[i] // k for i, k in chosen.items())
            for i, k in chosen.items():
                left[i] -= k * times
            yield [i for i in sorted(chosen) for _ in range(chosen[i])], times


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs that place every piece of a length histogram."""
    runs: list[Run] = []
    next_seq = 0
    used: dict[int, int] = {}

    def place(length: int, count: int, seq: int, offset: int) -> None:
        rank = used.get(length, 0)
        runs.append((length, rank, count, seq, offset))
        used[length] = rank + count

    if full := histogram.get(capacity, 0):
        place(capacity, full, 0, 0)
        next_seq = full
    bound = int(capacity * SMALL)
    large = {n: c for n, c in histogram.items() if bound < n < capacity and c}
    small = {n: c for n, c in histogram.items() if 0 < n <= bound and c}
    grouped = group_large(large, groups)
    members = [list(m) for _, m in grouped]
    spare: dict[int, list[tuple[int, int]]] = {}  # room -> runs of (first sequence, count)
    for slots, times in configurations([s for s, _ in grouped], [sum(c for _, c in m) for _, m in grouped], capacity):
        # substitute actual lengths: each slot draws the next `times` members of its group
        draws = []
        for g in slots:
            draw, need = [], times
            while need:
                length, c = members[g][0]
                take = min(c, need)
                draw.append([length, take])
                need -= take
                if take == c:
                    members[g].pop(0)
                else:
                    members[g][0] = (length, c - take)
            draws.append(draw)
        done = 0
        while done < times:
            n = min(d[0][1] for d in draws)
            offset = 0
            for d in draws:
                place(d[0][0], n, next_seq + done, offset)
                offset += d[0][0]
                d[0][1] -= n
                if not d[0][1]:
                    d.pop(0)
            if offset < capacity:
                spare.setdefault(capacity - offset, []).append((next_seq + done, n))
            done += n
        next_seq += times
    rooms = sorted(spare)
    for length in sorted(small, reverse=True):
        left = small[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fresh = -(-left // (capacity // length))
                spare[capacity] = [(next_seq, fresh)]
                rooms.append(capacity)
                next_seq += fresh
                continue
            room = rooms[at]
            seq, n = spare[room].pop()
            take = min(n, left)
            place(length, take, seq, capacity - room)
            left -= take
            if take < n:
                spare[room].append((seq + take, n - take))
            if not spare[room]:
                del spare[room]
                rooms.pop(at)
            if rest := room - length:
                if rest not in spare:
                    spare[rest] = []
                    bisect.insort(rooms, rest)
                spare[rest].append((seq, take))
    return runs


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with the task that made it and its number among the
    task's pieces of that length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

    def run(batches):
        coder, end = ids_by(tokenizer), int(end_id).to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for texts in gathered(batches, 1, SLICE_BYTES):
            rows = []
            for doc_id, packed in zip(texts["doc_id"].to_pylist(), (coder.packed(t.as_py() or "") for t in texts["text"])):
                packed += end
                for k, (start, length) in enumerate(cut_lengths(len(packed) // 4, capacity)):
                    crc = zlib.crc32(packed[4 * start:4 * (start + length)])
                    rows.append((doc_id, k, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(giving_back(run), schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         groups: int = GROUPS) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A null text counts as empty and becomes the end id alone; repeated
    rows are packed as often as they occur; a null doc_id is kept; no input
    gives no rows. Other columns are ignored.
    """
    cut = stage(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id), "pieces")
    counts = stage(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most `capacity` rows, whatever the input
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(plan(histogram, capacity, groups))
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    first = {int(n): int(i) for n, i in zip(*np.unique(table[:, 0], return_index=True))} if len(runs) else {}
    ends = {n: int(np.searchsorted(table[:, 0], n, side="right")) for n in first}

    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(offsets.hint("merge"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def assign(batches):
        for df in batches:
            seq = np.zeros(len(df), dtype=np.int64)
            off = np.zeros(len(df), dtype=np.int64)
            lengths, ranks = df["length"].to_numpy(), df["rank"].to_numpy()
            for n in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == n)
                own = table[first[n]:ends[n]]
                at = np.searchsorted(own[:, 1], ranks[rows], side="right") - 1
                seq[rows] = own[at, 3] + ranks[rows] - own[at, 1]
                off[rows] = own[at, 4]
            yield df.drop(columns="rank").assign(sequence_id=seq, offset=off)

    return ranked.mapInPandas(
        assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
