"""Exact substring deduplication with suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts anywhere
else in the input as well. The work is cut up so that no task needs more than
a bounded part of the text:

1. The anchor of a window (a string of ``LENGTH`` bytes) is its rightmost
   ``GRAM``-byte string of least hash. Equal windows have equal anchors, and a
   text's windows fall into runs of one anchor, about 70 windows each.
2. Anchors meet by hash. Those that occur once have no repeated window. Runs
   whose bytes are equal are repeated as a whole. What is left are different
   runs around one anchor.
3. Their bytes are fetched and, group by group, cut into blocks of ``STEP``
   bytes in step with the anchor. A suffix array over the blocks (built by
   linear grouping, see ``suffixes``) brings together the suffixes whose first
   blocks are equal; only these can hold equal windows, which are confirmed
   byte for byte.
4. The covered ranges of a text are joined, and its bytes rewritten once.

An anchor with over ``GROUP`` different runs is not gathered in one task: its
windows are counted by hash across the cluster.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.bpe import SLICE_BYTES
from runway.llm.common import gathered, giving_back, small_batches, stage
from runway.llm.shingles import mix
from runway.llm.suffixes import suffix_array

LENGTH, GRAM, STEP = 200, 48, 32
GROUP = 32_768  # different runs of an anchor that one task may hold
BUCKET_BLOCKS = 100_000  # blocks of one suffix array
CARRY_ROWS = 500_000  # rows of one anchor held while judging it
CONTEXT_TEXT = 1 << 20  # bytes of text whose runs are cut out together; runs overlap, so they are some four times as long
PIECE = 1 << 22  # bytes of a long text looked at together

_M = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 24) - 1)


def anchor_runs(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, anchor, first window, last window) of a text's runs."""
    windows = len(raw) - length + 1
    out, at = [], 0
    while at < windows:  # a long text in pieces; a run may be cut, which is harmless
        part = raw[at:at + PIECE + length - 1]
        h = part.astype(np.uint64)
        width = 1
        while width < gram:
            s = min(width, gram - width)
            h = mix(h[:-s] * _M + h[s:] + np.uint64(width))
            width += s
        # least hash first, then the rightmost
        key = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        span, least = length - gram + 1, key
        have = 1
        while have * 2 <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if span > have:
            least = np.minimum(least[:have - span], least[span - have:])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        anchor = (_LOW - (least[first] & _LOW)).astype(np.int64)
        last = np.append(first[1:] - 1, len(least) - 1)
        out.append((h[anchor].view(np.int64), anchor + at, first + at, last + at))
        at += PIECE
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a row id: the doc_id where it is one, else a new number."""
    twice = docs.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR _id IS NULL")
    if twice.isEmpty():
        return docs.withColumn("_row", F.col("_id"))
    return stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


COVERED, OPEN, KNOWN = 0, 1, 2  # a repeated run, one to look into, and one to compare with


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    """A row for each run: anchor hash, hash of the run's bytes, row, place, times.

    Runs that occur more than once in the texts at hand are repeated, whatever
    else there is: they go on as such (times 0, dealt by row), and one row
    (times 2) stands for them at their anchor. So however often a run occurs, a
    task sends its anchor one row a slice.
    """
    def run(batches):
        for batch in gathered(batches, 1, SLICE_BYTES):
            out = []
            for row, text in zip(batch["_row"].to_numpy().tolist(), batch["text"].to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                if len(raw) < length:
                    continue
                h, anchor, first, last = anchor_runs(np.frombuffer(raw, dtype=np.uint8), length)
                own = [xxhash.xxh3_64_intdigest(raw[a:b + length], seed=p - a) for p, a, b in zip(
                    anchor.tolist(), first.tolist(), last.tolist())]
                # anchor (40 bits), its distance from the first window (12), windows - 1 (12)
                place = anchor << 24 | (anchor - first) << 12 | (last - first)
                out.append((h, np.array(own, dtype=np.uint64).view(np.int64), np.full(len(h), row), place))
            if not out:
                continue
            h, own, row, place = (np.concatenate(c) for c in zip(*out))
            by = np.lexsort((own, h))
            fresh = np.ones(len(by), dtype=bool)
            fresh[1:] = (h[by[1:]] != h[by[:-1]]) | (own[by[1:]] != own[by[:-1]])
            copies = np.bincount(np.cumsum(fresh) - 1)[np.cumsum(fresh) - 1]
            single, twice, heads = by[copies == 1], by[copies > 1], by[(copies > 1) & fresh]
            parts = np.concatenate([single, twice, heads])
            times = np.repeat(np.array([1, 0, 2], dtype=np.int32), [len(single), len(twice), len(heads)])
            to = np.where(times == 0, mix(row[parts].view(np.uint64)).view(np.int64), h[parts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(own[parts]), pa.array(row[parts]), pa.array(place[parts]), pa.array(times)],
                names=["anchor", "run", "row", "place", "times"])

    return rows.select("_row", "text").mapInArrow(giving_back(run), "anchor long, run long, row long, place long, times int")


def _judge(anchors: DataFrame) -> DataFrame:
    """Runs that are repeated as a whole, and different runs around one anchor.

    Within an anchor, runs come in order of their hash and are numbered in
    blocks of ``GROUP``; the rows of one anchor are never held all at once.
    """
    def judge(t: np.ndarray, more: bool, offset: int):
        """Kinds and blocks of whole anchors; ``more``: the first anchor had other runs before."""
        anchor, run, times = t[0], t[1], t[4]
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        fresh = new | np.concatenate([[True], run[1:] != run[:-1]])
        group, kind = np.cumsum(new) - 1, np.cumsum(fresh) - 1
        copies = np.bincount(kind, weights=times)[kind]
        runs = np.bincount(group, weights=fresh).astype(np.int64)
        before = np.cumsum(runs) - runs
        runs[0] += more
        several = runs[group] > 1
        number = kind - before[group] + np.where(group == 0, offset, 0)
        block = number // GROUP
        yield t[2:4], np.flatnonzero((copies > 1) & (times == 1)), COVERED, anchor, block
        yield t[2:4], np.flatnonzero(several & (copies == 1)), OPEN, anchor, block
        yield t[2:4], np.flatnonzero(several & (copies > 1) & fresh), KNOWN, anchor, block

    def emit(parts):
        for (row, place), at, kind, anchor, block in parts:
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[at]), pa.array(place[at]), pa.array(np.full(len(at), kind, dtype=np.int32)),
                     pa.array(anchor[at]), pa.array(block[at].astype(np.int32))],
                    names=["row", "place", "kind", "anchor", "block"])

    def run(batches):
        held, more, offset = None, False, 0
        for batch in batches:
            t = np.stack([c.to_numpy() for c in batch.columns]).astype(np.int64)
            done = t[4] == 0
            if done.any():
                here = np.flatnonzero(done)
                yield from emit([(t[2:4], here, COVERED, t[0], np.zeros(len(done), dtype=np.int64))])
                t = t[:, ~done]
            if not t.shape[1]:
                continue
            held = t if held is None else np.concatenate([held, t], axis=1)
            other = np.flatnonzero(held[0] != held[0, -1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from emit(judge(held[:, :cut], more, offset))
                held, more, offset = held[:, cut:], False, 0
            if held.shape[1] > CARRY_ROWS:
                # one anchor with very many rows: judge its finished runs, keep two rows of
                # the run that goes on (a range that is given twice does no harm)
                other = np.flatnonzero(held[1] != held[1, -1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    runs = len(np.unique(held[1, :cut]))
                    # that another run follows is known already
                    yield from emit(judge(held[:, :cut], True, offset))
                    more, offset, held = True, offset + runs, held[:, cut:]
                if held.shape[1] > CARRY_ROWS:
                    yield from emit(judge(held, more, offset))
                    held = held[:, -2:]
        if held is not None and held.shape[1]:
            yield from emit(judge(held, more, offset))

    dealt = anchors.repartition("anchor").sortWithinPartitions("anchor", "run")
    return dealt.mapInArrow(run, "row long, place long, kind int, anchor long, block int")


def _contexts(rows: DataFrame, judged: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs to compare, with their row and place."""
    wanted = judged.where(F.col("kind") != COVERED).groupBy("row").agg(
        F.collect_list(F.struct("anchor", "block", "place", "kind")).alias("runs"))  # at most a text's runs
    both = rows.where("_row IS NOT NULL").select("_row", "text").join(wanted, F.col("_row") == F.col("row"))

    names = ["anchor", "block", "kind", "row", "place", "bytes"]

    def run(batches):
        for batch in gathered(batches, 1, CONTEXT_TEXT):
            runs = batch["runs"].combine_chunks()
            ends = runs.offsets.to_numpy() - runs.offsets[0].as_py()
            flat = runs.flatten()
            anchor, block, place, kind = (flat.field(c) for c in ("anchor", "block", "place", "kind"))
            places = place.to_numpy()
            first = (places >> 24) - (places >> 12 & 0xFFF)
            last = first + (places & 0xFFF) + length
            ctx = []
            for k, text in enumerate(batch["text"].to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                ctx.extend(raw[a:b] for a, b in zip(first[ends[k]:ends[k + 1]].tolist(), last[ends[k]:ends[k + 1]].tolist()))
            rows = pa.array(np.repeat(batch["_row"].to_numpy(), np.diff(ends)))
            yield pa.RecordBatch.from_arrays([anchor, block, kind, rows, place, pa.array(ctx, pa.binary())], names=names)

    return both.select("_row", "text", "runs").mapInArrow(
        giving_back(run), "anchor long, block int, kind int, row long, place long, bytes binary")


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] is common, a[:hi] is not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def repeated_windows(runs: list[bytes], shifts: list[int], open_: list[bool], length: int = LENGTH, step: int = STEP):
    """(run, first, last): the repeated windows of each open run, as a range.

    ``shifts`` are the places of the runs' first block boundaries, in step with
    their anchors. All windows of a run overlap, so what they cover is one range.
    """
    counts = [(len(r) - s) // step for r, s in zip(runs, shifts)]
    blocks = [r[s + k * step:s + (k + 1) * step] for r, s, n in zip(runs, shifts, counts) for k in range(n)]
    # bytes as big-endian words compare like the bytes themselves
    words = np.frombuffer(b"".join(blocks), dtype=">u8").reshape(-1, step // 8)
    by = np.lexsort(words.T[::-1])
    fresh = np.ones(len(by), dtype=np.int64)
    fresh[1:] = (words[by[1:]] != words[by[:-1]]).any(axis=1)
    symbols = np.empty(len(by), dtype=np.int64)
    symbols[by] = np.cumsum(fresh) - 1
    lens = np.array(counts, dtype=np.int64)
    starts = np.cumsum(lens) - lens
    keep = lens > 0
    order = suffix_array(symbols, starts[keep])
    owner = np.repeat(np.arange(len(runs)), lens)[order]
    nth = order - starts[owner]
    # neighbours that share all blocks a window must hold right of its first boundary
    whole = (length - step + 1) // step
    enough = nth + whole <= lens[owner]
    padded = np.append(symbols, np.full(whole, -1))
    same = enough[1:] & enough[:-1]
    for k in range(whole):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    best: dict[int, list[int]] = {}

    def found(i: int, lo: int, hi: int) -> None:
        if open_[i]:
            r = best.get(i)
            if r is None:
                best[i] = [lo, hi]
            else:
                r[0], r[1] = min(r[0], lo), max(r[1], hi)

    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
        members = [(i, shifts[i] + int(k) * step) for i, k in zip(owner[lo:hi + 1].tolist(), nth[lo:hi + 1].tolist())]
        if len(members) == 2:
            (i, a), (j, b) = members
            x, y = runs[i], runs[j]
            right = _common(x[a:a + length], y[b:b + length])
            back = _common(x[max(0, a - step + 1):a][::-1], y[max(0, b - step + 1):b][::-1])
            # windows that start t bytes before the boundary, for t in [length - right, back]
            if length - right <= back:
                found(i, a - back, a - (length - right))
                found(j, b - back, b - (length - right))
            continue
        for t in range(step):
            seen: dict[bytes, list[tuple[int, int]]] = {}
            for i, a in members:
                w = runs[i][a - t:a - t + length] if a >= t else b""
                if len(w) == length:
                    seen.setdefault(w, []).append((i, a - t))
            for places in seen.values():
                if len(places) > 1:
                    for i, a in places:
                        found(i, a, a)
    return [(i, lo, hi) for i, (lo, hi) in best.items()]


def _search(contexts: DataFrame, length: int) -> DataFrame:
    """Covered ranges (row, lo, hi) of the open runs, by suffix arrays."""
    def look(rows: dict[str, list]):
        runs = rows["bytes"]
        before = [p >> 12 & 0xFFF for p in rows["place"]]  # the anchor's place in the run
        shifts = [b % STEP for b in before]
        out = []
        for i, lo, hi in repeated_windows(runs, shifts, [k == OPEN for k in rows["kind"]], length):
            first = (rows["place"][i] >> 24) - before[i]
            out.append((rows["row"][i], first + lo, first + hi + length))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "lo", "hi"])

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held["bytes"].nbytes < BUCKET_BLOCKS * STEP:
                continue
            key = np.stack([held["anchor"].to_numpy(), held["block"].to_numpy()])
            other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            if len(other):
                cut = int(other[-1]) + 1
                yield from look(held.slice(0, cut).to_pydict())
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from look(held.to_pydict())

    dealt = contexts.repartition("anchor", "block").sortWithinPartitions("anchor", "block")
    return dealt.mapInArrow(run, "row long, lo long, hi long")


def _count(contexts: DataFrame, length: int) -> DataFrame:
    """Covered ranges of open runs around an anchor with very many runs: their
    windows are counted by 128-bit hash."""
    def run(batches):
        for batch in batches:
            for kind, row, place, raw in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (
                    "kind", "row", "place", "bytes"))):
                first = (place >> 24) - (place >> 12 & 0xFFF)
                n = len(raw) - length + 1
                h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[s:s + length]) for s in range(n)), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.full(n, row)), pa.array(np.full(n, first)),
                     pa.array(first + np.arange(n)), pa.array(np.full(n, 1 + (kind == KNOWN)))],
                    names=["h1", "h2", "row", "first", "start", "times"])

    windows = contexts.mapInArrow(run, "h1 long, h2 long, row long, first long, start long, times long")
    often = windows.groupBy("h1", "h2").agg(F.sum("times").alias("n")).where("n > 1").select("h1", "h2")
    hit = windows.where("times = 1").join(often, ["h1", "h2"])
    return hit.groupBy("row", "first").agg(F.min("start").alias("lo"), (F.max("start") + length).alias("hi")).select("row", "lo", "hi")


def cut(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int]:
    """``raw`` without the ranges [lo, hi), which may overlap, and their number once joined."""
    if not len(lo):
        return raw, 0
    by = np.argsort(lo, kind="stable")
    lo, hi = lo[by], np.maximum.accumulate(hi[by])
    opens = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    starts, stops = lo[opens].tolist(), hi[np.append(opens[1:], len(lo)) - 1].tolist()
    return b"".join(raw[a:b] for a, b in zip([0, *stops], [*starts, len(raw)])), len(starts)


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without the bytes that a repeated string covers.

    Strings are judged on the input, matches never cross rows, overlaps count.
    Returns all columns with ``text`` rewritten (a character cut in two loses
    its other bytes too), plus n_bytes, n_removed, n_spans (maximal removed
    runs) and kept_sha256 (of the remaining bytes). A null text counts as
    empty and stays null; texts under ``length`` bytes are left alone; a row
    that is repeated matches its copies; null and repeated doc_ids are
    allowed; input columns named like an added one are overwritten.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rest = [c for c in docs.columns if c not in ("text", *added)]
    # the input's columns go through under numbers, so that no name of theirs can clash
    handed = [f"in{k}" for k in range(len(rest))]
    rows = _keyed(small_batches(docs).select(*[F.col(f"`{c}`").alias(h) for c, h in zip(rest, handed)],
                              F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")))
    judged = stage(_judge(_anchors(rows, length)), "judged")
    first = (F.shiftright("place", 24) - F.shiftright("place", 12).bitwiseAND(F.lit(0xFFF)))
    whole = judged.where(F.col("kind") == COVERED).select(
        "row", first.alias("lo"), (first + F.col("place").bitwiseAND(F.lit(0xFFF)) + length).alias("hi"))
    large = stage(judged.where("block > 0").select(F.col("anchor").alias("_large")).distinct(), "large-anchors")
    if large.isEmpty():
        spans = whole.unionAll(_search(_contexts(rows, judged, length), length))
    else:
        marked = stage(judged.join(large, F.col("anchor") == F.col("_large"), "left"), "marked")
        few, many = marked.where("_large IS NULL"), marked.where("_large IS NOT NULL")
        spans = whole.unionAll(_search(_contexts(rows, few, length), length)).unionAll(
            _count(_contexts(rows, many, length), length))
    of_row = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("_spans"))  # at most a text's runs
    both = rows.where("_row IS NOT NULL").join(of_row, F.col("_row") == F.col("row"), "left")
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {types[c]}" for c in rest]
                       + ["text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"])

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def rewrite(batches):
        for batch in gathered(batches, len(rest), SLICE_BYTES):
            spans = batch["_spans"].combine_chunks()
            ends = spans.offsets.to_numpy() - spans.offsets[0].as_py()
            flat = spans.flatten()
            lo, hi = (flat.field(c).to_numpy() for c in ("lo", "hi"))
            out = []
            for k, text in enumerate(batch["text"].to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                left, n = cut(raw, lo[ends[k]:ends[k + 1]], hi[ends[k]:ends[k + 1]])
                new = text if len(left) == len(raw) else left.decode("utf-8", "ignore")
                out.append((new, len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(k).combine_chunks() for k in range(len(rest))] + [
                pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[*rest, "text", *added])

    return both.select(*handed, "text", "_spans").mapInArrow(giving_back(rewrite), schema)
