"""Byte-level BPE encoding and decoding with a contiguous rank array.

A word is held as one array of part ids and one array of the merge ranks of
adjacent parts. Each step scans the rank array for its minimum, deletes that
boundary, and refreshes the two neighbouring ranks. Words are short, so the
scan over a contiguous array beats any pointer structure, and the words of a
batch take their steps together as rows of one matrix. Words longer than
``LONG_WORD`` bytes go through a heap over linked parts, which gives the same
merges in n log n.

Texts are cut into words first. A space between two non-space characters is
always a word boundary of the byte-level pattern, so a text without runs of
white space is split at single spaces and each piece is looked up in a
bounded table of encoded pieces; other texts go through the pattern as a
whole. Encoded pieces are kept as packed little-endian unsigned 32-bit ids.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.common import gathered, giving_back

# Fixed value: the published word pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_WORD = 256
CHUNK = 8192  # words that advance together
TABLE_BYTES = 96 << 20  # a worker's table of encoded pieces starts anew beyond this
ENTRY_BYTES = 200  # what an entry takes besides its characters and ids
SLICE_BYTES = 8 << 20  # characters of text that are worked on at once

_ID_BITS = 20
_ID_MASK = (1 << _ID_BITS) - 1
_NONE = 1 << 60


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class ByteBPE:
    """Encoder and decoder over a tokenizer file (vocabulary, merges, added tokens)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        pieces |= {i: t.encode() for t, i in self.added.items()}
        self.lengths = np.zeros(max(pieces) + 1, dtype=np.int64)
        for i, t in pieces.items():
            self.lengths[i] = len(t)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(len(self.lengths))), dtype=np.uint8)
        self.byte_id = np.zeros(256, dtype=np.int64)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        keys, ranks = [], []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            keys.append(vocab[left] << _ID_BITS | vocab[right])
            ranks.append(rank << _ID_BITS | vocab[left + right])
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], np.int64(1) << 62)
        self.ranks = np.append(np.array(ranks, dtype=np.int64)[order], _NONE)
        self.pairs = dict(zip(keys, ranks))
        b = self.byte_id
        self.byte_ranks = self._rank(np.repeat(b, 256), np.tile(b, 256))
        self.split = regex.compile(PATTERN).findall
        # a space beside other white space or at either end, or white space at the end
        self.runs = re.compile(r"\A | \s|\s |\s\Z").search
        longest = sorted(self.added, key=len, reverse=True)
        self.added_split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if self.added else None
        self.pieces: dict[str, bytes] = {}
        self.size = 0  # bytes that the pieces take, about

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << _ID_BITS | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; many words advance one merge at a time together."""
        out: list[bytes] = [b""] * len(words)
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lens, kind="stable")
        order = order[lens[order] > 0]
        short = order[lens[order] <= LONG_WORD]
        for i in order[len(short):].tolist():
            out[i] = np.array(self._merge_long(self.byte_id[list(words[i])].tolist()), dtype="<u4").tobytes()
        for lo in range(0, len(short), CHUNK):
            self._merge_chunk(words, short[lo:lo + CHUNK], lens, out)
        return out

    def _merge_chunk(self, words, rows, lens, out) -> None:
        own, width = lens[rows], int(lens[rows[-1]])
        cols = np.arange(width)
        there = cols < own[:, None]
        raw = np.zeros(there.shape, dtype=np.int64)
        raw[there] = np.frombuffer(b"".join([words[i] for i in rows.tolist()]), dtype=np.uint8)
        ids = self.byte_id[raw]
        ranks = np.full((len(rows), max(width, 2)), _NONE, dtype=np.int64)  # the last column stays empty
        if width > 1:
            ranks[:, :width - 1] = np.where(there[:, 1:], self.byte_ranks[raw[:, :-1] << 8 | raw[:, 1:]], _NONE)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            live = best < _NONE
            if not live.all():
                done = np.flatnonzero(~live)
                packed, n = ids[done].astype("<u4"), own[done].tolist()
                for k, i in enumerate(rows[done].tolist()):
                    out[i] = packed[k, :n[k]].tobytes()
                rows, ids, ranks, own, at, best = (x[live] for x in (rows, ids, ranks, own, at, best))
                if not len(rows):
                    return
            each = np.arange(len(rows))
            ids[each, at] = best & _ID_MASK
            own = own - 1
            last = int(own.max())
            # delete one boundary: everything right of it moves one place left
            cols = np.arange(last)
            ids = np.where(cols > at[:, None], ids[:, 1:last + 1], ids[:, :last])
            ranks = np.where(np.arange(ranks.shape[1] - 1) >= at[:, None], ranks[:, 1:], ranks[:, :-1]) if ranks.shape[1] > 2 else np.full((len(rows), 2), _NONE, dtype=np.int64)
            # refresh the ranks of the two pairs that hold the merged part
            for shift in (0, -1):
                left = at + shift
                ok = np.flatnonzero((left >= 0) & (left + 1 < own))
                ranks[ok, left[ok]] = self._rank(ids[ok, left[ok]], ids[ok, left[ok] + 1])

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self.pairs.get
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := rank_of(ids[i] << _ID_BITS | ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], j, ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, a, j, b = heapq.heappop(heap)
            if ids[i] != a or after[i] != j or ids[j] != b:
                continue
            ids[i], ids[j] = r & _ID_MASK, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def _words_of(self, lists: list[list[str]]) -> dict[str, bytes]:
        """A table of every word in ``lists``."""
        words = list(set(itertools.chain.from_iterable(lists)))
        return dict(zip(words, self.merge_words([w.encode("utf-8", "replace") for w in words])))

    def _cut(self, piece: str) -> list[str]:
        """Words of a space and a piece without white space at its ends."""
        if piece.isalpha():
            return [" " + piece]
        if piece[-1] in ".," and piece[:-1].isalpha():
            return [" " + piece[:-1], piece[-1]]
        return self.split(" " + piece)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        parts, of = [], []
        for k, text in enumerate(texts):
            for p in self.added_split.split(text) if self.added_split and any(t in text for t in self.added) else [text]:
                parts.append(p)
                of.append(k)
        if self.size > TABLE_BYTES:
            self.pieces, self.size = {}, 0
        known, missing = self.pieces.get, set()
        coded: list[tuple | None] = []  # of each part: what stands before its first space, ids of the pieces behind it, gaps
        for p in parts:
            if p in self.added:
                coded.append(None)
                continue
            pieces = [] if self.runs(p) else p.split(" ")
            if len(pieces) < 2:
                coded.append((p, [b""], (), ()))  # through the pattern as a whole
                continue
            ids = list(map(known, pieces))
            ids[0] = b""
            gaps = [at for at, x in enumerate(ids) if x is None]
            new = [pieces[at] for at in gaps]
            missing.update(new)
            coded.append((pieces[0], ids, gaps, new))
        fresh = list(missing)
        lists = [self._cut(x) for x in fresh]
        leads = [self.split(c[0]) if c else [] for c in coded]
        words = self._words_of(lists + leads).__getitem__
        new = {x: b"".join(map(words, w)) for x, w in zip(fresh, lists)}
        self.pieces.update(new)
        self.size += sum(map(len, new)) + sum(map(len, new.values())) + ENTRY_BYTES * len(new)
        out: list[list[bytes]] = [[] for _ in texts]
        for p, c, lead, k in zip(parts, coded, leads, of):
            if c is None:
                out[k].append(int(self.added[p]).to_bytes(4, "little"))
                continue
            _, ids, gaps, pieces = c
            for at, x in zip(gaps, pieces):
                ids[at] = new[x]
            ids[0] = b"".join(map(words, lead))
            out[k].append(b"".join(ids))
        return [b"".join(x) for x in out]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
        n = self.lengths[ids]
        total = int(n.sum())
        at = np.arange(total) + np.repeat(self.starts[ids] - (np.cumsum(n) - n), n)
        return self.letters[at].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def bpe(path: str) -> ByteBPE:
    """One encoder per worker process and file."""
    return ByteBPE(path)


def slices(texts: list[str | None]):
    """Runs of ``texts`` of about ``SLICE_BYTES`` each, at least one text a run."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= SLICE_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_decode(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 (lowercase hex), and
    with ``with_ids`` also ``ids`` (array<int>) and ``decoded``. A null text
    counts as empty: no tokens, digests of the empty string. A null doc_id is
    kept. Repeated rows give repeated results; other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches):
        coder = bpe(path)
        sha = hashlib.sha256
        for rows in gathered(batches, 1, SLICE_BYTES):
            packed = coder.encode_many([t or "" for t in rows["text"].to_pylist()])
            decoded = [coder.decode(p) for p in packed]
            cols = [rows["doc_id"].combine_chunks(), pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([sha(p).hexdigest() for p in packed], pa.string()),
                    pa.array([sha(d.encode("utf-8")).hexdigest() for d in decoded], pa.string())]
            if with_ids:
                cols += [pa.array([np.frombuffer(p, "<i4") for p in packed], pa.list_(pa.int32())),
                         pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names[:len(cols)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(giving_back(run), schema)
