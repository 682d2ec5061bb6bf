from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from helpers import ODD_TEXTS, by_id, docs, prose
from runway.llm import repeats
from runway.llm.suffixes import suffix_array


def brute(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def check(spark, texts):
    got = by_id(repeats.remove(docs(spark, texts)))
    want = brute(texts)
    for i, w in enumerate(want):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == w, i


def variants(seed):
    r = random.Random(seed)
    base = [prose(seed + k, 120) for k in range(4)]
    texts = list(base) + [base[0]]
    for k in range(12):
        w = r.choice(base).split(" ")
        for _ in range(r.randint(1, 4)):
            w[r.randrange(len(w))] = f"edit{r.randint(0, 99)}"
        texts.append(" ".join(w))
    texts.append(prose(99, 40) + base[1][100:420] + prose(98, 40) + base[1][100:420])
    texts.append("ha " * 300)
    texts += [t[r.randint(0, 50):] for t in base]
    return texts


@pytest.mark.parametrize("seed", [1, 50])
def test_matches_brute_force(spark, seed):
    check(spark, variants(seed))


def test_boundary_lengths(spark):
    a = prose(7, 60)[:199]
    check(spark, [a, a])  # a byte short of a string
    b = prose(8, 60)[:200]
    check(spark, [b, "x" + b, "y" + b + "z"])
    check(spark, [b + prose(9, 5), prose(10, 5) + b[:199] + "#" + b])


def test_odd_texts(spark):
    check(spark, ODD_TEXTS)
    assert by_id(repeats.remove(docs(spark, ODD_TEXTS)))[0]["text"] is None


def test_repeated_and_missing_ids(spark):
    t, u = prose(3, 80), prose(4, 80)
    rows = repeats.remove(docs(spark, [(1, t), (1, u), (None, t), (2, "short")])).collect()
    assert sorted((r["n_removed"], r["n_bytes"]) for r in rows) == sorted(
        [(len(t), len(t)), (0, len(u)), (len(t), len(t)), (0, 5)])


def test_extra_columns_and_empty_table(spark):
    df = docs(spark, [prose(5, 60), "b"]).selectExpr("*", "1 AS n_spans", "2 AS `row`", "3 AS place", "text AS anchor", "4 AS _row", "5 AS _spans")
    out = repeats.remove(df)
    assert by_id(out)[0]["row"] == 2 and by_id(out)[0]["n_spans"] == 0
    assert repeats.remove(docs(spark, [])).count() == 0


def test_anchor_with_very_many_runs_and_long_carry(spark, monkeypatch):
    texts = variants(5)
    monkeypatch.setattr(repeats, "GROUP", 2)
    got = by_id(repeats.remove(docs(spark, texts)))
    for i, w in enumerate(brute(texts)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == w


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    raw = np.frombuffer((prose(1, 500)).encode(), dtype=np.uint8)
    _, anchor, first, last = repeats.anchor_runs(raw)
    assert first[0] == 0 and last[-1] == len(raw) - 200
    assert (first[1:] == last[:-1] + 1).all()
    assert ((anchor >= last) & (anchor + repeats.GRAM <= first + 200)).all()


def test_suffix_array_against_sorting():
    r = random.Random(3)
    for _ in range(300):
        seqs = [[r.randint(0, r.choice([1, 2, 5])) for _ in range(r.randint(1, 9))] for _ in range(r.randint(1, 6))]
        starts = np.cumsum([0] + [len(s) for s in seqs])[:-1]
        want = sorted((s[j:], i, starts[i] + j) for i, s in enumerate(seqs) for j in range(len(s)))
        assert suffix_array(np.array(sum(seqs, [])), starts).tolist() == [w[2] for w in want]
    assert len(suffix_array(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))) == 0
