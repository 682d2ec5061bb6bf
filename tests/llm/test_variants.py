"""Spelling variants against a plain version over all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from helpers import ODD_TEXTS, docs
from runway.llm import variants


def distance(u, v):
    row = list(range(len(v) + 1))
    for i, a in enumerate(u, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(v, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return row[-1]


def plain(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and distance(v, w) == 1] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def rows_of(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def edited(r, w):
    at, c = r.randrange(len(w) + 1), r.choice("abcdeéÿÀ÷")
    return r.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w[:at] + w[at + 1:]])


def corpus(seed, words=60, texts=200):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéÿ") for _ in range(r.randint(5, 13))) for _ in range(words)]
    for _ in range(3):
        base += [edited(r, w) for w in base]
    weights = [r.random() ** 4 for _ in base]
    return ["-".join(w.title() if r.random() < .2 else w for w in r.choices(base, weights, k=60)) for _ in range(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_version(spark, seed):
    texts = corpus(seed) + ODD_TEXTS
    rows = [*enumerate(texts), (None, texts[0]), (0, texts[0]), (0, texts[0])]
    got = variants.group(docs(spark, rows))
    want = plain(rows)
    assert rows_of(got) == want and got.count() == len(want)
    assert any(w[1] and w[2] != w[1] for w in want) and sum(w[4] for w in want) > 500


def test_tiles_and_gathering_change_nothing(spark, monkeypatch):
    texts = corpus(5, words=40, texts=80)
    monkeypatch.setattr(variants, "TILE", 3)
    monkeypatch.setattr(variants, "GATHER", 4)
    monkeypatch.setattr(variants, "HELD", 50)
    assert rows_of(variants.group(docs(spark, texts))) == plain(list(enumerate(texts)))


def test_no_table_is_broadcast(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(variants, "stage", lambda df, *a, old=variants.stage: plans.append(df) or old(df, *a))
    got = variants.group(docs(spark, corpus(3, words=20, texts=60)))
    assert rows_of(got) == plain(list(enumerate(corpus(3, words=20, texts=60))))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, got]]  # the last one as it was run
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)


def test_one_edit():
    for u, v, near in [("house", "house", False), ("house", "houses", True), ("house", "hose", True), ("house", "mouse", True),
                       ("abcde", "abced", False), ("aabbb", "abbb", True), ("abcde", "abcdefg", False), ("abcde", "xbcdex", False), ("aaaaa", "aaaaaa", True)]:
        assert variants.one_edit(u, v) is near and variants.one_edit(v, u) is near


def test_long_texts_are_cut_between_runs(monkeypatch):
    text = corpus(9, texts=1)[0] + "é" * 300 + " ~ Ab" + "c" * 40
    whole = variants.runs(text)
    monkeypatch.setattr(variants, "PIECE", 7)
    assert variants.runs(text) == whole


def test_empty_table_and_other_columns(spark):
    empty = variants.group(docs(spark, []))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    data = docs(spark, ["house house house mouse mouse mouse mouse mouse mouse"]).withColumnsRenamed({"lang": "word", "source": "n"})
    assert rows_of(variants.group(data)) == plain([(0, "house house house mouse mouse mouse mouse mouse mouse")])
    assert variants.group(docs(spark, [None, "", "ab cd"])).count() == 0
