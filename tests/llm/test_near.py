from __future__ import annotations

import random
import re

import numpy as np

from helpers import ODD_TEXTS, by_id, docs, prose
from runway.llm import near
from runway.llm.components import components
from runway.llm.shingles import shingle_sets


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, percent=80, k=2):
    s = {i: sets(t, k) for i, t in rows}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(s)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s[i]), find(i)) for i in ids}


def check(spark, texts, k=2):
    rows = list(enumerate(texts))
    got = by_id(near.groups(docs(spark, texts), k=k))
    for i, (n, c) in brute(rows, k=k).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, c == i), i


def copies(seed, n):
    r = random.Random(seed)
    base = [prose(seed * 10 + k, r.randint(5, 80)) for k in range(5)]
    out = list(base)
    for _ in range(n):
        w = r.choice(out).split(" ")
        for _ in range(r.randint(0, max(1, len(w) // 8))):
            w[r.randrange(len(w))] = f"e{r.randint(0, 9999)}"
        out.append(" ".join(w).upper() if r.random() < 0.1 else " ".join(w))
    return out


def test_matches_brute_force(spark):
    check(spark, copies(1, 60) + ODD_TEXTS)
    check(spark, copies(2, 40), k=5)


def test_blocks_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "CLUSTER_BLOCK", 3)
    check(spark, copies(3, 50))


def test_threshold_is_inclusive(spark):
    words = [f"w{i}" for i in range(40)]
    a = " ".join(words[:37])  # 36 shingles
    b = " ".join(words[:33] + ["q1", "q2", "q3", "q4"])  # shares 32 of 40: exactly 0.8
    c = " ".join(words[:32] + ["r1", "r2", "r3", "r4", "r5"])
    check(spark, [a, b, c])
    assert by_id(near.groups(docs(spark, [a, b])))[1]["component_id"] == 0


def test_nulls_repeats_empty_and_extra_columns(spark):
    t = prose(1, 30)
    rows = near.groups(docs(spark, [(5, t), (5, t), (None, t), (3, None), (9, t), (9, prose(2, 30)), (7, prose(2, 30))])
                       .selectExpr("*", "1 AS n_shingles", "2 AS rep", "3 AS sig", "4 AS bucket")).collect()
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in rows}
    # 9 has the texts of 5 and of 7, so all three are one group
    assert got == {(5, 5, True), (None, None, False), (3, 3, True), (9, 5, False), (7, 5, False)} and len(rows) == 7
    assert near.groups(docs(spark, [])).count() == 0


def test_sequential_test_keeps_true_pairs():
    r = np.random.default_rng(0)
    left = r.integers(0, 256, (2000, near.HASHES), dtype=np.uint8)
    right = np.where(r.random(left.shape) < 0.8, left, r.integers(0, 256, left.shape, dtype=np.uint8))
    assert len(near.survive(left, right, 80)) == 2000
    assert len(near.survive(left, np.where(r.random(left.shape) < 0.3, left, right[::-1]), 80)) == 0


def test_shingle_sets_cut_long_words_and_slices(monkeypatch):
    from runway.llm import shingles
    texts = [prose(1, 3000), "x" * 4000 + " y", None, "one"]
    whole = shingle_sets(texts)
    monkeypatch.setattr(shingles, "SEGMENT", 500)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets(texts)))
    assert [len(x) for x in whole] == [len(sets(t, 2)) for t in texts]


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (12, 11), (5, 5)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, **{100 + i: 100 for i in range(31)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_with_several_texts_join_their_groups(spark):
    r = np.random.default_rng(8)

    def near_copy(t):
        return " ".join(["changed", *t.split()[1:]])

    a, b = prose(11, 60), prose(12, 60)
    rows = [(1, a), (1, b), (2, near_copy(a)), (3, near_copy(b))]
    c = [prose(20 + i, 50) for i in range(12)]
    # documents with up to four texts, each near to another document's
    for i, t in enumerate(c):
        rows += [(int(x), t) for x in r.integers(10, 30, r.integers(0, 3))] + [(40 + i, near_copy(t))]
    got = {x["doc_id"]: x["component_id"] for x in near.groups(docs(spark, rows)).collect()}
    texts = [t for _, t in rows]
    up = {d: d for d, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    of = [sets(t, 2) for t in texts]
    for i, (d, _) in enumerate(rows):
        for j in range(i):
            both = len(of[i] & of[j])
            if 100 * both >= 80 * (len(of[i]) + len(of[j]) - both):
                x, y = sorted((find(d), find(rows[j][0])))
                up[y] = x
    assert got == {d: find(d) for d in up} and got[3] == got[2] == 1


def test_stars_are_components_at_once(spark, monkeypatch):
    from runway.llm import components as module

    made = []
    stored = module.stage
    monkeypatch.setattr(module, "stage", lambda df, tag, *rest: made.append(tag) or stored(df, tag, *rest))
    links = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (7, 2), (9, 9)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(links).collect()} == {1: 1, 5: 1, 6: 1, 2: 2, 7: 2}
    assert made == ["links"]


def test_a_stored_step_has_few_files(spark):
    from runway.llm.common import few_tasks, stage

    rows = spark.range(1000).repartition(200, "id")
    made = stage(rows, "few", 3)
    assert len(made.inputFiles()) <= 3 and made.count() == 1000
    assert few_tasks(made, rows=100) == 4 * spark.sparkContext.defaultParallelism + 10
