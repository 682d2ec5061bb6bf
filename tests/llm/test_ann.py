from __future__ import annotations

import numpy as np

from runway.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(ids, x, q, k):
    x = np.asarray(x, dtype=np.float32).astype(float)
    s = (x * x[q]).sum(1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
    rows = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), s[i]) for i in rows]


def test_recall_and_exact_scores(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((1500, 24))
    ids = np.arange(1500)
    got = {}
    for row in ann.nearest(table(spark, zip(ids.tolist(), x.astype(np.float32).tolist()))).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    hit = total = 0
    for q in range(0, 1500, 50):
        want = dict(brute(ids, x, q, 5))
        rows = sorted(got[q])
        assert [a for a, _, _ in rows] == [1, 2, 3, 4, 5]
        hit += sum(v in want for _, v, _ in rows)
        total += 5
        for _, v, s in rows:
            if v in want:
                assert abs(s - want[v]) < 1e-12
        assert [s for _, _, s in rows] == sorted((s for _, _, s in rows), reverse=True)
    assert hit / total >= 0.9


def test_ties_few_candidates_and_invalid_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [4.0, 0.0]), (50, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [1.0, None]), (10, [1.0]), (None, [1.0, 1.0]), (7, [2.0, 0.0]), (100, [])]
    out = ann.nearest(table(spark, rows)).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out] == [
        (0, 1, 3, 1.0), (0, 2, 7, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 3, 0.0), (50, 3, 7, 0.0)]


def test_cut_vector_in_the_smallest_id(spark):
    rows = [(0, [1.0]), (50, [1.0, 0.0]), (51, [2.0, 0.0]), (52, [0.0, 1.0])]
    out = ann.nearest(table(spark, rows)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in out) == [(50, 1, 51), (50, 2, 52)]


def test_hot_vector_blocks_and_extra_columns(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 2)
    r = np.random.default_rng(2)
    x = np.concatenate([np.tile([1.0] * 8, (150, 1)), r.standard_normal((250, 8))]).astype(np.float32)
    ids = np.arange(400)
    df = table(spark, zip(ids.tolist(), x.tolist())).selectExpr("*", "1 AS bucket", "2 AS query_id", "3 AS t")
    got = {}
    for row in ann.nearest(df).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"]))
    assert [v for _, v in sorted(got[0])] == [1, 2, 3, 4, 5]
    assert [v for _, v in sorted(got[100])] == [0, 1, 2, 3, 4]
    want = {q: {v for v, _ in brute(ids, x, q, 5)} for q in range(150, 400, 50)}
    assert sum(v in want[q] for q in want for _, v in got[q]) >= 0.9 * 5 * len(want)


def test_empty(spark):
    assert ann.nearest(table(spark, [])).count() == 0
    assert ann.nearest(table(spark, [(1, [1.0, 2.0])])).count() == 0


def test_recall_beyond_the_sample(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(ann, "SAMPLE_QUERIES", 20)
    r = np.random.default_rng(5)
    x = np.concatenate([r.standard_normal((2500, 20)), r.standard_normal((40, 20)).repeat(25, 0) + 0.1 * r.standard_normal((1000, 20))])
    ids = np.arange(len(x))
    got = {}
    for row in ann.nearest(table(spark, zip(ids.tolist(), x.astype(np.float32).tolist()))).collect():
        got.setdefault(row["query_id"], set()).add(row["vec_id"])
    queries = range(0, len(x), 50)
    assert set(got) == set(queries)
    assert sum(len(got[q] & {v for v, _ in brute(ids, x, q, 5)}) for q in queries) >= 0.9 * 5 * len(queries)
