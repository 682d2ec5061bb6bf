"""Registered corpus queries: names, oracles on the smallest tables, clean removal."""

from __future__ import annotations

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF001
from helpers import docs, prose

TABLES = ["documents", "embeddings", "pages", "conversations", "labels"]


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(E.llm_queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    df = E.queries()[name](spark, SF001)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    norm = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    want = sorted((tuple(map(norm, r)) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr) == want


def test_pipeline_stages(spark):
    a, b = prose(1, 60), prose(2, 60)
    near = " ".join(["changed"] + a.split()[1:])
    texts = [a, near, b + " " + prose(3, 60), prose(4, 40) + " " + b, prose(5, 80) + " me.11@mail.example.com x", None, "12 34", "",
             prose(6, 2000), (None, prose(7, 50))]
    data = docs(spark, texts)
    step = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_strings", "personal_data", "packing"]
    one = step["language_id"](spark, data, "")
    assert one.columns == corpus_pipeline.COLUMNS
    ids = {r["doc_id"] for r in one.collect()}
    assert ids == {0, 1, 2, 3, 4, 8, None}  # null, empty and letterless texts are rejected
    two = step["near_duplicates"](spark, one, "")
    assert {r["doc_id"] for r in two.collect()} == ids - {1} and two.columns == corpus_pipeline.COLUMNS
    three = {r["doc_id"]: r for r in step["repeated_strings"](spark, two, "").collect()}
    assert set(three) == ids - {1} and three[2]["text"] == " " + prose(3, 60) and three[2]["n_chars"] == len(three[2]["text"])
    assert three[3]["text"] == prose(4, 40) + " " and three[0]["text"] == a
    four = {r["doc_id"]: r for r in step["personal_data"](spark, two, "").collect()}
    assert "me.11@mail" not in four[4]["text"] and four[0]["text"] == a
    five = step["packing"](spark, two, "").collect()
    assert {r["doc_id"] for r in five} == ids - {1}
    empty = docs(spark, [])
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, empty, "").count() == 0


def test_pipeline_runs_on_the_tables(spark):
    out = corpus_pipeline.run(spark, SF001)
    rows = out.collect()
    assert out.columns[0] == "doc_id" and rows
    assert max(r["offset"] + r["length"] for r in rows) <= 1024
