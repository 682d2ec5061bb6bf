"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a boolean expression over the text and a few counts. Its cost
(seconds a row) and selectivity (share of rows it rejects) are measured on a
bounded sample; the rules are then chained in one CASE in descending order of
rejection per cost, so that a row rejected by a cheap, selective rule never
meets the dear ones. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.llm.common import GAP, stage

SAMPLE_ROWS = 2000  # expected rows of the sample that orders the rules
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """``reject`` is an SQL expression over text, words and the base counts."""
    name: str
    reject: str


RULES = (
    Rule("symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("duplicate_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * (length(text) - length(replace(text, '\\n', '')) + 1)"),
    Rule("capitals", "2 * length(regexp_replace(text, '[^\\\\p{Lu}]', '')) > word_chars"),
    Rule("few_letter_words", "100 * size(filter(words, w -> w rlike '\\\\p{L}')) < 60 * n_words"),
    Rule("few_distinct_words", "100 * size(array_distinct(words)) < 8 * n_words"),
)


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text, words and the contract's counts of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("words", words)
    lines = F.split("text", "\n")
    with_word = r"[^\x20\x09-\x0D]"
    df = (df.withColumn("n_words", F.size("words").cast("long"))
          .withColumn("word_chars", F.length(F.translate("text", SPACES, "")).cast("long"))
          .withColumn("n_symbols", (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"))
          .withColumn("_lines", lines)
          .withColumn("_distinct", F.array_distinct("_lines"))
          .withColumn("n_dup_lines", F.when(F.size("_lines") == F.size("_distinct"), F.lit(0)).otherwise(
              F.size(F.filter("_lines", lambda x: x.rlike(with_word)))
              - F.size(F.filter("_distinct", lambda x: x.rlike(with_word)))).cast("long"))
          .drop("_lines", "_distinct"))
    return _repeat_words(df)


def _repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words: words inside windows that occur twice or more in the text.

    Windows are hashed; only a text with an equal pair has its windows sorted
    by hash, so that equal ones stand side by side. The covered words follow
    from the sorted starts: each covers the words up to the next start, at
    most a window. All steps are n log n in the words of one text.
    """
    w = WINDOW_WORDS
    hashes = F.when(F.col("n_words") >= w, F.transform(
        F.sequence(F.lit(1), F.col("n_words").cast("int") - (w - 1)),
        lambda i: F.xxhash64(F.slice("words", i, w)))).otherwise(F.array().cast("array<bigint>"))
    pair = F.transform("_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    n = F.size("_pair")
    equal_near = F.filter("_pair", lambda x, j: (
        ((j > 0) & (F.try_element_at("_pair", j)["h"] == x["h"]))
        | ((j < n - 1) & (F.try_element_at("_pair", j + 2)["h"] == x["h"]))))
    covered = F.aggregate(
        "_start", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-w).alias("last")),
        lambda acc, s: F.struct((acc["sum"] + F.least(F.lit(w), s - acc["last"])).cast("long").alias("sum"), s.alias("last")),
        lambda acc: acc["sum"])
    return (df.withColumn("_hash", hashes)
            .withColumn("_pair", F.when(F.size("_hash") > F.size(F.array_distinct("_hash")), F.sort_array(pair)))
            .withColumn("_start", F.when(F.col("_pair").isNotNull(), F.sort_array(F.transform(equal_near, lambda x: x["i"]))))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_hash", "_pair", "_start"))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules in descending order of rejection per cost, measured on a sample."""
    total = docs.count()
    part = docs.select("doc_id", "text")
    if total > sample_rows:
        part = part.sample(fraction=sample_rows / total, seed=7)
    sample = stage(base_counts(part), "rule-sample")

    def measure(reject: str) -> tuple[float, float]:
        began = time.perf_counter()
        row = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.expr(f"IF({reject}, 1, 0)")), F.lit(0)).alias("r")).first()
        return time.perf_counter() - began, row["r"] / max(1, row["n"])

    measure("false")  # start-up
    floor, _ = measure("false")
    measured = []
    for rule in rules:
        cost, rejected = measure(rule.reject)
        measured.append((rejected / max(cost - floor, 1e-3), rule))
    return [r for _, r in sorted(measured, key=lambda x: -x[0])]


def verdict(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects the row, null if none does."""
    chain = F
    for rule in rules:
        chain = chain.when(F.expr(rule.reject), F.lit(rule.name))
    return chain.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base verdict and cascade verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept. A null text has no words and so fails
    the base; a text without words fails it as well; repeated rows are judged
    alike; a null doc_id is kept; other columns are ignored.
    """
    counts = base_counts(docs)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counts.withColumn("base_failed", base).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(order_rules(docs, rules)).isNull()).alias("kept"))
