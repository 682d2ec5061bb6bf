"""Corpus pipeline: language identification, near-duplicates, repeated strings,
personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's result as a
table in the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.llm import langid, near, packing, pii, repeats
from runway.llm.common import stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` with n_chars of the text as it is now."""
    kind = docs.schema["n_chars"].dataType
    return df.withColumn("n_chars", F.length("text").cast(kind)).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly; the others go. ``lang`` becomes the language found."""
    found = langid.predict(docs, langid.fit(docs), keep=COLUMNS).where(~F.col("rejected"))
    return found.select(*[F.col("lang_pred" if c == "lang" else f"kept_{c}").alias(c) for c in COLUMNS])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.
    Five-word shingles at a similarity of 0.8; texts without words stay, rows that
    repeat an id and its text become one (an id's different texts all stay or go),
    rows without an id are linked with nothing."""
    kept = near.groups(docs, percent=80, k=5).where("kept OR n_shingles = 0").select("doc_id").distinct()
    one = docs.join(kept, "doc_id").withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).select(*COLUMNS)
    return one.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that occur more than once; no document goes."""
    return _documents(repeats.remove(docs.select(*COLUMNS)), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of personal data."""
    return _documents(pii.replace(docs.select(*COLUMNS)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in the training sequences."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("personal_data", personal_data), ("packing", pack)]

# learned languages and MinHash groups have no SQL form: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
