"""The registered queries of the corpus operators: each applies its operator,
with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.llm import ann, bpe, cascade, chat, langid, near, packing, pii, quality, repeats, sql, urls, variants, whiten
from runway.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.groups(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.judge(table(spark, sf_dir, "documents"))


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return urls.judge(pages, urls.outcomes(pages, labels)).drop("rate", "bound")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_repeated_strings, op2_near_duplicates, op3_nearest_neighbours, op4_language_id, op5_surrogates, op6_quality_rules,
        op7_chat_rotation, op8_bpe_codec, op9_packing, op10_quality_classifier, op11_spelling_variants, op12_whitening, op13_url_filters)}


def oracle_sql() -> dict[str, str]:
    return {"op2_near_duplicates": sql.OP2, "op6_quality_rules": sql.OP6, "op7_chat_rotation": sql.OP7, "op13_url_filters": sql.OP13}
