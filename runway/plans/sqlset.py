"""External SQL sets: a folder of ``<name>.sql`` files run by name over DataFrames.

All statements are loaded before anything runs (a missing or empty file
fails the job at once). Each statement refers to its inputs as
``{name}`` placeholders, bound with ``spark.sql(text, **dfs)`` — a
parameterised query, so no global temp view is needed and Catalyst plans
the statement together with the DataFrames it reads.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SQL_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "sql")


def load_sql_set(names, directory: str = SQL_DIR) -> dict[str, str]:
    texts = {}
    for name in names:
        path = os.path.join(directory, f"{name}.sql")
        try:
            with open(path, encoding="utf-8") as f:
                text = f.read().strip().rstrip(";")
        except OSError as e:
            raise RuntimeError(f"failed to load SQL {path}: {e}") from e
        if not text:
            raise RuntimeError(f"empty SQL {path}")
        texts[name] = text
    return texts


def run_sql_set(spark: SparkSession, texts: dict[str, str], **inputs: DataFrame) -> dict[str, DataFrame]:
    """Lazy DataFrame per statement; ``inputs`` bind the ``{placeholders}``."""
    return {name: spark.sql(text, **inputs) for name, text in texts.items()}


def run_sql(spark: SparkSession, name: str, directory: str = SQL_DIR, **inputs: DataFrame) -> DataFrame:
    return run_sql_set(spark, load_sql_set([name], directory), **inputs)[name]
