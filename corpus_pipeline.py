"""The corpus pipeline: documents through five of the operators in turn.

Quality rules drop rejected documents and clean the lines of the others;
near-duplicates leave one document of each group; repeated passages are cut from
all documents but the first; personal data is masked; what is left is packed.
Every stage but the last returns the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkrec.llm.common import materialize
from sparkrec.llm.minhash import drop_near_duplicates
from sparkrec.llm.packing import pack
from sparkrec.llm.pii import mask
from sparkrec.llm.quality import clean
from sparkrec.llm.suffix_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("PII", personal_data),
    ("best-fit packing", packing),
]

#: SQL cannot express the suffix-array and weak-supervision stages; tests/llm
#: compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
