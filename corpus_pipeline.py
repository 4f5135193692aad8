"""A corpus pipeline of five stages over the table ``documents``.

Each stage takes all that the one before kept, as a Parquet table. The first four return the
columns of ``documents``; the last one encodes what is left:

1. language_id: texts that are null or have no letter are rejected.
2. near_duplicates: one document of each group of near copies stays; a pair is near if its
   fingerprints of three-word shingles differ in at most two bits.
3. decontaminate: documents that overlap an item of ``benchmark`` go.
4. secrets: secrets are masked in the text.
5. tokens: texts are encoded to BPE ids and decoded again.

A row is kept or dropped by its own content, its group or its id; repeated rows go with the
group they are in. Extra columns pass through the first four stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake.llm import byte_bpe, decontaminate, language_id, secret_scan, simhash_dedup
from telemetry_lake.llm.tables import stored, table


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one_per_group(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_table(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", by_language),
    ("near_duplicates", without_near_duplicates),
    ("decontaminate", without_leaks),
    ("secrets", without_secrets),
    ("tokens", encoded),
]
#: The language classifier is trained, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
