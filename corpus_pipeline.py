"""A training corpus from the table of documents, stage by stage.

Each stage is written as Parquet and read by the next one. All but the last return the columns of documents.
Null and empty texts go in the first stage, as they have no language; repeated rows go in the second one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelmill.llm import decontam, langid, minhash, packing, pii
from parcelmill.llm.scratch import stored

#: SQL cannot express the stages; the tests hold the result against brute force.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """The documents with n_chars as it is after their texts were changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found: the text model is fitted on their own labels, the source is the host."""
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; those that are mostly such passages go."""
    return _sized(decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return _sized(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of the documents, a row for each piece."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", mask_pii), ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
