"""From raw documents to tokens: rules, near-duplicates, benchmark leaks, personal data, encoding.

Each stage is a function of ``(spark, docs, sf_dir)``; what it returns is written as Parquet to the
shared folder and read again as the next one's documents. All stages but the last keep the columns
of ``documents``. Rows go where a rule, a copy or a leak says so and nowhere else; each operator's
docstring says what it does with nulls, ties and repeated rows. The last stage gives, for every
document kept, the number of its tokens and the digests of its identifiers and of what they decode
to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.bpe_automaton import encoding_digests
from surveyloom.llm.decontaminate import drop_leaks
from surveyloom.llm.pii_crf import mask_personal_data
from surveyloom.llm.quality_rules import keep_good
from surveyloom.llm.simhash import keep_one_of_each
from surveyloom.sources.workspace import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust estimates keep."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and ``n_chars`` counted anew."""
    masked = mask_personal_data(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    return encoding_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Iterated estimates, components and tokens are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
