"""The corpus pipeline: documents in, token ids of a clean and mixed corpus out.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; its result
is written to the shared folder and read back as the next stage's ``docs``. All
stages but the last return the columns of their input.

Defined cases are those of the operators: NULL and empty texts fail the quality rules,
rows with one doc_id or none are told apart by all columns at the near-duplicate
stage, very long texts pass every stage whole, a NULL source is a source of its own in the mix, and an
empty table gives an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricehouse.llm import mixing, piece_encoding, quality_rules, queries, secret_scans, simhash
from pricehouse.llm.text import let_workers_import
from pricehouse.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of texts whose fingerprints are linked, as in the operator's own query."""
    let_workers_import(spark)
    return simhash.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    let_workers_import(spark)
    redacted = secret_scans.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, up to twice."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of every text."""
    let_workers_import(spark)
    coded = piece_encoding.encode(docs, queries.piece_model(), ("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing", mix),
    ("piece_encoding", encode),
]

#: The encoding has no counterpart in SQL; tests hold the run against a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
