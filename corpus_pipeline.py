"""Training text made ready: quality, near duplicates, leaks, secrets, token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.bpe import encode_documents
from tablesync.llm.common import unused, written
from tablesync.llm.decontaminate import without_leaks
from tablesync.llm.jaccard import link_similar
from tablesync.llm.quality import keep_good
from tablesync.llm.secrets import redact_secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without lines that too many documents of a source share.

    Null and empty texts go; rows of a repeated id, or without one, go by their own text.
    """
    return keep_good(docs, length_col="n_chars")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows with the same id, or without one, are documents of their own: one goes
    only if its text is the same as another's, or similar; one with an id stays
    before one without. Texts without words are only the same within an id, and all
    without an id stay.
    """
    row, linked, kept = unused(docs, "row", "linked", "kept")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = link_similar(numbered, id_col=row).select(F.col("doc_id").alias(linked), "n_shingles", "component_id")
    ids = numbered.select(row, F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    empty = F.col("n_shingles") == 0
    best = (
        groups.join(ids, F.col(linked) == F.col(row))
        .groupBy(
            F.when(~empty, F.col("component_id")),
            F.when(empty, F.col("id")),
            F.when(empty & F.col("id").isNull(), F.col(row)),
        )
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "hash", F.col(row).alias("row"))).alias("best"))
        .select(F.col("best.row").alias(kept))
    )
    return numbered.join(best, F.col(row) == F.col(kept), "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark; each row goes by its own text, null texts stay."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), by_row=True)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; null texts stay null, ids do not matter."""
    return redact_secrets(docs, public_tokenizers.path("word_bpe_49k.json"), length_col="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of ids and decoded text; a row per row, null texts are empty."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE", token_ids),
]

#: Components, guess costs and merges can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes a table in the shared folder that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
