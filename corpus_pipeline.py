"""The corpus pipeline: documents through five text operators, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pharmavane.llm import bpe, line_dedup, mixing, ngram_join, quality
from pharmavane.llm.common import staged
from pharmavane.session import run_scope


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the rules learned from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document of smaller id has."""
    return line_dedup.shorten(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return ngram_join.keep_one(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, cap=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the text read back."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("line dedup", drop_lines),
    ("n-gram join", drop_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# The learned rules, the seeded mix and the token ids have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage-{k}")
    return docs


def write(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The rows of ``run`` stored at ``target``; the tables between the stages go, also if it fails."""
    with run_scope(spark):
        run(spark, sf_dir).write.mode("overwrite").parquet(target)
