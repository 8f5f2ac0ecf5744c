"""From raw documents to token ids, in five stages that call the operators of tradetide.llm.

Each stage takes what its predecessor kept.  All but the last return the columns
of documents; the last returns token ids instead of texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradetide.llm import bpe, mixing, quality, secret_scan, simhash
from tradetide.llm.queries import table, tokenizer_definition
from tradetide.session import work_dir


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail a base rule or an adaptive threshold go."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup with the operator's own shingles and distance: one document of each group stays."""
    return simhash.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every finding is replaced by a mark; all documents stay."""
    model = secret_scan.train(secret_scan.labelled_samples(docs.select("doc_id", "text")))
    return secret_scan.redact(docs, model).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: all documents, in the order of the mix by tempered source weights."""
    return mixing.in_mixed_order(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact token ids of every document, with its language and source."""
    return bpe.encode(docs, tokenizer_definition())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_poor),
    ("SimHash near duplicates", drop_near_copies),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

# Exact token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
