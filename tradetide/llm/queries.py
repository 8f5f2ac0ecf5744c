"""The subpackage's queries with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradetide.llm import (
    bpe, chat, embeddings, filter_audit, language_id, main_text, mixing, quality, repeats, secret_scan, sharding, simhash,
    spelling)
from tradetide.llm.oracle import ORACLE  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_definition(path: str | None = None) -> str:
    """The production tokenizer's JSON, from a path or from the installed vocabularies."""
    if path is None:
        import public_tokenizers

        path = os.environ.get("BPE_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")
    return bpe.read_definition(path)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"), tokenizer_definition()).drop("n_tokens")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_definition())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = main_text.extract(table(spark, sf_dir, "pages"), main_text.fit(spark))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.classes(table(spark, sf_dir, "embeddings"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def piece_vocabulary(path: str | None = None) -> list[bytes]:
    """The pieces of the production vocabulary, from a path or from the installed ones."""
    if path is None:
        import public_tokenizers

        path = os.environ.get("LANGUAGE_PIECES") or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return language_id.read_pieces(path)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"), piece_vocabulary())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_secrets": op2_secrets,
    "op3_html": op3_html,
    "op4_embeddings": op4_embeddings,
    "op5_repeats": op5_repeats,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op8_chat": op8_chat,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling": op12_spelling,
    "op13_language": op13_language,
}
