"""Queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, licenses, lm, media, mixing, ngram_join, pii, quality, substring
from .workspace import table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def text_crc_mod(column: str, m: int):
    """crc32 of the id as text, modulo m (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_next(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", text_crc_mod("doc_id", 3) != 1)
    out = quality.scored(docs, model)
    return out.select("doc_id", (text_crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_paths(table(spark, sf_dir, "documents")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}
    return own | {"pipeline": importlib.import_module("corpus_pipeline").run}


def oracle_sql() -> dict[str, str]:
    out = {"op5_mixing": mixing.replicate_sql("documents", "*"), "op8_licenses": licenses.scan_sql()}
    pipeline = importlib.import_module("corpus_pipeline").ORACLE_SQL
    return out | ({"pipeline": pipeline} if pipeline else {})
