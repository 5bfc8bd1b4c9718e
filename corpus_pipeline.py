"""Corpus pipeline: reject, deduplicate, redact, mix, tokenise.

``STAGES`` are applied in order to ``documents``; each stage's rows are written as
Parquet in the shared folder and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import bpe, mixing, ngram_join, pii, quality
from cadenza.llm.workspace import Workspace, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score from 0.5 on stays)."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality")
    return quality.scored(docs, model, "__score").filter("__score >= 0.5").select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shared 5-word shingles, the one of least id."""
    return ngram_join.keep_first(docs).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes the name of its kind; ``n_chars`` follows the text."""
    from pyspark.sql import functions as F

    return pii.redacted(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn for their source's target weight, in global random order."""
    return mixing.replicate(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    out = bpe.encoded(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    return out.select("doc_id", "lang", "source", "n_chars", "token_ids")


STAGES = [("quality", classify), ("near_duplicates", deduplicate), ("pii", redact), ("mixing", mix), ("bpe", encode)]

#: Stages fit a model, match regular expressions by code point and join by similarity: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = space.keep(docs, name)
            if i:
                space.drop(STAGES[i - 1][0])
    return docs
