"""A training corpus from ``documents``: good text, without near copies and benchmark passages, mixed, as token ids.

Every stage takes the session, the documents left by the stage before, and the folder of tables; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, near_dedup, quality_classifier, token_output
from tidemark.llm.common import table
from tidemark.llm.queries import vocabulary
from tidemark.session import materialise, scratch_path

# Shares of tokens after mixing; the total is such that plain text keeps all its tokens. Junk is gone by then.
SHARES = {"plain": 0.98, "toxic": 0.02}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality_classifier.keep_good(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture asks for."""
    domains = mixing.fit_domains(docs, table(spark, sf_dir, "labels"), F.col("toxic"), list(SHARES))
    return mixing.mix(docs, domains, SHARES, "plain")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; per document its place in them and a checksum of its ids as read back."""
    path = scratch_path(spark, "corpus-tokens")
    token_output.write_tokens(docs, path, vocabulary())
    return token_output.digests(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", token_ids),
]

# Fitted models and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
