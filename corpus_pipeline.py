"""A training-data pipeline over ``documents``: rules, near duplicates, decontamination, pseudonyms, tokens.

``STAGES`` are (name, function) pairs; a function takes the session, the
documents that the stage before kept, and the folder of the tables. Each
stage's result is a Parquet table in the shared folder that the next one reads,
so a lost executor costs at most a part of one stage. All but the last stage
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, decontaminate, ngram_join, pii, quality
from tidepool.llm.common import table, written
from tidepool.llm.queries import RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, and all others."""
    return ngram_join.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a near copy of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the new text."""
    out = pii.pseudonymized(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of byte-BPE tokens, and digests of the ids and of the decoded text."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("tokens", tokens),
]

#: Near duplicates, pseudonyms and BPE are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
