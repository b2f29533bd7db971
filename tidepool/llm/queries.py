"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import (bpe, decontaminate, html_extract, ngram_join, phrases, pii, quality, substring, token_align, topk,
                          urlfilter, warc, wordpiece)
from tidepool.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "byte_bpe_50k.tiktoken"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_pages(table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                public_tokenizers.PATTERN)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_url_filters": op2_url_filters,
    "op3_pii": op3_pii,
    "op4_warc": op4_warc,
    "op5_html_text": op5_html_text,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_ngram_join": op7_ngram_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_exact_topk": op11_exact_topk,
    "op12_phrases": op12_phrases,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op2_url_filters": urlfilter.ORACLE_SQL,
    "op4_warc": warc.ORACLE_SQL,
    "op7_ngram_join": ngram_join.ORACLE_SQL,
    "op10_quality_rules": quality.ORACLE_SQL,
    "op11_exact_topk": topk.oracle_sql(every=50, k=5),
    "op12_phrases": phrases.oracle_sql(),
}
