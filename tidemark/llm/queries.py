"""One registered query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, balltree, katz, leaks, lines, mixing, ordinal, pagetext, pii, quality, repeats, simhash, urls
from tidemark.llm.common import table


def op1_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_scores(table(spark, folder, "documents"))


def op2_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_digest(table(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_digest(table(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_digest(table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_digest(table(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.url_digest(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal.classify_digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_digest(table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return balltree.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_extract_text(spark: SparkSession, folder: str) -> DataFrame:
    return pagetext.extract_text(table(spark, folder, "pages"))


def op13_align_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_digest(table(spark, folder, "documents"))


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_katz_scores, op2_simhash_dedup, op3_decontaminate, op4_personal_data, op5_quality_rules,
        op6_mix_sources, op7_line_dedup, op8_url_filter, op9_quality_classifier, op10_substring_dedup, op11_ranked_search, op12_extract_text, op13_align_tokens,
    )
}

STATEMENTS: dict[str, str] = {
    "op5_quality_rules": quality.QUALITY_SQL,
    "op7_line_dedup": lines.LINE_SQL,
    "op8_url_filter": urls.URL_SQL,
    "op10_substring_dedup": repeats.REPEAT_SQL,
    "op11_ranked_search": balltree.RANK_SQL,
}
