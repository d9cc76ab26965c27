"""The queries ``opN_<name>``: each applies an operator to its whole table. SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusq.llm import exact_dedup, html_text, packing, piece_scan, pii, quality_classifier, quality_rules, range_coder, simhash, warc
from corpusq.llm.common import read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(read_table(spark, sf_dir, "documents"))


def op3_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return range_coder.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_scan.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read_table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_exact_dedup, op2_quality_rules, op3_range_coder, op4_piece_scan, op5_warc, op6_best_fit_packing, op7_html_text, op8_simhash, op9_quality_classifier, op10_pii)}
