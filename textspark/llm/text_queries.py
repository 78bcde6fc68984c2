"""Queries that look at each text: language model, quality, license notices, language, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textspark.llm.encoding import encoding_report
from textspark.llm.langid import languages
from textspark.llm.licenses import notices
from textspark.llm.mixing import language_scores
from textspark.llm.quality import quality_scores
from textspark.llm.queries import query
from textspark.sources.tables import read_table


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(read_table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_report(read_table(spark, sf_dir, "documents"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices(read_table(spark, sf_dir, "documents"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read_table(spark, sf_dir, "documents"))
