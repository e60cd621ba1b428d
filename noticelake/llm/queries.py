"""Queries of the training-data operators over the notice tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm import canonical, packing, redelivery, spellings, splitting, tokens, truncation
from noticelake.runtime import table

#: Ranges of batch_no that p7_found takes in one after the other.
RANGES = 2


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return canonical.map_places(t("common_envelope"), t("city_reference"), t("country_reference"))


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return canonical.unmatched_report(t("common_envelope"), t("city_reference"), t("country_reference"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "bronze_notices"))


def p4_share(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_share(table(spark, d, "bronze_notices"))


def p4_evidence(spark: SparkSession, d: str) -> DataFrame:
    return truncation.evidence_report(table(spark, d, "bronze_notices"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return spellings.same_names(table(spark, d, "common_envelope"))


def p6_entities(spark: SparkSession, d: str) -> DataFrame:
    return spellings.entities(table(spark, d, "common_envelope"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Ranges of batch_no taken in one after the other, each against the index kept of the ranges before."""
    return redelivery.redelivered(table(spark, d, "bronze_notices"), RANGES)


def p7_at_once(spark: SparkSession, d: str) -> DataFrame:
    """As p7_found, all taken in as one batch."""
    return redelivery.redelivered(table(spark, d, "bronze_notices"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p9_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(packing.pack(table(spark, d, "documents")))


def p10_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_corpus(table(spark, d, "documents"))


def p10_report(spark: SparkSession, d: str) -> DataFrame:
    """Pieces by what they end at."""
    return splitting.split_corpus(table(spark, d, "documents")).groupBy("boundary").agg(F.count("*").alias("n_pieces"), F.max("n_tokens").alias("most_tokens"))


QUERIES = {f.__name__: f for f in (p2_found, p2_unmatched, p4_found, p4_share, p4_evidence, p6_found, p6_entities, p7_found, p7_at_once, p8_ids, p9_pack, p9_fill, p10_split, p10_report)}

SQL: dict[str, str] = {}
