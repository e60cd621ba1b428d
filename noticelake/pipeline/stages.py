"""The stages: raw days to bronze, bronze to section tables, envelope and quarantine, and changes to deltas. Each does a whole range of days in one plan a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.operators import bronze, contracts, deltas, sections
from noticelake.operators.envelope import build_envelope, publication_day
from noticelake.profiles import Profile, table_name
from noticelake.runtime import cut
from noticelake.sources import raw, tables

DAY = "publicationDateDay"


@dataclass(frozen=True)
class Places:
    """Folders of the layers."""

    raw: str
    bronze: str
    silver: str
    errors: str
    deltas: str


def build_bronze(spark: SparkSession, places: Places, start: str, end: str) -> dict[str, int]:
    """Raw files of a range of days into the bronze table: repeats within a file and of earlier days dropped, what is not valid kept in ``errors``, the days' partitions replaced. Counts of each.

    Earlier days are those before the range in the table, and within the range those of valid notices.
    """
    days = raw.days_between(start, end)
    rows = raw.read_days(spark, places.raw, days)
    rows = rows.withColumns({"_file_day": F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})", 1), "_errors": bronze.validation_errors(rows.columns)})
    before = None
    if tables.partition_values(spark, places.bronze, "noticeType", DAY):
        before = tables.read(spark, places.bronze).where(F.col(DAY) < start).select("objectId")
    flagged = cut(bronze.first_days(rows, "objectId", "_file_day", ["file", "pos"], F.size("_errors") == 0, before))
    kept = flagged.where("drop_reason is null")
    good = kept.where(F.size("_errors") == 0).drop("drop_reason", "_errors", "file", "pos")
    kinds = good.drop("_file_day").schema
    # the day a notice is filed under is that of its publication; one without goes by its file
    good = good.withColumns({"recordHash": bronze.record_hash(kinds), DAY: F.coalesce(publication_day("publicationDate"), "_file_day")}).drop("_file_day")
    tables.delete_days(spark, places.bronze, start, end)
    tables.write_table(good, places.bronze, ["noticeType", DAY])
    bad = kept.where(F.size("_errors") > 0).select("file", "pos", "objectId", F.col("_errors").alias("errors"), F.to_json(F.struct(*kinds.fieldNames())).alias("raw"), F.col("_file_day").alias("day"))
    tables.delete_days(spark, places.errors, start, end, "day")
    tables.overwrite_partitions(bad, places.errors, ["day"])
    c = flagged.agg(F.count("*").alias("raw"), F.count_if(F.col("drop_reason") == "in_input").alias("in_input"), F.count_if(F.col("drop_reason") == "known").alias("known"), F.count_if(F.col("drop_reason").isNull()).alias("after_dedup"), F.count_if(F.col("drop_reason").isNull() & (F.size("_errors") == 0)).alias("valid")).first()
    return c.asDict()


def bronze_rates(counts: Mapping[str, int]) -> dict[str, float]:
    """valid_rate (of what was left after deduplication) and dedup_cross_day_rate (of all), 0.0 where there is nothing to divide by."""
    part = lambda a, b: counts[a] / counts[b] if counts[b] else 0.0
    return {"valid_rate": part("valid", "after_dedup"), "dedup_cross_day_rate": part("known", "raw")}


def build_silver(spark: SparkSession, places: Places, start: str, end: str, profiles: Mapping[str, Profile], client_types: Mapping[str, str], provinces: Mapping[str, str], types: Sequence[str] | None = None, layer: str = "auto", rules: Mapping[tuple[str, str, str], Mapping[str, F.Column]] | None = None) -> DataFrame:
    """Section tables of every type with a profile, the envelope and the quarantine of a range of days, their partitions replaced. The quarantine's rows are given back.

    ``types`` limits the run to some types, ``rules`` gives extra contract rules by (type, entity, leaf). Pages are tokenized once for all types. A table whose columns miss its contract's is not written:
    ValueError.
    """
    notices = raw.bronze_or_raw(spark, places.bronze, places.raw, start, end, layer)
    if types is not None:
        notices = notices.where(F.col("noticeType").isin(*types))
    own = [p for t, p in profiles.items() if types is None or t in types]
    pages = notices.select("objectId", DAY, "noticeType", "htmlBody")
    rows = cut(sections.heading_rows(pages, own))
    placed = cut(sections.assign(rows))
    days = raw.days_between(start, end)
    day = pages.groupBy("objectId").agg(F.min(DAY).alias(DAY))
    held = sections.quarantine(rows, pages, own)
    for p in own:
        tables.delete_type(spark, places.silver, p.notice_type, days)
        for (entity, leaf), t in sections.section_tables(pages, rows, p, placed=placed).items():
            typed = sections.typed(t, p, entity, leaf)
            gap = contracts.drift(typed, contracts.contract(p, entity, leaf))
            if gap:
                raise ValueError(f"{p.notice_type} {entity}.{leaf}: missing {gap.missing}, other type {gap.other_type}")
            tables.write_table(typed.join(day, "objectId"), f"{places.silver}/{table_name(p.notice_type, entity, leaf)}", [DAY])
            extra = (rules or {}).get((p.notice_type, entity, leaf))
            if extra:
                model = entity if leaf == "core" else f"{entity}_{leaf}"
                held = held.unionByName(contracts.violations(typed.withColumn("noticeType", F.lit(p.notice_type)), extra, data_model=model))
    envelope = build_envelope(notices, dict(client_types), dict(provinces))
    if types is None:
        tables.delete_days(spark, f"{places.silver}/common_envelope", start, end)
        tables.write_table(envelope, f"{places.silver}/common_envelope", [DAY])
    held = held.join(day, "objectId", "left")
    tables.overwrite_partitions(held, f"{places.silver}/quarantine", [DAY, "noticeType"])
    return held


def build_deltas(spark: SparkSession, places: Places, start: str, end: str, profiles: Mapping[str, Profile]) -> dict[str, int]:
    """Deltas of the update notices of a range of days, one table a target type, the days replaced; counts of updates and how they resolved. Missing section tables count as empty."""
    at = lambda model: f"{places.silver}/{table_name('NoticeUpdateNotice', *model)}"
    core = tables.read_days(spark, at(("core", "core")), start, end, schema=f"objectId string, section_3_2 string, {DAY} string")
    parts = tables.read_days(spark, at(("part", "core")), start, end, schema=f"objectId string, part_ordinal int, section_3_4 string, {DAY} string")
    items = tables.read_days(spark, at(("part", "part")), start, end, schema=f"objectId string, part_ordinal int, part_part_ordinal int, section_3_4_1_label string, section_3_4_1_before string, section_3_4_1_after string, {DAY} string")
    envelope = tables.read(spark, f"{places.silver}/common_envelope")
    index = cut(deltas.number_index(envelope, deltas.years_referred(core)))
    found = deltas.build_deltas(core, parts, items, index, list(profiles.values()))
    targets = [p for t, p in profiles.items() if t != "NoticeUpdateNotice"]
    deltas.write_deltas(cut(found), places.deltas, targets, raw.days_between(start, end))
    return deltas.delta_stats(core, index, [p.notice_type for p in targets]).first().asDict()
