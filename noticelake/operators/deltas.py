"""Change deltas: what each update notice changes in the notice it names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.keys import leading_section_number, notice_number
from noticelake.functions.parsers import REGISTRY
from noticelake.profiles import Profile, table_name
from noticelake.sources.tables import delete_partitions, overwrite_partitions


def years_referred(core: DataFrame) -> list[str]:
    """Years whose notices an index needs for these updates: those of the numbers and of the updates' own days, and the year before each. A few values, read by the driver."""
    number, own = F.substring(notice_number("section_3_2"), 1, 4), F.substring("publicationDateDay", 1, 4)
    years = core.select(F.explode(F.array(number.try_cast("int"), own.try_cast("int"))).alias("y")).where("y is not null").distinct()
    return sorted({str(y) for r in years.collect() for y in (r.y - 1, r.y)})


def number_index(envelope: DataFrame, years: Sequence[str] | None = None) -> DataFrame:
    """(bzp_number, target_id, target_type, target_day): the earliest notice of each number, ties by objectId; blank numbers are skipped. Only notices of ``years`` if given."""
    if years is not None:
        envelope = envelope.where(F.substring("publicationDateDay", 1, 4).isin(*years) if years else F.lit(False))
    e = envelope.select(notice_number("bzpNumber").alias("bzp_number"), "objectId", "noticeType", "publicationDateDay").where("bzp_number is not null")
    return e.groupBy("bzp_number").agg(F.min(F.struct("publicationDateDay", "objectId", "noticeType")).alias("t")).select("bzp_number", F.col("t.objectId").alias("target_id"), F.col("t.noticeType").alias("target_type"), F.col("t.publicationDateDay").alias("target_day"))


def resolve(core: DataFrame, index: DataFrame) -> DataFrame:
    """(objectId, bzp_number, target_id, target_type, target_day) of updates whose number resolves, with publicationDateDay if ``core`` has it."""
    day = [F.max("publicationDateDay").alias("publicationDateDay")] if "publicationDateDay" in core.columns else []
    c = core.withColumn("bzp_number", notice_number("section_3_2")).where("bzp_number is not null").groupBy("objectId").agg(F.max("bzp_number").alias("bzp_number"), *day)
    return c.join(index, "bzp_number")


def build_deltas(core: DataFrame, parts: DataFrame, items: DataFrame, index: DataFrame, profiles: Sequence[Profile]) -> DataFrame:
    """One row a resolved update: its target, ``section_changes`` in order, ``changed`` (column -> parsed value as text) and ``parse_errors`` (JSON, null if none).

    The last change of a column counts, by (part_ordinal, part_part_ordinal) and, where rows differ under these, the greatest text: a null overwrites, a success clears an earlier error. Updates without changes
    have empty ones; changes of sections that are no core column of the target's type stay in ``section_changes`` alone.
    """
    r = resolve(core, index)
    p = parts.groupBy("objectId", "part_ordinal").agg(F.max("section_3_4").alias("prefix"))
    fields = ["section_3_4_1_label", "section_3_4_1_before", "section_3_4_1_after"]
    i = items.select("objectId", "part_ordinal", "part_part_ordinal", *fields).distinct().join(p, ["objectId", "part_ordinal"], "left").withColumn("prefix", F.coalesce("prefix", F.lit("")))
    change = F.struct("part_ordinal", "part_part_ordinal", "prefix", *[F.col(f).alias(f.rsplit("_", 1)[1]) for f in fields])
    lists = i.groupBy("objectId").agg(F.array_sort(F.collect_list(change)).alias("section_changes"))
    per_section: dict[str, list[str]] = {}
    for q in profiles:
        if q.notice_type == "NoticeUpdateNotice":
            continue
        for s in q.sections:
            if s.model == "core":
                per_section[f"{q.notice_type}|{s.number}"] = [f"{c}|{fn or ''}" for c, fn in (list(s.derived.items()) or [(s.column, s.parser)])]
    lookup = F.create_map(*[x for k, v in per_section.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    m = i.join(r.select("objectId", "target_type"), "objectId").select("objectId", "part_ordinal", "part_part_ordinal", F.col("section_3_4_1_after").alias("after"), F.explode(F.try_element_at(lookup, F.concat_ws("|", "target_type", leading_section_number("section_3_4_1_label")))).alias("_to"))
    m = m.withColumns({"column": F.split_part("_to", F.lit("|"), F.lit(1)), "fn": F.split_part("_to", F.lit("|"), F.lit(2))})
    value, error = F.col("after"), F.lit(None).cast("string")
    for name in sorted({x.split("|")[1] for v in per_section.values() for x in v} - {""}):
        if name in REGISTRY:
            q = REGISTRY[name][0](F.col("after"))
            as_text, failure = F.to_json(q.value) if REGISTRY[name][1].startswith("array") else q.value.cast("string"), q.error
        else:  # the text as it is, and an error
            as_text, failure = F.col("after"), F.when(F.col("after").isNotNull(), F.lit(f"{name}: unknown parser"))
        value, error = F.when(F.col("fn") == name, as_text).otherwise(value), F.when(F.col("fn") == name, failure).otherwise(error)
    last = m.select("objectId", "column", F.struct("part_ordinal", "part_part_ordinal", "after").alias("_at"), value.alias("value"), error.alias("error")).groupBy("objectId", "column").agg(F.max_by(F.struct("value", "error"), "_at").alias("v"))
    wide = last.groupBy("objectId").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "v.value")))).alias("changed"), F.array_sort(F.collect_list(F.when(F.col("v.error").isNotNull(), F.struct("column", "v.error")))).alias("_e"))
    wide = wide.select("objectId", "changed", F.when(F.size("_e") > 0, F.to_json(F.map_from_entries("_e"))).alias("parse_errors"))
    out = r.join(lists, "objectId", "left").join(wide, "objectId", "left")
    empty = F.array().cast(lists.schema["section_changes"].dataType)
    return out.withColumns({"section_changes": F.coalesce("section_changes", empty), "changed": F.coalesce("changed", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))})


#: Types of typed delta columns that differ from those of section tables.
WIDER = {"int": "bigint"}


def delta_columns(profile: Profile) -> dict[str, str]:
    """Column -> Spark type of a type's deltas: its core sections and what derives from them."""
    out: dict[str, str] = {}
    for s in profile.sections:
        if s.model == "core":
            for column, fn in list(s.derived.items()) or [(s.column, s.parser)]:
                kind = REGISTRY[fn][1] if fn in REGISTRY else "string"
                out[column] = WIDER.get(kind, kind)
    return out


def typed_deltas(deltas: DataFrame, profile: Profile) -> DataFrame:
    """The deltas of notices of one type, a typed column for each core column of its profile: null is unchanged, or changed to nothing (``changed_columns`` tells), of what was found by ``build_deltas``."""

    def column(name: str, kind: str) -> Column:
        text = F.try_element_at("changed", F.lit(name))
        return (F.from_json(text, kind) if kind.startswith("array") else text.try_cast(kind)).alias(name)

    own = deltas.where(F.col("target_type") == profile.notice_type)
    plain = ["objectId", "bzp_number", "target_id", "target_type", "target_day", *[c for c in ("publicationDateDay",) if c in deltas.columns]]
    return own.select(*plain, *[column(n, k) for n, k in delta_columns(profile).items()], F.map_keys("changed").alias("changed_columns"), "section_changes", "parse_errors")


def write_deltas(deltas: DataFrame, root: str, profiles: Sequence[Profile], days: Sequence[str]) -> None:
    """Write ``deltas`` (with ``publicationDateDay``) as one table a target type under ``root``, partitioned by day. What the days held before goes, also of types that have none now."""
    spark = deltas.sparkSession
    for p in profiles:
        path = f"{root}/{table_name(p.notice_type, 'delta', 'core')}"
        delete_partitions(spark, path, publicationDateDay=list(days))
        overwrite_partitions(typed_deltas(deltas, p).where(F.col("publicationDateDay").isin(*days)), path, ["publicationDateDay"])


def delta_stats(core: DataFrame, index: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """n_updates, n_resolved and n_unresolved (readable number without a notice), n_no_number; with ``types`` also n_unresolved_type (resolved to a type not among them)."""
    c = core.select("objectId", notice_number("section_3_2").alias("bzp_number")).groupBy("objectId").agg(F.max("bzp_number").alias("bzp_number"))
    j = c.join(index, "bzp_number", "left")
    other = [] if types is None else [F.count_if(F.col("target_id").isNotNull() & ~F.coalesce(F.col("target_type").isin(*types), F.lit(False))).alias("n_unresolved_type")]
    return j.agg(F.count("*").alias("n_updates"), F.count("target_id").alias("n_resolved"), F.count_if(F.col("bzp_number").isNotNull() & F.col("target_id").isNull()).alias("n_unresolved"), F.count_if(F.col("bzp_number").isNull()).alias("n_no_number"), *other)
