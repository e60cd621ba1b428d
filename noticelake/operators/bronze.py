"""Bronze layer: deduplication, validation and hashing of raw notices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.functions.text import blank, strip, strip_end

# Notice types that are accepted.
NOTICE_TYPES = (
    "ContractNotice", "ContractPerformingNotice", "TenderResultNotice", "NoticeUpdateNotice", "AgreementUpdateNotice", "AgreementIntentionNotice", "SmallContractNotice",
    "CompetitionNotice", "CompetitionResultNotice", "ConcessionNotice", "ConcessionAgreementNotice", "NoticeUpdateConcession", "ConcessionUpdateAgreementNotice",
    "ConcessionIntentionAgreementNotice", "CircumstancesFulfillmentNotice",
)
REQUIRED = ("objectId", "noticeType", "noticeNumber", "bzpNumber", "publicationDate", "cpvCode", "htmlBody", "organizationName", "organizationCity", "organizationCountry", "organizationNationalId", "organizationId", "isTenderAmountBelowEU")


def first_seen(df: DataFrame, key: str, order: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``df`` with ``drop_reason``: null for rows that are kept, ``in_input`` for repeats of a key, ``known`` for keys of ``known`` (one column, ``key``).

    Keys are compared stripped; rows whose key is null or blank are always kept. The first row by ``order`` (which should be total) is kept. A repeat
    is found with an aggregate, not a window, so that a hot key is no single task.
    """
    k = F.nullif(strip(key), F.lit(""))
    rows = df.withColumn("_key", k).withColumn("_at", F.struct(*order))
    first = rows.where("_key is not null").groupBy("_key").agg(F.min("_at").alias("_first"))
    out = rows.join(first, "_key", "left")
    old = F.lit(False)
    if known is not None:
        ids = known.select(strip(known.columns[0]).alias("_key")).where("_key <> ''").distinct().withColumn("_old", F.lit(True))
        out = out.join(ids, "_key", "left")
        old = F.coalesce("_old", F.lit(False))
    reason = F.when(F.col("_key").isNull(), F.lit(None)).when(F.col("_at") > F.col("_first"), "in_input").when(old, "known")
    return out.select(*df.columns, reason.alias("drop_reason"))


def dedup_stats(flagged: DataFrame) -> DataFrame:
    """input, output, dropped_in_input and dropped_other_day of ``first_seen``."""
    n = lambda c: F.count_if(c)
    r = F.col("drop_reason")
    return flagged.agg(F.count("*").alias("n_input"), n(r.isNull()).alias("n_output"), n(r == "in_input").alias("n_in_input"), n(r == "known").alias("n_known"))


def validation_errors(columns: Sequence[str]) -> Column:
    """array<string> of what is wrong with a raw notice, empty if nothing: required fields, known type, closed page, contractors that are records."""
    rules = [F.when(F.col(c).isNull(), f"{c}: field required") for c in REQUIRED if c in columns]
    rules += [F.lit(f"{c}: field required") for c in REQUIRED if c not in columns]
    if "noticeType" in columns:
        rules.append(F.when(~F.col("noticeType").isin(*NOTICE_TYPES), "noticeType: unknown type"))
    if "htmlBody" in columns:
        rules.append(F.when(~strip_end("htmlBody").endswith("</html>"), "htmlBody: page is not closed"))
    if "contractors" in columns:
        rules.append(F.when(F.exists("contractors", lambda c: c.isNull()), "contractors: item is no record"))
    return F.array_compact(F.array(*rules))


def _sorted_keys(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*[_sorted_keys(c[f.name], f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda e: _sorted_keys(e, kind.elementType))
    return c


def record_hash(schema: T.StructType) -> Column:
    """SHA-256 of the canonical JSON of a record with these fields: keys sorted at every depth, nulls included."""
    fields = sorted(schema.fields, key=lambda f: f.name)
    return F.sha2(F.to_json(F.struct(*[_sorted_keys(F.col(f.name), f.dataType).alias(f.name) for f in fields]), {"ignoreNullFields": "false"}), 256)


def html_hash(body: Column | str) -> Column:
    """SHA-256 of a page; null for none."""
    return F.sha2(body, 256)


def first_days(batch: DataFrame, key: str, day: str, order: Sequence[str], valid: Column, before: DataFrame | None = None) -> DataFrame:
    """``batch``, the days of a range, with ``drop_reason`` as ``first_seen``: ``in_input`` for repeats within a day, ``known`` for keys of an earlier day.

    A key counts as known from a day on if ``before`` (one column: the keys of days before the range) has it, or if the first row of it on an earlier day of the
    range is kept there and ``valid`` (of its row, null counting as false). Two aggregates stand for the run through the days: the first row of each key a day, and
    the first day whose first row is valid; no earlier day can have dropped that row, or the key had been known by then.
    """
    k = F.nullif(strip(key), F.lit(""))
    rows = batch.withColumn("_key", k).withColumn("_at", F.struct(*order)).withColumn("_ok", F.coalesce(valid, F.lit(False)))
    firsts = rows.where("_key is not null").groupBy("_key", F.col(day).alias("_day")).agg(F.min(F.struct("_at", "_ok")).alias("_f"))
    taken = firsts.where("_f._ok").groupBy("_key").agg(F.min("_day").alias("_taken"))
    out = rows.join(firsts.select("_key", F.col("_day").alias(day), F.col("_f._at").alias("_first")), ["_key", day], "left").join(taken, "_key", "left")
    old = F.coalesce(F.col("_taken") < F.col(day), F.lit(False))
    if before is not None:
        ids = before.select(strip(before.columns[0]).alias("_key")).where("_key <> ''").distinct().withColumn("_old", F.lit(True))
        out = out.join(ids, "_key", "left")
        old = old | F.coalesce("_old", F.lit(False))
    reason = F.when(F.col("_key").isNull(), F.lit(None)).when(F.col("_at") > F.col("_first"), "in_input").when(old, "known")
    return out.select(*batch.columns, reason.alias("drop_reason"))


def day_rows(df: DataFrame, day: str, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``drop_reason`` as at the time of fetching: ``other_day`` for rows not published on ``day``, ``duplicate`` for repeats of a key among the rest.

    Keys are compared as they are, without stripping; null and empty ones are never repeats.
    """
    here = F.coalesce(F.substring("publicationDate", 1, 10) == F.lit(day), F.lit(False))
    k = F.nullif(F.col(key), F.lit(""))
    rows = df.withColumn("_key", F.when(here, k)).withColumn("_at", F.struct(*order)).withColumn("_here", here)
    first = rows.where("_key is not null").groupBy("_key").agg(F.min("_at").alias("_first"))
    reason = F.when(~F.col("_here"), "other_day").when(F.col("_at") > F.col("_first"), "duplicate")
    return rows.join(first, "_key", "left").select(*df.columns, reason.alias("drop_reason"))


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows that are not repeats (see ``first_seen``)."""
    return first_seen(df, key, order).where("drop_reason is null").drop("drop_reason")


def latest(df: DataFrame, by: Sequence[str], at: str, ties: Sequence[str] = ()) -> DataFrame:
    """The latest row of each key, by ``at`` and then by ``ties``; one of fully equal rows."""
    rest = [c for c in df.columns if c not in by]
    top = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(at, *ties)).alias("_r"))
    return top.select(*by, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def same_day(df: DataFrame, day: Column) -> DataFrame:
    """Rows published on ``day`` as written; null and blank dates are dropped."""
    return df.where(F.coalesce(F.substring("publicationDate", 1, 10) == day, F.lit(False)) & ~blank("publicationDate"))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with each row's place from 1 within its key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
