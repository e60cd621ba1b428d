"""Queries of the core's data-processing operators over the notice tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.operators import change_feed, inlining, references
from noticelake.runtime import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return change_feed.current_sections(t("notice_update_core"), t("notice_update_part_part"), ()).select("bzp_number", "section_number", "object_id", "part_ordinal", "part_part_ordinal")


def p1_contents(spark: SparkSession, d: str) -> DataFrame:
    """Length and hash of every section's content in force."""
    t = lambda n: table(spark, d, n)
    r = change_feed.current_sections(t("notice_update_core"), t("notice_update_part_part"))
    return r.select("bzp_number", "section_number", F.length("after").cast("bigint").alias("n_chars"), F.sha2("after", 256).alias("content_hash"))


def p1_images(spark: SparkSession, d: str) -> DataFrame:
    """What the feed's own before- and after-images leave of every section, by hash."""
    t = lambda n: table(spark, d, n)
    r = change_feed.section_images(t("notice_update_core"), t("notice_update_part_part"))
    return r.select("bzp_number", "section_number", F.sha2("image", 256).alias("image_hash"), "n")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return references.notice_orphans(t("notice_update_core"), t("common_envelope"), t("procedure_register"), t("withdrawn_keys"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per referring table, month and kind."""
    return p3_found(spark, d).groupBy("source_table", "period", "orphan_kind").agg(F.count("*").alias("n_orphans"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return inlining.notice_items(table(spark, d, "bronze_notices"))


def p5_contractors(spark: SparkSession, d: str) -> DataFrame:
    """The contractors table with all its columns."""
    b = table(spark, d, "bronze_notices").select("ingest_id", "contractors")
    t = inlining.shared_inline(b, "ingest_id")["contractors"]
    return t.select("ingest_id", F.col("ordinals")[0].cast("bigint").alias("ordinal"), "contractorName", "contractorCity", "contractorProvince", "contractorCountry", "contractorNationalId")


QUERIES = {f.__name__: f for f in (p1_found, p1_contents, p1_images, p3_found, p3_report, p5_found, p5_contractors)}

_NANOS = r"(epoch_us(try_cast(regexp_replace({0}, '[.][0-9]+', '') AS TIMESTAMPTZ)) * 1000 + CAST(rpad(regexp_extract({0}, '[.]([0-9]+)', 1), 9, '0') AS BIGINT))"
_NUMBER = r"nullif(regexp_replace(regexp_extract(upper({0}), '(\d{{4}}[\s\x{{a0}}]*/[\s\x{{a0}}]*BZP[\s\x{{a0}}]*\d{{8}})', 1), '^(\d{{4}}).*(\d{{8}})$', '\1/BZP \2'), '')"
_BLANK = r"regexp_full_match({0}, '[\s\x{{a0}}]*')"

_CHANGES = rf"""
WITH head AS (SELECT objectId, max({_NANOS.format("publicationDate")}) AS at_ns, max({_NUMBER.format("section_3_2")}) AS bzp_number FROM notice_update_core GROUP BY objectId),
items AS (
  SELECT DISTINCT objectId, part_ordinal, part_part_ordinal, section_3_4_1_after AS after,
    nullif(regexp_replace(regexp_extract(section_3_4_1_label, '\d+([\s\x{{a0}}]*[.][\s\x{{a0}}]*\d+)+', 0), '[\s\x{{a0}}]', '', 'g'), '') AS section_number,
    CASE WHEN lower(change_op) IN ('d', 'delete', 'usunięcie') THEN true WHEN change_op IS NULL THEN coalesce({_BLANK.format("section_3_4_1_after")}, true) ELSE false END AS gone
  FROM notice_update_part_part),
ranked AS (
  SELECT bzp_number, section_number, objectId AS object_id, part_ordinal, part_part_ordinal, gone, after,
    row_number() OVER (PARTITION BY bzp_number, section_number ORDER BY at_ns DESC, part_ordinal DESC, part_part_ordinal DESC, objectId DESC) AS rn
  FROM items JOIN head USING (objectId) WHERE bzp_number IS NOT NULL AND section_number IS NOT NULL)
"""

_EDGE = r"nullif(regexp_replace({0}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g'), '')"
_IMAGES = rf"""
, feed AS (
  SELECT DISTINCT bzp_number, section_number, at_ns, i.objectId, i.part_ordinal, i.part_part_ordinal, {_EDGE.format("section_3_4_1_before")} AS before,
    CASE WHEN lower(change_op) IN ('d', 'delete', 'usunięcie') OR (change_op IS NULL AND coalesce({_BLANK.format("section_3_4_1_after")}, true)) THEN NULL ELSE {_EDGE.format("section_3_4_1_after")} END AS after
  FROM (SELECT *, nullif(regexp_replace(regexp_extract(section_3_4_1_label, '\d+([\s\x{{a0}}]*[.][\s\x{{a0}}]*\d+)+', 0), '[\s\x{{a0}}]', '', 'g'), '') AS section_number FROM notice_update_part_part) i JOIN head USING (objectId)
  WHERE bzp_number IS NOT NULL AND section_number IS NOT NULL),
first AS (SELECT bzp_number, section_number, before FROM (SELECT *, row_number() OVER (PARTITION BY bzp_number, section_number ORDER BY at_ns NULLS FIRST, part_ordinal NULLS FIRST, part_part_ordinal NULLS FIRST, objectId, before NULLS FIRST) AS rn FROM feed) WHERE rn = 1),
signed AS (SELECT bzp_number, section_number, before AS image, 1 AS k FROM first UNION ALL SELECT bzp_number, section_number, before, -1 FROM feed UNION ALL SELECT bzp_number, section_number, after, 1 FROM feed)
SELECT bzp_number, section_number, sha256(image) AS image_hash, CAST(sum(k) AS BIGINT) AS n FROM signed WHERE image IS NOT NULL GROUP BY bzp_number, section_number, image HAVING sum(k) > 0
"""
_KEY = _NUMBER
_ORPHANS = rf"""
WITH notices AS (SELECT coalesce({_KEY.format("bzpNumber")}, upper(trim(bzpNumber))) AS key, min({_NANOS.format("publicationDate")}) AS from_ns FROM common_envelope GROUP BY 1),
procedures AS (SELECT lower(trim(tenderId)) AS key, min(epoch_us(registered_at) * 1000) AS from_ns FROM procedure_register GROUP BY 1),
gone AS (SELECT key_kind, CASE key_kind WHEN 'tenderId' THEN lower(trim(key_value)) ELSE {_KEY.format("key_value")} END AS key, min(epoch_us(withdrawn_at) * 1000) AS to_ns FROM withdrawn_keys GROUP BY 1, 2),
refs AS (
  SELECT 'notice_update_core' AS source_table, objectId AS object_id, substr(publicationDateDay, 1, 7) AS period, 'bzpNumber' AS kind, coalesce({_KEY.format("section_3_2")}, upper(trim(section_3_2))) AS key, {_NANOS.format("publicationDate")} AS at_ns
  FROM notice_update_core WHERE NOT coalesce({_BLANK.format("section_3_2")}, true)
  UNION ALL
  SELECT 'common_envelope', objectId, substr(publicationDateDay, 1, 7), 'tenderId', lower(trim(tenderId)), {_NANOS.format("publicationDate")} FROM common_envelope WHERE NOT coalesce({_BLANK.format("tenderId")}, true)),
cases AS (
  SELECT source_table, object_id, period, CASE WHEN p.key IS NULL THEN 'missing' WHEN g.to_ns <= r.at_ns THEN 'deleted' WHEN p.from_ns > r.at_ns THEN 'late' END AS orphan_kind
  FROM refs r LEFT JOIN (SELECT 'bzpNumber' AS kind, * FROM notices UNION ALL SELECT 'tenderId', * FROM procedures) p USING (kind, key)
  LEFT JOIN gone g ON g.key_kind = r.kind AND g.key = r.key)
"""

SQL = {
    "p1_found": _CHANGES + "SELECT bzp_number, section_number, object_id, part_ordinal, part_part_ordinal FROM ranked WHERE rn = 1 AND NOT gone",
    "p1_contents": _CHANGES + "SELECT bzp_number, section_number, CAST(length(after) AS BIGINT) AS n_chars, sha256(after) AS content_hash FROM ranked WHERE rn = 1 AND NOT gone",
    "p1_images": _CHANGES + _IMAGES,
    "p3_found": _ORPHANS + "SELECT DISTINCT source_table, object_id, period, orphan_kind FROM cases WHERE orphan_kind IS NOT NULL",
    "p3_report": _ORPHANS + "SELECT source_table, period, orphan_kind, count(DISTINCT object_id) AS n_orphans FROM cases WHERE orphan_kind IS NOT NULL GROUP BY ALL",
    "p5_contractors": """
SELECT ingest_id, CAST(i AS BIGINT) AS ordinal, contractors[i].contractorName AS contractorName, contractors[i].contractorCity AS contractorCity, contractors[i].contractorProvince AS contractorProvince,
  contractors[i].contractorCountry AS contractorCountry, contractors[i].contractorNationalId AS contractorNationalId
FROM (SELECT ingest_id, contractors, unnest(generate_series(1, len(contractors))) AS i FROM bronze_notices)""",
}
