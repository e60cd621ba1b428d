"""References to records that do not exist, are deleted or arrive later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions.instants import iso_nanos, wall_nanos
from noticelake.functions.keys import loose_notice_key, tender_id
from noticelake.functions.text import blank


def validity(parents: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """(key, from_ns, to_ns): from the first time a key is there to its first withdrawal; one row per key that is in ``parents``.

    ``parents`` and ``withdrawn`` have (key, at). A key whose times are all null counts as there from the start.
    """
    p = parents.where("key is not null").groupBy("key").agg(F.min("at").alias("from_ns"))
    w = withdrawn.where("key is not null").groupBy("key").agg(F.min("at").alias("to_ns"))
    return p.join(w, "key", "left")


def orphans(references: DataFrame, intervals: DataFrame) -> DataFrame:
    """References (key, at, …) that meet no parent in its validity, with ``orphan_kind`` missing, deleted or late.

    Both sides are hashed and sorted on the key and merged in one pass (sort-merge join); the parents have one row a key, so a
    hot key is split on the references' side alone. A reference without a time is only ever missing. Null keys are no references.
    """
    r = references.where("key is not null").join(intervals.withColumn("_there", F.lit(True)).hint("merge"), "key", "left")
    kind = F.when(F.col("_there").isNull(), "missing").when(F.col("to_ns") <= F.col("at"), "deleted").when(F.col("from_ns") > F.col("at"), "late")
    return r.withColumn("orphan_kind", kind).where("orphan_kind is not null").drop("_there", "from_ns", "to_ns")


def notice_orphans(core: DataFrame, envelope: DataFrame, register: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """Orphans of update notices (to notices) and of notices (to procedures): source_table, object_id, period, orphan_kind, distinct."""
    gone = lambda kind: withdrawn.where(F.col("key_kind") == kind)
    notices = validity(
        envelope.select(loose_notice_key("bzpNumber").alias("key"), iso_nanos("publicationDate").alias("at")),
        gone("bzpNumber").select(loose_notice_key("key_value").alias("key"), wall_nanos("withdrawn_at").alias("at")),
    )
    procedures = validity(
        register.select(tender_id("tenderId").alias("key"), wall_nanos("registered_at").alias("at")),
        gone("tenderId").select(tender_id("key_value").alias("key"), wall_nanos("withdrawn_at").alias("at")),
    )
    refs = lambda t, key: t.select(F.col("objectId").alias("object_id"), F.substring("publicationDateDay", 1, 7).alias("period"), key.alias("key"), iso_nanos("publicationDate").alias("at")).distinct()
    a = orphans(refs(core.where(~blank("section_3_2")), loose_notice_key("section_3_2")), notices).withColumn("source_table", F.lit("notice_update_core"))
    b = orphans(refs(envelope.where(~blank("tenderId")), tender_id("tenderId")), procedures).withColumn("source_table", F.lit("common_envelope"))
    return a.unionByName(b).select("source_table", "object_id", "period", "orphan_kind").distinct()
