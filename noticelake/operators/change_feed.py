"""Applying a feed of inserts, updates and deletes (signed multiset)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions.instants import iso_nanos
from noticelake.functions.keys import notice_number, section_number
from noticelake.functions.text import blank, strip

#: Slices that the changes of one key are first netted in, so that a hot key is no single task.
SLICES = 64


def apply_changes(changes: DataFrame, key: Sequence[str], order: Sequence[str], deletes: Column, payload: Sequence[str] = (), base: DataFrame | None = None, slices: int = SLICES) -> DataFrame:
    """Current rows of a table after all ``changes``, in whatever order and however often they arrived.

    Every change adds its after-image (+1) and takes away its before-image (-1), which is the image the change before it
    in ``order`` left; a row of ``base`` stands before all changes. Images with a positive sum remain, and of them those
    that are no deletion. Sums are netted in ``slices`` of each key first and over the survivors after that, which is
    the same sum since images cancel in pairs. An image is known by its place in ``order``; its ``payload`` is fetched for the survivors alone.

    Result: ``key + order + payload`` of the image in force (``order`` null if it is the base row's). Repeated changes (equal
    key and order) count once; of differing payloads under one key and order a deletion, else the greatest counts. Changes with a null in
    ``key`` are left out; nulls in ``order`` come first. Deleting what is absent and inserting what is there are no
    errors. Other columns of the inputs are ignored.
    """
    key, order, payload = list(key), list(order), list(payload)
    gone = F.coalesce(deletes, F.lit(False)).alias("_gone")
    ev = changes.select(*key, F.struct(F.lit(1).alias("_rank"), *order).alias("_image"), gone).dropna(subset=key)
    if base is not None:
        types = dict(changes.dtypes)
        ev = ev.unionByName(base.select(*key, F.struct(F.lit(0).alias("_rank"), *[F.lit(None).cast(types[c]).alias(c) for c in order]).alias("_image"), F.lit(False).alias("_gone")).dropna(subset=key))
    by = key
    if slices > 1:  # one exchange by key and slice serves the repeats, the sort and the sums
        by = [*key, "_slice"]
        ev = ev.withColumn("_slice", F.pmod(F.xxhash64("_image"), F.lit(slices))).repartition(*by)
    ev = _net(ev.groupBy(*by, "_image").agg(F.max("_gone").alias("_gone")), by)
    if slices > 1:
        ev = _net(ev.drop("_slice"), key)
    now = ev.where("not _gone").select(*key, "_image._rank", *[F.col(f"_image.{c}").alias(c) for c in order])
    if not payload:
        return now.drop("_rank")
    rows = changes.where(~gone).select(*key, F.lit(1).alias("_rank"), *order, F.struct(*payload).alias("_p"))
    if base is not None:
        rows = rows.unionByName(base.select(*key, F.lit(0).alias("_rank"), *[F.lit(None).cast(types[c]).alias(c) for c in order], F.struct(*payload).alias("_p")))
    n, r = now.alias("n"), rows.alias("r")
    same = F.lit(True)
    for c in (*key, "_rank", *order):
        same = same & (F.col(f"n.{c}") == F.col(f"r.{c}") if c in key else F.col(f"n.{c}").eqNullSafe(F.col(f"r.{c}")))
    both = n.join(r, same).groupBy(*[F.col(f"n.{c}").alias(c) for c in (*key, "_rank", *order)]).agg(F.max("_p").alias("_p"))
    return both.select(*key, *order, *[F.col(f"_p.{c}").alias(c) for c in payload])


def _net(events: DataFrame, by: list[str]) -> DataFrame:
    """Images left of ``events`` (an image each, with ``_gone``) after each has taken away the one before it in its group."""
    image = F.struct("_image", "_gone")
    before = F.lag(image).over(Window.partitionBy(*by).orderBy("_image"))
    both = events.select(*by, image.alias("_now"), before.alias("_before"))
    signed = both.select(*by, F.inline(F.array(F.struct(F.col("_now").alias("_x"), F.lit(1).alias("_n")), F.struct(F.col("_before").alias("_x"), F.lit(-1).alias("_n")))))
    left = signed.where(F.col("_x").isNotNull()).groupBy(*by, "_x").agg(F.sum("_n").alias("_n")).where("_n > 0")
    return left.select(*by, "_x._image", "_x._gone")


def apply_images(changes: DataFrame, key: Sequence[str], identity: Sequence[str], before: str, after: str, base: DataFrame | None = None) -> DataFrame:
    """``key``, ``image`` and ``n``: the multiset of rows that a feed with both images leaves of ``base`` (key, image), taken at its word.

    Changes equal in ``key + identity`` and images count once. Each takes ``before`` away once and adds ``after`` once (null is none); images whose sum with the
    base is positive remain. A feed without gaps leaves one image a key, and another tells of changes that never arrived or whose before-image
    is not what stood there. No order is needed. Sums are taken where the rows are before they are shuffled, so that a hot key is no single task.
    """
    key = list(key)
    ev = changes.select(*key, *identity, before, after).dropna(subset=key).distinct()
    signed = ev.select(*key, F.inline(F.array(F.struct(F.col(after).alias("image"), F.lit(1).alias("n")), F.struct(F.col(before).alias("image"), F.lit(-1).alias("n")))))
    if base is not None:
        signed = signed.unionByName(base.select(*key, "image", F.lit(1).alias("n")).dropna(subset=key))
    return signed.where("image is not null").groupBy(*key, "image").agg(F.sum("n").alias("n")).where("n > 0")


# How a feed writes a deletion, in lower case.
DELETE_WORDS = ("d", "delete", "usunięcie")


def notice_changes(core: DataFrame, items: DataFrame, texts: Sequence[str] = ("after",)) -> DataFrame:
    """Section changes of update notices: (bzp_number, section_number) with (at, object_id, part_ordinal, part_part_ordinal), gone and the ``texts`` asked for (after, before).

    ``core`` and ``items`` may hold repeated rows; items without a head row, a readable number or a section number are left out.
    A null ``change_op`` deletes if the after-text is null or blank. An objectId whose head rows disagree takes the greatest readable one.
    """
    head = core.select("objectId", notice_number("section_3_2").alias("bzp_number"), iso_nanos("publicationDate").alias("at")).where("bzp_number is not null and objectId is not null")
    head = head.groupBy("objectId").agg(F.max(F.struct("at", "bzp_number")).alias("h")).select("objectId", "h.*")
    op = F.nullif(F.lower(strip("change_op")), F.lit(""))
    rows = items.select("objectId", "part_ordinal", "part_part_ordinal", section_number("section_3_4_1_label").alias("section_number"), *[F.col(f"section_3_4_1_{t}").alias(t) for t in texts], F.coalesce(op.isin(*DELETE_WORDS), blank("section_3_4_1_after")).alias("gone"))
    return rows.where("section_number is not null").join(head, "objectId").select("bzp_number", "section_number", "at", F.col("objectId").alias("object_id"), "part_ordinal", "part_part_ordinal", "gone", *texts)


ORDER = ("at", "part_ordinal", "part_part_ordinal", "object_id")


def current_sections(core: DataFrame, items: DataFrame, texts: Sequence[str] = ("after",)) -> DataFrame:
    """Section contents in force for every changed notice, with the key of the change that set each; without ``texts`` the keys alone.

    Changes of one instant, part and item are one change; if they come from different notices, the greatest objectId counts.
    """
    return apply_changes(notice_changes(core, items, texts), ["bzp_number", "section_number"], ORDER, F.col("gone"), texts)


def section_images(core: DataFrame, items: DataFrame) -> DataFrame:
    """(bzp_number, section_number, image, n): what the notices' own before- and after-images leave of each section.

    The base is what the section's first change says stood there before it.
    """
    ch = notice_changes(core, items, ("before", "after")).withColumns({"after": F.when(~F.col("gone"), F.nullif(strip("after"), F.lit(""))), "before": F.nullif(strip("before"), F.lit(""))})
    key = ["bzp_number", "section_number"]
    base = ch.groupBy(*key).agg(F.min(F.struct(*ORDER, "before")).alias("_f")).select(*key, F.col("_f.before").alias("image")).where("image is not null")
    return apply_images(ch, key, ORDER, "before", "after", base)
