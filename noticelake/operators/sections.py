"""Section tables: numbered headings of notice pages as core, repeated and nested tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions.headings import heading_column, section_text
from noticelake.functions.parsers import COMPUTED, Parsed, parser_of
from noticelake.functions.text import section_key
from noticelake.profiles import Profile


def heading_rows(pages: DataFrame, profiles: Sequence[Profile], key: str = "objectId", kind: str = "noticeType", body: str = "htmlBody") -> DataFrame:
    """(key, kind, pos, number, value, model, entity, leaf): one row a heading with a value, in page order; model null if the type's profile lacks the number.

    Pages are tokenized once for all types and profiles, which are joined as a literal map of a few hundred entries.
    """
    found = pages.select(key, kind, heading_column(body, anywhere=True).alias("_h")).select(key, kind, F.posexplode("_h").alias("pos", "_h"))
    lookup = {f"{p.notice_type}|{s.number}": f"{s.entity}.{s.leaf}{'!' if s.full_block else ''}" for p in profiles for s in p.sections}
    models = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv])
    m = F.try_element_at(models, F.concat_ws("|", kind, "_h.number"))
    value = F.when(m.endswith("!"), F.col("_h.block")).otherwise(section_text(F.col("_h")))
    rows = found.select(key, kind, "pos", F.col("_h.number").alias("number"), value.alias("value"), F.rtrim(m, F.lit("!")).alias("model")).where("value is not null")
    return rows.withColumns({"entity": F.split_part("model", F.lit("."), F.lit(1)), "leaf": F.split_part("model", F.lit("."), F.lit(2))})


def assign(rows: DataFrame, key: str = "objectId") -> DataFrame:
    """``rows`` with ent_idx and chi_idx: a core heading whose number is not greater than the one before it in its entity opens the next occurrence, a
    child heading likewise within it. Both count from 0. Windows are of one page's headings each."""
    page = [key, "entity"]
    before = lambda by: F.lag("_k").over(Window.partitionBy(*by).orderBy("pos"))
    upto = lambda by: Window.partitionBy(*by).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = F.col("leaf") == "core"
    r = rows.where("entity is not null and entity <> 'core'").withColumn("_k", section_key("number"))
    r = r.withColumn("_opens", (own & F.coalesce(F.col("_k") <= before([*page, "leaf"]), F.lit(False))).cast("int"))
    r = r.withColumn("ent_idx", F.sum("_opens").over(upto(page)).cast("int"))
    r = r.withColumn("_opens", (~own & F.coalesce(F.col("_k") <= before([*page, "leaf", "ent_idx"]), F.lit(False))).cast("int"))
    return r.withColumn("chi_idx", F.sum("_opens").over(upto([*page, "leaf", "ent_idx"])).cast("int")).drop("_k", "_opens")


def core_errors(rows: DataFrame, key: str = "objectId") -> DataFrame:
    """(key, kind, errors): pages whose core sections repeat, an entry for each repeated number; they are quarantined."""
    n = rows.where("entity = 'core'").groupBy(key, "noticeType", "number").agg(F.count("*").alias("n")).where("n > 1")
    msg = F.concat(F.lit("duplicate_core_section: "), "number")
    return n.groupBy(key, "noticeType").agg(F.array_sort(F.collect_list(msg)).alias("errors"))


def unknown_sections(rows: DataFrame, key: str = "objectId") -> DataFrame:
    """(key, kind, errors): pages with numbers their profile lacks; flagged, not dropped."""
    u = rows.where("model is null").select(key, "noticeType", "number").distinct()
    return u.groupBy(key, "noticeType").agg(F.transform(F.array_sort(F.collect_list("number")), lambda x: F.concat(F.lit("unknown section: "), x)).alias("errors"))


def section_tables(pages: DataFrame, rows: DataFrame, profile: Profile, key: str = "objectId", placed: DataFrame | None = None) -> dict[tuple[str, str], DataFrame]:
    """Tables of one notice type by (entity, leaf), raw texts: ``section_…`` columns, ``<entity>_ordinal`` and ``<entity>_<leaf>_ordinal`` (which runs on across parents).

    Pages whose core sections repeat are in none of them; pages without core headings have a core row of nulls. An entity has a row for every
    occurrence, also one that only children opened. ``placed`` is ``assign(rows)`` where a caller has cut it for several types.
    """
    own = rows.where(F.col("noticeType") == profile.notice_type).join(core_errors(rows, key).select(key), key, "left_anti")
    placed = assign(own, key) if placed is None else placed.where(F.col("noticeType") == profile.notice_type).join(core_errors(rows, key).select(key), key, "left_anti")
    out = {}
    for (entity, leaf), sections in profile.models().items():
        pick = lambda r, ss: [F.max(F.when(r["number"] == s.number, r["value"])).alias(s.column) for s in ss]
        if entity == "core":
            base = pages.where(F.col("noticeType") == profile.notice_type).select(key).distinct().join(core_errors(rows, key).select(key), key, "left_anti")
            core = own.where("entity = 'core'")
            out[entity, leaf] = base.join(core.groupBy(key).agg(*pick(core, sections)), key, "left")
            continue
        mine = placed.where(F.col("entity") == entity)
        if leaf == "core":
            values = mine.withColumn("value", F.when(F.col("leaf") == "core", F.col("value")))
            out[entity, leaf] = values.groupBy(key, (F.col("ent_idx") + 1).alias(f"{entity}_ordinal")).agg(*pick(values, sections))
        else:
            child = mine.where(F.col("leaf") == leaf)
            g = child.groupBy(key, (F.col("ent_idx") + 1).alias(f"{entity}_ordinal"), "chi_idx").agg(*pick(child, sections))
            place = F.dense_rank().over(Window.partitionBy(key).orderBy(f"{entity}_ordinal", "chi_idx")).alias(f"{entity}_{leaf}_ordinal")
            out[entity, leaf] = g.select(key, f"{entity}_ordinal", place, *[s.column for s in sections])
    return out


def _unknown(name: str) -> Callable[[Column], Parsed]:
    """Stands in for a parser that isn't registered: the text as it is, and an error."""
    return lambda c: Parsed(c, F.when(c.isNotNull(), F.lit(f"{name}: unknown parser")))


def typed(table: DataFrame, profile: Profile, entity: str, leaf: str) -> DataFrame:
    """A section table with typed columns and ``parse_errors`` (null if none): parsed in place, derived ones appended for their dropped source, then computed ones.

    Errors are ``column: message``, in the order parsed, derived, computed. Sections without a parser keep their text; unknown parser names too.
    """
    sections = profile.models()[entity, leaf]
    plain = [c for c in table.columns if c not in {s.column for s in sections}]
    cols: list[Column] = []
    errors: list[Column] = []
    tail: list[Column] = []

    def use(name: str, source: str, as_: str, into: list[Column]) -> None:
        parser, kind = parser_of(name, profile.notice_type) or (_unknown(name), "string")
        p = parser(F.col(source))
        into.append(p.value.cast(kind).alias(as_))
        errors.append(F.concat(F.lit(f"{as_}: "), p.error))

    for s in sections:
        if s.derived:
            continue
        if s.parser and parser_of(s.parser, profile.notice_type):
            use(s.parser, s.column, s.column, cols)
        else:
            cols.append(F.col(s.column))
    for s in sections:
        for as_, name in s.derived.items():
            use(name, s.column, as_, tail)
    flat = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
    out = table.select(*plain, *cols, *tail, F.when(F.size(flat) > 0, flat).alias("parse_errors"))
    new = {as_: COMPUTED[f][0](*args).cast(COMPUTED[f][1]) for as_, (f, args) in profile.computed.items() if set(args) <= set(out.columns)}
    return out.withColumns(new) if new else out


def quarantine(rows: DataFrame, pages: DataFrame, profiles: Sequence[Profile], key: str = "objectId") -> DataFrame:
    """(key, noticeType, data_model, errors): repeated core sections, unknown sections and types without a profile."""
    no_profile = pages.where(~F.coalesce(F.col("noticeType").isin(*[p.notice_type for p in profiles]), F.lit(False)))
    none = no_profile.select(key, "noticeType", F.lit("core").alias("data_model"), F.array(F.concat(F.lit("no registered profile for notice type: "), F.coalesce("noticeType", F.lit("null")))).alias("errors"))
    own = rows.where(F.col("noticeType").isin(*[p.notice_type for p in profiles]))
    a = core_errors(own, key).withColumn("data_model", F.lit("core"))
    b = unknown_sections(own, key).withColumn("data_model", F.lit("unknown"))
    return none.unionByName(a).unionByName(b)
