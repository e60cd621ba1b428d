"""Deeply nested records as related flat tables (shared inlining)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.functions.headings import first_value, heading_column
from noticelake.functions.markup import closes_page
from noticelake.functions.text import let, section_key


@dataclass
class Relation:
    """A table of the flat schema: ``path`` of the element (() for the root), the leaves inlined into it and its child tables."""

    name: str
    path: tuple[str, ...] = ()
    leaves: list[tuple[str, ...]] = field(default_factory=list)
    children: list[Relation] = field(default_factory=list)
    kind: str = "array"  # how the element is held: array, map or single (a shared struct)
    scalar: bool = False  # the element itself is a value, in column ``value``
    table: str = ""  # the table its rows belong to, where several relations share one

    def every(self) -> list[Relation]:
        return [self, *(r for c in self.children for r in c.every())]


def _structs(kind: T.DataType) -> list[T.StructType]:
    """All struct types within a type, itself included."""
    if isinstance(kind, T.StructType):
        return [kind, *(s for f in kind.fields for s in _structs(f.dataType))]
    if isinstance(kind, T.ArrayType):
        return _structs(kind.elementType)
    return [*_structs(kind.keyType), *_structs(kind.valueType)] if isinstance(kind, T.MapType) else []


def schema_graph(schema: T.StructType, name: str = "root") -> Relation:
    """The relations of a schema. Structs with one place are inlined into their parent; every array and map becomes a table of its own, and so does every struct
    that is shared: held at more than one place of the graph.

    ``table`` is equal for the places of one shared struct, and for elements that recur within themselves (a repeated field below one of its own name, as in a tree of
    items kept to some depth); else it is the relation's name.
    """
    rel = Relation(name, table=name)
    seen: dict[str, int] = {}
    for s in _structs(schema)[1:]:
        seen[s.simpleString()] = seen.get(s.simpleString(), 0) + 1
    shared: dict[str, str] = {}  # struct held at several places -> its table

    def place(into: Relation, path: tuple[str, ...], element: T.DataType, kind: str, above: tuple[Relation, ...]) -> None:
        label = "_".join(path)
        child = Relation(label if into is rel else f"{into.name}_{label}", path, kind=kind)
        into.children.append(child)
        again = next((a for a in above if kind != "single" and a.path and a.path[-1] == path[-1]), None)
        child.table = again.table if again else child.name
        if kind == "map":
            child.leaves.append(("key",))
            element = T.StructType([T.StructField("value", element)])
        if isinstance(element, T.StructType):
            if again is None and seen.get(element.simpleString(), 0) > 1:
                child.table = shared.setdefault(element.simpleString(), child.name)
            walk(element, child, (), (*above, child))
        else:
            child.scalar = True

    def walk(s: T.StructType, into: Relation, at: tuple[str, ...], above: tuple[Relation, ...]) -> None:
        for f in s.fields:
            kind, path = f.dataType, (*at, f.name)
            if isinstance(kind, T.ArrayType):
                place(into, path, kind.elementType, "array", above)
            elif isinstance(kind, T.MapType):
                place(into, path, kind.valueType, "map", above)
            elif isinstance(kind, T.StructType) and seen[kind.simpleString()] > 1:
                place(into, path, kind, "single", above)
            elif isinstance(kind, T.StructType):
                walk(kind, into, path, above)
            else:
                into.leaves.append(path)

    walk(schema, rel, (), ())
    return rel


def _at(c: Column, path: tuple[str, ...]) -> Column:
    for p in path:
        c = c[p]
    return c


def shared_inline(df: DataFrame, key: str, graph: Relation | None = None) -> dict[str, DataFrame]:
    """Flat tables of ``df`` by relation name; ``root`` holds the inlined leaves.

    Each child table has ``key``, ``ordinals`` (place from 1 in every repeated element above it and in its own; a shared struct adds none), so that
    (key, all but the last ordinal) is the foreign key to its parent, and its leaves, named by their path joined with ``_``.
    Null and empty arrays and maps give no rows, null elements a row of nulls, a null shared struct none. Nothing is shuffled: rows stay where they are read.
    """
    graph = graph or schema_graph(T.StructType([f for f in df.schema.fields if f.name != key]))
    name = lambda path: "_".join(path)
    out = {graph.name: df.select(key, *[_at(F.col(p[0]), p[1:]).alias(name(p)) for p in graph.leaves])}

    def down(parent: DataFrame, rel: Relation, get: Callable[[tuple[str, ...]], Column]) -> None:
        held = get(rel.path)
        if rel.kind == "single":
            rows = parent.select(key, "_ords", held.alias("_e")).where("_e is not null")
        else:
            rows = parent.select(key, "_ords", F.posexplode(F.map_entries(held) if rel.kind == "map" else held).alias("_i", "_e")).withColumn("_ords", F.concat("_ords", F.array(F.col("_i") + 1)))
        leaves = [F.col("_e").alias("value")] if rel.scalar else [_at(F.col("_e"), p).alias(name(p)) for p in rel.leaves]
        out[rel.name] = rows.select(key, F.col("_ords").alias("ordinals"), *leaves)
        for c in rel.children:
            down(rows, c, lambda path: _at(F.col("_e"), path))

    start = df.withColumn("_ords", F.array().cast("array<int>"))
    for c in graph.children:
        down(start, c, lambda path: _at(F.col(path[0]), path[1:]))
    return out


def related_tables(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """The tables of ``shared_inline``, those of one shared or recursive element put together, with foreign keys written out.

    Every child table has ``key``, ``relation`` (the place in the schema), ``ordinals``, ``parent`` (the relation of the parent row) and ``parent_ordinals``: a row's parent is the row of
    the table of ``parent`` with the same key, that relation and those ordinals; the root's has none. Fields that only some places of an element have are null in the others.
    """
    graph = schema_graph(T.StructType([f for f in df.schema.fields if f.name != key]))
    flat = shared_inline(df, key, graph)
    out = {graph.name: flat[graph.name]}
    for parent in graph.every():
        for rel in parent.children:
            t = flat[rel.name]
            up = F.col("ordinals") if rel.kind == "single" else F.slice("ordinals", 1, F.size("ordinals") - 1)
            t = t.select(key, F.lit(rel.name).alias("relation"), "ordinals", F.lit(parent.name).alias("parent"), up.alias("parent_ordinals"), *t.columns[2:])
            out[rel.table] = out[rel.table].unionByName(t, allowMissingColumns=True) if rel.table in out else t
    return out


def inline_rows(graph: Relation, get: Callable[[tuple[str, ...]], Column], leaf: Callable[[Relation, Column], Column]) -> Column:
    """All child tables of ``graph`` at once: array of struct(relation, ordinals, ``leaf`` of the element).

    For results that take the same columns of every table: the records are read and exploded once, not once a table.
    """

    def rows(rel: Relation, of: Callable[[tuple[str, ...]], Column], ords: Column) -> Column:
        def element(e: Column, i: Column) -> Column:
            own = F.concat(ords, F.array(i + 1))
            one = F.array(F.struct(F.lit(rel.name).alias("relation"), own.alias("ordinals"), leaf(rel, e).alias("leaf")))
            return F.concat(one, *[rows(c, lambda path: _at(e, path), own) for c in rel.children])

        return F.coalesce(F.flatten(F.transform(of(rel.path), element)), F.array())

    return F.concat(*[rows(c, get, F.array().cast("array<int>")) for c in graph.children])


# Sections that make up parts and criteria, by notice type.
PART_SECTIONS = {"ContractNotice": ("4.2.2", "4.2.6", "4.2.10", "4.3.1"), "TenderResultNotice": ("6.1", "6.2", "7.3.1", "8.2")}
CRITERION_SECTIONS = {"ContractNotice": ("4.3.5", "4.3.6")}

_CODE = r"(?<!\d)(\d{8}-\d)(?!\d)"
_ROWS = "array<struct<kind:string,part:int,criterion:int,number:string,value:string>>"


def nested_parts(notice_type: Column, heads: Column) -> Column:
    """Parts of a notice as array<struct<item_key, criteria array<struct<item_key>>>>, from its headings in order.

    A part heading whose number is not greater than the last part heading's opens a new part, and likewise for criteria within
    a part; the first heading of either kind opens the first. Null headings give null.
    """
    kind = lambda n: F.lit(None).cast("string")
    for label, m in (("criterion", CRITERION_SECTIONS), ("part", PART_SECTIONS)):
        for t, numbers in m.items():
            kind = lambda n, k=kind, t=t, numbers=numbers, label=label: F.when((notice_type == t) & n.isin(*numbers), label).otherwise(k(n))
    items = F.transform(F.filter(heads, lambda h: kind(h["number"]).isNotNull()), lambda h: F.struct(kind(h["number"]).alias("kind"), h["number"].alias("number"), first_value(h).alias("value")))
    zero = F.struct(F.array().cast(_ROWS).alias("rows"), F.lit(0).alias("part"), F.lit(0).alias("criterion"), F.lit(None).cast("string").alias("last_part"), F.lit(None).cast("string").alias("last_criterion"))

    def step(a: Column, x: Column) -> Column:
        is_part = x["kind"] == "part"
        back = lambda last: F.coalesce(section_key(x["number"]) <= section_key(last), F.lit(False))
        opens = is_part & back(a["last_part"])
        part = F.greatest(a["part"], F.lit(1)) + opens.cast("int")
        last = F.when(~opens, a["last_criterion"])
        had = F.when(opens, 0).otherwise(a["criterion"])
        criterion = F.when(is_part, had).otherwise(F.greatest(had, F.lit(1)) + back(last).cast("int"))
        row = F.struct(x["kind"].alias("kind"), part.alias("part"), criterion.alias("criterion"), x["number"].alias("number"), x["value"].alias("value"))
        return F.struct(F.concat(a["rows"], F.array(row)).alias("rows"), part.alias("part"), criterion.alias("criterion"), F.when(is_part, x["number"]).otherwise(a["last_part"]).alias("last_part"), F.when(is_part, last).otherwise(x["number"]).alias("last_criterion"))

    rows = F.aggregate(items, zero, step, lambda a: a["rows"])
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.coalesce(n, F.lit(0))), lambda i: i > 0)
    first = lambda xs: F.coalesce(F.get(F.transform(F.filter(xs, lambda r: r["value"] != ""), lambda r: r["value"]), F.lit(0)), F.lit(""))

    def part_of(rows: Column) -> Column:
        def part(p: Column) -> Column:
            own = F.filter(rows, lambda r: r["part"] == p)
            heads = F.filter(own, lambda r: r["number"].isin("4.2.6", "6.1"))
            named = F.transform(heads, lambda r: F.struct(F.when(r["number"] == "4.2.6", F.regexp_extract(r["value"], _CODE, 1)).otherwise(r["value"]).alias("value")))
            crit = F.filter(own, lambda r: r["kind"] == "criterion")
            criteria = F.transform(upto(F.array_max(F.transform(crit, lambda r: r["criterion"]))), lambda c: F.struct(first(F.filter(crit, lambda r: (r["criterion"] == c) & (r["number"] == "4.3.5"))).alias("item_key")))
            return F.struct(first(named).alias("item_key"), criteria.alias("criteria"))

        return F.transform(upto(F.array_max(F.transform(rows, lambda r: r["part"]))), part)

    return let(rows, part_of)


def _nested(bronze: DataFrame) -> DataFrame:
    """(ingest_id, contractors, parts): only pages with a closing html tag, of the types that have parts, are tokenized."""
    numbers = sorted({n for m in (PART_SECTIONS, CRITERION_SECTIONS) for ns in m.values() for n in ns})
    ours = F.col("noticeType").isin(*PART_SECTIONS, *CRITERION_SECTIONS) & closes_page("htmlBody")
    page = F.when(F.coalesce(ours, F.lit(False)), F.col("htmlBody"))
    heads = bronze.select("ingest_id", "contractors", "noticeType", page.alias("_page")).select("ingest_id", "contractors", "noticeType", heading_column("_page", numbers, full=False).alias("_heads"))
    return heads.select("ingest_id", "contractors", nested_parts(F.col("noticeType"), F.col("_heads")).alias("parts"))


def notice_tables(bronze: DataFrame) -> dict[str, DataFrame]:
    """Related tables of raw notices: ``contractors``, ``parts`` and ``parts_criteria``, each with ``ingest_id`` and ``ordinals``."""
    return shared_inline(_nested(bronze), "ingest_id")


def notice_items(bronze: DataFrame) -> DataFrame:
    """(ingest_id, entity, parent_ordinal, ordinal, item_key) of every contractor, part and criterion; distinct rows.

    Contractors whose fields are all null are left out (their place still counts). Whatever has no name or code has the key ''.
    """
    nested = _nested(bronze)
    graph = schema_graph(T.StructType([f for f in nested.schema.fields if f.name != "ingest_id"]))

    def leaf(rel: Relation, e: Column) -> Column:
        if rel.name != "contractors":
            return F.struct(F.lit(True).alias("there"), e["item_key"].alias("item_key"))
        return F.struct(F.coalesce(*[_at(e, p).cast("string") for p in rel.leaves]).isNotNull().alias("there"), F.coalesce(e["contractorName"], F.lit("")).alias("item_key"))

    r = nested.select("ingest_id", F.inline(inline_rows(graph, lambda path: _at(F.col(path[0]), path[1:]), leaf))).where("leaf.there")
    entity = F.create_map(*[F.lit(x) for x in ("contractors", "contractor", "parts", "part", "parts_criteria", "criterion")])[F.col("relation")]
    deep = F.size("ordinals") == 2
    return r.select("ingest_id", entity.alias("entity"), F.when(deep, F.col("ordinals")[0]).otherwise(0).alias("parent_ordinal"), F.element_at("ordinals", -1).alias("ordinal"), F.col("leaf.item_key").alias("item_key"))
