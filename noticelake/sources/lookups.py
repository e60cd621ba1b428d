"""Looking up single records and places in pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.markup import markup_text, without_comments
from noticelake.functions.text import blank, col, strip


def rows_of(tables: Mapping[str, DataFrame], column: str, value: str, day: str = "publicationDateDay") -> DataFrame:
    """Rows of several tables where a column has a value, with ``_source_day`` and ``_source_dataset``; columns that a table lacks are null. The filter reaches each scan."""
    out = None
    for name, t in sorted(tables.items()):
        found = t.where(F.col(column) == value).withColumns({"_source_day": F.col(day).cast("string") if day in t.columns else F.lit(None).cast("string"), "_source_dataset": F.lit(name)})
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables")
    return out


def raw_record(df: DataFrame, object_id: str) -> DataFrame:
    """The first record (by ``file``, ``pos``) whose stripped objectId is the one asked for."""
    return df.where(strip(F.col("objectId").cast("string")) == object_id).orderBy("file", "pos").limit(1)


def page_of(record: Column | str, paths: Sequence[str]) -> Column:
    """The first of the given JSON paths of a record (as JSON text) that holds a text that is not blank."""
    texts = [F.get_json_object(col(record), p) for p in paths]
    return F.coalesce(*[F.when(~blank(t), t) for t in texts])


def heading_contexts(body: Column | str, number: str, width: int = 300) -> Column:
    """array<struct<heading, before, after>>: every h3 of a page that holds ``number``, as text, with the text of up to ``width`` letters of markup on either side."""
    escaped = number.replace(".", r"\.")
    rule = rf"(?is)(.{{0,{width}}})(<h3\b[^>]*>(?:(?!</h3).)*?(?<![\d.]){escaped}(?![\d.]*\d)(?:(?!</h3).)*</h3\s*>)(?=(.{{0,{width}}}))"
    groups = [F.regexp_extract_all(without_comments(body), F.lit(rule), F.lit(i)) for i in (2, 1, 3)]
    text = lambda c: markup_text(F.regexp_replace(c, r"^[^<>]*>|<[^<>]*$", " "))
    return F.transform(F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("h", "b", "a"), strict=True)]), lambda x: F.struct(markup_text(x["h"]).alias("heading"), text(x["b"]).alias("before"), text(x["a"]).alias("after")))
