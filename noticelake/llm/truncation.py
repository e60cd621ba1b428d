"""Texts cut off by field limits: self-joins by prefix, of whole texts and of the words they end with, beside the marks a cut leaves."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions.text import blank
from noticelake.llm.pages import closed, page_text
from noticelake.runtime import cut, small

#: Words before a text's last one that a longer copy must share with it.
CONTEXT = 2

# What cutters put where they cut (the last stands for half a character), and abbreviations whose dot ends no sentence.
_MARK = re.compile(r"\s*(?:…|\.\.\.|\[\.{3}\]|\[…\]|\((?:dalej|cd\.?|c\.d\.)\)|\ufffd)$")
_SHORT = re.compile(r"(?i)(?<![\w.])(?:r|nr|ust|poz|lit|tj|np|godz|ul|pkt|szt|rozdz|art|im|woj|tel|ok|pok|dz|zał)\.$")
# All of these look at a text's end alone, which these letters hold.
_END = 48
_ENDED = re.compile(r"[.?!][\"”»')\]]*$|(?<!\d)\d{4}-\d{2}-\d{2}$")
_SENTENCE = re.compile(r"(?<=[.!?]) +(?=[^\W\d_])")
_DIGITS = re.compile(r"\d+")


def unfinished(text: str) -> bool:
    """True if a text stops in mid-sentence: pages end with running text or a date, so that a last word without a full stop, or with an abbreviation's dot alone, is none's end."""
    end = text[-_END:]
    return not _ENDED.search(end) or bool(_SHORT.search(end))


def looks_cut(body: str, text: str) -> bool:
    """True if a page shows by itself that its end is missing: it is not closed, or its text stops in mid-sentence or at a cutter's mark."""
    return not closed(body) or unfinished(text) or bool(_MARK.search(text[-_END:]))


def unmarked(text: str) -> str:
    """A text without a cutter's mark at its end: what a longer copy would start with."""
    return text[:-_END] + _MARK.sub("", text[-_END:])


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence, numbers written as 0."""
    return [s.split() for s in _SENTENCE.split(_DIGITS.sub("0", text))]


def _context(words: list[str]) -> int:
    """Hash of the words before one, as a signed number."""
    x = xxhash.xxh64_intdigest(" ".join(words[-CONTEXT:]))
    return x - (1 << 64) if x >> 63 else x


def page_ends(bronze: DataFrame) -> DataFrame:
    """One pass over the bodies that are not blank, cut: a row a page (``word`` null) and, a batch, a row a place in a sentence (``ingest_id`` null).

    A page has ``text``, whole but for a cutter's mark, what its own end shows (``open``: not closed, ``marked``, ``midway``: in mid-sentence) and, if its text
    stops midway or at a mark, the hash of the words before its last one (``context``) and that (``last``). A place has a word, the hash of the words
    before it in its sentence, and if another follows (``more``).
    """
    schema = pa.schema([("ingest_id", pa.int64()), ("feed_source", pa.string()), ("text", pa.string()), ("open", pa.bool_()), ("marked", pa.bool_()), ("midway", pa.bool_()), ("context", pa.int64()), ("last", pa.string()), ("word", pa.string()), ("more", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            places: dict[tuple[str, str], bool] = {}
            for body in b.column(2).to_pylist():
                full = page_text(body)
                text = unmarked(full)
                marked, midway = text != full, unfinished(full)
                said = sentences(text)
                for words in said:
                    before = ["", *(" ".join(words[max(0, j - CONTEXT) : j]) for j in range(1, len(words)))]
                    for place in zip(before, words[:-1], strict=False):
                        places[place] = True
                    if words:
                        places.setdefault((before[-1], words[-1]), False)
                end = said[-1] if marked or midway else []
                for column, x in zip(rows, (text, not closed(body), marked, midway, _context(end[:-1]) if end else None, end[-1] if end else None), strict=True):
                    column.append(x)
            none = [None] * len(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((b.column(0).to_pylist(), b.column(1).to_pylist(), *rows, none, none), schema, strict=True)], schema=schema)
            none = [None] * len(places)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((none, none, none, none, none, none, [_context([c]) for c, _ in places], none, [w for _, w in places], list(places.values())), schema, strict=True)], schema=schema)

    return cut(bronze.where(~blank("htmlBody")).select("ingest_id", "feed_source", "htmlBody").mapInArrow(run, "ingest_id bigint, feed_source string, text string, open boolean, marked boolean, midway boolean, context bigint, last string, word string, more boolean"))


def ends_continued(ends: DataFrame) -> DataFrame:
    """``ingest_id`` of the pages whose last words are a strict prefix of longer copies elsewhere: after the same words stands a longer word that starts
    as the last one does, or the same word and others after it.

    Both sides are distinct: a page's end is looked up once, however many pages end so, and a place once, however often it is there. The prefixes of the words
    are joined by equality of hashes, so that no hot context pairs its ends with its places.
    """
    tails = ends.where("last is not null").select("ingest_id", "context", F.xxhash64("context", "last").alias("key"))
    places = ends.where("word is not null").join(small(tails.select("context").distinct()), "context", "left_semi")
    places = places.groupBy("context", "word").agg(F.max("more").alias("more"))
    upto = F.length("word") - F.when(F.col("more"), 0).otherwise(1)
    prefixes = F.transform(F.filter(F.sequence(F.lit(0), upto), lambda i: i > 0), lambda i: F.xxhash64("context", F.substring(F.col("word"), F.lit(1), i)))
    return tails.join(places.select(F.explode(prefixes).alias("key")).distinct(), "key", "left_semi").select("ingest_id")


def strict_prefixes(rows: DataFrame) -> DataFrame:
    """``id`` of the rows whose ``text`` is a strict prefix of another row's text. Rows (id, text); null and empty texts are none.

    Texts are range-sorted, equal ones spread by id. In sorted order whatever continues a text follows right after its copies, so the
    next different text decides: one pass over each range, and for the last run of a range the first different text of the later
    ones, from a table of at most three rows a range.
    """
    some = rows.where("text <> ''").select("id", "text")
    ordered = some.repartitionByRange("text", "id").sortWithinPartitions("text", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, cut, edge): id with cut true for hits; cut null for the ids of the last run; edge for the texts that may decide other ranges' last runs."""
        ids: list[int] = []
        last: str | None = None
        runs = 0
        names = ["id", "cut", "edge"]
        make = lambda i, c, e: pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(c, pa.bool_()), pa.array(e, pa.string())], names)
        for b in batches:
            hits: list[int] = []
            edges: list[str] = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t != last:
                    if last is not None and t.startswith(last):
                        hits += ids
                    ids, last, runs = [], t, runs + 1
                    if runs <= 2:
                        edges.append(t)
                ids.append(i)
            yield make(hits + [None] * len(edges), [True] * len(hits) + [None] * len(edges), [None] * len(hits) + edges)
        if last is not None:
            yield make(ids, [None] * len(ids), [last] * len(ids))

    swept = cut(ordered.mapInArrow(run, "id bigint, cut boolean, edge string"))
    edges = swept.where("edge is not null").groupBy("edge").agg(F.lit(1).alias("_one")).select("edge")
    follow = edges.withColumn("next", F.lead("edge").over(Window.orderBy("edge"))).where("startswith(next, edge)").select("edge")
    late = swept.where("id is not null and cut is null").join(follow, "edge", "left_semi").select("id")
    return swept.where("cut").select("id").unionByName(late)


def evidence(bronze: DataFrame) -> DataFrame:
    """One row a body that is not blank and lost part of its content, with what shows it: ingest_id, feed_source, copy (its text is a strict prefix of another
    page's), words (its last words are one of longer copies elsewhere), open (the page is not closed), marked (it ends with a cutter's mark), midway (in mid-sentence)."""
    ends = page_ends(bronze)
    pages = ends.where("word is null").select("ingest_id", "feed_source", "open", "marked", "midway")
    shorter = strict_prefixes(ends.where("word is null").select(F.col("ingest_id").alias("id"), "text")).select(F.col("id").alias("ingest_id"), F.lit("copy").alias("how"))
    found = shorter.unionByName(ends_continued(ends).withColumn("how", F.lit("words"))).groupBy("ingest_id").agg(*[F.max(F.col("how") == h).alias(h) for h in ("copy", "words")])
    by = [F.coalesce(h, F.lit(False)).alias(h) for h in ("copy", "words")]
    return pages.join(found, "ingest_id", "left").select("ingest_id", "feed_source", *by, "open", "marked", "midway").where("copy or words or open or marked or midway")


def truncated(bronze: DataFrame) -> DataFrame:
    """(ingest_id, feed_source) of the records whose body lost part of its content, by any ``evidence``; distinct. Null, empty and blank bodies are no cases."""
    return evidence(bronze).select("ingest_id", "feed_source").distinct()


def evidence_report(bronze: DataFrame) -> DataFrame:
    """How many records each kind of evidence shows, alone or with others: n_found, by_copy, by_words, by_prefix (either of the two), by_end (open, marked or midway), end_only."""
    prefix, end = F.col("copy") | F.col("words"), F.col("open") | F.col("marked") | F.col("midway")
    return evidence(bronze).agg(F.count("*").alias("n_found"), F.count_if("copy").alias("by_copy"), F.count_if("words").alias("by_words"), F.count_if(prefix).alias("by_prefix"), F.count_if(end).alias("by_end"), F.count_if(~prefix).alias("end_only"))


def truncation_share(bronze: DataFrame) -> DataFrame:
    """How often each source truncates: feed_source, n_records, n_bodies (non-blank), n_truncated, share (of the non-blank)."""
    lost = truncated(bronze).groupBy("feed_source").agg(F.count("*").alias("n_truncated"))
    every = bronze.groupBy("feed_source").agg(F.count("*").alias("n_records"), F.count_if(~blank("htmlBody")).alias("n_bodies"))
    both = every.join(lost, every["feed_source"].eqNullSafe(lost["feed_source"]), "left").drop(lost["feed_source"])
    n = F.coalesce("n_truncated", F.lit(0))
    return both.select("feed_source", "n_records", "n_bodies", n.alias("n_truncated"), (n / F.nullif("n_bodies", F.lit(0))).alias("share"))
