"""Mapping free-entered values to a canonical list (partition-based pigeonhole join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import blank, fold, let, squeeze, strip
from noticelake.runtime import BROADCAST_ROWS, cut, small

#: Typing errors a town may have; a swap of neighbours is one error.
TOWN_ERRORS = 2
COUNTRY_ERRORS = 1


def segments(s: Column, n: int) -> Column:
    """``s`` cut into ``n`` pieces of even length: array of struct(no, at, piece), places from 1; shorter strings give empty pieces."""
    size = F.length(s)
    cutpoint = lambda i: F.floor(size * i / n).cast("int")
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(i.alias("no"), (cutpoint(i - 1) + 1).alias("at"), F.substring(s, cutpoint(i - 1) + 1, cutpoint(i) - cutpoint(i - 1)).alias("piece")))


def probes(s: Column, lengths: Column, n: int) -> Column:
    """Substrings of ``s`` that can meet a segment of a string of one of ``lengths`` at most n-1 edits away: array of struct(len, no, piece).

    Segment ``no`` of a string of length l starts at floor(l(no-1)/n)+1; with d = |s|-l, only starts within no-1 of it, and within n-no of it plus d,
    can belong to an alignment whose errors left of the segment are fewer than no (multi-match-aware selection).
    """
    size = F.length(s)

    def of(no: Column, length: Column) -> Column:
        start = F.floor(length * (no - 1) / n).cast("int") + 1
        width = F.floor(length * no / n).cast("int") - start + 1
        d = size - length
        lo = F.greatest(F.lit(1), start - (no - 1), start + d - (n - no))
        hi = F.least(size - width + 1, start + (no - 1), start + d + (n - no))
        at = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda p: F.struct(length.alias("len"), no.alias("no"), F.substring(s, p, width).alias("piece")))

    return F.array_distinct(F.flatten(F.transform(lengths, lambda length: F.flatten(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda no: of(no, length))))))


def errors(a: Column, b: Column, edits: Column) -> Column:
    """Typing errors between two strings that are ``edits`` (at most 4) apart by levenshtein, where one swap of neighbours counts 1; null for more than 2.

    An edit more than two apart is explained by one swap and an edit, or by two swaps, or not at all.
    """
    swapped = lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a)))
    left = F.transform(F.filter(F.sequence(F.lit(0), F.length(a) - 1), lambda i: i > 0), lambda i: F.levenshtein(swapped(i), b, 2))
    letters = lambda x: F.array_sort(F.split(x, ""))

    def least(d: Column) -> Column:
        return F.when(F.array_contains(d, 0), 1).when((edits == 2) | F.array_contains(d, 1), 2).when(F.array_contains(d, 2) & (letters(a) == letters(b)), 2)

    return F.when(edits <= 1, edits).otherwise(let(left, least))


#: Edits that two typing errors may cost, a swap costing two; and segments of which one survives them.
REACH, SEGMENTS = 4, 5


def pigeonhole_join(forms: DataFrame, aliases: DataFrame) -> DataFrame:
    """(kind, form, ref_id, err) of all pairs of a form and an alias of one kind that are at most two typing errors apart.

    Aliases are cut into segments of which one survives REACH edits untouched; forms probe the substrings that may equal it. The
    equality join is on (kind, alias length, segment number, piece).
    """
    index = aliases.select("kind", "ref_id", "alias", F.length("alias").alias("len"), F.inline(segments(F.col("alias"), SEGMENTS))).select("kind", "ref_id", "alias", "len", "no", "piece")
    size = F.length("form")
    p = forms.select("kind", "form").distinct().select("kind", "form", F.explode(probes(F.col("form"), F.sequence(F.greatest(F.lit(1), size - REACH), size + REACH), SEGMENTS)).alias("p")).select("kind", "form", "p.*")
    pairs = p.join(index, ["kind", "len", "no", "piece"]).select("kind", "form", "ref_id", "alias").distinct()
    pairs = pairs.withColumn("edits", F.levenshtein("form", "alias", REACH)).where("edits >= 0").withColumn("err", errors(F.col("form"), F.col("alias"), F.col("edits")))
    return pairs.where("err is not null").groupBy("kind", "form", "ref_id").agg(F.min("err").alias("err"))


def map_values(values: DataFrame, aliases: DataFrame) -> DataFrame:
    """Map each typed value to the entry it means: (kind, value, ref_id), -1 if none is.

    ``values`` has (kind, value, forms, words, most): its normal forms, the best first, words that may name it by themselves, and the typing
    errors it may have. ``aliases`` has (kind, ref_id, alias). All forms and words go through one ``pigeonhole_join``. A form without an error that one entry alone
    has decides, the first such form first; else the fewest errors over all forms, if one entry alone has that few; else a word without an error, if all
    such words are of one entry. Ties between entries are reported as unmatched. Null and empty forms match nothing. What is found no way comes from an anti-join: no value is dropped.
    """
    forms = values.select("kind", "value", "most", F.posexplode("forms").alias("rank", "form"), F.lit(False).alias("word"))
    words = values.select("kind", "value", F.lit(0).alias("most"), F.lit(0).alias("rank"), F.explode("words").alias("form"), F.lit(True).alias("word"))
    every = cut(forms.unionByName(words).where("form <> ''"))
    hits = every.join(pigeonhole_join(every, aliases), ["kind", "form"]).where((F.col("err") == 0) | (F.col("err") <= F.least(F.col("most"), F.length("form") - 2)))
    way = lambda no, level: F.struct(F.lit(no).alias("way"), level.cast("int").alias("level"))
    ways = F.when(F.col("word"), F.array(way(2, F.lit(0)))).when(F.col("err") == 0, F.array(way(0, F.col("rank")), way(1, F.lit(0)))).otherwise(F.array(way(1, F.col("err"))))
    each = hits.select("kind", "value", "ref_id", F.inline(ways)).groupBy("kind", "value", "way", "level").agg(F.min("ref_id").alias("ref_id"), F.max("ref_id").alias("_other"))
    # of forms without an error those of several entries are passed over, of errors only the fewest count
    best = each.where("way <> 0 or ref_id = _other").groupBy("kind", "value", "way").agg(F.min_by(F.struct("ref_id", "_other"), "level").alias("b")).where("b.ref_id = b._other")
    found = cut(best.groupBy("kind", "value").agg(F.min_by("b.ref_id", "way").alias("ref_id")))
    missed = values.select("kind", "value").join(found, ["kind", "value"], "left_anti").withColumn("ref_id", F.lit(-1).cast("bigint"))
    return found.unionByName(missed)


# What is written around a town's name.
_SPACED = r"^\S(?: +\S)+$"
_BEFORE = r"^(?:\d{2}-\d{3} +)?(?:(?:gm\.|m\.|m\.st\.|gmina|miasto|wies) +)?"
_AFTER = r" *(?:\(.*|, *(?:ul|al|os|pl)\..*|[ ,]+woj\..*)$"
_VOWELS = "[aeiouy]"


def town_forms(value: Column) -> Column:
    """Normal forms of a typed town, best first: what is left without postal code, kind, district, street and province."""
    s = squeeze(fold(value))
    wide = F.replace(F.regexp_replace(F.regexp_replace(strip(fold(value)), r"(?U)\s{2,}", "\u0001"), r"(?U)\s", ""), F.lit("\u0001"), F.lit(" "))
    s = F.when(s.rlike(_SPACED), wide).otherwise(s)
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, _BEFORE, ""), _AFTER, ""), r"^[ .,;:-]+|[ .,;:-]+$", "")
    return F.array(s)


def town_aliases(cities: DataFrame) -> DataFrame:
    """(ref_id, alias): folded names; of two-word names also the words swapped and the second word cut to its consonants or first three letters."""
    n = squeeze(fold("city_name"))
    a, b = F.regexp_extract(n, r"^(\S+) (\S+)$", 1), F.regexp_extract(n, r"^(\S+) (\S+)$", 2)
    more = F.when(b != "", F.array(n, F.concat(b, F.lit(" "), a), F.concat(a, F.lit(" "), F.regexp_replace(b, _VOWELS, "")), F.concat(a, F.lit(" "), F.substring(b, 1, 3)))).otherwise(F.array(n))
    return cities.select(F.col("city_id").alias("ref_id"), F.explode(more).alias("alias")).where("alias <> ''").distinct()


def country_forms(value: Column) -> Column:
    """Normal forms of a typed country: the whole, what is in or before brackets, either side of a dash, single words of four letters and more."""
    s = squeeze(fold(value))
    trim = lambda c: F.regexp_replace(c, r"^[ .,;:-]+|[ .,;:-]+$", "")
    parts = F.concat(F.array(s, F.regexp_extract(s, r"\(([^()]*)\)", 1), F.regexp_replace(s, r" *\(.*$", "")), F.split(s, r" +[-–—] +"))
    return F.array_distinct(F.transform(parts, trim))


def country_words(value: Column) -> Column:
    """Words of a typed country that may name it among others (``Rzeczpospolita Polska``)."""
    return F.filter(F.split(squeeze(fold(value)), r"[^\p{L}]+"), lambda w: F.length(w) >= 4)


def country_aliases(countries: DataFrame) -> DataFrame:
    names = [squeeze(fold(c)) for c in ("country_code", "country_code3", "name_pl", "name_en", "name_native")]
    return countries.select(F.col("country_id").alias("ref_id"), F.explode(F.array(*names)).alias("alias")).where("alias <> ''").distinct()


def typed_places(envelope: DataFrame) -> DataFrame:
    """(object_id, field_name, contractor_no, value): the non-blank typed towns and countries of the envelope, distinct."""
    own = envelope.select(F.col("objectId").alias("object_id"), F.lit("organizationCity").alias("field_name"), F.lit(0).alias("contractor_no"), F.col("organizationCity").alias("value"))
    each = envelope.select(F.col("objectId").alias("object_id"), F.posexplode("contractors").alias("i", "c"))
    pairs = F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"c.{f}").alias("value")) for f in ("contractorCity", "contractorCountry")]))
    theirs = each.select("object_id", (F.col("i") + 1).alias("contractor_no"), pairs)
    return own.unionByName(theirs).where(~blank("value")).distinct()


def map_places(envelope: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """(object_id, field_name, contractor_no, ref_id) of every typed town and country that is not written exactly as in its list; -1 where none is meant.

    Rows are mapped through their distinct values. The lists, and the segments of their aliases, are broadcast only if they are few (counted).
    """
    town = F.col("field_name") != "contractorCountry"
    rows = typed_places(envelope).withColumn("kind", F.when(town, "town").otherwise("country"))
    listed = cities.select(F.lit("town").alias("kind"), F.col("city_name").alias("value")).unionByName(countries.select(F.lit("country").alias("kind"), F.col("country_code").alias("value")))
    typed = rows.join(small(listed), ["kind", "value"], "left_anti")
    v = F.col("value")
    is_town = F.col("kind") == "town"
    values = cut(typed.select("kind", "value").distinct().select("kind", "value", F.when(is_town, town_forms(v)).otherwise(country_forms(v)).alias("forms"), F.when(is_town, F.array().cast("array<string>")).otherwise(country_words(v)).alias("words"), F.when(is_town, TOWN_ERRORS).otherwise(COUNTRY_ERRORS).alias("most")))
    aliases = cut(town_aliases(cities).withColumn("kind", F.lit("town")).unionByName(country_aliases(countries).withColumn("kind", F.lit("country"))))
    mapping = map_values(values, small(aliases, BROADCAST_ROWS // SEGMENTS))
    return typed.join(mapping, ["kind", "value"]).select("object_id", "field_name", "contractor_no", "ref_id")


def unmatched_report(envelope: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """How often each field's values were mapped and how often none was meant: field_name, mapped, unmatched."""
    m = map_places(envelope, cities, countries)
    return m.groupBy("field_name").agg(F.count_if(F.col("ref_id") >= 0).alias("mapped"), F.count_if(F.col("ref_id") < 0).alias("unmatched"))
