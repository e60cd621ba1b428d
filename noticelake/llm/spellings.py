"""Variant spellings of the names of organisations and people (noisy-channel attribution)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import blank, fold, let
from noticelake.llm.canonical import probes, segments
from noticelake.runtime import cut, small

#: Edits within one word, and letters of a word that can tell a name.
EDITS, TELLING = 2, 4
#: Log-likelihoods: of one edit, of a word cut short or written by initials, of a word left out.
EDIT, SHORT, OMITTED = -2.5, -1.0, -0.5

# Diminutives and the given names they stand for, and short forms that initials don't explain; marks folded.
DIMINUTIVES = {
    "ada": "adrianna", "adas": "adam", "ala": "alicja", "ania": "anna", "antek": "antoni", "arek": "arkadiusz", "asia": "joanna", "basia": "barbara", "bartek": "bartlomiej",
    "bogus": "boguslaw", "czarek": "cezary", "darek": "dariusz", "ela": "elzbieta", "ewka": "ewa", "franek": "franciszek", "gosia": "malgorzata", "grzes": "grzegorz",
    "hania": "hanna", "irek": "ireneusz", "iwonka": "iwona", "jacek": "jacek", "janek": "jan", "jas": "jan", "jarek": "jaroslaw", "jola": "jolanta", "jozek": "jozef", "jurek": "jerzy",
    "kasia": "katarzyna", "kazik": "kazimierz", "krysia": "krystyna", "krzysiek": "krzysztof", "krzys": "krzysztof", "kuba": "jakub", "leszek": "leslaw", "maciek": "maciej",
    "madzia": "magdalena", "magda": "magdalena", "marysia": "maria", "marzenka": "marzena", "michas": "michal", "mirek": "miroslaw", "misiek": "michal", "ola": "aleksandra", "olek": "aleksander",
    "pawelek": "pawel", "piotrek": "piotr", "radek": "radoslaw", "romek": "roman", "rysiek": "ryszard", "slawek": "slawomir", "stasiek": "stanislaw", "staszek": "stanislaw", "stas": "stanislaw",
    "tadek": "tadeusz", "tomek": "tomasz", "tosia": "antonina", "waldek": "waldemar", "wiesiek": "wieslaw", "witek": "witold", "wojtek": "wojciech", "zbyszek": "zbigniew", "zbychu": "zbigniew",
    "zenek": "zenon", "zosia": "zofia", "zuzia": "zuzanna", "ug": "gmina", "gm": "gmina", "gminy": "gmina",
}
# Legal forms, in the order they are taken out, and words that tell nothing.
_LEGAL = (
    r"(?<![a-z])(?:spolka|sp)[. ]*z[. ]*(?:ograniczona|o)[. ]*(?:odpowiedzialnoscia|o)(?![a-z])",
    r"(?<![a-z])sp[. ]*zoo(?![a-z])",
    r"(?<![a-z])(?:spolka|sp)[. ]*(?:komandytowa|komand|k|jawna|j|cywilna|c)(?![a-z])",
    r"(?<![a-z])(?:spolka akcyjna|s\. ?a\.?|sa)(?![a-z])",
    r"^f\. ?u\.",
    r"(?<![a-z])w m\.",
)
_NOISE = ("im", "imienia", "w", "we", "i", "nr", "z", "oraz", "urzad", "wojt", "burmistrz")


def words(name: Column) -> Column:
    """Words of a name: folded, legal forms and joining words out, digits apart from letters, diminutives as given names; an initial ends with ``_``."""
    s = fold(name)
    for rule in _LEGAL:
        s = F.regexp_replace(s, rule, " ")
    s = F.regexp_replace(F.regexp_replace(s, r"(?<![\p{L}\p{N}])(\p{L})\.", "$1_ "), r"(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})", " ")
    nick = F.create_map(*[F.lit(x) for kv in DIMINUTIVES.items() for x in kv])
    tokens = F.filter(F.split(s, r"[^\p{L}\p{N}_]+"), lambda w: (w != "") & ~w.isin(*_NOISE))
    return F.array_distinct(F.transform(tokens, lambda w: F.when(w.endswith("_"), w).otherwise(F.coalesce(F.try_element_at(nick, w), w))))


def word_fit(t: Column, u: Column) -> Column:
    """Log-likelihood of writing ``t`` for the word ``u``; null if it can't be meant."""
    letters = t.rlike(r"^\p{L}+$")
    cutoff = (F.length(t) >= 3) & u.startswith(t) | (F.length(u) >= 3) & t.startswith(u)
    edits = F.levenshtein(t, u, EDITS)
    typo = (edits >= 0) & (F.least(F.length(t), F.length(u)) >= 2 + edits) & letters
    return F.when(t == u, 0.0).when(t.endswith("_") | u.endswith("_"), F.when(F.substring(t, 1, 1) == F.substring(u, 1, 1), SHORT)).when(letters & cutoff, SHORT).when(typo, EDIT * edits)


def name_fit(s: Column, c: Column) -> Column:
    """Log-likelihood that a name of words ``s`` is written for one of words ``c``; null if a word or number of ``s`` has none to stand for.

    Every word of ``c`` is written once: one that ``s`` has too is that one, and words of ``s`` that the same few words explain are at most as many as these.
    Only letters for several words (``PPH``) take none away. A bare initial of ``c`` explains a word of ``s`` if the longest word of one name, the one that tells
    most, is written out in the other.
    """
    numeric = lambda ws: F.filter(ws, lambda w: w.rlike(r"^\p{N}+$"))
    initials = F.array_join(F.transform(c, lambda w: F.substring(w, 1, 1)), "")
    by_initials = lambda t: t.rlike(r"^\p{L}{2,5}$") & (initials.contains(t) | initials.contains(F.replace(t, F.lit("i"), F.lit(""))))
    bare = lambda t: t.endswith("_")
    most = lambda ws: F.coalesce(F.array_max(F.transform(F.filter(ws, lambda w: w.rlike(r"^\p{L}+$")), F.length)), F.lit(0))
    rest = F.array_except(c, s)

    def explained(t: Column) -> Column:
        fits = F.filter(F.transform(rest, lambda u: F.struct(word_fit(t, u).alias("fit"), u.alias("u"))), lambda e: e["fit"].isNotNull())
        alone = lambda f: F.when(~bare(t) & ~by_initials(t) & F.forall(f, lambda e: bare(e["u"])), t)
        return let(
            fits, lambda f: F.struct(F.greatest(F.array_max(f)["fit"], F.when(by_initials(t), SHORT)).alias("fit"), F.when(~by_initials(t), F.transform(f, lambda e: e["u"])).alias("by"), alone(f).alias("alone"))
        )

    def total(each: Column) -> Column:
        by = F.filter(F.transform(each, lambda e: e["by"]), lambda ws: ws.isNotNull())
        enough = lambda ways: F.forall(ways, lambda o: F.size(F.filter(ways, lambda ws: F.size(F.array_except(ws, o)) == 0)) <= F.size(o)) & (F.size(F.array_distinct(F.flatten(ways))) >= F.size(ways))
        alone = F.filter(F.transform(each, lambda e: e["alone"]), lambda t: t.isNotNull())
        written = lambda u: F.exists(s, lambda t: ~bare(t) & word_fit(t, u).isNotNull())
        told = (F.size(alone) == 0) | (most(F.array_except(s, alone)) >= most(alone)) | F.exists(c, lambda u: (F.length(u) == most(c)) & ~bare(u) & written(u))
        sums = F.aggregate(each, F.lit(0.0), lambda a, e: a + e["fit"])
        return F.when(let(by, enough) & told, sums + OMITTED * F.greatest(F.size(c) - F.size(s), F.lit(0)))

    ok = (F.size(F.array_except(numeric(s), numeric(c))) == 0) & ((F.size(numeric(s)) > 0) | (F.size(numeric(c)) == 0) | (F.size(s) < F.size(c)))
    return F.when(ok, let(F.transform(F.array_except(s, c), explained), total))


def spellings(envelope: DataFrame) -> DataFrame:
    """(name, freq): every stored spelling of an organisation's or contractor's name that is not blank, and how many times it stands there."""
    own = envelope.select(F.col("organizationName").alias("name"))
    theirs = envelope.select(F.explode("contractors").alias("c")).select(F.col("c.contractorName").alias("name"))
    return own.unionByName(theirs).where(~blank("name")).groupBy("name").agg(F.count("*").alias("freq"))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(t, u) of all words at most EDITS edits apart, each with itself too: pigeonhole join on segments, then levenshtein."""
    n = EDITS + 1
    size = F.length("t")
    index = vocabulary.select(F.col("t").alias("u"), F.length("t").alias("len"), F.inline(segments(F.col("t"), n))).select("u", F.xxhash64("len", "no", "piece").alias("key"))
    probe = vocabulary.select("t", F.explode(probes(F.col("t"), F.sequence(F.greatest(F.lit(n), size - EDITS), size + EDITS), n)).alias("p")).select("t", F.xxhash64("p.len", "p.no", "p.piece").alias("key"))
    pairs = probe.join(index, "key").where(F.levenshtein("t", "u", EDITS) >= 0).select("t", "u")
    return pairs.unionByName(vocabulary.select("t", F.col("t").alias("u"))).distinct()


def marks(w: Column) -> Column:
    """What a name of words ``w`` can explain words by: its words, ``^`` and the first letter of each, ``#`` and each run of up to five initials (the empty one too)."""
    first = F.transform(w, lambda t: F.substring(t, 1, 1))
    initials = F.array_join(first, "")
    runs = F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.concat(F.lit("#"), F.substring(initials, i, k))))
    return F.array_distinct(F.concat(w, F.transform(first, lambda x: F.concat(F.lit("^"), x)), F.flatten(runs)))


def explaining(vocabulary: DataFrame) -> DataFrame:
    """(t, mark) of every word and each mark of a name that may explain it: all that ``word_fit`` accepts but a bare initial for a whole word, and no frequency left out."""
    letters = vocabulary.where(F.col("t").rlike(r"^\p{L}+$"))
    near = near_words(letters.where(F.length("t") >= 3))
    longer = letters.where(F.length("t") > 3).select(F.col("t").alias("u"), F.explode(F.transform(F.sequence(F.lit(3), F.length("t") - 1), lambda k: F.substring(F.col("t"), F.lit(1), k))).alias("t"))
    longer = longer.join(letters, "t").select("t", "u")
    own = F.when(F.col("t").endswith("_"), F.array("t", F.concat(F.lit("^"), F.substring("t", 1, 1)))).otherwise(F.array("t"))
    runs = F.when(F.col("t").rlike(r"^\p{L}{2,5}$"), F.array(F.concat(F.lit("#"), "t"), F.concat(F.lit("#"), F.replace("t", F.lit("i"), F.lit(""))))).otherwise(F.array().cast("array<string>"))
    alone = vocabulary.select("t", F.explode(F.concat(own, runs)).alias("u"))
    return near.unionByName(longer).unionByName(longer.select(F.col("u").alias("t"), F.col("t").alias("u"))).unionByName(alone).select("t", F.col("u").alias("mark")).distinct()


def shared(s: Column, c: Column) -> Column:
    """True if two names share a telling word at most EDITS edits apart, or all words, or are written with the same letters (``ZUK`` and ``Z.U.K.``)."""
    letters = lambda ws: F.replace(F.array_join(ws, ""), F.lit("_"), F.lit(""))
    tell = lambda ws: F.filter(ws, lambda w: (F.length(w) >= TELLING) & ~w.rlike(r"\p{N}|_"))
    return (F.array_sort(s) == F.array_sort(c)) | (letters(s) == letters(c)) | F.arrays_overlap(tell(s), tell(c)) | F.exists(tell(s), lambda t: F.exists(tell(c), lambda u: F.levenshtein(t, u, EDITS) >= 0))


def attribute(names: DataFrame) -> DataFrame:
    """(name, root): each spelling with the canonical one it is attributed to, itself if none.

    Frequent and complete spellings are the candidates: those with more words, or as many and a higher count (ties by name). A spelling goes
    to the candidate of greatest posterior, log count plus the log-likelihoods of its edits, short forms and omissions, if the
    candidate explains every word and number of it; from there on to that one's own. Candidates are ``shared``. As a candidate explains every word of a spelling, it is looked up by the
    rarest one, the word that the fewest names may explain (typos count as what they may be), among all words of all names, however common. A candidate that
    has that one as a bare initial alone is looked up by that letter and the next rarest word, one that has both so by both letters and each word after these: so
    every candidate is found that explains the spelling, whatever the size of the table.
    """
    n = cut(names.select("name", "freq", words(F.col("name")).alias("w")).where(F.size("w") > 0).withColumn("id", F.xxhash64("name")))
    each = n.select("id", F.explode("w").alias("t"))
    bare = F.array_distinct(F.transform(F.filter("w", lambda t: t.endswith("_")), lambda t: F.substring(t, 1, 1)))
    two = F.flatten(F.transform(bare, lambda x: F.transform(bare, lambda y: F.concat(x, y))))
    marked = cut(n.select("id", F.explode(marks(F.col("w"))).alias("mark"), F.concat(bare, two).alias("initials")))
    df = marked.groupBy("mark").agg(F.count("*").alias("df"))
    by = cut(explaining(each.select("t").distinct()).join(df, "mark"))
    reach = by.groupBy("t").agg(F.sum("df").alias("reach"))
    ranked = each.join(reach, "t").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("reach", "t"))).alias("ts"))
    letter = lambda i: F.substring(F.col("ts")[i]["t"], 1, 1)
    looked = ranked.select(F.col("id").alias("s"), F.posexplode("ts").alias("place", "e"), letter(0).alias("x"), F.when(F.size("ts") > 1, F.concat(letter(0), F.get("ts", F.lit(1))["t"].substr(1, 1))).alias("xy"))
    looked = looked.select("s", "e.t", F.when(F.col("place") == 0, "").when(F.col("place") == 1, F.col("x")).otherwise(F.col("xy")).alias("initials"))
    some = cut(marked.where(F.size("initials") > 0).select(F.col("id").alias("c"), "mark", F.explode("initials").alias("initials")))
    ways = by.select("t", "mark")
    first = looked.where("initials = ''").join(ways, "t").join(marked.select(F.col("id").alias("c"), "mark"), "mark").select("s", "c")
    later = looked.where("initials <> ''").join(small(some.select("initials").distinct()), "initials", "left_semi").join(ways, "t").join(some, ["initials", "mark"]).select("s", "c")
    pairs = first.unionByName(later).where("s <> c").distinct()
    side = lambda p: n.select(F.col("id").alias(p), F.col("w").alias(f"w{p}"), F.col("freq").alias(f"f{p}"), F.col("name").alias(f"n{p}"))
    p = pairs.join(side("s"), "s").join(side("c"), "c")
    rank = lambda x: F.struct(F.size(f"w{x}"), F.col(f"f{x}"), F.col(f"n{x}"))
    p = p.where(rank("c") > rank("s")).withColumn("fit", name_fit(F.col("ws"), F.col("wc"))).where(F.col("fit").isNotNull() & shared(F.col("ws"), F.col("wc")))
    # of as many words, each must explain the other: a short form may hide in a telling word
    p = p.where((F.size("ws") < F.size("wc")) | name_fit(F.col("wc"), F.col("ws")).isNotNull())
    best = p.groupBy("s").agg(F.max_by("c", F.struct(F.log("fc") + F.col("fit"), F.col("fc"), F.col("nc"))).alias("c"))
    up = cut(n.select("id").join(best.withColumnRenamed("s", "id"), "id", "left").select("id", F.coalesce("c", "id").alias("up")))
    while True:  # every step halves the way to the root
        higher = cut(up.join(up.select(F.col("id").alias("up"), F.col("up").alias("top")), "up").select("id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
        up = higher.select("id", "up")
        if higher.where("moved").limit(1).count() == 0:
            break
    roots = up.join(n.select(F.col("id").alias("up"), F.col("name").alias("root")), "up")
    return n.select("id", "name").join(roots, "id").select("name", "root")


def same_names(envelope: DataFrame) -> DataFrame:
    """(name_a, name_b), a before b by code point: all pairs of different spellings attributed to one canonical one. Null and blank names and names without a word are in none."""
    r = cut(attribute(spellings(envelope)))
    return r.select("root", F.col("name").alias("name_a")).join(r.select("root", F.col("name").alias("name_b")), "root").where("name_a < name_b").select("name_a", "name_b")


def entities(envelope: DataFrame) -> DataFrame:
    """One row a spelling: name, freq, canonical (the spelling it is attributed to) and n_spellings of that."""
    s = cut(spellings(envelope))
    r = cut(attribute(s))
    k = r.groupBy("root").agg(F.count("*").alias("n_spellings"))
    return s.join(r, "name").join(k, "root").select("name", "freq", F.col("root").alias("canonical"), "n_spellings")
