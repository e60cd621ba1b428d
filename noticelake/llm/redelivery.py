"""Deduplicating new batches against all history (segment index for edit distance)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.functions.instants import SECOND, iso_nanos
from noticelake.functions.keys import object_key
from noticelake.llm.pages import page_text
from noticelake.llm.truncation import looks_cut, unmarked
from noticelake.runtime import checkpoint_dir, cut, small
from noticelake.sources.tables import append, delete_partitions

#: Edits that two deliveries of one text may differ by, and seconds that their publication may be written apart.
EDITS, APART = 2, 120
#: Seconds that one objectId's publication may be written apart (texts cut to seconds).
SAME_ID_APART = 5
#: Lengths of the beginnings by which cut-off texts are looked up: the least, and how many times longer each next one is.
LEAST, STEP = 3, 4

_BUCKET = 2 * APART * SECOND


def cuts(length: int, n: int) -> list[int]:
    """Where ``n`` segments of a string of ``length`` start, and its end."""
    return [length * i // n for i in range(n + 1)]


def segment_keys(text: str, k: int) -> tuple[list[int], list[int]]:
    """(keys to store, keys to probe): hashes of (length, segment number, piece) for the k+1 segments of the text, and for every substring
    that a segment of a text at most k edits away may equal (multi-match-aware: starts within what the errors left and right of it allow)."""
    n, size = k + 1, len(text)
    own = cuts(size, n)
    data = [text[a:b].encode() for a, b in zip(own, own[1:], strict=False)]
    key = lambda length, no, piece: xxhash.xxh64_intdigest(piece, length * n + no)
    store = [key(size, i, p) for i, p in enumerate(data)]
    probe = set()
    for length in range(max(n, size - k), size + k + 1):
        d, at = size - length, cuts(length, n)
        for i in range(n):
            start, width = at[i], at[i + 1] - at[i]
            for p in range(max(0, start - i, start + d - (k - i)), min(size - width, start + i, start + d + (k - i)) + 1):
                probe.add(key(length, i, text[p : p + width].encode()))
    return store, list(probe)


def beginning_keys(text: str, k: int) -> tuple[list[int], list[int]]:
    """(keys of a text as the whole one, keys of it as one cut off): hashes of (length, segment number, piece) for the k+1 segments of its beginnings
    of every length of the ladder, and for every substring that a segment of the beginning of the longest of these lengths it has may equal,
    in a text that starts as it does but for k edits (of the first i segments with at most i errors, the last has none)."""
    n, whole, own = k + 1, [], 0
    key = lambda length, no, piece: xxhash.xxh64_intdigest(piece, (1 << 32) + length * n + no)
    length = LEAST
    while length <= len(text):
        at, own = cuts(length, n), length
        whole += [key(length, i, text[a:b].encode()) for i, (a, b) in enumerate(zip(at, at[1:], strict=False))]
        length *= STEP
    at, part = cuts(own, n), set()
    for i in range(n if own else 0):
        start, width = at[i], at[i + 1] - at[i]
        part |= {key(own, i, text[p : p + width].encode()) for p in range(max(0, start - i), min(len(text) - width, start + i) + 1)}
    return whole, list(part)


_SIGNED = 1 << 64


def _signed(x: int) -> int:
    return x - _SIGNED if x >= _SIGNED >> 1 else x


def _read(bodies: pa.Array) -> tuple[list[str], list[bool]]:
    """Texts of pages without a cutter's mark, '' for none; and if their own ends show a cut."""
    pages = [(x, page_text(x)) if x else ("", "") for x in bodies.to_pylist()]
    return [unmarked(t) for _, t in pages], [bool(t) and looks_cut(x, t) for x, t in pages]


def records(bronze: DataFrame) -> DataFrame:
    """What identifies each delivery: ingest_id, oid (null if blank), at (ns, null if unreadable), text (its page's whole text without a cutter's mark, '' if none), shown (true if the page's own end shows a cut), content (the text's hash, null if none), and the keys of its index entries: stored and probed (of the text's segments), whole and part (of its beginnings, as the whole text and, if it shows a cut, as one cut off)."""
    schema = pa.schema([("ingest_id", pa.int64()), ("oid", pa.string()), ("at", pa.int64()), ("text", pa.string()), ("shown", pa.bool_()), ("content", pa.string()), *((n, pa.list_(pa.int64())) for n in ("stored", "probed", "whole", "part"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, shown = _read(b.column(3))
            keys = [segment_keys(t, EDITS) if len(t) > EDITS else ([], []) for t in texts]
            starts = [(w, c if cut_off else []) for (w, c), cut_off in zip((beginning_keys(t, EDITS) for t in texts), shown, strict=True)]
            content = [xxhash.xxh128_hexdigest(t.encode()) if t else None for t in texts]
            lists = [[[_signed(x) for x in pair[i]] for pair in pairs] for pairs in (keys, starts) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(x, f.type) for x, f in zip((texts, shown, content, *lists), list(schema)[3:], strict=True))], schema=schema)

    r = bronze.select("ingest_id", object_key("objectId").alias("oid"), iso_nanos("publicationDate").alias("at"), "htmlBody")
    return r.mapInArrow(run, "ingest_id bigint, oid string, at bigint, text string, shown boolean, content string, stored array<bigint>, probed array<bigint>, whole array<bigint>, part array<bigint>")


def _buckets(at: Column, width: int) -> Column:
    """Two bucket numbers of an instant; instants at most half a bucket apart share at least one."""
    return F.array(F.floor(at / width).cast("bigint") * 2, F.floor((at + width // 2) / width).cast("bigint") * 2 + 1)


def _groups(r: DataFrame) -> DataFrame:
    """(ingest_id, new, group): deliveries of one group are one version for certain: one objectId or one content, at one time. The group is null for what has neither."""
    by_id = F.transform(_buckets(F.col("at"), 2 * SAME_ID_APART * SECOND), lambda b: F.when(F.col("oid").isNotNull(), F.xxhash64(F.lit("id"), "oid", b)))
    by_text = F.transform(_buckets(F.col("at"), _BUCKET), lambda b: F.when(F.col("content").isNotNull() & F.col("at").isNotNull(), F.xxhash64(F.lit("text"), "content", b)))
    return r.select("ingest_id", "new", F.explode_outer(F.filter(F.concat(by_id, by_text), lambda g: g.isNotNull())).alias("group"))


def _same_length(i: int, j: int, a: str, b: str) -> int:
    """How many letters of ``a`` from ``i`` and ``b`` from ``j`` on are equal."""
    n, step = 0, 64
    most = min(len(a) - i, len(b) - j)
    while n < most and a[i + n : i + n + step] == b[j + n : j + n + step]:
        n, step = n + step, step * 2
    while step > 1 and n < most:
        step //= 2
        if a[i + n : i + n + step] == b[j + n : j + n + step]:
            n += step
    return min(n, most)


def edits_within(a: str, b: str, k: int) -> int:
    """Levenshtein distance of two texts, -1 for more than ``k``: the furthest place reached on each diagonal with 0, 1, … errors, so in time linear in their length."""
    goal = len(b) - len(a)
    if abs(goal) > k:
        return -1
    far = {0: _same_length(0, 0, a, b)}
    for errors in range(k + 1):
        if far.get(goal, -1) >= len(a):
            return errors
        ahead = {}
        for d in range(-errors - 1, errors + 2):
            i = min(max(far.get(d, -9) + 1, far.get(d - 1, -9), far.get(d + 1, -9) + 1), len(a), len(b) - d)
            if i >= 0 and i + d >= 0:
                ahead[d] = i + _same_length(i, i + d, a, b)
        far = ahead
    return -1


@F.arrow_udf(T.IntegerType())
def _beginnings_apart(a: pa.Array, b: pa.Array) -> pa.Array:
    """Edits between two texts over the length of the shorter one, -1 for more than EDITS."""
    short = ((x, y, min(len(x), len(y))) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True))
    return pa.array([edits_within(x[:n], y[:n], EDITS) for x, y, n in short], pa.int32())


def _candidates(r: DataFrame) -> DataFrame:
    """(a, b), a < b, of a new delivery and another whose index entries meet, published in neighbouring slots of time.

    Of equal texts of one slot the first stands for all, apart by whether their pages show a cut and by whether they are new. Entries are stored under both slots of
    the time they were published in and probed under one, so that texts repeated over the years never meet. Known texts' segments are never probed with: new ones meet them from
    their side. Both sorts of entries go through one join, as their keys never meet.
    """
    first = r.where("content is not null and at is not null").groupBy("content", "shown", "new", F.floor(F.col("at") / _BUCKET).alias("slot")).agg(F.min_by(F.struct("ingest_id", "at", "stored", "probed", "whole", "part"), "ingest_id").alias("r")).select("new", "r.*")
    slots = F.array_distinct(F.array(F.floor((F.col("at") - APART * SECOND) / _BUCKET), F.floor((F.col("at") + APART * SECOND) / _BUCKET)))
    kept = F.flatten(F.transform(slots, lambda s: F.transform(F.concat("stored", "part"), lambda k: F.xxhash64(k, s))))
    asked = F.transform(F.concat(F.when(F.col("new"), F.col("probed")).otherwise(F.array()), "whole"), lambda k: F.xxhash64(k, F.floor(F.col("at") / _BUCKET)))
    side = lambda keys, name: first.select(F.explode(keys).alias("key"), F.col("ingest_id").alias(name), F.col("new").alias(f"new_{name}"))
    met = side(kept, "a").join(side(asked, "b"), "key").where("(new_a or new_b) and a <> b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near(r: DataFrame) -> DataFrame:
    """(a, b), a < b: deliveries, one of them new, published close together whose texts are at most EDITS apart, or one of which is a cut-off copy of the other.

    A text cut off so early that it fits unlike ones goes to the likeliest (fewest edits, then nearest in time) and those alike to it.
    """
    pairs = cut(_candidates(r))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("ingest_id")).distinct()
    texts = cut(r.select("ingest_id", "at", "text", "shown").join(small(ids), "ingest_id", "left_semi"))
    side = lambda x: texts.select(F.col("ingest_id").alias(x), F.col("text").alias(f"t{x}"), F.col("at").alias(f"at_{x}"), F.col("shown").alias(f"shown_{x}"))
    p = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("apart", F.abs(F.col("at_a") - F.col("at_b"))).where(F.col("apart") <= APART * SECOND).withColumn("more", F.length("tb") - F.length("ta"))
    by_length = lambda x, y: F.when(F.col("more") > 0, x).otherwise(y)
    # cut before the filter, so that the edits are counted once
    p = cut(p.select("a", "b", "apart", "more", _beginnings_apart("ta", "tb").alias("edits"), by_length(F.col("shown_a"), F.col("shown_b")).alias("shown"))).where("edits >= 0")
    alike = F.col("more").between(-EDITS, EDITS)
    off = p.where(~alike & F.col("shown")).select("a", "b", "edits", "apart", by_length(F.col("a"), F.col("b")).alias("part"), by_length(F.col("b"), F.col("a")).alias("whole"))
    off = off.withColumn("likeliest", F.min(F.struct("edits", "apart", "whole")).over(Window.partitionBy("part"))["whole"])
    others = off.where("whole <> likeliest").select("a", "b", "whole", "likeliest").join(side("whole"), "whole").join(side("likeliest"), "likeliest").withColumn("edits", _beginnings_apart("twhole", "tlikeliest")).where("edits >= 0")
    return p.where(alike).unionByName(off.where("whole = likeliest"), allowMissingColumns=True).unionByName(others, allowMissingColumns=True).select("a", "b")


def link(r: DataFrame, known: DataFrame) -> DataFrame:
    """(ingest_id, first_id, new) of the deliveries that share a version with a new one: the first record of each set of linked records, of known ones the first they were linked to.

    ``r`` has the columns of ``records`` and ``new``, ``known`` the ``first`` of each known ``ingest_id`` that has one. Labels go through the groups until each group has one, that of
    its record too; while some have several, a round takes each label to its own record's and then through the groups again. Only groups with a new record and another take part, so that the loop works on the
    repeated deliveries alone. What a record or a group has in common is found by windows rather than joins: each exchange of a plan costs the driver memory, whatever the size of the tables.
    """
    near = _near(r).select(F.explode(F.array("a", "b")).alias("ingest_id"), F.xxhash64(F.lit("near"), "a", "b").alias("group"))
    g = _groups(r).unionByName(near, allowMissingColumns=True).unionByName(known, allowMissingColumns=True)
    of_id, of_group = Window.partitionBy("ingest_id"), Window.partitionBy("group")
    # a record may be new and known; first counts for what is known in r
    g = g.select("ingest_id", "group", F.max("new").over(of_id).alias("new"), (~F.min("new").over(of_id)).alias("old"), F.min("first").over(of_id).alias("first")).where("group is not null")
    g = g.select("ingest_id", "group", "new", F.least(F.when(F.col("new"), F.col("ingest_id")), F.coalesce(F.when(F.col("old"), F.col("first")), "ingest_id")).alias("first_id"))
    several = (F.min("ingest_id").over(of_group) < F.max("ingest_id").over(of_group)) & F.max("new").over(of_group)
    g = g.withColumns({"several": several, "first_id": F.min("first_id").over(of_group)}).where("several").select("ingest_id", "group", "new", "first_id").distinct()
    spread = lambda rows: rows.withColumn("first_id", F.min("first_id").over(of_id))
    g = cut(spread(g))
    # a record's label and its name as a label must be the same too: a known one's first may have been linked further
    named = lambda kind, name: F.struct(F.lit(kind).alias("kind"), F.col(name).alias("of"))
    labels = lambda: g.select(F.explode(F.array(named("group", "group"), named("record", "ingest_id"), named("record", "first_id"))).alias("k"), "first_id")
    while not labels().groupBy("k.kind", "k.of").agg(F.min("first_id").alias("least"), F.max("first_id").alias("most")).where("least < most").isEmpty():
        up = g.select(F.col("ingest_id").alias("first_id"), F.col("first_id").alias("further")).distinct()
        g = g.join(up, "first_id", "left").select("ingest_id", "group", "new", F.least("first_id", "further").alias("first_id"))
        g = cut(spread(g.withColumn("first_id", F.min("first_id").over(of_group))))
    return g.select("ingest_id", "first_id", "new").distinct()


def deduplicate_batch(spark: SparkSession, batch: DataFrame, store: str, label: str | None = None) -> DataFrame:
    """(ingest_id_a, ingest_id_b): the records b of a new batch that deliver again the version that record a, the first of it, delivered, in the batch or in what was taken in before.

    Records are one version if they have one objectId (as written apart from blanks, case, braces and dashes) and one time of publication, or
    texts at most EDITS edits apart (or cut off) published at most APART seconds apart, whatever their ids. Blank ids and missing
    bodies link by what else there is; records with neither are never linked. Repeated ingest_ids count once.

    ``store`` keeps the index: the records with their segment keys, by batch and week of publication, and the first record of each redelivery. The batch is appended as ``label`` and read
    back, so nothing else has to be materialised; a batch reads the weeks it publishes in and their neighbours, never all history. Taking in a label again replaces it; without one
    the batch gets a label of its own.
    Batches must come in order of ingest_id.
    """
    kept, firsts, label = f"{store}/records", f"{store}/firsts", f"batch-{label or uuid.uuid4().hex}"
    week = F.coalesce(F.floor(F.col("at") / (7 * 86400 * SECOND)), F.lit(-1)).cast("int")
    for path in (kept, firsts):
        delete_partitions(spark, path, batch=label)
    append(records(batch).withColumns({"week": week, "batch": F.lit(label)}), kept, ["batch", "week"])
    if not _exists(spark, kept):  # an empty batch into an empty store
        return spark.createDataFrame([], "ingest_id_a bigint, ingest_id_b bigint")
    index = spark.read.parquet(kept)
    columns = ["ingest_id", "oid", "at", "text", "shown", "content", "stored", "probed", "whole", "part"]
    mine = F.col("batch") == label
    new = index.where(mine)
    weeks = sorted({w + k for r in new.select(F.col("week").cast("int").alias("w")).distinct().collect() for w in (r.w,) for k in (-1, 0, 1)})
    every = new.select(*columns, F.lit(True).alias("new")).unionByName(index.where(~mine & F.col("week").cast("int").isin(weeks)).select(*columns, F.lit(False).alias("new")))
    known = spark.read.parquet(firsts).where(~mine).select("ingest_id", "first") if _exists(spark, firsts) else spark.createDataFrame([], "ingest_id bigint, first bigint")
    result = cut(link(every, known).where("new and ingest_id <> first_id").select("ingest_id", F.col("first_id").alias("first")))
    append(result.withColumn("batch", F.lit(label)), firsts, ["batch"])
    return result.select(F.col("first").alias("ingest_id_a"), F.col("ingest_id").alias("ingest_id_b"))


def _exists(spark: SparkSession, path: str) -> bool:
    """True if a table has been written there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*")
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def redelivered(bronze: DataFrame, batches: int = 1, store: str | None = None) -> DataFrame:
    """``deduplicate_batch`` of a whole table, taken in by so many ranges of ``batch_no`` one after the other (null counts as 0); the index goes into ``store``, or a folder of its own
    beside the checkpoints that is removed at the end."""
    spark = bronze.sparkSession
    place = store or f"{checkpoint_dir(spark)}/redelivered-{uuid.uuid4().hex}"
    found = spark.createDataFrame([], "ingest_id_a bigint, ingest_id_b bigint")
    if batches == 1:
        found = deduplicate_batch(spark, bronze, place, "0")
    else:
        no = F.coalesce("batch_no", F.lit(0))
        least, most = bronze.agg(F.min(no), F.max(no)).first()
        for k in range(batches):
            part = F.floor((no - F.lit(least or 0)) * batches / F.lit((most or 0) - (least or 0) + 1))
            found = found.unionByName(deduplicate_batch(spark, bronze.where(part == k), place, str(k)))
    if store is None:
        p = spark._jvm.org.apache.hadoop.fs.Path(place)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return found
