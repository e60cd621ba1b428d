import random
from pathlib import Path

import pytest

from noticelake.llm.queries import QUERIES
from noticelake.llm.redelivery import beginning_keys, deduplicate_batch, edits_within, redelivered, segment_keys

SF = Path("/root/testdata/sf0.001")
SCHEMA = "ingest_id bigint, objectId string, publicationDate string, htmlBody string, text string, at string"


def body(rnd, n=60):
    return "<html><head><title>a</title></head><body><p>" + " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n)) + ".</p></body></html>"


def test_segments_meet_within_the_edits():
    rnd = random.Random(2)
    for _ in range(300):
        t = "".join(rnd.choice("abc") for _ in range(rnd.randint(3, 60)))
        s = t
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(s))
            s = s[:i] + rnd.choice(["", "x", s[i] + "y"]) + s[i + 1 :]
        if len(s) > 2:
            assert set(segment_keys(t, 2)[0]) & set(segment_keys(s, 2)[1])


def deliveries():
    rnd = random.Random(3)
    a, b, c = body(rnd), body(rnd), body(rnd)
    at = "2026-01-0{}T10:00:{}Z".format
    return [
        (1, "A-1", at(1, "00.1234567"), a, None, ""), (2, " {a1} ", "2026-01-01T11:00:00.123+01:00", None, None, ""), (3, "", at(1, "30"), a.replace("<p>", "<p>q", 1), None, ""), (4, "new", at(1, "50"), a.replace("<p>", "<p>  <b>").replace("title", "TITLE"), None, ""),
        (5, "other", at(5, "00"), a, None, ""), (6, "A-1", at(3, "00"), b, None, ""), (7, None, at(2, "00"), c, None, ""), (8, None, at(2, "20"), c[: len(c) - 120] + "</p></body></html>", None, ""), (9, " ", None, None, None, ""), (10, None, "x", None, None, ""), (11, "Z", at(6, "00"), "", None, ""), (12, "z", at(6, "00.5"), "", None, ""),
    ]


WANT = [(1, 2), (1, 3), (1, 4), (11, 12), (7, 8)]


def test_versions(spark, rows):
    df = spark.createDataFrame(deliveries(), SCHEMA)
    assert rows(redelivered(df.union(df.limit(3)))) == sorted(WANT, key=repr)
    assert redelivered(df.limit(0)).count() == 0


def test_batches_give_the_same_as_all_at_once(spark, tmp_path):
    d, store, got = deliveries(), str(tmp_path / "store"), []
    for k in range(0, 12, 3):
        got += [tuple(r) for r in deduplicate_batch(spark, spark.createDataFrame(d[k : k + 3], SCHEMA), store).collect()]
    assert sorted(got) == sorted(WANT)


def test_beginnings_meet_within_the_edits():
    rnd = random.Random(4)
    for _ in range(2000):
        t = "".join(rnd.choice("abc") for _ in range(rnd.randint(3, 60)))
        n = rnd.randint(3, len(t))
        s = list(t[:n])
        for _ in range(rnd.randint(0, 2)):
            s[rnd.randrange(n)] = rnd.choice("abcx")
        if n > 3 and rnd.random() < 0.3:
            i = rnd.randrange(n - 1)
            s = [*t[:i], "x", *t[i : n - 1]]
        assert set(beginning_keys(t, 2)[0]) & set(beginning_keys("".join(s), 2)[1])


def test_copies_cut_off_early_or_with_an_edit_near_the_start(spark, rows):
    rnd = random.Random(5)
    a, b, c, d = (body(rnd) for _ in range(4))
    cut = lambda x, n: x[: x.index("<p>") + 3 + n]
    same, at = c[: c.index("<p>") + 3 + 150], "2026-01-0{}T10:00:{}Z".format
    data = [
        (1, "a", at(1, "00"), a, None, ""), (2, "b", at(1, "40"), cut(a, 150), None, ""), (3, "c", at(2, "00"), cut(b, 10), None, ""), (4, " ", at(2, "40"), b, None, ""),
        (5, "e", at(3, "00"), c, None, ""), (6, "f", at(3, "10"), cut(c, 300).replace("<p>", "<p>x", 1), None, ""),
        (7, "g", at(4, "00"), c, None, ""), (8, "h", at(4, "30"), same + d[d.index("<p>") + 3 :], None, ""), (9, "i", at(4, "40"), cut(c, 120), None, ""), (10, "j", at(5, "00"), d, None, ""),
    ]
    assert rows(redelivered(spark.createDataFrame(data, SCHEMA))) == sorted([(1, 2), (3, 4), (5, 6), (8, 9)], key=repr)


def test_copies_cut_at_a_mark_or_after_a_full_stop(spark, rows):
    rnd, at = random.Random(6), "2026-01-0{}T10:00:{}Z".format
    data = []
    for k, end in enumerate([" [...]</p></body></html>", "...</p></body></html>", "… </p></body></html>", " (dalej)</p></body></html>", ". ", ".</p></body></html>"]):
        a = body(rnd)
        half = a[: a.index("<p>") + 3 + 300]
        whole = half + ". " + a[len(half) :]
        data += [(2 * k + 1, f"a{k}", at(k + 1, "00"), whole, None, ""), (2 * k + 2, f"b{k}", at(k + 1, "40"), half + end, None, "")]
    # the last, closed and without a mark, is a version of its own
    assert rows(redelivered(spark.createDataFrame(data, SCHEMA))) == sorted([(2 * k + 1, 2 * k + 2) for k in range(5)], key=repr)


def test_edits_within_match_brute_force():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rnd = random.Random(8)
    for _ in range(4000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9)))
        b = list(a) if rnd.random() < 0.7 else [rnd.choice("ab") for _ in range(rnd.randint(0, 9))]
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randint(0, len(b))
            b[i : i + rnd.randint(0, 1)] = rnd.choice(["", "a", "b"])
        b = "".join(b)
        want = slow(a, b)
        assert edits_within(a, b, 2) == (want if want <= 2 else -1), (a, b)
    long = "żółw " * 50_000
    assert edits_within(long, "x" + long[:-1], 2) == 2 and edits_within(long, long[:100_000] + "??" + long[100_000:], 2) == 2 and edits_within(long, long[1:] + "xyz", 2) == -1


def test_ranges_of_batches_and_batches_taken_in_again(spark, rows, tmp_path):
    df = spark.createDataFrame([(*d, None if d[0] < 3 else d[0] // 2) for d in deliveries()], SCHEMA + ", batch_no int")
    want = sorted(WANT, key=repr)
    store = str(tmp_path / "s")
    assert rows(redelivered(df, 3, store)) == want
    late = df.where("ingest_id >= 8")
    assert rows(deduplicate_batch(spark, late, store, "2")) == [r for r in want if r[1] >= 8]
    assert redelivered(df.limit(0), 2).count() == 0


def test_labels_go_along_chains_and_through_firsts_of_earlier_batches(spark, rows, tmp_path):
    rnd, at = random.Random(9), "2026-01-0{}T10:00:00Z".format
    ids, texts, data = list(range(1, 61)), [body(rnd, 8) for _ in range(32)], []
    rnd.shuffle(ids)
    # two chains, each record of one objectId with the one before and of one text with the one after
    for k, i in enumerate(ids):
        data.append((i, f"{k // 2}", at(1 + k // 40), texts[(k + 1) // 2 + k // 40], None, ""))
    want = [(min(c), i) for c in (ids[:40], ids[40:]) for i in c if i != min(c)]
    assert rows(redelivered(spark.createDataFrame(data, SCHEMA))) == sorted(want, key=repr)
    # 20 shares a version with 10, known to repeat 5, which 21 shows to repeat 2
    early = [(2, "y", at(1), None, None, ""), (5, "x", at(1), texts[0], None, ""), (10, "x", at(1), texts[1], None, "")]
    late = [(20, "z", at(1), texts[1], None, ""), (21, "y", at(1), texts[0], None, "")]
    store = str(tmp_path / "s")
    assert rows(deduplicate_batch(spark, spark.createDataFrame(early, SCHEMA), store)) == [(5, 10)]
    assert rows(deduplicate_batch(spark, spark.createDataFrame(late, SCHEMA), store)) == [(2, 20), (2, 21)]


def test_a_batch_plans_few_exchanges(spark, tmp_path):
    """Each exchange has a thread, plans and compiled code in the driver, whatever the size of the batch."""
    bus, seen = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    store, d = str(tmp_path / "s"), deliveries()

    def exchanges():
        bus.waitUntilEmpty(30_000)
        ran = seen.executionsList()
        graphs = [seen.planGraph(ran.apply(i).executionId()).allNodes() for i in range(ran.size())]
        return sum(g.apply(i).name() in ("Exchange", "BroadcastExchange") for g in graphs for i in range(g.size()))

    before = exchanges()
    deduplicate_batch(spark, spark.createDataFrame(d[:6], SCHEMA), store)
    first = exchanges() - before
    deduplicate_batch(spark, spark.createDataFrame(d[6:], SCHEMA), store)
    assert first <= 25 and exchanges() - before - first <= 25


@pytest.mark.skipif(not (SF / "bronze_notices.parquet").exists(), reason="no test data")
def test_batches_of_the_whole_table_give_the_same(spark, rows):
    want = rows(QUERIES["p7_at_once"](spark, str(SF)))
    assert want and rows(QUERIES["p7_found"](spark, str(SF))) == want
