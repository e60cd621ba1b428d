import random

from noticelake.llm.truncation import evidence, evidence_report, looks_cut, sentences, strict_prefixes, truncated, truncation_share, unfinished, unmarked
from noticelake.llm.pages import page_text

SCHEMA = "ingest_id bigint, feed_source string, htmlBody string, text string"


def page(text, end="</p></body></html>"):
    return f"<html><head><title>t</title></head><body><h3>9.3) X</h3><p>{text}{end}"


def test_strict_prefixes_match_brute_force(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 12))) for _ in range(400)] + ["", None, "a" * 9] * 20
    got = {r.id for r in strict_prefixes(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(7)).collect()}
    some = {t for t in texts if t}
    assert got == {i for i, t in enumerate(texts) if t and any(o != t and o.startswith(t) for o in some)}
    assert strict_prefixes(spark.createDataFrame([], "id bigint, text string")).count() == 0


def test_cases(spark, rows):
    full = "Termin upływa 2028 r. i trwa. Kara wynosi 5 zł."
    data = [
        (1, "a", page(full), None), (2, "a", page(full, "</p></body></HTML><!-- koniec -->\n"), None), (3, "a", page("Termin upływa 2028 r."), None), (4, "b", page("Termin upływa 2028 r. i trwa."), None), (5, "b", page(full, ""), None),
        (6, "b", page("Inna treść [...]"), None), (7, "b", page("Inna treść…"), None), (8, None, page("Inna treś"), None), (9, "c", page("Z dnia", "</p><h3>9.4) Data</h3>2025-01-01<br/></body></html>"), None), (10, "c", None, "x"), (11, "c", " ", "x"), (8, None, page("Inna treś"), None), (12, "c", page("Ko", "") + "&oacu", None), (13, "c", page("x" * 50000 + "."), None),
    ]
    b = spark.createDataFrame(data, SCHEMA)
    assert [r[0] for r in rows(truncated(b))] == sorted([3, 4, 5, 6, 7, 8, 12], key=lambda i: repr((i,)))
    share = {r.feed_source: (r.n_records, r.n_bodies, r.n_truncated) for r in truncation_share(b).collect()}
    assert share["a"] == (3, 3, 1) and share["c"] == (5, 3, 1) and share[None][2] == 1
    assert truncated(b.limit(0)).count() == 0


def test_words_that_go_on_elsewhere_match_brute_force(spark):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["umowa", "umowy", "umów", "art. 5", "dni", "dnia", "kary", "nr 7", "nr 12", "Zob", "i"])
    texts = [" ".join(word() for _ in range(rnd.randint(1, 9))) + rnd.choice([".", "", "", "…", ". Dalej jest", "�"]) for _ in range(500)]
    got = {r.ingest_id: r for r in evidence(spark.createDataFrame([(i, None, page(t), None) for i, t in enumerate(texts)], SCHEMA).repartition(5)).collect()}
    places = set()
    for t in texts:
        for ws in sentences(unmarked(page_text(page(t)))):
            for j, w in enumerate(ws):
                places |= {(tuple(ws[max(0, j - 2) : j]), w[:k]) for k in range(1, len(w) + (j + 1 < len(ws)))}
    for i, t in enumerate(texts):
        full = page_text(page(t))
        text = unmarked(full)
        ws = sentences(text)[-1] if text != full or unfinished(full) else []
        want = bool(ws) and (tuple(ws[-3:-1]), ws[-1]) in places
        assert (got[i].words if i in got else False) == want, t
    r = evidence_report(spark.createDataFrame([(1, None, page("Ala ma kota."), None), (2, None, page("Ala ma ko"), None), (3, None, page("Obca tre"), None)], SCHEMA)).first()
    assert (r.n_found, r.by_copy, r.by_words, r.by_prefix, r.end_only) == (2, 1, 1, 1, 1)


def test_abbreviations_end_no_sentence():
    assert looks_cut(page("x"), "Zgodnie z art.") and not looks_cut(page("x"), "z dnia 5 r..") and not looks_cut(page("x"), "pok. 334.")
