import random

import pytest

from noticelake.functions.headings import headings
from noticelake.operators.sections import assign, heading_rows, quarantine, section_tables, typed
from noticelake.profiles import PROFILES, Profile, Section, load_profile, table_name

P = PROFILES["ContractNotice"]


def h3(n, v):
    return f"<h3>{n}) X: <span class='normal'>{v}</span></h3>"


def test_value_candidates():
    body = "<h3>1.1) A</h3>text<br/><p>one</p><p>two</p><div>skip</div><h3>1.2.) B <span class='normal'>s&oacute;</span></h3><h2>S</h2><p>no</p><h3>no number</h3><h3>1.3) C</h3><p>p1<p>p2"
    got = [(h["number"], h["span"], h["inline"], h["paragraphs"]) for h in headings(body)]
    assert got == [("1.1", None, "text", ["one", "two"]), ("1.2", "só", None, []), ("1.3", None, None, ["p1", "p2"])]
    assert headings(None) is None and headings("") == []


def _machine(seq):
    """The rule replayed heading by heading: (ent_idx, chi_idx) of each."""
    out, ent, last, chi, clast = [], 0, None, 0, None
    for leaf, key in seq:
        if leaf == "core":
            if last is not None and key <= last:
                ent, chi, clast = ent + 1, 0, None
            last = key
            out.append((ent, 0))
        else:
            if clast is not None and key <= clast:
                chi += 1
            clast = key
            out.append((ent, chi))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_assignment_matches_replay(spark, seed):
    rnd = random.Random(seed)
    data, want = [], {}
    for page in range(40):
        seq = [(leaf := rnd.choice(["core", "criterion"]), rnd.choice(["4.2.2", "4.2.6", "4.2.10"] if leaf == "core" else ["4.3.5", "4.3.6"])) for _ in range(rnd.randint(0, 12))]
        key = lambda n: tuple(map(int, n.split(".")))
        for pos, ((leaf, n), w) in enumerate(zip(seq, _machine([(leaf, key(n)) for leaf, n in seq]), strict=True)):
            data.append((str(page), pos, n, "part", leaf))
            want[str(page), pos] = w
    got = assign(spark.createDataFrame(data, "objectId string, pos int, number string, entity string, leaf string")).collect()
    assert {(r.objectId, r.pos): (r.ent_idx, r.chi_idx) for r in got} == want


def test_tables_and_quarantine(spark, rows):
    data = [
        ("a", "ContractNotice", h3("1.1", "N") + h3("4.3.5", "orphan") + h3("4.2.2", "p1") + h3("4.3.5", "c1") + h3("4.3.6", "33,5") + h3("4.2.2", "p2") + h3("4.3.5", "c2") + h3("99.9", "?")),
        ("b", "ContractNotice", h3("1.1", "N") + h3("1.1", "again")), ("c", "ContractNotice", None), ("d", "Other", h3("1.1", "x")), ("e", None, ""),
    ]
    pages = spark.createDataFrame(data, "objectId string, noticeType string, htmlBody string")
    hr = heading_rows(pages, [P])
    t = section_tables(pages, hr, P)
    assert rows(t["core", "core"].select("objectId", "section_1_1")) == [("a", "N"), ("c", None)]
    assert rows(t["part", "core"].select("objectId", "part_ordinal", "section_4_2_2")) == [("a", 1, "p1"), ("a", 2, "p2")]
    crit = typed(t["part", "criterion"], P, "part", "criterion")
    assert rows(crit.select("part_ordinal", "part_criterion_ordinal", "section_4_3_5", "section_4_3_6")) == [(1, 1, "orphan", None), (1, 2, "c1", 34), (2, 3, "c2", None)]
    assert rows(quarantine(hr, pages, [P]).select("objectId", "data_model")) == [("a", "unknown"), ("b", "core"), ("d", "core"), ("e", "core")]


def test_errors_are_kept_per_column(spark):
    t = spark.createDataFrame([("a", "x", "abc", None)], "objectId string, section_9_4 string, section_1_3 string, section_1_1 string")
    p = Profile("T", (Section("9.4", parser="parse_date_from_text"), Section("1.3", derived={"n": "parse_int_from_text"}), Section("1.1", parser="unknown")))
    r = typed(t, p, "core", "core").first()
    assert (r.section_9_4, r.n, len(r.parse_errors)) == (None, None, 2) and r.parse_errors[0].startswith("section_9_4: parse_date_from_text")


def test_names_and_files(tmp_path):
    assert table_name("ContractNotice", "part", "criterion") == "contract_notice__part_criterion" and table_name(None, "core", "core") == "unknown__core"
    f = tmp_path / "p.json"
    f.write_text('{"notice_type": "T", "sections": [{"number": "1.1"}, {"number": "3.4.1", "model": "part.part", "full_block": true}], "computed": {"x": ["compute_duration_days", ["a", "b"]]}}')
    p = load_profile(f)
    assert p.sections[1].leaf == "part" and p.computed["x"] == ("compute_duration_days", ("a", "b"))
