import pytest
from pyspark.sql import functions as F

from noticelake.functions import durations, identifiers
from noticelake.functions import parsers as P
from noticelake.functions.instants import iso_nanos
from noticelake.functions.keys import file_name, leading_section_number, notice_number, notice_type_token, object_key, section_number, snake_case
from noticelake.functions.markup import decode_entities, markup_text
from noticelake.functions.text import blank, squeeze, strip

FAIL = object()
CASES = {
    "parse_pln_value": [("184 430,40 PLN", 184430.4), ("1.234,56", 1234.56), ("1.234", 1.234), ("1,234,567", FAIL), ("-5", FAIL), ("12 abc", 12.0), ("12\xa0000 zł", 12000.0), ("nie dotyczy", FAIL), (" ", None), (None, None), (",", FAIL)],
    "parse_tak_nie": [("  Tak ", True), ("NIE", False), ("moze", FAIL), ("", None), (None, None)],
    "parse_criterion_weight": [("60,00", 60), ("100 %", 100), ("33,5", 34), ("32.5", 32), ("x", FAIL), ("99999999999", FAIL), ("9" * 400, FAIL), (None, None)],
    "parse_cpv_codes": [("45000000-7 (a),1234567-8, 45000000-7,45100000-8", ["45000000-7", "45100000-8"]), ("none", []), (None, None)],
    "parse_currency_code": [("5 EUR", "EUR"), ("5 PLNX", None), (None, None)],
    "parse_int_from_text": [("ofert: 007", 7), ("brak", FAIL), ("\xa0", None), ("9" * 40, FAIL)],
    "parse_date_from_text": [("do 2024-12-13 r.", "2024-12-13"), ("jutro", FAIL), ("", None)],
    "parse_datetime_from_text": [("2025-01-20 13:00", "2025-01-20T13:00"), ("2025-01-20", "2025-01-20"), ("x", FAIL)],
    "parse_list_from_newlines": [("a\r\n\n b \n", ["a", "b"]), (" \n ", None), (None, None)],
    "parse_nuts3_code": [("PL21A - Oświęcimski - x", "PL21A"), ("PL21A", FAIL), (" ", None)],
    "parse_nuts3_name": [("PL21A - Oświęcimski - x", "Oświęcimski - x"), ("-", FAIL)],
    "parse_change_label": [("8.1\nPRZED  ZMIANA: a\nPo zmianie: b", "8.1"), ("8.1 ", "8.1"), ("", None)],
    "parse_change_before": [("8.1\nPrzed zmianą: a\nPo zmianie: b", "a"), ("8.1\nPrzed zmianą: a", "a"), ("8.1", None)],
    "parse_change_after": [("8.1\nPrzed zmianą: a\nPo zmianie: b\nc", "b\nc"), ("8.1", None)],
    "parse_national_id_value": [("NIP 526-10-40-828", "5261040828"), ("44051401458", "44051401458"), ("abc", None)],
    "parse_national_id_type": [("5261040828", "NIP"), ("123456785", "REGON"), ("44051401458", "PESEL"), ("99999999999", "PESEL"), ("abc", None), (None, None)],
    "parse_duration_iso": [("24 miesiące", "P24M"), ("30 dni", "P30D"), ("2 lata", "P2Y"), ("3 tygodnie", "P3W"), ("do 2024-01-01", None), ("007 TYG.", "P7W"), ("1 roku", "P1Y"), ("3 miesięcy lub 90 dni", "P3M"), ("1 dzień", "P1D"), ("5 sztuk", None), (None, None)],
    "parse_duration_end_date": [("od 2024-01-01 do 2024-12-31", "2024-12-31"), ("do 2024-12-13", "2024-12-13"), ("2 lata", None)],
    "parse_duration_start_date": [("od 2024-01-01 do 2024-12-31", "2024-01-01"), ("do 2024-12-13", None)],
    "parse_duration_days_from_range": [("od 2024-01-01 do 2024-12-31", 365), ("od 2024-02-31 do 2024-12-31", None)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_parser(spark, name):
    cases = CASES[name]
    parser, kind = P.REGISTRY[name]
    p = parser(F.col("raw"))
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], "i int, raw string").select("i", p.value.alias("v"), p.error.alias("e"))
    assert dict(df.dtypes)["v"] == kind
    for r in df.collect():
        want = cases[r.i][1]
        assert (r.v, r.e is None) == ((None, False) if want is FAIL else (want, True)), (name, cases[r.i], r)


def test_every_registered_parser_has_cases():
    assert set(CASES) == set(P.REGISTRY)


def test_computed_durations(spark):
    df = spark.createDataFrame([("2024-01-31", "1 miesiące"), ("2024-01-01", "do 2024-01-11"), (None, "2 lata"), (None, "od 2024-01-01 do 2024-01-03"), ("x", "2 dni"), ("2024-01-01", None), ("2024-01-01", "999999999 tygodni"), ("2024-01-01", "999999999 miesiąc"), ("2024-01-01", "999999999 lat"), ("2024-01-01", "99999999999 dni"), ("2024-01-01", "7975 lat"), ("2024-01-01", "7976 lat"), ("2024-01-01", "0 dni")], "s string, d string")
    assert [tuple(r) for r in df.select(durations.days("s", "d"), durations.contract_end("s", "d")).collect()] == [(29, "2024-02-29"), (10, "2024-01-11"), (None, None), (2, "2024-01-03"), *[(None, None)] * 6, (2912809, "9999-01-01"), (None, None), (0, "2024-01-01")]


def test_ids_by_country(spark):
    k = identifiers.by_country("c", "r")
    df = spark.createDataFrame([("Polska", "5261040828"), ("DE", " x1 "), ("pl", "zz"), (None, "1"), ("PL", " ")], "c string, r string").select(k["raw"], k["parsed"], k["type"])
    assert [tuple(r) for r in df.collect()] == [("5261040828", "5261040828", "NIP"), ("x1", "x1", "foreign"), ("zz", None, "not_recognized"), ("1", "1", "foreign"), (None, None, None)]


def test_instants_keys_and_text(spark):
    one = lambda v, *cols: tuple(spark.createDataFrame([(v,)], "v string").select(*cols).first())
    v = F.col("v")
    a, b = one("2025-01-01T02:00:00.0000007+02:00", iso_nanos(v))[0], one(" 2025-01-01T00:00:00Z ", iso_nanos(v))[0]
    assert a - b == 700 and b == 1735689600 * 10**9
    assert [one(x, iso_nanos(v))[0] for x in ("2025-02-30T00:00:00Z", "x", None)] == [None] * 3
    ends = [one(x, iso_nanos(v))[0] for x in ("9999-12-31T00:00:00Z", "0001-01-01T00:00:00Z")]
    assert ends == [9 * 10**18, -9 * 10**18] and [one(x, iso_nanos(v))[0] for x in ("2025-01-01T99:99:99Z", "2025-01-01T24:00:00Z", "2025-01-01T10:00+99:00")] == [None] * 3
    assert one("4.2.2.  Krótki", leading_section_number(v))[0] == "4.2.2" and one(" 3 x", leading_section_number(v))[0] == "3" and one("pkt 3.1", leading_section_number(v))[0] is None
    assert one("Contract Notice/ż", notice_type_token(v), file_name(v), snake_case(F.lit("ContractNotice"))) == ("Contract_Notice", "Contract_Notice_", "contract_notice")
    assert [one(x, notice_type_token(v))[0] for x in (None, "", "/")] == ["__NULL__", "__EMPTY__", "__EMPTY__"]
    labels = {"Ĺ‚": "l", "WadĹ‚a": "wadla", "Ä…Ĺ›": "as", "Ă„â€¦": "a", "Straße ﬁn ＡＢ①": "strasse fin ab①", "Łódź  é\u0301": "łodz e", "x\u00a0²½": "x 21⁄2"}
    assert {x: one(x, P.normalized_label("v"))[0] for x in labels} == labels
    assert one(" 2025 / bzp\xa000000001/02.", notice_number(v))[0] == "2025/BZP 00000001"
    assert one("{AB-c\t}", object_key(v))[0] == "abc" and one(" ", object_key(v))[0] is None
    assert one("Sekcja 4, pkt 4. 2.10 – x", section_number(v))[0] == "4.2.10"
    assert one(" \xa0a　 \n b\x1f ", strip(v), squeeze(v), blank(v)) == ("a　 \n b", "a b", False)
    assert one("a&oacute;&#322;&#x17c;&amp;lt;&#99999999; &unknown;", decode_entities(v))[0] == "aółż&lt;&#99999999; &unknown;"
    assert one("<p>a&nbsp;<b>b</b></p><i", markup_text(v))[0] == "a b"
