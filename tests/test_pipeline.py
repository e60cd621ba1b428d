import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from noticelake.operators import bronze, deltas
from noticelake.operators.envelope import build_envelope
from noticelake.profiles import PROFILES, Profile, Section, find_profile, find_profiles
from noticelake.sources import manifests, raw, tables
from noticelake.streaming import ingest_stream


def test_first_seen(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, " a "), (3, ""), (4, None), (5, "  "), (6, "b"), (7, "c")], "pos int, id string")
    known = spark.createDataFrame([("b ",), (None,)], "id string")
    got = bronze.first_seen(df, "id", ["pos"], known)
    assert [r[2] for r in rows(got)] == [None, "in_input", None, None, None, "known", None]
    assert tuple(bronze.dedup_stats(got).first()) == (7, 5, 1, 1)
    assert tuple(bronze.dedup_stats(bronze.first_seen(df.limit(0), "id", ["pos"])).first()) == (0, 0, 0, 0)


def test_validation(spark):
    cols = {c: "x" for c in bronze.REQUIRED if c != "isTenderAmountBelowEU"} | {"noticeType": "ContractNotice", "htmlBody": "<html></html> \n"}
    bad = cols | {"noticeType": "Odd", "htmlBody": "<html>", "bzpNumber": None}
    df = spark.createDataFrame([tuple(cols.values()), tuple(bad.values())], ", ".join(f"{c} string" for c in cols))
    df = df.withColumn("isTenderAmountBelowEU", F.lit(True))
    assert [len(r[0]) for r in df.select(bronze.validation_errors(df.columns)).collect()] == [0, 3]
    late = df.limit(1).withColumns({"htmlBody": F.concat(F.lit("<html></html>"), F.repeat(F.lit(" \n\u00a0"), 40)), "contractors": F.expr("array(named_struct('contractorName', 'x'), null)"), "isTenderAmountBelowEU": F.lit(None).cast("boolean")})
    assert late.select(bronze.validation_errors(late.columns)).first()[0] == ["isTenderAmountBelowEU: field required", "contractors: item is no record"]


def test_record_hash_sorts_keys_at_every_depth(spark):
    a = spark.sql("select 1 b, named_struct('y', 1, 'x', 'ż') a, array(named_struct('n', 1, 'm', cast(null as string))) c")
    b = spark.sql("select array(named_struct('m', cast(null as string), 'n', 1)) c, named_struct('x', 'ż', 'y', 1) a, 1 b")
    assert a.select(bronze.record_hash(a.schema)).first() == b.select(bronze.record_hash(b.schema)).first()
    want = hashlib.sha256('{"a":{"x":"ż","y":1},"b":1,"c":[{"m":null,"n":1}]}'.encode()).hexdigest()
    assert a.select(bronze.record_hash(a.schema)).first()[0] == want


def test_days_of_a_range_match_a_run_through_them(spark):
    rnd = random.Random(2)
    data = [(i, f"2025-01-0{rnd.randint(1, 6)}", rnd.choice(["a", "b", " b", "c", "d", "", None]), rnd.random() < 0.4) for i in range(60)]
    df = spark.createDataFrame(data, "pos int, day string, id string, ok boolean")
    got = {r.pos: r.drop_reason for r in bronze.first_days(df, "id", "day", ["pos"], F.col("ok"), spark.createDataFrame([("d ",), (None,)], "id string")).collect()}
    known, want = {"d"}, {}
    for day in sorted({d for _, d, _, _ in data}):
        seen, new = set(), set()
        for pos, d, k, ok in data:
            if d != day:
                continue
            k = (k or "").strip()
            want[pos] = None if not k else "in_input" if k in seen else "known" if k in known else None
            if k and want[pos] is None and ok:
                new.add(k)
            seen.add(k)
        known |= new
    assert got == want
    assert bronze.first_days(df.limit(0), "id", "day", ["pos"], F.col("ok")).count() == 0


def test_rows_of_a_day_as_fetched(spark, rows):
    df = spark.createDataFrame([(1, "a", "2025-01-01T01"), (2, "a ", "2025-01-01"), (3, "a", "2025-01-01"), (4, "a", "2025-01-02"), (5, None, None), (6, "", "2025-01-01"), (7, "", "2025-01-01")], "pos int, id string, publicationDate string")
    assert [r[3] for r in rows(bronze.day_rows(df, "2025-01-01", "id", ["pos"]))] == [None, None, "duplicate", "other_day", "other_day", None, None]


def test_raw_files(spark, tmp_path):
    (tmp_path / "bzp_2025-01-01.json").write_text(json.dumps([{"objectId": "a", "contractors": [{"contractorName": "N"}]}, {"objectId": "b"}]))
    (tmp_path / "bzp_2025-01-01_2.json").write_text("[]")
    got = raw.read_days(spark, str(tmp_path), ["2025-01-01", "2025-01-02"]).collect()
    assert [(r.objectId, r.pos, r.contractors and r.contractors[0].contractorName) for r in got] == [("a", 0, "N"), ("b", 1, None)]
    assert raw.read_days(spark, str(tmp_path), ["1999-01-01"]).count() == 0
    (tmp_path / "bzp_2025-01-03.json").write_text("{}")
    with pytest.raises(Exception, match="not an array"):
        raw.read_days(spark, str(tmp_path), ["2025-01-03"]).collect()
    (tmp_path / "bzp_2025-01-04.json").write_text('[{"objectId":"a"},{"objectId":"b"')
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        raw.read_days(spark, str(tmp_path), ["2025-01-04"]).collect()
    (tmp_path / "bzp_2025-01-05.json").write_text('\ufeff [{"objectId":"a","isTenderAmountBelowEU":"maybe"}, {"objectId":7}, {"objectId":"b","isTenderAmountBelowEU":"yes"}]')
    assert [(r.objectId, r.isTenderAmountBelowEU, r.pos) for r in raw.read_days(spark, str(tmp_path), ["2025-01-05"]).collect()] == [("a", None, 0), ("7", None, 1), ("b", True, 2)]


def test_partition_overwrite_and_delete(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = lambda *r: spark.createDataFrame(list(r), "id int, day string")
    tables.overwrite_partitions(df((1, "2025-01-01"), (2, "2025-01-02")), path, ["day"])
    tables.overwrite_partitions(df((3, "2025-01-02")), path, ["day"])
    assert rows(tables.read(spark, path)) == [(1, "2025-01-01"), (3, "2025-01-02")]
    assert tables.delete_partitions(spark, path, day=["2025-01-01"]) == 1
    assert rows(tables.read(spark, path)) == [(3, "2025-01-02")]
    assert "PARTITIONED BY (`day`)" in tables.external_ddl("x", df((1, "d")), path, ["day"])


def test_manifests(tmp_path):
    assert not manifests.is_done(tmp_path, "silver", "2025-01-01", "h")
    manifests.write(tmp_path, "silver", "2025-01-01", "h", {"bronze": "1"}, "ContractNotice")
    done = lambda **k: manifests.is_done(tmp_path, "silver", "2025-01-01", **({"script_hash": "h", "kind": "ContractNotice"} | k))
    assert done() and done(dependencies={"bronze": "1"}) and not done(script_hash="x") and not done(dependencies={}) and not done(kind=None)
    assert manifests.code_hash([manifests.__file__]) == manifests.code_hash([manifests.__file__])


def test_stream_keeps_first_across_batches(spark, rows, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: ingest_stream(spark, src, "pos int, id string, day string", out, str(tmp_path / "cp"), "id", ["pos"], ["day"])
    for batch in ([(1, "a", "d1"), (2, "a", "d2")], [(3, "a", "d3"), (4, "b", "d3")]):
        spark.createDataFrame(batch, "pos int, id string, day string").coalesce(1).write.mode("append").parquet(src)
        run()
    assert rows(spark.read.parquet(out).select("pos", "id")) == [(1, "a"), (4, "b")]


def test_deltas(spark):
    core = spark.createDataFrame([("u1", "2025/BZP 00000001"), ("u2", "2025/BZP 00000009"), ("u3", None), ("u4", "2025/BZP 00000001")], "objectId string, section_3_2 string")
    parts = spark.createDataFrame([("u1", 1, "SEKCJA I")], "objectId string, part_ordinal int, section_3_4 string")
    items = spark.createDataFrame([("u1", 1, 1, "9.4) Data", None, "bad"), ("u1", 1, 2, "9.4) Data", None, "2025-02-02"), ("u1", 2, 1, "4.2.2) part", None, "x"), ("u1", 2, 2, "1.3", None, "5261040828")], "objectId string, part_ordinal int, part_part_ordinal int, section_3_4_1_label string, section_3_4_1_before string, section_3_4_1_after string")
    env = spark.createDataFrame([("n2", "ContractNotice", "2025/BZP 00000001", "2025-01-02"), ("n1", "ContractNotice", "2025/BZP 00000001", "2025-01-01"), ("n0", "ContractNotice", None, "2025-01-01")], "objectId string, noticeType string, bzpNumber string, publicationDateDay string")
    ix = deltas.number_index(env)
    got = {r.objectId: r for r in deltas.build_deltas(core, parts, items, ix, list(PROFILES.values())).collect()}
    assert set(got) == {"u1", "u4"} and got["u1"].target_id == "n1" and got["u4"].section_changes == [] and got["u4"].changed == {}
    assert got["u1"].changed == {"section_9_4": "2025-02-02", "section_1_3": "5261040828", "section_1_3_type": "NIP"} and got["u1"].parse_errors is None
    assert [c.prefix for c in got["u1"].section_changes] == ["SEKCJA I", "SEKCJA I", "", ""]
    assert tuple(deltas.delta_stats(core, ix).first()) == (4, 2, 1, 1) and tuple(deltas.delta_stats(core, ix, ["TenderResultNotice"]).first()) == (4, 2, 1, 1, 2)


def test_typed_deltas_by_day(spark, tmp_path):
    core = spark.createDataFrame([("u1", "2025/BZP 00000001", "2025-03-01"), ("u2", "2024/BZP 00000001", "2025-03-02"), ("u3", None, None)], "objectId string, section_3_2 string, publicationDateDay string")
    items = spark.createDataFrame([("u1", 1, 1, "4.1.2) Liczba", None, "części 3"), ("u1", 1, 2, "7.7 Kody", None, "45000000-7, 45000000-7"), ("u1", 1, 3, "1.9 x", None, "y"), ("u1", 1, 4, "8.1", None, "99"), ("u1", 1, 5, "2.6", "a", None)], "objectId string, part_ordinal int, part_part_ordinal int, section_3_4_1_label string, section_3_4_1_before string, section_3_4_1_after string")
    env = spark.createDataFrame([("n1", "T", "2025/BZP 00000001", "2025-01-01"), ("n2", "T", "2024/BZP 00000001", "2022-01-01")], "objectId string, noticeType string, bzpNumber string, publicationDateDay string")
    p = Profile("T", (Section("4.1.2", parser="parse_int_from_text"), Section("7.7", parser="parse_cpv_codes"), Section("1.9", parser="parse_nothing"), Section("8.1", parser="parse_date_from_text"), Section("2.6"), Section("9.9", "part")))
    years = deltas.years_referred(core)
    assert years == ["2023", "2024", "2025"]
    ix = deltas.number_index(env, years)
    parts = spark.createDataFrame([], "objectId string, part_ordinal int, section_3_4 string")
    d = deltas.build_deltas(core, parts, items, ix, [p])
    t = deltas.typed_deltas(d, p)
    assert dict(t.dtypes)["section_4_1_2"] == "bigint" and "section_9_9" not in t.columns
    r = t.collect()
    assert len(r) == 1 and (r[0].section_4_1_2, r[0].section_7_7, r[0].section_1_9, r[0].section_8_1, r[0].section_2_6) == (3, ["45000000-7"], "y", None, None)
    assert sorted(r[0].changed_columns) == ["section_1_9", "section_2_6", "section_4_1_2", "section_7_7", "section_8_1"]
    assert json.loads(r[0].parse_errors) == {"section_1_9": "parse_nothing: unknown parser", "section_8_1": "parse_date_from_text: cannot read 99"}
    for days in (["2025-03-01", "2025-03-02"], ["2025-03-01"]):
        deltas.write_deltas(d, str(tmp_path), [p], days)
    assert [x.objectId for x in tables.read(spark, f"{tmp_path}/t__delta").collect()] == ["u1"]


def test_profiles_kept_as_files(tmp_path):
    numbered = {"1.1": {"col_name": "section_1_1", "data_model": "core"}, "3.4.1": {"col_name": "section_3_4_1", "data_model": "part.part", "section_value_mode": "full_block", "derived_cols": {"a": {"fn": "parse_change_label"}}}, "_computed_cols": [{"col_name": "x", "fn": "compute_duration_days", "sources": ["a", "b"]}]}
    (tmp_path / "small_thing_profile_automatic.json").write_text(json.dumps(numbered))
    p = find_profile("SmallThing", tmp_path)
    assert p.sections[1] == Section("3.4.1", "part.part", None, {"a": "parse_change_label"}, True) and p.computed == {"x": ("compute_duration_days", ("a", "b"))}
    (tmp_path / "small_thing_profile.json").write_text(json.dumps({"notice_type": "SmallThing", "sections": [{"number": "1.1"}]}))
    assert find_profile("SmallThing", tmp_path).sections == (Section("1.1"),)
    assert set(find_profiles(["SmallThing", "ContractNotice", "Nothing"], tmp_path)) == {"SmallThing", "ContractNotice"}
    (tmp_path / "odd_profile.json").write_text(json.dumps({"1.1": {"col_name": "section_1_2"}}))
    with pytest.raises(ValueError, match="must be kept"):
        find_profile("Odd", tmp_path)


def test_envelope(spark):
    df = spark.createDataFrame([("o", "TenderResultNotice", None, "1", "X", "2026-02-10T06:23:34Z"), ("p", None, "t", None, None, "x")], "objectId string, noticeType string, tenderId string, clientType string, organizationProvince string, publicationDate string")
    got = build_envelope(df, {"1": "one"}, {}).select("caseId", "noticeStage", "clientTypeName", "provinceName", "publicationDateDay").collect()
    assert [tuple(r) for r in got] == [("o", "RESULT", "one", None, "2026-02-10"), ("t", "INIT", None, None, None)]
