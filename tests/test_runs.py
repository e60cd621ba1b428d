import json
import logging

import pytest
from pyspark.sql import functions as F

from noticelake.operators import contracts
from noticelake.operators import observability as obs
from noticelake.pipeline import control, stages
from noticelake.profiles import PROFILES
from noticelake.sources import dictionaries, fetch, lookups, raw, tables


def notice(i, kind="ContractNotice", day="2025-03-01", **more):
    body = more.pop("body", f"<html><body><h3>1.1) Nazwa: <span class='normal'>Z{i}</span></h3><h3>4.2.6) Kod</h3><p>45000000-7 x</p><h3>4.3.5) Kryt</h3>Cena<h3>4.3.6) Waga: <span class='normal'>60 %</span></h3></body></html>")
    base = dict.fromkeys(("noticeNumber", "cpvCode", "organizationName", "organizationCity", "organizationCountry", "organizationNationalId", "organizationId"), "x")
    return base | {"objectId": f"o{i}", "noticeType": kind, "bzpNumber": f"2025/BZP 0000000{i}", "publicationDate": f"{day}T08:00:00Z", "isTenderAmountBelowEU": True, "htmlBody": body, "contractors": None} | more


def test_a_range_from_raw_days_to_deltas(spark, tmp_path, rows):
    p = stages.Places(*(str(tmp_path / x) for x in ("raw", "bronze", "silver", "errors", "deltas")))
    change = "<html><body><h3>3.2) Numer: <span class='normal'>2025/BZP 00000001</span></h3><h3>3.4) Sekcja: <span class='normal'>SEKCJA IV</span></h3><h3>3.4.1) Zmiana</h3><p>4.1.2) Liczba Przed zmianą: 1 Po zmianie: 3</p></body></html>"
    fetch.write_day([notice(1), notice(2), notice(1), notice(3, body="<html>")], p.raw, "2025-03-01")
    fetch.write_day([notice(1, day="2025-03-02"), notice(4, "NoticeUpdateNotice", "2025-03-02", body=change), notice(5, "SmallContractNotice", "2025-03-02"), notice(3, day="2025-03-02")], p.raw, "2025-03-02")
    counts = stages.build_bronze(spark, p, "2025-03-01", "2025-03-02")
    assert counts == {"raw": 8, "in_input": 1, "known": 1, "after_dedup": 6, "valid": 5}
    assert stages.bronze_rates(counts) == {"valid_rate": 5 / 6, "dedup_cross_day_rate": 1 / 8}
    assert rows(tables.read(spark, p.bronze).select("objectId", "publicationDateDay")) == [("o1", "2025-03-01"), ("o2", "2025-03-01"), ("o3", "2025-03-02"), ("o4", "2025-03-02"), ("o5", "2025-03-02")]
    assert [(r.objectId, r.errors) for r in tables.read(spark, p.errors).collect()] == [("o3", ["htmlBody: page is not closed"])]
    assert tables.partition_values(spark, p.bronze, "noticeType", publicationDateDay="2025-03-01") == [("ContractNotice",)]
    rules = {("ContractNotice", "core", "core"): {"section_1_1": F.when(F.col("section_1_1") == "Z2", F.lit("odd"))}}
    two = {t: PROFILES[t] for t in ("ContractNotice", "NoticeUpdateNotice")}
    held = stages.build_silver(spark, p, "2025-03-01", "2025-03-02", two, {}, {}, rules=rules)
    stages.build_silver(spark, p, "2025-03-01", "2025-03-02", two, {}, {}, types=["NoticeUpdateNotice"])  # done again, a type gives the same
    assert {(r.objectId, r.data_model, *r.errors) for r in held.collect()} == {("o5", "core", "no registered profile for notice type: SmallContractNotice"), ("o2", "core", "section_1_1: odd")}
    assert rows(tables.read(spark, f"{p.silver}/contract_notice__part_criterion").select("objectId", "part_ordinal", "part_criterion_ordinal", "section_4_3_5", "section_4_3_6")) == [(f"o{i}", 1, 1, "Cena", 60) for i in (1, 2, 3)]
    assert tables.read(spark, f"{p.silver}/common_envelope").count() == 5
    assert obs.quarantine_summary(held).count() == 2
    assert stages.build_deltas(spark, p, "2025-03-01", "2025-03-02", two) == {"n_updates": 1, "n_resolved": 1, "n_unresolved": 0, "n_no_number": 0, "n_unresolved_type": 0}
    assert [(r.objectId, r.section_4_1_2, r.publicationDateDay) for r in tables.read(spark, f"{p.deltas}/contract_notice__delta").collect()] == [("o4", 3, "2025-03-02")]
    names = tables.external_tables(spark, p.silver, "db")
    assert "contract_notice_part" in tables.external_name("contract_notice__part_core") and "contract_notice_core" in names and "PARTITIONED BY (`publicationDateDay`)" in names["contract_notice_core"]
    assert tables.delete_days(spark, p.bronze, "2025-03-01", "2025-03-01") == 1
    assert raw.bronze_or_raw(spark, p.bronze, p.raw, "2025-03-01", "2025-03-01").count() == 4 and raw.bronze_or_raw(spark, p.bronze, p.raw, "2025-03-02", "2025-03-02").count() == 3


def test_contracts(spark):
    p = PROFILES["ContractNotice"]
    c = contracts.contract(p, "part", "criterion")
    assert c == {"section_4_3_5": "string", "section_4_3_6": "int"} and contracts.contract(p, "core", "core")["section_1_3_type"] == "string"
    df = spark.createDataFrame([("a", "x", 5), ("b", None, 200)], "objectId string, section_4_3_5 string, section_4_3_6 bigint")
    d = contracts.drift(df.withColumn("other", F.lit(1)).withColumn("part_ordinal", F.lit(1)), c | {"gone": "string"})
    assert d and d.missing == ("gone",) and d.extra == ("other",) and d.other_type == {"section_4_3_6": ("int", "bigint")}
    assert not contracts.drift(df.withColumn("section_4_3_6", F.lit(1)), c)
    v = contracts.violations(df.withColumn("noticeType", F.lit("T")), {"section_4_3_6": contracts.between("section_4_3_6", 0, 100), "section_4_3_5": contracts.matches("section_4_3_5", "^[a-w]$")})
    assert {(r.objectId, *r.errors) for r in v.collect()} == {("a", "section_4_3_5: unexpected form"), ("b", "section_4_3_6: 200 is not within 0..100")}


def test_observability(spark, tmp_path):
    path = str(tmp_path / "runs")
    for k, (layer, status, n) in enumerate([("bronze", "failed", {"raw": 1}), ("bronze", "success", {"raw": 2, "valid": 1}), ("silver", "success", {})]):
        obs.run_record(spark, layer, "2025-03-01", f"r{k}", "2025-03-02T00", f"2025-03-02T0{k}:00Z", status, n, git_commit="c1").write.mode("append").partitionBy("dt").parquet(path)
    runs = tables.read(spark, path, merge=True)
    metrics = obs.tall_metrics(spark, "bronze", "2025-03-01", "r0", "2025-03-02T00:00Z", {"valid_rate": 0.1}).unionByName(obs.tall_metrics(spark, "bronze", "2025-03-01", "r1", "2025-03-02T01:00Z", {"valid_rate": 0.5, "x": 1}))
    assert {(r.run_id, r.metric_name) for r in obs.latest_metrics(metrics, runs).collect()} == {("r1", "valid_rate"), ("r1", "x")}
    assert obs.metrics_of_commit(metrics, runs, "c1").count() == 3 and obs.metrics_of_commit(metrics, runs, "c2").count() == 0
    assert [tuple(r) for r in obs.trend(metrics, "bronze", "valid_rate", 14).collect()] == [("2025-03-01", 0.5)]
    assert [r.metric_name for r in obs.metric_violations(metrics, {("bronze", "__all__", "valid_rate"): (">=", 0.5), ("bronze", "__all__", "none"): ("==", 1)}).collect()] == ["valid_rate"]
    assert obs.history(runs, "2025-03-16").count() == 3 and obs.history(runs, "2025-03-17").count() == 0
    q = spark.createDataFrame([("2025-03-01", "A", 2), ("2025-03-01", "A", 1), ("2025-03-01", "B", 1)], "target_date string, notice_type string, row_count bigint")
    text = obs.dashboard(runs, metrics, q)
    assert "| 2025-03-01 | - | success | success |" in text and "- 2025-03-01: 0.5000" in text and "- 2025-03-01: 4 (A=3, B=1)" in text
    a, e = spark.createDataFrame([("1", None, 5), ("2", "x", 6)], "objectId string, city string, n int"), spark.createDataFrame([("1", "env", "a", 1), ("1", "env", "b", 2)], "objectId string, city string, org string, at int")
    assert sorted(tuple(r) for r in obs.with_envelope(a, e, order=["at"]).collect()) == [("1", None, 5, "b", 2), ("2", "x", 6, None, None)]


def test_fetching_pages():
    data = [{"objectId": str(i)} for i in range(5)]
    asked, waits = [], []

    def get(q):
        asked.append(q.get("SearchAfter"))
        if len(asked) == 2:
            raise fetch.HttpError(503)
        i = 0 if "SearchAfter" not in q else int(q["SearchAfter"]) + 1
        return data[i : i + 2]

    assert [len(p) for p in fetch.pages(get, "ContractNotice", "2025-01-01", "2025-01-02", 2, sleep=waits.append)] == [2, 2, 1] and asked == [None, "1", "1", "3"] and 2 <= waits[0] <= 3
    with pytest.raises(fetch.HttpError):
        fetch.with_retries(lambda: (_ for _ in ()).throw(fetch.HttpError(404)), sleep=waits.append)
    with pytest.raises(TimeoutError):
        fetch.with_retries(lambda: (_ for _ in ()).throw(TimeoutError()), tries=3, sleep=waits.append)
    assert len(waits) == 3


def test_files_and_lookups(spark, tmp_path, rows):
    (tmp_path / "d.json").write_text(json.dumps({"items": [{"identifier": "1", "key": "a", "Items": [{"identifier": "1.1", "key": "b", "Items": None}, {"identifier": "x"}]}, {"key": "c"}]}))
    assert dictionaries.load(str(tmp_path / "d.json")) == {"1": "a", "1.1": "b"}
    (tmp_path / "cal.csv").write_text("Date,No\n2025-01-02,7\n")
    assert fetch.package_number(tmp_path / "cal.csv", "2025-01-02", "Date", "No") == "202500007"
    with pytest.raises(LookupError):
        fetch.package_number(tmp_path / "cal.csv", "2025-01-03", "Date", "No")
    df = spark.sql("select 'a' id, array(named_struct('x', 'ż,\"q\"')) n, '2025-01-01' publicationDateDay")
    tables.dump_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).first().n == '[{"x":"ż,\\"q\\""}]'
    tables.dump_report(df, tmp_path / "r.json", day="d")
    assert json.loads((tmp_path / "r.json").read_text()) == {"day": "d", "rows": [{"id": "a", "n": [{"x": 'ż,"q"'}], "publicationDateDay": "2025-01-01"}], "count": 1}
    found = lookups.rows_of({"one": df, "two": df.select("id")}, "id", "a")
    assert rows(found.select("_source_day", "_source_dataset")) == [("2025-01-01", "one"), (None, "two")]
    recs = spark.createDataFrame([(" a ", "f", 2), ("a", "f", 1), ("b", "e", 0)], "objectId string, file string, pos bigint")
    assert lookups.raw_record(recs, "a").first().pos == 1
    page = spark.createDataFrame([('{"htmlBody":" ","data":{"html":"<p>"}}',), ("x",)], "r string").select(lookups.page_of("r", ["$.htmlBody", "$.data.html"]))
    assert [r[0] for r in page.collect()] == ["<p>", None]
    body = spark.createDataFrame([("<p>przed <b>tym</b></p><h3>4.2.6) Kod <i>x</i></h3><p>po tym</p><!-- <h3>4.2.6) nie</h3> --><h3>4.2.60) nie</h3>",), (None,)], "b string")
    got = [r[0] for r in body.select(lookups.heading_contexts("b", "4.2.6")).collect()]
    assert [tuple(x) for x in got[0]][0][:2] == ("4.2.6) Kod x", "przed tym") and got[0][0].after.startswith("po tym") and len(got[0]) == 1 and got[1] is None


def test_control(tmp_path, caplog):
    assert control.chunks([1, 2, 3], 2) == [[1, 2], [3]] and control.chunks([1, 2], 0) == [[1, 2]] and control.chunks([], 0) == []
    assert control.in_order(["B", None, "A", "C", "A"], {"C": 1}) == ["C", "A", "B", None]
    assert raw.days_between("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    with pytest.raises(ValueError):
        raw.days_between("2024-02-02", "2024-02-01")
    from noticelake.sources import manifests

    h = {"fetch": "f", "bronze": "b", "silver": "s"}
    manifests.write(tmp_path, "silver", "d1", "s", {"fetch": "f", "bronze": "b"}, "A")
    assert control.pending_types(tmp_path, "silver", ["d1", "d2"], ["A", "B"], h) == {"A": ["d2"], "B": ["d1", "d2"]} and control.pending_types(tmp_path, "silver", ["d1"], ["A"], h) == {}
    with control.lock(tmp_path / "l"):
        with pytest.raises(TimeoutError), control.lock(tmp_path / "l", 0.1):
            pass
    (tmp_path / "l").mkdir()
    with control.lock(tmp_path / "l", stale=-1):
        pass
    assert not (tmp_path / "l").exists()
    tried = []

    def work(d):
        tried.append(d)
        if d == "2" and len(tried) < 4:
            raise RuntimeError("no")

    loop = control.DayLoop(tmp_path / "state.json", ["1", "2", "3"])
    with pytest.raises(RuntimeError):
        loop.run(work)
    assert control.DayLoop(tmp_path / "state.json", ["1", "2", "3"]).run(work, go_on=True) == {"1": "completed", "2": "failed", "3": "completed"}
    last = control.DayLoop(tmp_path / "state.json", ["1", "2", "3"])
    assert last.run(work, most=1)["2"] == "completed" and tried == ["1", "2", "2", "3", "2"] and last.state["2"]["attempts"] == 3
    with pytest.raises(ValueError):
        control.DayLoop(tmp_path / "state.json", ["1"])
    assert [r[0::2] for r in control.run_stages({"a": lambda: 1})] == [("a", "success"), ("total", "success")]
    with pytest.raises(ZeroDivisionError) as e:
        control.run_stages({"a": lambda: 1 / 0, "b": lambda: 1})
    assert [r[2] for r in e.value.report] == ["failed", "skipped", "failed"]
    with caplog.at_level(logging.INFO):
        control.stage_logger("x", stage="bronze").info("done %s", "ż", extra={"count": 2})
    line = json.loads(control.JsonLines().format(caplog.records[-1]))
    assert (line["message"], line["stage"], line["count"], line["level"]) == ("done ż", "bronze", 2, "INFO")
