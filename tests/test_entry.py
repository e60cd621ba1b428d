from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")
CORE = ["p1_found", "p3_found", "p3_report", "p5_contractors", "parse_cpv_list", "delta_changes", "bronze_dedup_cross_day", "envelope_case_stage", "obs_nonnull", "section_roundtrip_child", "p1_contents", "p1_images", "delta_wide", "delta_typed", "bronze_running_seen", "fetch_day_rows", "obs_merged_envelope", "label_numbers_tokens"]


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not SF.exists(), reason="no test data")
@pytest.mark.parametrize("name", CORE)
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, str(SF))
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.skipif(not SF.exists(), reason="no test data")
def test_pesel_over_all_orders(spark):
    test_equals_sql(spark, "id_pesel_centuries")
    df = entry.queries()["id_pesel_centuries"](spark, str(SF))
    assert df.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
