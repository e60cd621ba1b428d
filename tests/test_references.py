from datetime import datetime

from noticelake.operators.references import notice_orphans


def test_missing_deleted_late(spark, rows):
    day = lambda d: datetime(2025, 1, d)
    core = spark.createDataFrame(
        [(k, f"2025-01-{d:02}", f"2025-01-{d:02}T12:00:00+02:00", ref) for k, d, ref in [("ok", 5, "2025/BZP 00000001"), ("gone", 20, "nr 2025/bzp00000001."), ("miss", 5, "2025/BZP 00000009"), ("late", 1, "2025/BZP 00000002"), ("odd", 5, "no number"), ("blank", 5, " "), ("null", 5, None)]],
        "objectId string, publicationDateDay string, publicationDate string, section_3_2 string",
    )
    env = spark.createDataFrame(
        [("e1", "2025-01-03", "2025-01-03T00:00:00Z", "2025/BZP\xa000000001", "T1 "), ("e1", "2025-01-03", "2025-01-03T00:00:00Z", "2025/BZP\xa000000001", "T1 "), ("e2", "2025-01-02", "2025-01-02T00:00:00Z", "2025/BZP 00000002", "t2"), ("e3", "2025-01-09", None, None, None)],
        "objectId string, publicationDateDay string, publicationDate string, bzpNumber string, tenderId string",
    )
    reg = spark.createDataFrame([("t1", day(4)), ("t1", day(8)), (None, day(1))], "tenderId string, registered_at timestamp_ntz")
    gone = spark.createDataFrame([("bzpNumber", "2025/BZP 00000001", day(10)), ("tenderId", "t9", day(1))], "key_kind string, key_value string, withdrawn_at timestamp_ntz")
    got = notice_orphans(core, env, reg, gone)
    assert rows(got) == [
        ("common_envelope", "e1", "2025-01", "late"), ("common_envelope", "e2", "2025-01", "missing"), ("notice_update_core", "gone", "2025-01", "deleted"),
        ("notice_update_core", "late", "2025-01", "late"), ("notice_update_core", "miss", "2025-01", "missing"), ("notice_update_core", "odd", "2025-01", "missing"),
    ]
    assert rows(notice_orphans(core.limit(0), env.limit(0), reg.limit(0), gone.limit(0))) == []
