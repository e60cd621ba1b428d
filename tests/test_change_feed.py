import random

import pytest
from pyspark.sql import functions as F

from noticelake.operators.change_feed import apply_changes, current_sections

CORE = "objectId string, publicationDate string, section_3_2 string, received_at int"
ITEM = "objectId string, part_ordinal int, part_part_ordinal int, change_op string, section_3_4_1_label string, section_3_4_1_after string, received_at int"


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_matches_replay_in_any_order(spark, rows, slices):
    rnd = random.Random(slices)
    feed = [(rnd.choice("ab"), i, rnd.random() < 0.3, f"v{i}") for i in range(200)]
    state = {"b": (None, "base"), "c": (None, "base")}
    for k, i, gone, v in feed:
        state.pop(k, None)
        if not gone:
            state[k] = (i, v)
    sent = feed + rnd.sample(feed, 80)
    rnd.shuffle(sent)
    base = spark.createDataFrame([("b", "base"), ("c", "base")], "k string, v string")
    got = apply_changes(spark.createDataFrame(sent, "k string, i int, gone boolean, v string"), ["k"], ["i"], F.col("gone"), ["v"], base, slices)
    assert rows(got) == sorted([(k, i, v) for k, (i, v) in state.items()], key=repr)


def test_null_keys_unknown_deletes_and_empty(spark, rows):
    schema = "k string, i int, gone boolean, v string, _image string"
    feed = spark.createDataFrame([(None, 1, False, "x", ""), ("a", 1, True, None, ""), ("b", 2, None, None, None)], schema)
    assert rows(apply_changes(feed, ["k"], ["i"], F.col("gone"), ["v"])) == [("b", 2, None)]
    assert rows(apply_changes(feed.limit(0), ["k"], ["i"], F.col("gone"), ["v"])) == []


def test_sections_follow_publication_not_arrival(spark, rows):
    core = [("n2", "2025-01-02T00:00:00.0000002Z", "nr 2025/BZP00000001", 1), ("n1", "2025-01-02T00:00:00.0000001Z", "2025/bzp 00000001/02", 9), ("n1", "2025-01-02T00:00:00.0000001Z", "2025/bzp 00000001/02", 9), ("n3", "2025-01-03T00:00:00Z", " ", 1)]
    items = [
        ("n1", 1, 1, "U", "4. 2. 6 Kod", "old", 9), ("n2", 1, 1, None, "pkt 4.2.6) x", "new", 1), ("n1", 1, 2, "insert", "8.1.", None, 9), ("n2", 2, 1, "usunięcie", "8.1", "kept text", 1),
        ("n2", 2, 2, "dodanie", "Sekcja 9, pkt 9.10 – x", "", 1), ("n2", 2, 3, None, "5.5", "  ", 1), ("n2", 2, 4, "I", "Tabela 6", "x", 1), ("n3", 1, 1, "I", "1.1", "x", 1), ("no head", 1, 1, "I", "1.1", "x", 1), ("n2", 2, 5, "I", None, "x", 1),
    ]
    got = current_sections(spark.createDataFrame(core, CORE), spark.createDataFrame(items, ITEM))
    assert rows(got.select("bzp_number", "section_number", "object_id", "part_ordinal", "part_part_ordinal", "after")) == [("2025/BZP 00000001", "4.2.6", "n2", 1, 1, "new"), ("2025/BZP 00000001", "9.10", "n2", 2, 2, "")]
