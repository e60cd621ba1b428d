from pyspark.sql import functions as F

from noticelake.operators.inlining import notice_items, related_tables, schema_graph, shared_inline

SCHEMA = "ingest_id bigint, noticeType string, htmlBody string, contractors array<struct<contractorName:string,contractorCity:string>>"


def page(*heads):
    return "<html><body>" + "".join(heads) + "</body></HTML>"


def span(n, v):
    return f"<h3>{n}) X: <span class='normal'> {v} </span></h3>"


def test_parts_and_criteria(spark, rows):
    body = page(
        span("4.3.5", "first"), "<!-- " + span("4.2.2", "no") + " -->", "<p>pkt 4.2.2)</p>", "<h3 class='a'>4.2.6.) Kod</h3>\n<p>09135100-5 - Olej</p><p>Zob. 4.3.5)</p>", "<H3><b>4.2.10)</b> Okres</H3>5 dni<br/>",
        span("4.3.5", "a&oacute;&nbsp; b"), span("4.3.6", "1"), span("4.3.5", "c"), span("4.2.6", "brak"), "<h3>\n 4.3.6.) Waga:\n</h3>7<br/>", span("4.2.2", "next"),
    )
    data = [(1, "ContractNotice", body, [(None, None), ("N", None), (None, "C")]), (2, "TenderResultNotice", page(span("6.1", "5"), span("7.3.1", "x"), span("6.1", "6"), span("4.2.2", "no")), None), (3, "ContractNotice", body[:-7], []), (4, None, None, None), (5, "SmallContractNotice", body, None)]
    got = notice_items(spark.createDataFrame(data, SCHEMA))
    assert got.columns == ["ingest_id", "entity", "parent_ordinal", "ordinal", "item_key"]
    assert rows(got) == sorted(
        [
            (1, "contractor", 0, 2, "N"), (1, "contractor", 0, 3, ""), (1, "criterion", 1, 1, "first"), (1, "criterion", 1, 2, "aó b"), (1, "criterion", 1, 3, "c"), (1, "criterion", 2, 1, ""),
            (1, "part", 0, 1, "09135100-5"), (1, "part", 0, 2, ""), (1, "part", 0, 3, ""), (2, "part", 0, 1, "5"), (2, "part", 0, 2, "6"),
        ],
        key=repr,
    )
    assert rows(notice_items(spark.createDataFrame([], SCHEMA))) == []


def test_shared_inlining_of_a_nested_schema(spark, rows):
    df = spark.sql("select 1L id, named_struct('b', 2, 'deep', named_struct('c', 'x')) a, array(named_struct('n', 1, 'subs', array('u', 'v')), named_struct('n', 2, 'subs', cast(null as array<string>))) items union all select 2L, null, null")
    assert schema_graph(df.drop("id").schema).leaves == [("a", "b"), ("a", "deep", "c")]
    t = shared_inline(df, "id")
    assert rows(t["root"]) == [(1, 2, "x"), (2, None, None)]
    assert rows(t["items"]) == [(1, [1], 1), (1, [2], 2)]
    assert rows(t["items_subs"].select("id", F.array_join("ordinals", "."), "value")) == [(1, "1.1", "u"), (1, "1.2", "v")]


def test_shared_recursive_and_mapped_elements(spark, rows):
    place = "struct<city:string,zip:string>"
    schema = f"id bigint, seat {place}, post {place}, offices array<{place}>, tags map<string,int>, items array<struct<code:string,items:array<struct<code:string,items:array<struct<code:string>>>>>>"
    data = [
        (1, ("A", "1"), None, [("B", "2"), None], {"x": 7}, [("1", [("1.1", [("1.1.1",)]), ("1.2", None)]), ("2", [])]),
        (2, None, ("C", None), [], None, None),
    ]
    t = related_tables(spark.createDataFrame(data, schema), "id")
    assert set(t) == {"root", "seat", "tags", "items"}
    flat = lambda df, *c: rows(df.select("id", "relation", F.array_join("ordinals", "."), "parent", F.array_join("parent_ordinals", "."), *c))
    assert flat(t["seat"], "city", "zip") == [(1, "offices", "1", "root", "", "B", "2"), (1, "offices", "2", "root", "", None, None), (1, "seat", "", "root", "", "A", "1"), (2, "post", "", "root", "", "C", None)]
    assert flat(t["tags"], "key", "value") == [(1, "tags", "1", "root", "", "x", 7)]
    assert flat(t["items"], "code") == sorted([(1, "items", "1", "root", "", "1"), (1, "items", "2", "root", "", "2"), (1, "items_items", "1.1", "items", "1", "1.1"), (1, "items_items", "1.2", "items", "1", "1.2"), (1, "items_items_items", "1.1.1", "items_items", "1.1", "1.1.1")], key=repr)
    assert all(f.count() == 0 for f in related_tables(spark.createDataFrame([], schema), "id").values())
