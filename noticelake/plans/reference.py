"""Queries over each operator of the notice pipeline, with the SQL that gives the same rows.

Typed values are read from the notice tables where they have them, else from texts rendered from the star schema by an expression
that both engines evaluate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions import durations, identifiers
from noticelake.functions import parsers as P
from noticelake.functions.headings import heading_column
from noticelake.functions.keys import file_name, leading_section_number, notice_number, notice_type_token, snake_case
from noticelake.functions.text import squeeze
from noticelake.operators import bronze, deltas, envelope, sections
from noticelake.operators import observability as obs
from noticelake.profiles import PROFILES
from noticelake.runtime import cut, table
from noticelake.sources.tables import distinct_days, pending

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Decoded client types and provinces used by the envelope query.
CLIENT_TYPES = {"1.1.1": "urząd szczebla centralnego", "1.1.2": "urząd szczebla lokalnego", "1.2": "placówka oświatowa", "1.3": "placówka lecznicza", "1.4": "zakład komunalny", "1.5": "instytucja kultury", "2.1": "operator sieci"}
PROVINCES = {"PL10": "jeziorańskie", "PL28": "modrzewskie", "PL02": "zalesińskie", "PL12": "kamienieckie", "PL14": "dolinowskie"}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _render(name: str, source: str, key: str, expr: str, parse: Callable[[Column], P.Parsed], value_sql: str, error_sql: str | None = None, cast: str = "string", out: Callable[[Column], Column] = lambda c: c) -> None:
    """A query that renders a text per row, parses it and gives value and whether it was an error."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        t = table(spark, d, source).select(F.expr(key).alias("id"), F.expr(expr).alias("raw"))
        p = parse(F.col("raw"))
        return t.select("id", out(p.value).cast(cast).alias("value"), p.error.isNotNull().alias("failed"))

    QUERIES[name] = run
    SQL[name] = f"WITH t AS (SELECT {key} AS id, {expr} AS raw FROM {source}) SELECT id, {value_sql} AS value, {error_sql or 'false'} AS failed FROM t"


_render("parse_money", "orders", "o_orderkey",
    "CASE WHEN o_orderkey % 6 = 0 THEN concat(CAST(o_orderkey AS VARCHAR(20)), ',50 PLN') WHEN o_orderkey % 6 = 1 THEN concat('1 ', lpad(CAST(o_orderkey % 1000 AS VARCHAR(20)), 3, '0'), ',25 EUR') "
    "WHEN o_orderkey % 6 = 2 THEN concat('2.', lpad(CAST(o_orderkey % 1000 AS VARCHAR(20)), 3, '0'), ',75') WHEN o_orderkey % 6 = 3 THEN 'nie dotyczy' WHEN o_orderkey % 6 = 4 THEN '  ' ELSE '1,234,567' END",
    P.pln_value,
    "CASE o_id WHEN 0 THEN id + 0.5 WHEN 1 THEN 1000 + id % 1000 + 0.25 WHEN 2 THEN 2000 + id % 1000 + 0.75 END".replace("o_id", "id % 6"), "id % 6 IN (3, 5)", "double")
SQL["parse_money"] = SQL["parse_money"].replace("SELECT id, CASE", "SELECT id, CAST(CASE").replace(" END AS value", " END AS DOUBLE) AS value")
_render("parse_currency", "orders", "o_orderkey", "concat('1,00 ', CASE o_orderkey % 4 WHEN 0 THEN 'PLN' WHEN 1 THEN 'EUR brutto' WHEN 2 THEN 'CHFX' ELSE 'zł' END)", P.currency_code, "nullif(regexp_extract(raw, '\\b(PLN|EUR|USD|GBP|CHF)\\b', 1), '')")
_render("parse_yes_no", "lineitem", "l_orderkey * 10 + l_linenumber", "CASE l_returnflag WHEN 'A' THEN ' Tak ' WHEN 'N' THEN 'NIE' ELSE 'może' END", P.tak_nie, "CASE WHEN lower(trim(raw)) = 'tak' THEN true WHEN lower(trim(raw)) = 'nie' THEN false END", "raw = 'może'", "boolean")
_render("parse_weight_half_even", "part", "p_partkey", "concat(CAST(p_size AS VARCHAR(9)), CASE p_partkey % 3 WHEN 0 THEN ',50' WHEN 1 THEN '.00 %' ELSE ' pkt' END)", P.criterion_weight, "CAST(CASE id % 3 WHEN 0 THEN round_even(CAST(regexp_extract(raw, '^(\\d+)', 1) AS DOUBLE) + 0.5, 0) ELSE CAST(regexp_extract(raw, '^(\\d+)', 1) AS INT) END AS INT)", None, "int")
_render("parse_int", "documents", "doc_id", "concat(CASE WHEN doc_id % 5 = 0 THEN 'brak' ELSE concat('ofert: ', CAST(doc_id AS VARCHAR(20))) END, '; część')", P.int_from_text, "CASE WHEN id % 5 <> 0 THEN CAST(id AS INT) END", "id % 5 = 0", "int")
_render("parse_list_lines", "documents", "doc_id", "text", P.list_from_newlines, "nullif(array_to_string(list_filter(list_transform(string_split_regex(raw, '\\r\\n|[\\n\\r\\x{b}\\x{c}\\x{85}\\x{2028}\\x{2029}]'), lambda x: regexp_replace(x, '^[\\s\\x{a0}\\x{b}\\x{1c}-\\x{1f}\\x{85}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+|[\\s\\x{a0}\\x{b}\\x{1c}-\\x{1f}\\x{85}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+$', '', 'g')), lambda x: x <> ''), '|'), '')", out=lambda c: F.nullif(F.array_join(c, "|"), F.lit("")))
_render("parse_region_code", "nation", "n_nationkey", "CASE WHEN n_nationkey % 6 = 0 THEN n_name ELSE concat('N', CAST(n_nationkey AS VARCHAR(9)), ' - ', n_name, ' - x') END", P.nuts3_code, "CASE WHEN id % 6 <> 0 THEN concat('N', id) END", "id % 6 = 0")
_render("parse_region_name", "nation", "n_nationkey", "CASE WHEN n_nationkey % 6 = 0 THEN n_name ELSE concat('N', CAST(n_nationkey AS VARCHAR(9)), ' - ', n_name, ' - x') END", P.nuts3_name, "CASE WHEN id % 6 <> 0 THEN regexp_extract(raw, '^.*? - (.*)$', 1) END", "id % 6 = 0")
_render("date_from_text", "orders", "o_orderkey", "CASE WHEN o_orderkey % 4 = 0 THEN 'bez daty' ELSE concat('do dnia ', substr(CAST(o_orderdate AS VARCHAR(40)), 1, 10), ' r.') END", P.date_from_text, "CASE WHEN id % 4 <> 0 THEN regexp_extract(raw, '\\d{4}-\\d{2}-\\d{2}', 0) END", "id % 4 = 0")
_render("datetime_from_text", "events", "event_id", "CASE event_id % 3 WHEN 0 THEN concat('dnia ', substr(CAST(ts AS VARCHAR(40)), 1, 16)) WHEN 1 THEN substr(CAST(ts AS VARCHAR(40)), 1, 10) ELSE 'jutro' END", P.datetime_from_text, "CASE id % 3 WHEN 0 THEN replace(substr(raw, 6), ' ', 'T') WHEN 1 THEN raw END", "id % 3 = 2")
_render("parse_change_after", "orders", "o_orderkey", "concat('8.1 Termin', CASE WHEN o_orderkey % 3 < 2 THEN concat(chr(10), 'Przed zmianą: ', CAST(o_orderkey AS VARCHAR(20))) ELSE '' END, CASE WHEN o_orderkey % 3 > 0 THEN concat(chr(10), 'PO ZMIANIE:  ', o_orderpriority) ELSE '' END)", P.change_after, "CASE WHEN id % 3 > 0 THEN trim(regexp_extract(raw, '(?s)PO ZMIANIE:(.*)$', 1)) END")
_render("parse_change_before", "orders", "o_orderkey", "concat('8.1 Termin', CASE WHEN o_orderkey % 3 < 2 THEN concat(chr(10), 'Przed zmianą: ', CAST(o_orderkey AS VARCHAR(20))) ELSE '' END, CASE WHEN o_orderkey % 3 > 0 THEN concat(chr(10), 'PO ZMIANIE:  ', o_orderpriority) ELSE '' END)", P.change_before, "CASE WHEN id % 3 < 2 THEN CAST(id AS VARCHAR) END")
_render("parse_change_label", "orders", "o_orderkey", "concat('8.1 Termin', CASE WHEN o_orderkey % 3 < 2 THEN concat(chr(10), 'Przed zmianą: ', CAST(o_orderkey AS VARCHAR(20))) ELSE '' END)", P.change_label, "'8.1 Termin'")

_CPV = "concat(cpvCode, ',', split_part(cpvCode, ' ', 1))"


@_query(f"SELECT objectId AS object_id, array_to_string(list_filter(list_transform(string_split_regex({_CPV}, ','), lambda x: regexp_extract(x, '\\d{{8}}-\\d', 0)), lambda x, i: x <> '' AND list_position(list_transform(string_split_regex({_CPV}, ','), lambda y: regexp_extract(y, '\\d{{8}}-\\d', 0)), x) = i), ',') AS codes FROM (SELECT DISTINCT objectId, cpvCode FROM common_envelope) WHERE cpvCode IS NOT NULL")
def parse_cpv_list(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "common_envelope").select("objectId", "cpvCode").distinct().where("cpvCode is not null")
    return t.select(F.col("objectId").alias("object_id"), F.array_join(P.cpv_codes(F.expr(_CPV)).value, ",").alias("codes"))


@_query("SELECT objectId AS object_id, regexp_replace(trim(regexp_replace(replace(strip_accents(replace(lower(orderObject), 'ł', '\x01')), '\x01', 'ł'), '[\\s\\x{a0}]+', ' ', 'g')), '^ | $', '', 'g') AS label FROM (SELECT DISTINCT objectId, orderObject FROM common_envelope) WHERE orderObject IS NOT NULL")
def label_normalise(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "common_envelope").select("objectId", "orderObject").distinct().where("orderObject is not null")
    return t.select(F.col("objectId").alias("object_id"), P.normalized_label("orderObject").alias("label"))


def _weighted(digits: str, weights: tuple[int, ...]) -> str:
    return "(" + " + ".join(f"{w} * CAST(substr({digits}, {i}, 1) AS INT)" for i, w in enumerate(weights, 1)) + ")"


_NIP = _weighted("d", identifiers.NIP_WEIGHTS)


@_query(f"WITH t AS (SELECT DISTINCT organizationNationalId AS raw, regexp_replace(organizationNationalId, '\\D', '', 'g') AS d FROM common_envelope WHERE organizationNationalId IS NOT NULL), u AS (SELECT *, CASE WHEN length(d) = 10 THEN {_NIP} % 11 END AS s FROM t) SELECT raw, coalesce(s <> 10 AND s = TRY_CAST(substr(d, 10, 1) AS INT), false) AS valid FROM u")
def id_nip(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "common_envelope").select(F.col("organizationNationalId").alias("raw")).where("raw is not null").distinct()
    return t.select("raw", identifiers.is_nip(F.regexp_replace("raw", r"\D", "")).alias("valid"))


def _id_sql(width: int, weights: tuple[int, ...], check: str) -> str:
    s = _weighted("d", weights)
    return f"WITH t AS (SELECT c_custkey AS id, right(concat(repeat('0', {width}), CAST(c_custkey * 7919 AS VARCHAR)), {width}) AS d FROM customer) SELECT id, ({check.format(s=s)}) = CAST(substr(d, {width}, 1) AS INT) AS valid FROM t"


def _id_query(name: str, width: int, test: Callable[[Column], Column], weights: tuple[int, ...], check: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), test(F.lpad((F.col("c_custkey") * 7919).cast("string"), width, "0")).alias("valid"))

    QUERIES[name], SQL[name] = run, _id_sql(width, weights, check)


_id_query("id_regon9", 9, identifiers.is_regon9, identifiers.REGON9_WEIGHTS, "{s} % 11 % 10")
_id_query("id_regon14", 14, identifiers.is_regon14, identifiers.REGON14_WEIGHTS, "{s} % 11 % 10")


@_query(
    "WITH t AS (SELECT o_orderkey AS id, concat(strftime(o_orderdate, '%y%m%d'), right(concat('00000', CAST(o_orderkey AS VARCHAR)), 5)) AS d FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'), "
    f"u AS (SELECT id, d, (10 - {_weighted('d', identifiers.PESEL_WEIGHTS)} % 10) % 10 = CAST(substr(d, 11, 1) AS INT) AS valid FROM t) SELECT id, valid FROM u"
)
def id_pesel(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").where("o_orderdate < timestamp_ntz'2000-01-01'")
    return t.select(F.col("o_orderkey").alias("id"), identifiers.is_pesel(F.concat(F.date_format("o_orderdate", "yyMMdd"), F.right(F.concat(F.lit("00000"), F.col("o_orderkey").cast("string")), F.lit(5)))).alias("valid"))


@_query(
    "WITH t AS (SELECT o_orderkey AS id, concat(strftime(o_orderdate, '%y'), lpad(CAST(month(o_orderdate) + CASE WHEN year(o_orderdate) >= 2000 THEN 20 ELSE 0 END AS VARCHAR), 2, '0'), strftime(o_orderdate, '%d'), right(concat('00000', CAST(o_orderkey AS VARCHAR)), 5)) AS d FROM orders), "
    f"u AS (SELECT id, d, (10 - {_weighted('d', identifiers.PESEL_WEIGHTS)} % 10) % 10 = CAST(substr(d, 11, 1) AS INT) AS valid FROM t) SELECT id, valid FROM u"
)
def id_pesel_centuries(spark: SparkSession, d: str) -> DataFrame:
    """As id_pesel, over all orders: the month carries the century from 2000 on."""
    month = F.lpad((F.month("o_orderdate") + F.when(F.year("o_orderdate") >= 2000, 20).otherwise(0)).cast("string"), 2, "0")
    digits = F.concat(F.date_format("o_orderdate", "yy"), month, F.date_format("o_orderdate", "dd"), F.right(F.concat(F.lit("00000"), F.col("o_orderkey").cast("string")), F.lit(5)))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), identifiers.is_pesel(digits).alias("valid"))


@_query()
def id_classify(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "common_envelope").select(F.explode("contractors").alias("c")).select("c.contractorNationalId").where("contractorNationalId is not null").distinct()
    k = identifiers.classify("contractorNationalId")
    return t.select(F.col("contractorNationalId").alias("raw"), k["value"].alias("parsed"), k["type"].alias("kind"))


@_query()
def contractor_array(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "common_envelope").select("objectId", identifiers.with_classified_ids("contractors").alias("c")).distinct()
    return t.select(F.col("objectId").alias("object_id"), F.posexplode("c").alias("i", "c")).select("object_id", F.col("i").cast("bigint").alias("i"), F.col("c.contractorNationalId_raw").alias("raw"), F.col("c.contractorNationalId_type").alias("kind"))


_DUR = "CASE o_orderkey % 6 WHEN 0 THEN concat(CAST(o_orderkey % 90 AS VARCHAR(9)), ' dni') WHEN 1 THEN concat(CAST(o_orderkey % 30 AS VARCHAR(9)), ' tygodnie') WHEN 2 THEN concat(CAST(o_orderkey % 30 AS VARCHAR(9)), ' miesięcy') WHEN 3 THEN '2 lata' WHEN 4 THEN 'od 2024-01-31 do 2024-12-31' ELSE 'do 2030-06-30' END"
_DUR_SQL = f"""
WITH t AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS s, o_orderkey % 6 AS k, {_DUR} AS raw FROM orders),
e AS (SELECT *, CASE k WHEN 0 THEN s + CAST(id % 90 AS INT) WHEN 1 THEN s + CAST(id % 30 * 7 AS INT) WHEN 2 THEN CAST(s + to_months(CAST(id % 30 AS INT)) AS DATE) WHEN 3 THEN CAST(s + to_months(24) AS DATE) WHEN 4 THEN DATE '2024-12-31' ELSE DATE '2030-06-30' END AS till FROM t)
"""


def _orders_with_duration(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").cast("string").alias("s"), F.expr(_DUR).alias("raw"))


@_query(_DUR_SQL + "SELECT id, CAST(CASE k WHEN 4 THEN date_diff('day', DATE '2024-01-31', till) ELSE date_diff('day', s, till) END AS INT) AS days FROM e")
def duration_days(spark: SparkSession, d: str) -> DataFrame:
    return _orders_with_duration(spark, d).select("id", durations.days("s", "raw").alias("days"))


@_query(_DUR_SQL + "SELECT id, CAST(till AS VARCHAR) AS contract_end FROM e")
def contract_end(spark: SparkSession, d: str) -> DataFrame:
    return _orders_with_duration(spark, d).select("id", durations.contract_end("s", "raw").alias("contract_end"))


@_query(_DUR_SQL + "SELECT id, CASE k WHEN 0 THEN concat('P', id % 90, 'D') WHEN 1 THEN concat('P', id % 30, 'W') WHEN 2 THEN concat('P', id % 30, 'M') WHEN 3 THEN 'P2Y' END AS iso FROM e")
def duration_iso(spark: SparkSession, d: str) -> DataFrame:
    return _orders_with_duration(spark, d).select("id", durations.iso("raw").alias("iso"))


@_query(_DUR_SQL + "SELECT id, CASE WHEN k = 4 THEN '2024-01-31' END AS start_date, CASE k WHEN 4 THEN '2024-12-31' WHEN 5 THEN '2030-06-30' END AS end_date, CAST(CASE WHEN k = 4 THEN 335 END AS INT) AS days FROM e")
def duration_range(spark: SparkSession, d: str) -> DataFrame:
    return _orders_with_duration(spark, d).select("id", durations.start_date("raw").alias("start_date"), durations.end_date("raw").alias("end_date"), durations.range_days("raw").alias("days"))


_MAP = lambda m: " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items())


@_query(
    f"SELECT DISTINCT objectId AS object_id, coalesce(tenderId, objectId) AS case_id, CASE WHEN noticeType = 'TenderResultNotice' THEN 'RESULT' WHEN noticeType = 'ContractPerformingNotice' THEN 'EXECUTION' WHEN noticeType IN ('NoticeUpdateNotice', 'AgreementUpdateNotice') THEN 'UPDATE' ELSE 'INIT' END AS stage, "
    f"CASE clientType {_MAP(CLIENT_TYPES)} END AS client_type, CASE organizationProvince {_MAP(PROVINCES)} END AS province, substr(publicationDate, 1, 10) AS day FROM bronze_notices"
)
def envelope_case_stage(spark: SparkSession, d: str) -> DataFrame:
    e = envelope.build_envelope(table(spark, d, "bronze_notices"), CLIENT_TYPES, PROVINCES)
    return e.select(F.col("objectId").alias("object_id"), F.col("caseId").alias("case_id"), F.col("noticeStage").alias("stage"), F.col("clientTypeName").alias("client_type"), F.col("provinceName").alias("province"), F.col("publicationDateDay").alias("day")).distinct()


@_query("SELECT ingest_id, publicationDateDay AS day FROM bronze_notices WHERE substr(publicationDate, 1, 10) = '2026-02-24'")
def same_day_filter(spark: SparkSession, d: str) -> DataFrame:
    return bronze.same_day(table(spark, d, "bronze_notices"), F.lit("2026-02-24")).select("ingest_id", F.col("publicationDateDay").alias("day"))


@_query("WITH b AS (SELECT ingest_id, batch_no, nullif(regexp_replace(objectId, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g'), '') AS k FROM bronze_notices) SELECT ingest_id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ingest_id) AS rn FROM b) WHERE k IS NULL OR rn = 1")
def bronze_dedup_in_file(spark: SparkSession, d: str) -> DataFrame:
    return bronze.keep_first(table(spark, d, "bronze_notices"), "objectId", ["ingest_id"]).select("ingest_id")


_DEDUP = r"""
WITH b AS (SELECT ingest_id, batch_no, nullif(regexp_replace(objectId, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'), '') AS k FROM bronze_notices),
known AS (SELECT DISTINCT k FROM b WHERE batch_no <= 20 AND k IS NOT NULL),
new AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ingest_id) AS rn FROM b WHERE batch_no > 20),
flagged AS (SELECT ingest_id, CASE WHEN k IS NULL THEN NULL WHEN rn > 1 THEN 'in_input' WHEN k IN (SELECT k FROM known) THEN 'known' END AS drop_reason FROM new)
"""


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze_notices").select("ingest_id", "batch_no", "objectId")
    return bronze.first_seen(b.where("batch_no > 20"), "objectId", ["ingest_id"], b.where("batch_no <= 20").select("objectId"))


@_query(_DEDUP + "SELECT ingest_id, drop_reason FROM flagged")
def bronze_dedup_cross_day(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).select("ingest_id", "drop_reason")


@_query(_DEDUP + "SELECT count(*) AS n_input, count(*) FILTER (drop_reason IS NULL) AS n_output, count(*) FILTER (drop_reason = 'in_input') AS n_in_input, count(*) FILTER (drop_reason = 'known') AS n_known FROM flagged")
def dedup_stats(spark: SparkSession, d: str) -> DataFrame:
    return bronze.dedup_stats(_flagged(spark, d))


@_query("SELECT ingest_id, (objectId IS NULL)::INT + (isTenderAmountBelowEU IS NULL)::INT + (organizationNationalId IS NULL)::INT + (htmlBody IS NULL)::INT + (organizationCity IS NULL)::INT + (organizationName IS NULL)::INT + (organizationCountry IS NULL)::INT + (bzpNumber IS NULL)::INT + (noticeNumber IS NULL)::INT + (cpvCode IS NULL)::INT + (organizationId IS NULL)::INT + (coalesce(len(list_filter(contractors, lambda c: c IS NULL)), 0) > 0)::INT + coalesce((NOT regexp_matches(htmlBody, '</html>\\s*$'))::INT, 0) AS n_errors FROM bronze_notices")
def bronze_validation(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze_notices")
    return b.select("ingest_id", F.size(bronze.validation_errors(b.columns)).alias("n_errors"))


@_query("SELECT o_orderkey AS id, sha256(concat('{\"o_custkey\":', o_custkey, ',\"o_orderkey\":', o_orderkey, ',\"o_orderpriority\":\"', o_orderpriority, '\",\"o_orderstatus\":', CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE concat('\"', o_orderstatus, '\"') END, '}')) AS hash FROM orders")
def record_hash(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"))
    return t.select(F.col("o_orderkey").alias("id"), bronze.record_hash(t.schema).alias("hash"))


# an order as a page: core sections 1.1 and 2.2, a part (4.2.2, 4.2.6) a line item and a criterion (4.3.5, 4.3.6) for each line of more than 25
def _order_pages(spark: SparkSession, d: str) -> DataFrame:
    h3 = lambda n, v: F.concat(F.lit(f"<h3>{n}) X: <span class='normal'>"), v.cast("string"), F.lit("</span></h3>"))
    part = F.concat(h3("4.2.2", F.col("l_partkey")), h3("4.2.6", F.concat(F.lpad(F.col("l_suppkey").cast("string"), 8, "0"), F.lit("-1 x"))), F.when(F.col("l_quantity") > 25, F.concat(h3("4.3.5", F.col("l_returnflag")), h3("4.3.6", F.col("l_quantity").cast("int")))).otherwise(""))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", part.alias("h")))).alias("ls"))
    o = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    twice = F.when(F.col("o_orderkey") % 50 == 0, h3("1.1", F.lit("again"))).when(F.col("o_orderkey") % 50 == 1, h3("77.7", F.lit("?"))).otherwise("")
    body = F.concat(F.lit("<html><body>"), h3("1.1", F.col("o_orderpriority")), h3("2.2", F.col("o_totalprice").cast("decimal(20,2)")), twice, F.coalesce(F.array_join(F.transform("ls", lambda x: x["h"]), ""), F.lit("")), F.lit("</body></html>"))
    return o.select(F.col("o_orderkey").alias("objectId"), F.lit("ContractNotice").alias("noticeType"), body.alias("htmlBody"))


def _order_sections(spark: SparkSession, d: str, entity: str, leaf: str) -> DataFrame:
    pages, p = _order_pages(spark, d), PROFILES["ContractNotice"]
    return sections.typed(sections.section_tables(pages, cut(sections.heading_rows(pages, [p])), p)[entity, leaf], p, entity, leaf)


@_query("SELECT o_orderkey AS id, o_orderpriority AS section_1_1, CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS section_2_2 FROM orders WHERE o_orderkey % 50 <> 0")
def section_roundtrip_core(spark: SparkSession, d: str) -> DataFrame:
    return _order_sections(spark, d, "core", "core").select(F.col("objectId").alias("id"), "section_1_1", "section_2_2")


@_query("SELECT l_orderkey AS id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag) AS INT) AS part_ordinal, CAST(l_partkey AS VARCHAR) AS section_4_2_2, concat(lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), '-1') AS codes FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 50 <> 0")
def section_roundtrip_part(spark: SparkSession, d: str) -> DataFrame:
    return _order_sections(spark, d, "part", "core").select(F.col("objectId").alias("id"), "part_ordinal", "section_4_2_2", F.array_join("section_4_2_6", ",").alias("codes"))


@_query("WITH p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 50 <> 0) SELECT l_orderkey AS id, CAST(n AS INT) AS part_ordinal, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY n) AS INT) AS criterion_ordinal, l_returnflag AS section_4_3_5, CAST(floor(l_quantity) AS INT) AS section_4_3_6 FROM p WHERE l_quantity > 25")
def section_roundtrip_child(spark: SparkSession, d: str) -> DataFrame:
    r = _order_sections(spark, d, "part", "criterion")
    return r.select(F.col("objectId").alias("id"), "part_ordinal", F.col("part_criterion_ordinal").alias("criterion_ordinal"), "section_4_3_5", "section_4_3_6")


@_query("SELECT o_orderkey AS id, CASE o_orderkey % 50 WHEN 0 THEN 'core' ELSE 'unknown' END AS data_model, CASE o_orderkey % 50 WHEN 0 THEN 'duplicate_core_section: 1.1' ELSE 'unknown section: 77.7' END AS errors FROM orders WHERE o_orderkey % 50 < 2")
def section_quarantine(spark: SparkSession, d: str) -> DataFrame:
    pages, ps = _order_pages(spark, d), [PROFILES["ContractNotice"]]
    return sections.quarantine(cut(sections.heading_rows(pages, ps)), pages, ps).select(F.col("objectId").alias("id"), "data_model", F.array_join("errors", ";").alias("errors"))


@_query()
def notice_sections_core(spark: SparkSession, d: str) -> DataFrame:
    """Typed core sections of the contract notices among the deliveries."""
    b = table(spark, d, "bronze_notices").where("noticeType = 'ContractNotice'").select(F.col("ingest_id").cast("string").alias("objectId"), "noticeType", "htmlBody")
    p = PROFILES["ContractNotice"]
    t = sections.typed(sections.section_tables(b, cut(sections.heading_rows(b, [p])), p)["core", "core"], p, "core", "core")
    return t.withColumn("parse_errors", F.array_join("parse_errors", ";"))


@_query()
def page_tokens(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze_notices").select("ingest_id", heading_column("htmlBody").alias("h"))
    return b.select("ingest_id", F.posexplode("h").alias("pos", "h")).select("ingest_id", "pos", "h.number", F.coalesce("h.span", "h.inline").alias("value"))


_TYPED = "CASE o_orderkey % 3 WHEN 0 THEN '12,5 PLN' WHEN 1 THEN 'x' END"


@_query("SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 12.5::DOUBLE END AS amount, CASE o_orderkey % 3 WHEN 0 THEN 'PLN' END AS currency, CASE o_orderkey % 3 WHEN 1 THEN 1 ELSE 0 END AS n_errors FROM orders")
def typed_columns_errors(spark: SparkSession, d: str) -> DataFrame:
    from noticelake.profiles import Profile, Section

    p = Profile("T", (Section("6.2", derived={"amount": "parse_pln_value", "currency": "parse_currency_code"}),))
    t = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_TYPED).alias("section_6_2"))
    return sections.typed(t, p, "core", "core").select("id", "amount", "currency", F.coalesce(F.size("parse_errors"), F.lit(0)).alias("n_errors"))


_NUM = r"nullif(regexp_replace(regexp_extract(upper({0}), '(\d{{4}}[\s\x{{a0}}]*/[\s\x{{a0}}]*BZP[\s\x{{a0}}]*\d{{8}})', 1), '^(\d{{4}}).*(\d{{8}})$', '\1/BZP \2'), '')"
_INDEX = rf"""
WITH idx AS (SELECT bzp_number, target_id, target_type, target_day FROM (SELECT {_NUM.format("bzpNumber")} AS bzp_number, objectId AS target_id, noticeType AS target_type, publicationDateDay AS target_day,
  row_number() OVER (PARTITION BY {_NUM.format("bzpNumber")} ORDER BY publicationDateDay, objectId, noticeType) AS rn FROM common_envelope) WHERE rn = 1 AND bzp_number IS NOT NULL),
c AS (SELECT objectId, max({_NUM.format("section_3_2")}) AS bzp_number FROM notice_update_core GROUP BY objectId)
"""


def _notices(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, d, n) for n in ("notice_update_core", "notice_update_part", "notice_update_part_part", "common_envelope"))


@_query(_INDEX + "SELECT * FROM idx")
def delta_number_index(spark: SparkSession, d: str) -> DataFrame:
    return deltas.number_index(_notices(spark, d)[3])


@_query(_INDEX + "SELECT objectId AS object_id, bzp_number, target_id, target_type, target_day FROM c JOIN idx USING (bzp_number)")
def delta_resolve(spark: SparkSession, d: str) -> DataFrame:
    c, _, _, e = _notices(spark, d)
    return deltas.resolve(c.drop("publicationDateDay"), deltas.number_index(e)).withColumnRenamed("objectId", "object_id")


@_query(_INDEX + "SELECT count(*) AS n_updates, count(target_id) AS n_resolved, count(*) FILTER (bzp_number IS NOT NULL AND target_id IS NULL) AS n_unresolved, count(*) FILTER (bzp_number IS NULL) AS n_no_number FROM c LEFT JOIN idx USING (bzp_number)")
def delta_stats(spark: SparkSession, d: str) -> DataFrame:
    c, _, _, e = _notices(spark, d)
    return deltas.delta_stats(c, deltas.number_index(e))


@_query(
    _INDEX + ", i AS (SELECT DISTINCT objectId, part_ordinal, part_part_ordinal, section_3_4_1_label AS label, section_3_4_1_before AS before, section_3_4_1_after AS after FROM notice_update_part_part) "
    "SELECT c.objectId AS object_id, count(i.objectId) AS n_changes, string_agg(CASE WHEN i.objectId IS NOT NULL THEN concat(i.part_ordinal, '.', i.part_part_ordinal) END, ',' ORDER BY i.part_ordinal, i.part_part_ordinal) AS places FROM c JOIN idx USING (bzp_number) LEFT JOIN i ON i.objectId = c.objectId GROUP BY 1"
)
def delta_changes(spark: SparkSession, d: str) -> DataFrame:
    c, p, i, e = _notices(spark, d)
    r = deltas.build_deltas(c, p, i, deltas.number_index(e), list(PROFILES.values()))
    places = F.nullif(F.array_join(F.transform("section_changes", lambda x: F.concat(x["part_ordinal"].cast("string"), F.lit("."), x["part_part_ordinal"].cast("string"))), ","), F.lit(""))
    return r.select(F.col("objectId").alias("object_id"), F.size("section_changes").cast("bigint").alias("n_changes"), places.alias("places"))


# core sections of contract notices that changes name, and how each is read
_READ = {"2.5": "date", "2.6": "", "3.1": "", "3.10": "", "3.15": "", "4.1.2": "int", "5.4": "", "5.7": "", "6.1": "", "6.4": "", "7.4": "", "8.1": "datetime", "8.2": "", "8.3": "datetime", "8.4": "date", "9.1": "", "9.2": "", "9.3": "", "9.4": "date", "1.1": "", "1.4.2": "", "2.1": "", "2.2": ""}
_RESULT = {"1.1": "", "1.4.2": "", "2.1": "", "2.2": "", "9.1": "", "9.2": "", "9.3": "", "9.4": "date"}
_TO = ", ".join(f"('{t}', '{n}', '{how}')" for t, m in (("ContractNotice", _READ), ("TenderResultNotice", _RESULT)) for n, how in m.items())
_DAY = r"nullif(regexp_extract(after, '\d{4}-\d{2}-\d{2}', 0), '')"


@_query(
    _INDEX + rf""", how(kind, number, how) AS (VALUES {_TO}),
    i AS (SELECT DISTINCT objectId, part_ordinal, part_part_ordinal, section_3_4_1_after AS after, regexp_extract(regexp_replace(section_3_4_1_label, '^[\s\x{{a0}}]+', ''), '^\d+([.]\d+)*', 0) AS number FROM notice_update_part_part),
    m AS (SELECT i.*, how, 'section_' || replace(number, '.', '_') AS "column", CASE WHEN after IS NULL OR (how <> '' AND regexp_full_match(after, '[\s\x{{a0}}]*')) THEN NULL WHEN how = 'date' THEN {_DAY} WHEN how = 'int' THEN CAST(TRY_CAST(nullif(regexp_extract(after, '\d+', 0), '') AS INT) AS VARCHAR)
      WHEN how = 'datetime' THEN coalesce(nullif(regexp_replace(regexp_extract(after, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}', 0), '[T ]', 'T'), ''), {_DAY}) ELSE after END AS value
      FROM i JOIN c USING (objectId) JOIN idx USING (bzp_number) JOIN how USING (number) WHERE how.kind = target_type),
    last AS (SELECT *, row_number() OVER (PARTITION BY objectId, "column" ORDER BY part_ordinal DESC NULLS LAST, part_part_ordinal DESC NULLS LAST, after DESC NULLS LAST) AS rn FROM m)
    SELECT objectId AS object_id, "column" AS changed_column, value, coalesce(how <> '' AND value IS NULL AND NOT regexp_full_match(after, '[\s\x{{a0}}]*'), false) AS failed FROM last WHERE rn = 1"""
)
def delta_wide(spark: SparkSession, d: str) -> DataFrame:
    """Typed values that updates change, and whether the text could not be read."""
    c, p, i, e = _notices(spark, d)
    r = deltas.build_deltas(c, p, i, deltas.number_index(e, deltas.years_referred(c)), list(PROFILES.values()))
    bad = F.coalesce(F.map_contains_key(F.from_json("parse_errors", "map<string,string>"), F.col("column")), F.lit(False))
    return r.select(F.col("objectId").alias("object_id"), "parse_errors", F.explode("changed").alias("column", "value")).select("object_id", F.col("column").alias("changed_column"), "value", bad.alias("failed"))


@_query("SELECT o_custkey AS cust, max(o_orderkey) AS last_order FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1 GROUP BY 1")
def obs_latest_run(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return bronze.latest(t, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("last_order"))


_RATED = ("tenderId", "organizationNationalId", "clientType", "orderObject")


@_query(" UNION ALL ".join(f"SELECT '{c}' AS metric_name, round(avg(CASE WHEN {c} IS NULL THEN 0.0 ELSE 1.0 END), 9) AS metric_value FROM common_envelope" for c in _RATED))
def obs_nonnull(spark: SparkSession, d: str) -> DataFrame:
    return obs.non_null_rates(table(spark, d, "common_envelope"), _RATED).withColumn("metric_value", F.round("metric_value", 9))


@_query("SELECT coalesce(tenderType, 'null') AS value, count(*) AS n_rows FROM common_envelope GROUP BY 1 ORDER BY n_rows DESC, value LIMIT 5")
def obs_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return obs.value_counts(table(spark, d, "common_envelope"), "tenderType", 5)


@_query("SELECT count(DISTINCT caseId) AS n_cases, count(DISTINCT nullif(organizationId, '')) AS n_organizations FROM common_envelope")
def obs_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "common_envelope").agg(F.countDistinct("caseId").alias("n_cases"), F.countDistinct(F.nullif("organizationId", F.lit(""))).alias("n_organizations"))


@_query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, arg_max(event_id, (ts, event_id)) FILTER (event_type = 'click') AS click, arg_max(event_id, (ts, event_id)) FILTER (event_type = 'error') AS error, arg_max(event_id, (ts, event_id)) FILTER (event_type = 'view') AS \"view\" FROM events GROUP BY 1")
def obs_status_pivot(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "events").select(F.col("ts").cast("date").cast("string").alias("day"), "event_type", "event_id", F.struct("ts", "event_id").alias("at"))
    return obs.status_pivot(t, "day", "event_type", "event_id", "at", ["click", "error", "view"])


@_query("SELECT substr(publicationDateDay, 1, 7) AS month, noticeType AS kind, count(*) AS n_rows FROM common_envelope GROUP BY ROLLUP (1, 2)")
def obs_quarantine_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "common_envelope").select(F.substring("publicationDateDay", 1, 7).alias("month"), F.col("noticeType").alias("kind"))
    return obs.rollup_counts(t, "month", "kind")


@_query("SELECT batch_no, round(count(*) FILTER (htmlBody IS NOT NULL AND htmlBody <> '') / count(*)::DOUBLE, 9) AS body_rate, round(coalesce(count(*) FILTER (tenderId IS NOT NULL AND clientType IS NOT NULL) / nullif(count(*) FILTER (tenderId IS NOT NULL), 0)::DOUBLE, 0), 9) AS client_rate FROM bronze_notices GROUP BY 1")
def dq_ratios(spark: SparkSession, d: str) -> DataFrame:
    has = F.col("tenderId").isNotNull()
    cols = obs.ratios({"body_rate": (F.coalesce(F.col("htmlBody") != "", F.lit(False)), F.lit(True)), "client_rate": (has & F.col("clientType").isNotNull(), has)})
    return table(spark, d, "bronze_notices").groupBy("batch_no").agg(*[F.round(c, 9).alias(n) for c, n in zip(cols, ("body_rate", "client_rate"), strict=True)])


@_query("SELECT metric_name, round(v, 9) AS metric_value FROM (SELECT 'tenderId' AS metric_name, avg((tenderId IS NOT NULL)::INT) AS v FROM common_envelope UNION ALL SELECT 'orderObject', avg((orderObject IS NOT NULL)::INT) FROM common_envelope) WHERE (metric_name = 'tenderId' AND v < 0.99) OR (metric_name = 'orderObject' AND v > 0.5)")
def dq_thresholds(spark: SparkSession, d: str) -> DataFrame:
    m = obs.non_null_rates(table(spark, d, "common_envelope"), ("tenderId", "orderObject"))
    return obs.violations(m, {"tenderId": ("min", 0.99), "orderObject": ("max", 0.5), "absent": ("min", 1.0)}).withColumn("metric_value", F.round("metric_value", 9))


@_query("SELECT country, count(*) AS n_rows FROM (SELECT regexp_replace(regexp_replace(unnest(contractors).contractorCountry, '[\\s\\x{a0}]+', ' ', 'g'), '^ | $', '', 'g') AS country FROM common_envelope) WHERE country <> '' GROUP BY 1")
def exploded_frequency(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "common_envelope").select(F.explode("contractors").alias("c")).select(squeeze("c.contractorCountry").alias("country"))
    return c.where("country <> ''").groupBy("country").agg(F.count("*").alias("n_rows"))


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 42")
def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where("o_custkey = 42").select("o_orderkey", "o_totalprice")


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topn(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@_query("SELECT s_name AS name, 'supplier' AS kind FROM supplier UNION ALL SELECT c_name, 'customer' FROM customer")
def set_union(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return a.unionByName(table(spark, d, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind")))


@_query("SELECT DISTINCT e.noticeType AS kind, e.publicationDateDay AS day FROM common_envelope e WHERE NOT EXISTS (SELECT 1 FROM bronze_notices b WHERE b.noticeType = e.noticeType AND b.publicationDateDay = e.publicationDateDay)")
def pending_set(spark: SparkSession, d: str) -> DataFrame:
    keys = [F.col("noticeType").alias("kind"), F.col("publicationDateDay").alias("day")]
    wanted = table(spark, d, "common_envelope").select(*keys).distinct()
    done = table(spark, d, "bronze_notices").select(*keys, F.lit("h").alias("script_hash"))
    return pending(wanted, done, ["kind", "day"], "h")


@_query(f"SELECT substr(publicationDateDay, 1, 4) AS year, count(DISTINCT {_NUM.format('bzpNumber')}) AS n_numbers FROM common_envelope WHERE publicationDateDay >= '2025-01-01' AND publicationDateDay < '2026-01-01' GROUP BY 1")
def year_scoped_index(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "common_envelope").where("publicationDateDay >= '2025-01-01' AND publicationDateDay < '2026-01-01'")
    return e.groupBy(F.substring("publicationDateDay", 1, 4).alias("year")).agg(F.countDistinct(notice_number("bzpNumber")).alias("n_numbers"))


@_query(r"""
WITH b AS (SELECT ingest_id, batch_no, nullif(regexp_replace(objectId, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'), '') AS k, coalesce(regexp_matches(htmlBody, '</html>\s*$'), false) AS ok FROM bronze_notices),
r AS (SELECT *, row_number() OVER (PARTITION BY k, batch_no ORDER BY ingest_id) AS rn FROM b),
taken AS (SELECT k, min(batch_no) AS day FROM r WHERE rn = 1 AND ok AND k IS NOT NULL GROUP BY 1)
SELECT ingest_id, CASE WHEN k IS NULL THEN NULL WHEN rn > 1 THEN 'in_input' WHEN day < batch_no THEN 'known' END AS drop_reason FROM r LEFT JOIN taken USING (k)""")
def bronze_running_seen(spark: SparkSession, d: str) -> DataFrame:
    """Batches as the days of a range, deduplicated one after the other against the valid ones before."""
    b = table(spark, d, "bronze_notices")
    return bronze.first_days(b, "objectId", "batch_no", ["ingest_id"], F.rtrim("htmlBody", F.lit(" \n\r\t")).endswith("</html>")).select("ingest_id", "drop_reason")


@_query("WITH b AS (SELECT ingest_id, coalesce(substr(publicationDate, 1, 10) = '2026-02-24', false) AS here, nullif(objectId, '') AS k FROM bronze_notices), r AS (SELECT *, row_number() OVER (PARTITION BY here, k ORDER BY ingest_id) AS rn FROM b) SELECT ingest_id, CASE WHEN NOT here THEN 'other_day' WHEN k IS NOT NULL AND rn > 1 THEN 'duplicate' END AS drop_reason FROM r")
def fetch_day_rows(spark: SparkSession, d: str) -> DataFrame:
    return bronze.day_rows(table(spark, d, "bronze_notices"), "2026-02-24", "objectId", ["ingest_id"]).select("ingest_id", "drop_reason")


# events as runs: a run a click of a user's day, its metric the event's value
def _runs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("event_type").alias("layer"), F.col("ts").cast("date").cast("string").alias("target_date"), F.col("event_id").alias("run_id"), F.col("ts").alias("written_at"), F.lit("__all__").alias("notice_type"), F.lit("value").alias("metric_name"), F.col("value").alias("metric_value"))


@_query("SELECT run_id, metric_value FROM (SELECT event_id AS run_id, value AS metric_value, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def obs_latest_metrics(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    return obs.latest_metrics(r, r.select("layer", "target_date", "run_id", "written_at")).select("run_id", "metric_value")


@_query("SELECT CAST(day AS VARCHAR) AS target_date, metric_value FROM (SELECT CAST(ts AS DATE) AS day, value AS metric_value, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'purchase') WHERE rn = 1 ORDER BY day DESC LIMIT 14")
def obs_trend(spark: SparkSession, d: str) -> DataFrame:
    return obs.trend(_runs(spark, d), "purchase", "value", 14)


@_query("WITH e AS (SELECT objectId, organizationName, received_at AS at, row_number() OVER (PARTITION BY objectId ORDER BY received_at DESC, organizationName DESC NULLS LAST) AS rn FROM common_envelope) SELECT DISTINCT c.objectId AS object_id, c.section_2_1, e.organizationName AS organization FROM notice_update_core c LEFT JOIN e ON e.objectId = c.objectId AND rn = 1")
def obs_merged_envelope(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "notice_update_core").select("objectId", "section_2_1")
    e = table(spark, d, "common_envelope").select("objectId", "organizationName", F.col("received_at").alias("at"))
    return obs.with_envelope(c, e, order=["at", "organizationName"]).select(F.col("objectId").alias("object_id"), "section_2_1", F.col("organizationName").alias("organization")).distinct()


@_query(r"SELECT DISTINCT section_3_4_1_label AS label, nullif(regexp_extract(regexp_replace(section_3_4_1_label, '^[\s\x{a0}]+', ''), '^\d+([.]\d+)*', 0), '') AS number, coalesce(nullif(trim(regexp_replace(section_3_4_1_label, '[^A-Za-z0-9_.-]+', '_', 'g'), '_'), ''), '__EMPTY__') AS token, regexp_replace(section_3_4_1_label, '[^A-Za-z0-9._-]+', '_', 'g') AS file FROM notice_update_part_part WHERE section_3_4_1_label IS NOT NULL")
def label_numbers_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "notice_update_part_part").select(F.col("section_3_4_1_label").alias("label")).where("label is not null").distinct()
    return t.select("label", leading_section_number("label").alias("number"), notice_type_token("label").alias("token"), file_name("label").alias("file"))


@_query(r"SELECT ingest_id, sha256(htmlBody) AS hash, lower(regexp_replace(noticeType, '([A-Z])', '_\1', 'g'))[2:] AS snake FROM bronze_notices")
def html_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze_notices").select("ingest_id", bronze.html_hash("htmlBody").alias("hash"), snake_case("noticeType").alias("snake"))


@_query("SELECT DISTINCT publicationDateDay AS day FROM common_envelope WHERE publicationDateDay BETWEEN '2025-02-01' AND '2026-01-31' AND publicationDateDay LIKE '2025%'")
def days_of_a_year(spark: SparkSession, d: str) -> DataFrame:
    return distinct_days(table(spark, d, "common_envelope"), "2025-02-01", "2026-01-31", "2025")


@_query(SQL["delta_wide"].replace("SELECT objectId AS object_id, \"column\"", ", w AS (SELECT objectId AS object_id, \"column\"") + """)
SELECT object_id, CAST(max(CASE WHEN changed_column = 'section_4_1_2' THEN value END) AS BIGINT) AS n_parts, max(CASE WHEN changed_column = 'section_8_1' THEN value END) AS deadline, count(*) AS n_columns FROM w GROUP BY 1""")
def delta_typed(spark: SparkSession, d: str) -> DataFrame:
    """Typed columns of the deltas of contract notices and of results, those that changed."""
    c, p, i, e = _notices(spark, d)
    r = cut(deltas.build_deltas(c, p, i, deltas.number_index(e, deltas.years_referred(c)), list(PROFILES.values())))
    t = deltas.typed_deltas(r, PROFILES["ContractNotice"]).unionByName(deltas.typed_deltas(r, PROFILES["TenderResultNotice"]), allowMissingColumns=True)
    return t.where(F.size("changed_columns") > 0).select(F.col("objectId").alias("object_id"), F.col("section_4_1_2").alias("n_parts"), F.col("section_8_1").alias("deadline"), F.size("changed_columns").cast("bigint").alias("n_columns"))
