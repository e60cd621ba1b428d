"""Raw daily payloads: one JSON array of notices a file."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACTOR = "struct<contractorName:string,contractorCity:string,contractorProvince:string,contractorCountry:string,contractorNationalId:string>"
RAW_SCHEMA = (
    "objectId string, noticeType string, noticeNumber string, bzpNumber string, publicationDate string, isTenderAmountBelowEU boolean, orderObject string, cpvCode string, htmlBody string, "
    "clientType string, orderType string, tenderType string, submittingOffersDate string, procedureResult string, organizationName string, organizationCity string, organizationProvince string, "
    f"organizationCountry string, organizationNationalId string, organizationId string, tenderId string, contractors array<{CONTRACTOR}>"
)


def read_days(spark: SparkSession, root: str, days: Sequence[str]) -> DataFrame:
    """All notices of the given days with ``file`` and ``pos`` (order of reading within the file).

    Files are ``bzp_<day>.json`` and ``bzp_<day>_*.json``; days without a file give no rows. A payload that is no array of objects, or is damaged or cut off, raises. A field that
    can't be read as the schema's type is null. A file is read by one task, as a JSON array can't be split.
    """
    pattern = [f"{root}/bzp_{d}{{,_*}}.json" for d in days]
    paths = [str(p.getPath()) for g in pattern for p in _glob(spark, g)]
    if not paths:
        return spark.createDataFrame([], RAW_SCHEMA + ", file string, pos bigint")
    for p in paths:
        if _first_letter(spark, p) != "[":
            raise ValueError(f"payload is not an array: {p}")
    # every field is read as text first, which takes any type; what is no JSON, or cut off, fails the read
    fields = T._parse_datatype_string(RAW_SCHEMA).fields
    texts = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in fields])).options(multiLine=True, mode="FAILFAST").json(paths)
    typed = [F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return texts.select(*typed, F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("pos"))


def _first_letter(spark: SparkSession, path: str) -> str:
    """The first letter of a file after blanks and a byte order mark, '' for none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        while True:
            c = stream.read()
            if c < 0:
                return ""
            if c not in b" \t\r\n\xef\xbb\xbf":
                return chr(c)
    finally:
        stream.close()


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or [])


def bronze_or_raw(spark: SparkSession, bronze: str, raw: str, start: str, end: str, layer: str = "auto") -> DataFrame:
    """The notices of a range of days: from the bronze table, from the raw files, or with ``auto`` from bronze if it has a partition of these days, else from the raw files."""
    from noticelake.sources.tables import partition_values
    from noticelake.sources.tables import read_days as read_table

    if layer not in ("auto", "raw", "bronze"):
        raise ValueError(f"unknown layer: {layer}")
    if layer == "bronze" or (layer == "auto" and any(d is not None and start <= d <= end for _, d in partition_values(spark, bronze, "noticeType", "publicationDateDay"))):
        return read_table(spark, bronze, start, end)
    rows = read_days(spark, raw, days_between(start, end))
    return rows.withColumn("publicationDateDay", F.try_to_date(F.substring("publicationDate", 1, 10)).cast("string"))


def days_between(start: str, end: str) -> list[str]:
    """The ISO days of a range, both ends included; raises if it ends before it starts."""
    a, b = date.fromisoformat(start), date.fromisoformat(end)
    if b < a:
        raise ValueError(f"{end} is before {start}")
    return [(a + timedelta(days=k)).isoformat() for k in range((b - a).days + 1)]
