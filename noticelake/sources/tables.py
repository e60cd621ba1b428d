"""Partitioned Parquet tables with overwrite by partition."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.profiles import snake

# Folder names that stand for no value.
NULL_NAMES = ("__NULL__", "__HIVE_DEFAULT_PARTITION__")


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of; all others stay. Rows are gathered by partition first, so that each is a few files."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("append").partitionBy(*by).parquet(path)


def delete_partitions(spark: SparkSession, path: str, **values: str | Sequence[str]) -> int:
    """Delete the partitions whose columns have the given values; how many there were. Later partition columns may be left out."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    glob = "/".join(f"{k}={v if isinstance(v, str) else '{' + ','.join(v) + '}'}" for k, v in values.items())
    pattern = fs_path(f"{path}/{glob}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.globStatus(pattern) or [])
    for f in found:
        fs.delete(f.getPath(), True)
    return len(found)


def delete_days(spark: SparkSession, path: str, start: str, end: str, column: str = "publicationDateDay") -> int:
    """Delete the partitions of a range of days, both ends included, at any depth of up to three partition columns; how many there were."""
    return sum(_drop(spark, p) for p in _partition_paths(spark, path, column) if start <= _unescape(p.getName().split("=", 1)[1]) <= end)


def delete_type(spark: SparkSession, root: str, notice_type: str | None, days: Sequence[str], column: str = "publicationDateDay") -> int:
    """Delete the given days from every table of a notice type under ``root`` (``<type>__…``); how many partitions there were."""
    prefix = f"{snake(notice_type or 'unknown')}__"
    wanted = set(days)
    found = [p for t in _glob(spark, f"{root}/{prefix}*") for p in _partition_paths(spark, str(t), column)]
    return sum(_drop(spark, p) for p in found if _unescape(p.getName().split("=", 1)[1]) in wanted)


def _glob(spark: SparkSession, pattern: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [f.getPath() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []]


def _holds(spark: SparkSession, path: str) -> bool:
    """True if a table is there and not all of its partitions are gone."""
    return bool(_glob(spark, f"{path}/*=*") or _glob(spark, f"{path}/*.parquet"))


def _partition_paths(spark: SparkSession, path: str, column: str) -> list:
    return [p for depth in ("", "/*", "/*/*") for p in _glob(spark, f"{path}{depth}/{column}=*")]


def _drop(spark: SparkSession, path: object) -> int:
    return int(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def _unescape(value: str) -> str | None:
    value = unquote(value)
    return None if value in NULL_NAMES else value


def partition_values(spark: SparkSession, path: str, *columns: str, **fixed: str) -> list[tuple[str | None, ...]]:
    """The values that the leading partition columns have in a table's folders, distinct, nulls first; only those with the ``fixed`` values. No data is read."""
    every = [*columns, *(k for k in fixed if k not in columns)]
    # folders lie in the order of the table's columns, which is found by what is there
    found = set()
    for p in [q for depth in range(len(every)) for q in _glob(spark, path + "/*=*" * (depth + 1))]:
        parts = dict(x.split("=", 1) for x in str(p).split("/") if "=" in x)
        if set(every) <= set(parts) and all(_unescape(parts[k]) == v for k, v in fixed.items()):
            found.add(tuple(_unescape(parts[c]) for c in columns))
    return sorted(found, key=lambda t: [(v is not None, v or "") for v in t])


def read(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """The table with its partition columns as text; ``merge`` reads every file's schema, for tables whose columns have grown."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(path)


def read_days(spark: SparkSession, path: str, start: str, end: str | None = None, notice_type: str | None | bool = True, schema: str | None = None, column: str = "publicationDateDay") -> DataFrame:
    """The rows of a day or a range of days, of one notice type if given (None: of those without one; True: all), by partition pruning. A missing table is empty if ``schema`` is given, else an error."""
    if schema is not None and not _holds(spark, path):
        return spark.createDataFrame([], schema)
    rows = read(spark, path).where(F.col(column).between(start, end or start))
    return rows if notice_type is True else rows.where(F.col("noticeType").eqNullSafe(F.lit(notice_type)))


def distinct_days(df: DataFrame, start: str | None = None, end: str | None = None, year: str | None = None, column: str = "publicationDateDay") -> DataFrame:
    """The days that ``df`` has rows of, in order, within a range or a year if given; null days are left out."""
    d = F.col(column)
    keep = d.isNotNull()
    for bound in ([] if start is None else [d >= start], [] if end is None else [d <= end], [] if year is None else [d.startswith(year)]):
        for b in bound:
            keep = keep & b
    return df.where(keep).select(d.alias("day")).distinct().orderBy("day")


def write_table(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Create the table, or replace the partitions that ``df`` has rows of: columns come in the order the table has them, new ones last, missing ones as null."""
    spark = df.sparkSession
    if _holds(spark, path):
        there = read(spark, path)
        types = dict(there.dtypes)
        df = df.select(*[F.col(c).cast(types[c]).alias(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in there.columns], *[c for c in df.columns if c not in types])
    overwrite_partitions(df, path, by)


def dump_csv(df: DataFrame, path: str, rows: int | None = None) -> None:
    """Write a table as CSV with a header, nested columns as JSON; at most ``rows`` rows if given."""
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name) for f in df.schema.fields]
    (df if rows is None else df.limit(rows)).select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def dump_report(df: DataFrame, path: str | Path, **about: object) -> None:
    """Write a report as one JSON object: what it is about, ``count`` and ``rows``. Rows are taken one by one, so the driver holds one at a time."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(about, ensure_ascii=False, default=str)[:-1] + (", " if about else "") + '"rows": [')
        for r in df.toLocalIterator():
            f.write((", " if n else "") + json.dumps(r.asDict(recursive=True), ensure_ascii=False, default=str))
            n += 1
        f.write(f'], "count": {n}}}')


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str], script_hash: str) -> DataFrame:
    """Keys of ``wanted`` that no row of ``done`` (keys, script_hash) has processed with this code."""
    return wanted.join(done.where(F.col("script_hash") == script_hash).select(*keys).distinct(), list(keys), "left_anti")


def external_ddl(name: str, df: DataFrame, path: str, by: Sequence[str], replace: bool = False) -> str:
    """CREATE statement of an external table over a written one, partition columns last."""
    columns = [f for f in df.schema.fields if f.name not in by] + [f for c in by for f in df.schema.fields if f.name == c]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
    return f"CREATE {'OR REPLACE TABLE' if replace else 'TABLE IF NOT EXISTS'} {name} ({cols}) USING parquet{part} LOCATION '{path}'"


def external_name(table: str) -> str:
    """The name of a section or delta table outside: ``contract_notice__part_core`` as ``contract_notice_part``, ``contract_notice__delta`` as ``contract_notice_delta``."""
    name = table.replace("__", "_")
    return name.removesuffix("_core") if name.endswith("_part_core") else name


def external_tables(spark: SparkSession, root: str, database: str, by: Sequence[str] = ("publicationDateDay",)) -> dict[str, str]:
    """name -> CREATE statement for every table written under ``root``; nothing is carried out."""
    out = {}
    for p in sorted((q for q in _glob(spark, f"{root}/*__*") if _holds(spark, str(q))), key=str):
        name = external_name(p.getName())
        out[name] = external_ddl(f"{database}.{name}", read(spark, str(p)), str(p), by)
    return out
