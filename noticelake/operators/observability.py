"""Data quality and run observability over any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def non_null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric_name, metric_value): share of non-null values of each column, 0.0 for an empty table; one pass."""
    one = df.agg(*[F.coalesce(F.avg(F.col(c).isNotNull().cast("double")), F.lit(0.0)).alias(c) for c in columns])
    return one.unpivot([], list(columns), "metric_name", "metric_value")


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """(value, n_rows) of the ``n`` most frequent values, null as 'null', ties by value: a top-k report."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("value")).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "value").limit(n)


def status_pivot(runs: DataFrame, day: str, layer: str, status: str, at: str, layers: Sequence[str], days: int | None = None) -> DataFrame:
    """Per day the last status of each layer as columns; the latest ``days`` alone if given (a report)."""
    wide = runs.groupBy(F.col(day).alias("day")).agg(*[F.max_by(F.when(F.col(layer) == x, F.col(status)), F.when(F.col(layer) == x, F.col(at))).alias(x) for x in layers])
    return wide if days is None else wide.orderBy(F.desc("day")).limit(days)


def rollup_counts(df: DataFrame, day: str, kind: str) -> DataFrame:
    """(day, kind, n_rows) with a total a day (kind null) and over all."""
    return df.rollup(day, kind).agg(F.count("*").alias("n_rows"))


def ratios(parts: dict[str, tuple[Column, Column]]) -> list[Column]:
    """Ratios of two counts by name, 0.0 where there is nothing to divide by."""
    return [F.coalesce(F.count_if(a) / F.nullif(F.count_if(b), F.lit(0)), F.lit(0.0)).alias(k) for k, (a, b) in parts.items()]


def latest_runs(runs: DataFrame, keys: Sequence[str] = ("layer", "target_date")) -> DataFrame:
    """The latest written run of each key, ties by run_id; keys may be null."""
    top = runs.groupBy(*keys).agg(F.max_by("run_id", F.struct("written_at", "run_id")).alias("run_id"))
    return top.select(*keys, "run_id")


def latest_metrics(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """The metrics of the latest run of each layer and day: those of runs that were done again don't count."""
    return metrics.join(latest_runs(runs).dropna(), ["layer", "target_date", "run_id"], "left_semi")


def metrics_of_commit(metrics: DataFrame, runs: DataFrame, commit: str) -> DataFrame:
    """The metrics of all runs of one state of the code, with the run's status."""
    return metrics.join(runs.where(F.col("git_commit") == commit).select("run_id", "status").distinct(), "run_id")


def trend(metrics: DataFrame, layer: str, name: str, days: int, notice_type: str = "__all__") -> DataFrame:
    """(target_date, metric_value) of one metric on the latest ``days``, newest first; of several values a day the last written."""
    own = metrics.where((F.col("layer") == layer) & (F.col("notice_type") == notice_type) & (F.col("metric_name") == name))
    return own.groupBy("target_date").agg(F.max_by("metric_value", F.struct("written_at", "run_id")).alias("metric_value")).orderBy(F.desc("target_date")).limit(days)


def with_envelope(rows: DataFrame, envelope: DataFrame, key: str = "objectId", order: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the envelope's columns they lack, from the envelope row of their key that is last by ``order`` (which should be total). Own columns stay, also where they are null."""
    more = [c for c in envelope.columns if c not in rows.columns]
    last = envelope.groupBy(key).agg(F.max_by(F.struct(*more), F.struct(*order)).alias("_e")) if more and order else envelope.groupBy(key).agg(F.max(F.struct(*more)).alias("_e"))
    return rows.join(last, key, "left").select(*rows.columns, *[F.col(f"_e.{c}").alias(c) for c in more])


def history(runs: DataFrame, today: str, days: int = 14, column: str = "dt") -> DataFrame:
    """Rows whose partition ``column`` lies at most ``days`` back, by partition pruning."""
    return runs.where(F.col(column) >= F.date_sub(F.lit(today).cast("date"), days).cast("string"))


def quarantine_summary(quarantine: DataFrame, day: str = "publicationDateDay", kind: str = "noticeType") -> DataFrame:
    """(target_date, notice_type, row_count) of quarantined rows, days and types with none left out; a null type is ``unknown``."""
    return quarantine.groupBy(F.col(day).alias("target_date"), F.coalesce(kind, F.lit("unknown")).alias("notice_type")).agg(F.count("*").alias("row_count"))


def run_record(spark: SparkSession, layer: str, target_date: str, run_id: str, started_at: str, completed_at: str, status: str, counts: Mapping[str, int] | None = None, **about: str) -> DataFrame:
    """One row of the run table: who, when, how, a ``count_…`` column for each count, and ``about`` (git_commit, script_hash, extra_json) as text; ``dt`` is the day it was completed on."""
    row = {"layer": layer, "target_date": target_date, "run_id": run_id, "started_at": started_at, "completed_at": completed_at, "written_at": completed_at, "status": status, **about, "dt": completed_at[:10]}
    n = {f"count_{k}": v for k, v in (counts or {}).items()}
    schema = ", ".join([*(f"`{k}` string" for k in row), *(f"`{k}` bigint" for k in n)])
    return spark.createDataFrame([(*row.values(), *n.values())], schema)


def tall_metrics(spark: SparkSession, layer: str, target_date: str, run_id: str, written_at: str, values: Mapping[str, float], notice_type: str = "__all__") -> DataFrame:
    """A row (layer, target_date, run_id, notice_type, metric_name, metric_value, written_at, dt) for each value of a run."""
    schema = "layer string, target_date string, run_id string, notice_type string, metric_name string, metric_value double, written_at string, dt string"
    return spark.createDataFrame([(layer, target_date, run_id, notice_type, k, float(v), written_at, written_at[:10]) for k, v in values.items()], schema)


def dashboard(runs: DataFrame, metrics: DataFrame, quarantine: DataFrame, layers: Sequence[str] = ("fetch", "bronze", "silver"), days: int = 14) -> str:
    """The latest ``days`` as markdown: status of each layer, valid_rate of bronze, quarantined rows a day and type. The driver reads these few rows."""
    table = [["date", *layers], ["---"] * (len(layers) + 1)] + [[r.day, *(r[x] or "-" for x in layers)] for r in status_pivot(runs, "target_date", "layer", "status", "written_at", layers, days).collect()]
    rates = [f"- {r.target_date}: {r.metric_value:.4f}" for r in trend(metrics, "bronze", "valid_rate", days).collect()]
    per_day = quarantine.groupBy("target_date", "notice_type").agg(F.sum("row_count").alias("n")).groupBy("target_date").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.concat_ws("=", "notice_type", "n"))).alias("each"))
    held = [f"- {r.target_date}: {r.n} ({', '.join(r.each)})" for r in per_day.orderBy(F.desc("target_date")).limit(days).collect()]
    parts = {"Runs": ["| " + " | ".join(x) + " |" for x in table], "Bronze valid_rate": rates or ["No data."], "Quarantine": held or ["No data."]}
    return "\n\n".join(f"## {k}\n\n" + "\n".join(v) for k, v in parts.items()) + "\n"


def violations(metrics: DataFrame, thresholds: dict[str, tuple[str, float]]) -> DataFrame:
    """Metrics beyond their threshold: ``thresholds`` gives (``min`` or ``max``, value) by name; metrics without one pass, missing metrics too."""
    bad = F.lit(False)
    for name, (kind, limit) in thresholds.items():
        v = F.col("metric_value")
        bad = bad | ((F.col("metric_name") == name) & (v < limit if kind == "min" else v > limit))
    return metrics.where(bad)


def metric_violations(metrics: DataFrame, thresholds: Mapping[tuple[str, str, str], tuple[str, float]]) -> DataFrame:
    """Metrics beyond their threshold: ``thresholds`` gives by (layer, notice type, metric) what must hold (``>=``, ``<=``, ``>``, ``<`` or ``==``) and the value; missing metrics pass."""
    v, bad = F.col("metric_value"), F.lit(False)
    for (layer, kind, name), (op, limit) in thresholds.items():
        holds = {">=": v >= limit, "<=": v <= limit, ">": v > limit, "<": v < limit, "==": v == limit}[op]
        bad = bad | ((F.col("layer") == layer) & (F.col("notice_type") == kind) & (F.col("metric_name") == name) & ~holds)
    return metrics.where(bad)
