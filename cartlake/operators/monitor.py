"""Freshness, volume, anomalies and the health verdict.

The time of the run is always an argument; nothing here reads the clock.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartlake.config import MonitorLimits, layer_of
from cartlake.functions.typing import age_minutes, floor_to_minutes, percent_change
from cartlake.sources.ledger import Load


def instant(as_of: datetime | str) -> Column:
    """Run time as an instant; text and naive times count as UTC."""
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    clock = text[10:]
    zoned = text if text.endswith("Z") or "+" in clock or "-" in clock else f"{text}Z"
    return F.to_timestamp(F.lit(zoned))


def freshness_status(age: Column, limits: MonitorLimits = MonitorLimits()) -> Column:
    return (
        F.when(age <= limits.fresh_min, "fresh")
        .when(age <= limits.critical_min, "stale")
        .otherwise("critical")
    )


def freshness(
    events: DataFrame,
    as_of: datetime | str,
    run_id: str,
    table_name: str = "raw_events",
    limits: MonitorLimits = MonitorLimits(),
) -> DataFrame:
    """Age of the newest event, by a scan of all. No events, or an unreadable time, is critical."""
    text = F.col("timestamp")
    time = F.try_to_timestamp(text)
    newest = events.agg(
        F.max(time).alias("newest"), F.count_if(text.isNotNull() & time.isNull()).alias("bad")
    )
    return _aged(newest, as_of, run_id, table_name, limits)


def kept_freshness(
    spark: SparkSession,
    loads: Iterable[Load],
    as_of: datetime | str,
    run_id: str,
    table_name: str = "raw_events",
    limits: MonitorLimits = MonitorLimits(),
) -> DataFrame:
    """The same verdict from what was kept with each load when it was written: no event is read again."""
    kept = [(x.facts.get("newest"), x.facts.get("unreadable") or 0) for x in loads]
    newest = spark.createDataFrame(kept, "newest bigint, bad bigint").agg(
        F.timestamp_micros(F.max("newest")).alias("newest"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    return _aged(newest, as_of, run_id, table_name, limits)


def _aged(newest: DataFrame, as_of: datetime | str, run_id: str, table_name: str, limits: MonitorLimits) -> DataFrame:
    newest = newest.select(F.when(F.col("bad") == 0, F.col("newest")).alias("max_event_time"))
    now = instant(as_of)
    age = age_minutes(F.col("max_event_time"), now)
    return newest.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table_name).alias("table_name"),
        "max_event_time",
        age.cast("decimal(10,2)").alias("freshness_min"),
        freshness_status(age, limits).alias("status"),
        F.lit(limits.fresh_min).alias("threshold_min"),
        now.alias("checked_at"),
    )


def unreadable_freshness(
    spark: SparkSession, as_of: datetime | str, run_id: str, table_name: str = "raw_events",
    limits: MonitorLimits = MonitorLimits(),
) -> DataFrame:
    """The row for a table that cannot be scanned."""
    empty = spark.createDataFrame([], "timestamp string")
    return freshness(empty, as_of, run_id, table_name, limits)


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table in one job: table_name, record_count, count_error."""
    parts = [
        df.selectExpr("count(*) AS record_count").selectExpr(
            f"'{name}' AS table_name", "record_count", "CAST(NULL AS STRING) AS count_error"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def kept_counts(spark: SparkSession, counters: Mapping[str, Callable[[], int]]) -> DataFrame:
    """Row counts that were kept when the tables were written; a table without one counts as zero rows with its error.

    `counters` maps names to functions that look the count up.
    """
    rows = []
    for name, count in counters.items():
        try:
            rows.append((name, count(), None))
        except Exception as error:
            rows.append((name, 0, str(error)))
    return spark.createDataFrame(rows, "table_name string, record_count bigint, count_error string")


def count_rows_isolated(spark: SparkSession, tables: Mapping[str, object]) -> DataFrame:
    """Row counts where one bad table does not spoil the rest.

    `tables` maps names to functions that return the table. All readable tables
    are counted in one job; only if that job fails is each counted on its own to
    find the bad one. A bad table counts as zero rows with its error.
    """
    readable, rows = {}, []
    for name, load in tables.items():
        try:
            readable[name] = load()
        except Exception as error:
            rows.append((name, 0, str(error)))
    if readable:
        try:
            rows += [tuple(r) for r in count_rows(readable).collect()]
        except Exception:
            for name, df in readable.items():
                try:
                    rows.append((name, df.count(), None))
                except Exception as error:
                    rows.append((name, 0, str(error)))
    return spark.createDataFrame(
        rows, "table_name string, record_count bigint, count_error string"
    )


def mean_counts(
    history: DataFrame,
    as_of: datetime | str,
    limits: MonitorLimits = MonitorLimits(),
    tables: list[str] | None = None,
) -> DataFrame:
    """Mean record count per table over the days before the run, for some or all tables."""
    since = instant(as_of) - F.make_dt_interval(days=F.lit(limits.history_days))
    recent = history.where(F.col("snapshot_hour") >= since)
    if tables is not None:
        recent = recent.where(F.col("table_name").isin(tables))
    return recent.groupBy("table_name").agg(F.avg("record_count").alias("mean_count"))


def volume_snapshot(
    counts: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    run_id: str,
    limits: MonitorLimits = MonitorLimits(),
    tables: list[str] | None = None,
) -> DataFrame:
    """Counts with their change against the recent mean.

    `tables` names the counted tables, so that the history of others is not read. Without history, or with a mean of zero, the change is null and no anomaly. A
    table that could not be counted is one.
    """
    if "count_error" not in counts.columns:
        counts = counts.withColumn("count_error", F.lit(None).cast("string"))
    now = instant(as_of)
    joined = counts.join(mean_counts(history, as_of, limits, tables), "table_name", "left")
    failed = F.col("count_error").isNotNull()
    change = F.when(~failed, percent_change(F.col("record_count"), F.col("mean_count")))
    measured = joined.withColumn("change", change)
    return measured.select(
        F.lit(run_id).alias("run_id"),
        layer_column(F.col("table_name")).alias("layer"),
        "table_name",
        "record_count",
        floor_to_minutes(now, limits.snapshot_minutes).alias("snapshot_hour"),
        F.col("change").cast("decimal(18,2)").alias("pct_change_vs_avg"),
        (failed | F.coalesce(F.abs("change") > limits.anomaly_pct, F.lit(False))).alias(
            "is_anomaly"
        ),
        now.alias("created_at"),
        "mean_count",
        "count_error",
    )


def layer_column(table_name: Column) -> Column:
    return (
        F.when(table_name.startswith("stg_"), layer_of("stg_"))
        .when(table_name.startswith("dim_") | table_name.startswith("fct_"), layer_of("dim_"))
        .otherwise(layer_of("raw_"))
    )


def to_volume_log(snapshot: DataFrame, attempt: int = 1) -> DataFrame:
    return snapshot.select(
        "run_id", "layer", "table_name", "record_count", "snapshot_hour",
        F.col("pct_change_vs_avg").cast("decimal(18,2)").alias("pct_change_vs_avg"),
        "is_anomaly", "created_at", F.lit(attempt).alias("attempt"),
    )


def anomalies(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows out of line, in the terms of the health detail."""
    return snapshot.where("is_anomaly").select(
        F.col("table_name").alias("table"),
        F.col("record_count").alias("current"),
        F.col("mean_count").alias("avg_7d"),
        F.col("pct_change_vs_avg").cast("double").alias("pct_change"),
        F.col("count_error").alias("error"),
    )


def health(freshness_rows: DataFrame, snapshot: DataFrame, run_id: str) -> DataFrame:
    """Verdict over one monitoring run, with a JSON detail unless healthy.

    Both inputs hold one row per monitored table, so their lists stay small.
    """
    c = F.col
    fresh = freshness_rows.select(
        F.struct(
            "table_name", "status", c("freshness_min").cast("double").alias("freshness_min")
        ).alias("fresh"),
    )
    odd = anomalies(snapshot).select(
        F.struct("table", "current", "avg_7d", "pct_change", "error").alias("odd")
    )
    found = fresh.unionByName(odd, allowMissingColumns=True).agg(
        F.coalesce(F.bool_or(c("fresh.status") == "critical"), F.lit(False)).alias("critical"),
        F.coalesce(F.bool_or(c("fresh.status") == "stale"), F.lit(False)).alias("stale"),
        F.count("odd").alias("n_anomalies"),
        F.map_from_entries(
            F.collect_list(
                F.when(
                    c("fresh").isNotNull(),
                    F.struct(c("fresh.table_name"), F.struct("fresh.status", "fresh.freshness_min")),
                )
            )
        ).alias("freshness"),
        F.sort_array(F.collect_list("odd")).alias("anomalies"),
    )
    status = (
        F.when(c("critical"), "CRITICAL")
        .when(c("stale") | (c("n_anomalies") > 0), "WARNING")
        .otherwise("HEALTHY")
    )
    return found.withColumn("status", status).select(
        F.lit(run_id).alias("run_id"),
        F.lit("health_summary").alias("task_id"),
        "status",
        "n_anomalies",
        F.when(
            c("status") != "HEALTHY", F.to_json(F.struct("freshness", "anomalies"))
        ).alias("error_message"),
    )
