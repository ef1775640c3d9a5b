import json
from datetime import datetime, timedelta

import pytest

from cartlake import schemas as S
from cartlake.operators import monitor
from events import events

NOW = datetime(2024, 1, 8, 12, 37, 30)


def fresh(spark, *times):
    df = events(spark, *[{"timestamp": t} for t in times])
    return monitor.freshness(df, NOW, "r1").head()


@pytest.mark.parametrize(
    "seconds, status",
    [(0, "fresh"), (3600, "fresh"), (3601, "stale"), (7200, "stale"), (7201, "critical"), (-60, "fresh")],
)
def test_freshness_limits(spark, seconds, status):
    newest = (NOW - timedelta(seconds=seconds)).isoformat() + "+00:00"
    row = fresh(spark, "2024-01-01T00:00:00+00:00", newest)
    assert row["status"] == status
    assert float(row["freshness_min"]) == round(seconds / 60, 2)
    assert row["threshold_min"] == 60


def test_no_events_and_unreadable_times_are_critical(spark):
    empty = monitor.freshness(spark.createDataFrame([], S.EVENT), NOW, "r1").head()
    assert (empty["status"], empty["max_event_time"], empty["freshness_min"]) == ("critical", None, None)
    bad = fresh(spark, "not a time", NOW.isoformat() + "+00:00")
    assert (bad["status"], bad["max_event_time"]) == ("critical", None)
    assert monitor.unreadable_freshness(spark, NOW, "r1").head()["status"] == "critical"


def snapshot(spark, counts, history):
    counts = spark.createDataFrame(counts, "table_name string, record_count bigint, count_error string")
    history = spark.createDataFrame(
        [(t, n, NOW - timedelta(days=d)) for t, n, d in history],
        "table_name string, record_count bigint, snapshot_hour timestamp",
    )
    return monitor.volume_snapshot(counts, history, NOW, "r1")


def test_anomaly_limits(spark):
    counts = [
        ("stg_same", 1300, None), ("stg_more", 13001, None), ("stg_new", 5, None),
        ("dim_zero", 5, None), ("dim_less", 69, None), ("fct_broken", 0, "gone"),
    ]
    history = [
        ("stg_same", 1000, 1), ("stg_more", 10000, 1), ("dim_zero", 0, 1), ("dim_less", 100, 2),
        ("fct_broken", 100, 1),
    ]
    rows = {r["table_name"]: r for r in snapshot(spark, counts, history).collect()}
    flags = {k: r["is_anomaly"] for k, r in rows.items()}
    assert flags == {
        "stg_same": False, "stg_more": True, "stg_new": False, "dim_zero": False,
        "dim_less": True, "fct_broken": True,
    }
    assert float(rows["stg_same"]["pct_change_vs_avg"]) == 30.0
    assert float(rows["stg_more"]["pct_change_vs_avg"]) == 30.01
    assert rows["fct_broken"]["pct_change_vs_avg"] is None
    assert rows["dim_less"]["layer"] == rows["fct_broken"]["layer"] == "gold"
    assert rows["stg_same"]["snapshot_hour"] == datetime(2024, 1, 8, 12, 30)


def test_history_of_seven_days_counts(spark):
    history = [("stg_a", 10, 1), ("stg_a", 20, 7), ("stg_a", 9000, 7.01)]
    row = snapshot(spark, [("stg_a", 15, None)], history).head()
    assert (row["mean_count"], float(row["pct_change_vs_avg"])) == (15.0, 0.0)


def test_means_of_chosen_tables(spark):
    history = spark.createDataFrame(
        [("stg_a", 10, NOW), ("stg_b", 20, NOW)],
        "table_name string, record_count bigint, snapshot_hour timestamp",
    )
    rows = monitor.mean_counts(history, NOW, tables=["stg_b"]).collect()
    assert [tuple(r) for r in rows] == [("stg_b", 20.0)]


def verdict(spark, *, age, odd):
    newest = (NOW - timedelta(minutes=age)).isoformat() + "+00:00"
    fresh_rows = monitor.freshness(events(spark, {"timestamp": newest}), NOW, "r1")
    counts = [("stg_a", 200 if odd else 100, None), ("dim_b", 7, None)]
    return monitor.health(fresh_rows, snapshot(spark, counts, [("stg_a", 100, 1)]), "r1").head()


@pytest.mark.parametrize(
    "age, odd, status",
    [
        (5, False, "HEALTHY"), (5, True, "WARNING"), (90, False, "WARNING"), (200, True, "CRITICAL"),
    ],
)
def test_health(spark, age, odd, status):
    row = verdict(spark, age=age, odd=odd)
    assert row["status"] == status
    assert row["n_anomalies"] == int(odd)
    if status == "HEALTHY":
        assert row["error_message"] is None
        return
    detail = json.loads(row["error_message"])
    assert detail["freshness"]["raw_events"]["freshness_min"] == age
    assert [a["table"] for a in detail["anomalies"]] == (["stg_a"] if odd else [])
    if odd:
        assert detail["anomalies"][0] == {
            "table": "stg_a", "current": 200, "avg_7d": 100.0, "pct_change": 100.0,
        }


def test_counts_in_one_job_and_isolated(spark):
    good, bad = spark.range(7), spark.range(3).selectExpr("raise_error('no') AS x").where("x > 1")
    assert {r["table_name"]: r["record_count"] for r in monitor.count_rows({"a": good}).collect()} == {"a": 7}

    def missing():
        raise RuntimeError("no such table")

    rows = {
        r["table_name"]: r
        for r in monitor.count_rows_isolated(
            spark, {"a": lambda: good, "b": lambda: bad, "c": missing}
        ).collect()
    }
    assert rows["a"]["record_count"] == 7 and rows["a"]["count_error"] is None
    assert rows["b"]["record_count"] == 0 and rows["b"]["count_error"]
    assert rows["c"]["count_error"] == "no such table"
