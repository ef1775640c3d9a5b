from datetime import datetime, timedelta, timezone

import pytest

from cartlake import schemas as S
from cartlake.config import BRONZE, GOLD, GOLD_MODELS, MONITORING, SILVER, SILVER_MODELS, Storage
from cartlake.operators import export
from cartlake.operators.checks import GateClosed
from cartlake.plans import medallion
from cartlake.sources.warehouse import MissingTables, Warehouse
from events import events, item

NOW = datetime(2024, 1, 1, 0, 30, tzinfo=timezone.utc)

ROWS = [
    {"event_id": "1", "payload_items": item(), "order_status": "created", "customer_zip_code": "9"},
    {"event_id": "2", "event_type": "payment.processed", "order_status": "approved",
     "payload_payments": "[{'payment_type': 'pix', 'payment_value': 12.5}]"},
    {"event_id": "3", "event_type": "order.reviewed",
     "payload_review": "{'review_id': 'r1', 'review_score': 5}"},
]


@pytest.fixture
def lake(spark, tmp_path):
    warehouse = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    warehouse.replace(BRONZE, "raw_events", events(spark, *ROWS), [S.EVENT_PARTITION])
    return warehouse


def log(lake, name):
    return lake.read(MONITORING, name)


def test_full_run(spark, lake, tmp_path):
    report = medallion.run_build(
        lake, "r1", export.folder_sink(str(tmp_path / "dw")), clock=lambda: NOW
    )
    assert {r["table_name"]: r["status"] for r in report.collect()} == dict.fromkeys(GOLD_MODELS, "ok")
    fact = lake.read(GOLD, "fct_orders").collect()
    assert [(r["order_id"], r["cash_flow_received"]) for r in fact] == [("o1", 12.5)]
    assert spark.read.parquet(str(tmp_path / "dw" / "fct_orders")).count() == 1

    results = log(lake, "dq_gate_log")
    assert results.schema.simpleString() == spark.createDataFrame([], S.DQ_LOG).schema.simpleString()
    built = results.where("status IN ('success', 'error')")
    assert {r["test_name"] for r in built.collect()} == set(SILVER_MODELS)
    assert results.where("status NOT IN ('success', 'error')").count() == 62
    bad = {(r["model_name"], r["test_name"], r["status"]) for r in results.where("failure_count > 0").collect()}
    # pix is no listed payment type; the created and approved order has two rows.
    assert bad == {
        ("stg_order_payments", "accepted_values", "warn"), ("dim_order_attributes", "unique", "fail"),
        ("stg_order_items", "not_null", "warn"),
    }
    row = log(lake, "pipeline_run_log").collect()
    assert [(r["task_id"], r["status"], r["error_message"]) for r in row] == [("run", "success", None)]

    # A second run replaces tables and appends to the logs.
    medallion.run_build(lake, "r2")
    assert lake.read(SILVER, "stg_order_items").count() == 1
    per_run = log(lake, "dq_gate_log").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in per_run} == {"r1": 67, "r2": 67}


def test_catalog_tables_work_the_same(spark):
    lake = Warehouse(spark)
    lake.create_layers((BRONZE, SILVER, GOLD, MONITORING))
    lake.create_raw_events()
    lake.append(BRONZE, "raw_events", events(spark, *ROWS), [S.EVENT_PARTITION])
    medallion.run_build(lake, "r1")
    assert medallion.run_monitoring(lake, "m1", NOW) == "HEALTHY"
    assert lake.read(GOLD, "fct_orders").count() == 1
    for layer in (BRONZE, SILVER, GOLD, MONITORING):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_missing_bronze_is_logged(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    with pytest.raises(MissingTables):
        medallion.run_build(lake, "r1")
    row = log(lake, "pipeline_run_log").head()
    assert (row["task_id"], row["status"]) == ("verify_bronze", "failed")
    assert "raw_events" in row["error_message"]


def test_bad_value_spoils_its_model_only(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    rows = [*ROWS, {"event_id": "4", "payload_items": item(price="ten")}]
    lake.replace(BRONZE, "raw_events", events(spark, *rows), [S.EVENT_PARTITION])
    built = {r.model: r.status for r in medallion.build_silver(lake)}
    assert built.pop("stg_order_items") == "error"
    assert set(built.values()) == {"success"}
    with pytest.raises(MissingTables):
        medallion.run_build(lake, "r1")
    task = log(lake, "pipeline_run_log").head()
    assert (task["task_id"], task["status"]) == ("gold_build", "failed")
    built = {r.model: r.status for r in medallion.build_silver(lake, on_bad_value="null")}
    assert set(built.values()) == {"success"}


def test_failed_rebuild_keeps_the_old_table(spark, tmp_path):
    for storage in (Storage(root=str(tmp_path)), Storage()):
        lake = Warehouse(spark, storage)
        lake.create_layers((BRONZE, SILVER, GOLD, MONITORING))
        lake.replace(BRONZE, "raw_events", events(spark, *ROWS), [S.EVENT_PARTITION])
        medallion.build_silver(lake)
        rows = [*ROWS, {"event_id": "4", "payload_items": item(price="ten")}]
        lake.replace(BRONZE, "raw_events", events(spark, *rows), [S.EVENT_PARTITION])
        failed = [r for r in medallion.build_silver(lake) if r.status == "error"]
        assert [r.model for r in failed] == ["stg_order_items"]
        assert "CAST_INVALID_INPUT" in failed[0].error
        assert lake.read(SILVER, "stg_order_items").count() == 1
    for layer in (BRONZE, SILVER, GOLD, MONITORING):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_enforced_gate_stops_before_export(lake, tmp_path):
    sink = export.folder_sink(str(tmp_path / "dw"))
    with pytest.raises(GateClosed):
        medallion.run_build(lake, "r1", sink, gate_mode="enforce")
    assert not (tmp_path / "dw").exists()
    assert log(lake, "pipeline_run_log").head()["status"] == "failed"


def test_failed_export_fails_the_run(lake):
    def sink(df, table):
        raise RuntimeError("no store")

    with pytest.raises(export.ExportFailed):
        medallion.run_build(lake, "r1", sink)
    assert log(lake, "pipeline_run_log").head()["task_id"] == "gold_export"


def test_monitoring_runs(spark, lake):
    # Nothing built yet: thirteen tables cannot be counted.
    assert medallion.run_monitoring(lake, "m0", NOW) == "WARNING"
    assert log(lake, "volume_snapshot_log").where("is_anomaly AND record_count = 0").count() == 13
    medallion.run_build(lake, "r1")
    assert medallion.run_monitoring(lake, "m1", NOW + timedelta(minutes=5)) == "HEALTHY"
    assert medallion.run_monitoring(lake, "m2", NOW + timedelta(minutes=60)) == "WARNING"
    assert medallion.run_monitoring(lake, "m3", NOW + timedelta(days=1)) == "CRITICAL"
    fresh = {r["run_id"]: r["status"] for r in log(lake, "freshness_log").collect()}
    assert fresh == {"m0": "fresh", "m1": "fresh", "m2": "stale", "m3": "critical"}
    rows = log(lake, "pipeline_run_log").where("task_id = 'health_summary'").collect()
    assert {r["run_id"]: r["status"] for r in rows} == {
        "m0": "WARNING", "m1": "HEALTHY", "m2": "WARNING", "m3": "CRITICAL",
    }
    assert {r["run_id"]: r["error_message"] is None for r in rows}["m1"]


def test_monitoring_without_bronze_is_critical(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    assert medallion.run_monitoring(lake, "m1", NOW) == "CRITICAL"


def test_a_repeated_run_id_is_judged_anew(lake):
    for attempt in (1, 2, 2):
        medallion.build_silver(lake)
        results = medallion.check_layer(lake, SILVER, "r1", NOW, attempt=attempt)
        assert results.count() == 39
    per_attempt = log(lake, "dq_gate_log").groupBy("attempt").count().collect()
    assert {r["attempt"]: r["count"] for r in per_attempt} == {1: 39, 2: 39}
    assert medallion.run_monitoring(lake, "m1", NOW) == medallion.run_monitoring(lake, "m1", NOW)


def test_checks_without_their_table_are_errors(lake):
    medallion.build_silver(lake)
    rows = medallion.check_layer(lake, SILVER, "r1", NOW, failed=["stg_order_items"]).collect()
    assert len(rows) == 39
    errors = [r for r in rows if r["status"] == "error"]
    assert errors and all("stg_order_items" in r["error_detail"] for r in errors)
    assert {r["model_name"] for r in rows if r["status"] != "error"}.isdisjoint({"stg_order_items"})


def test_attempts_of_a_run_stay_apart(lake):
    for attempt in (1, 2, 2):
        medallion.run_build(lake, "r1", clock=lambda: NOW, attempt=attempt)
        medallion.run_monitoring(lake, "m1", NOW, attempt=attempt)
    for name, n in (("dq_gate_log", 67), ("freshness_log", 1), ("volume_snapshot_log", 13), ("pipeline_run_log", 2)):
        counts = log(lake, name).groupBy("attempt").count().collect()
        assert {r["attempt"]: r["count"] for r in counts} == {1: n, 2: n}, name


def test_gold_is_not_built_from_an_earlier_run(lake, spark):
    medallion.run_build(lake, "r1")
    old = {m: lake.version(GOLD, m).number for m in GOLD_MODELS}
    rows = [*ROWS, {"event_id": "4", "payload_items": item(price="ten")}]
    lake.replace(BRONZE, "raw_events", events(spark, *rows), [S.EVENT_PARTITION])
    medallion.run_build(lake, "r2")
    needing = {m for m, (_, needs) in medallion.GOLD_BUILDERS.items() if "stg_order_items" in needs}
    new = {m: lake.version(GOLD, m).number for m in GOLD_MODELS}
    assert needing and {m for m in GOLD_MODELS if new[m] == old[m]} == needing
    skipped = log(lake, "dq_gate_log").where("run_id = 'r2' AND status = 'skipped'").collect()
    assert {r["model_name"] for r in skipped} == needing
    assert all(r["error_detail"] == "failed: stg_order_items" for r in skipped)
