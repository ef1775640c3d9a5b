"""The full refresh: bronze to silver, checks, gold, checks, export, logs."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlake import schemas as S
from cartlake.config import BRONZE, GOLD, GOLD_MODELS, MONITORING, SILVER, SILVER_MODELS, MonitorLimits
from cartlake.operators import checks, export, monitor
from cartlake.plans.declared_checks import GOLD_CHECKS, SILVER_CHECKS
from cartlake.plans.gold import GOLD as GOLD_BUILDERS
from cartlake.plans.silver import SILVER as SILVER_BUILDERS, raw_events
from cartlake.sources.warehouse import Warehouse

BUILD_JOB, MONITOR_JOB = "shop_build", "shop_monitoring"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class RunLog:
    """Rows of the run log, appended when the run ends; those of one attempt once only."""

    warehouse: Warehouse
    run_id: str
    dag_id: str = BUILD_JOB
    attempt: int = 1
    clock: Callable[[], datetime] = utc_now
    rows: list = field(default_factory=list)

    def add(self, task_id: str, status: str, started: datetime, error: object = None) -> None:
        finished = self.clock()
        text = None if error is None else (str(error)[:2000] or "Unknown error")
        self.rows.append(
            (self.dag_id, self.run_id, task_id, status, text, None, started, finished, None, finished, self.attempt)
        )

    def step(self, task_id: str, work: Callable[[], object]) -> object:
        """Runs one task; a failure is logged and passed on."""
        started = self.clock()
        try:
            return work()
        except Exception as error:
            self.add(task_id, "failed", started, error)
            raise

    def flush(self) -> None:
        key = attempt_key(self.dag_id, self.run_id, self.attempt)
        self.warehouse.append_rows(MONITORING, "pipeline_run_log", self.rows, S.RUN_LOG, key)
        self.rows = []


def attempt_key(*parts: object) -> str:
    """Key under which the log rows of one step of one attempt of a run are written."""
    return "/".join(quote(str(p), safe="") for p in parts)


class BuildFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class BuildResult:
    model: str
    status: str
    error: str | None = None


def silver_tables(
    events: DataFrame, on_bad_value: str = "error", lenient: bool = False
) -> dict[str, DataFrame]:
    """All silver models, lazily."""
    with_payload = ("stg_order_items", "stg_order_payments", "stg_order_reviews")
    return {
        model: build(events, on_bad_value, lenient)
        if model in with_payload
        else build(events, on_bad_value)
        for model, build in SILVER_BUILDERS.items()
    }


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        model: build(*[silver[name] for name in needs])
        for model, (build, needs) in GOLD_BUILDERS.items()
    }


def replace_all(
    warehouse: Warehouse, layer: str, tables: dict[str, DataFrame], threads: int = 4
) -> list[BuildResult]:
    """Replaces tables side by side, so that small ones fill idle executors.

    A failed table does not stop the rest.
    """

    def replace(model: str) -> BuildResult:
        try:
            warehouse.replace(layer, model, tables[model])
            return BuildResult(model, "success")
        except Exception as error:
            return BuildResult(model, "error", str(error))

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(replace, tables))


def build_silver(warehouse: Warehouse, **options) -> list[BuildResult]:
    """Rebuilds the silver tables from bronze."""
    events = raw_events(warehouse.read(BRONZE, "raw_events"))
    return replace_all(warehouse, SILVER, silver_tables(events, **options))


def build_gold(warehouse: Warehouse, failed: Collection[str] = ()) -> list[BuildResult]:
    """Rebuilds the gold tables from the stored silver tables.

    Models that need one of the `failed` silver tables are skipped: they would be built from the rows of an
    earlier run and pass for this one's.
    """
    warehouse.require(SILVER, SILVER_MODELS)
    silver = {m: warehouse.read(SILVER, m) for m in SILVER_MODELS}
    stale = {m: sorted(set(needs) & set(failed)) for m, (_, needs) in GOLD_BUILDERS.items()}
    tables = {m: t for m, t in gold_tables(silver).items() if not stale[m]}
    skipped = [BuildResult(m, "skipped", f"failed: {', '.join(x)}") for m, x in stale.items() if x]
    return replace_all(warehouse, GOLD, tables) + skipped


def raise_on_error(results: list[BuildResult]) -> None:
    failed = [f"{r.model}: {r.error}" for r in results if r.status == "error"]
    if failed:
        raise BuildFailed("; ".join(failed))


def stored(warehouse: Warehouse, layer: str, models) -> dict[str, DataFrame]:
    return {m: warehouse.read(layer, m) for m in models if warehouse.exists(layer, m)}


def check_layer(
    warehouse: Warehouse, layer: str, run_id: str, tested_at: datetime, failed: Collection[str] = (), attempt: int = 1
) -> DataFrame:
    """Runs the declared checks of a layer on its stored tables and logs them.

    Gives the rows of this call only, so a run repeated under its id is judged anew; the log keeps one
    set of rows per attempt. Checks that
    need a table which is missing, or whose model is in `failed`, are logged as errors.
    """
    names = SILVER_MODELS if layer == SILVER else GOLD_MODELS
    tables = {m: t for m, t in stored(warehouse, layer, names).items() if m not in failed}
    rows, runnable = [], []
    for check in SILVER_CHECKS if layer == SILVER else GOLD_CHECKS:
        needed = {check.model} | ({check.argument[0]} if check.kind == "relationships" else set())
        absent = sorted(needed - set(tables))
        if not absent:
            runnable.append(check)
            continue
        detail = f"No table of this run: {', '.join(absent)}"
        rows.append((run_id, layer, check.model, check.test_name, "error", 0, detail, tested_at, attempt))
    if runnable:
        # One row a check. Fixed here, so the gate judges what was logged.
        rows += checks.to_log(checks.run_checks(tables, runnable, run_id, tested_at), attempt).collect()
    results = warehouse.spark.createDataFrame(rows, S.DQ_LOG)
    key = attempt_key("checks", layer, run_id, attempt)
    warehouse.append(MONITORING, "dq_gate_log", results.coalesce(1), key=key)
    return results


def log_builds(warehouse: Warehouse, layer: str, run_id: str, results, tested_at, attempt: int = 1) -> None:
    """Build outcomes go to the check log too, under the model's own name."""
    rows = [
        (run_id, layer, r.model, r.model, r.status, 0, (r.error or "")[:2000] or None, tested_at, attempt)
        for r in results
    ]
    key = attempt_key("builds", layer, run_id, attempt)
    warehouse.append_rows(MONITORING, "dq_gate_log", rows, S.DQ_LOG, key)


def run_build(
    warehouse: Warehouse,
    run_id: str,
    sink: Callable[[DataFrame, str], str] | None = None,
    gate_mode: str = "log_only",
    clock: Callable[[], datetime] = utc_now,
    attempt: int = 1,
    **options,
) -> DataFrame | None:
    """One full refresh. Returns the export report, if there is a sink.

    A retry runs under the same id with the next attempt, and its log rows stay apart; rows of an
    attempt that were logged already are not logged again.

    Checks are logged; they stop the run only with `gate_mode="enforce"`. The first
    failed task is written to the run log and ends the run.
    """
    log = RunLog(warehouse, run_id, attempt=attempt, clock=clock)
    started = clock()
    failed: list[str] = []

    def silver_quality_gate():
        built = build_silver(warehouse, **options)
        log_builds(warehouse, SILVER, run_id, built, clock(), attempt)
        failed.extend(r.model for r in built if r.status == "error")
        results = check_layer(warehouse, SILVER, run_id, clock(), failed, attempt)
        checks.enforce(results, SILVER, gate_mode)

    def gold_build():
        built = build_gold(warehouse, failed)
        skipped = [r for r in built if r.status == "skipped"]
        log_builds(warehouse, GOLD, run_id, skipped, clock(), attempt)
        raise_on_error(built)
        results = check_layer(warehouse, GOLD, run_id, clock(), [r.model for r in skipped], attempt)
        checks.enforce(results, GOLD, gate_mode)

    def gold_export():
        tables = {m: (lambda m=m: warehouse.read(GOLD, m)) for m in GOLD_MODELS}
        report = export.export_tables(warehouse.spark, tables, sink)
        export.raise_on_failure(report)
        return report

    try:
        log.step("verify_bronze", lambda: warehouse.require(BRONZE, ["raw_events"]))
        log.step("silver_quality_gate", silver_quality_gate)
        log.step("gold_build", gold_build)
        report = log.step("gold_export", gold_export) if sink else None
        log.add("run", "success", started)
        return report
    finally:
        log.flush()


def bronze_freshness(
    warehouse: Warehouse, as_of: datetime | str, run_id: str, limits: MonitorLimits = MonitorLimits()
) -> DataFrame:
    """Freshness of bronze from the counts of its loads; tables of other formats are scanned."""
    warehouse.require(BRONZE, ["raw_events"])
    if warehouse.plain and warehouse.location(BRONZE, "raw_events"):
        loads = warehouse.version(BRONZE, "raw_events").loads
        return monitor.kept_freshness(warehouse.spark, loads, as_of, run_id, limits=limits)
    return monitor.freshness(warehouse.read(BRONZE, "raw_events"), as_of, run_id, limits=limits)


def table_counts(warehouse: Warehouse) -> DataFrame:
    """Row counts of all silver and gold tables, without reading them where the format keeps counts."""
    names = [(SILVER, m) for m in SILVER_MODELS] + [(GOLD, m) for m in GOLD_MODELS]
    if warehouse.plain:
        counters = {m: (lambda layer=layer, m=m: warehouse.row_count(layer, m)) for layer, m in names}
        return monitor.kept_counts(warehouse.spark, counters)
    loaders = {m: (lambda layer=layer, m=m: warehouse.read(layer, m)) for layer, m in names}
    return monitor.count_rows_isolated(warehouse.spark, loaders)


def run_upkeep(warehouse: Warehouse, hours: float = 168) -> None:
    """Packs the tables that grow by small loads and deletes what no version has held for `hours`."""
    grown = [(BRONZE, "raw_events")]
    grown += [(MONITORING, m) for m in ("pipeline_run_log", "dq_gate_log", "volume_snapshot_log", "freshness_log")]
    for layer, model in grown:
        if warehouse.exists(layer, model):
            warehouse.pack(layer, model)
    refreshed = [(SILVER, m) for m in SILVER_MODELS] + [(GOLD, m) for m in GOLD_MODELS]
    for layer, model in (*grown, *refreshed):
        warehouse.vacuum(layer, model, hours)


def run_monitoring(
    warehouse: Warehouse,
    run_id: str,
    as_of: datetime,
    limits: MonitorLimits = MonitorLimits(),
    attempt: int = 1,
) -> str:
    """One monitoring run: freshness, volume and verdict, each logged once per attempt."""
    spark = warehouse.spark
    key = attempt_key(MONITOR_JOB, run_id, attempt)
    try:
        fresh = bronze_freshness(warehouse, as_of, run_id, limits)
        row = fresh.head()
    except Exception:
        fresh = monitor.unreadable_freshness(spark, as_of, run_id, limits=limits)
        row = fresh.head()
    fresh = spark.createDataFrame([row], fresh.schema)
    logged = fresh.withColumn("attempt", F.lit(attempt))
    warehouse.append(MONITORING, "freshness_log", logged.coalesce(1), key=key)

    counts = table_counts(warehouse)
    if warehouse.exists(MONITORING, "volume_snapshot_log"):
        history = warehouse.read(MONITORING, "volume_snapshot_log")
    else:
        history = spark.createDataFrame([], S.VOLUME_LOG)
    names = [*SILVER_MODELS, *GOLD_MODELS]
    snapshot = monitor.volume_snapshot(counts, history, as_of, run_id, limits, names)
    # Three small results of at most 13 rows: fixed here, so the verdict judges what
    # was logged and the new snapshot never counts as its own history.
    rows = snapshot.collect()
    snapshot = spark.createDataFrame(rows, snapshot.schema)
    logged = monitor.to_volume_log(snapshot, attempt)
    warehouse.append(MONITORING, "volume_snapshot_log", logged.coalesce(1), key=key)

    verdict = monitor.health(fresh, snapshot, run_id).head()
    warehouse.append_rows(
        MONITORING,
        "pipeline_run_log",
        [(MONITOR_JOB, run_id, verdict["task_id"], verdict["status"], verdict["error_message"],
          None, as_of, as_of, None, as_of, attempt)],
        S.RUN_LOG,
        key,
    )
    return verdict["status"]
