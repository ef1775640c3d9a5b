"""The registered queries: every job of the lake over the given tables.

The given tables hold no shop events, so Spark first derives them and lands them
as the bronze table, partitioned by event type, in the shared folder. Silver models read
that table. Gold models and jobs over whole layers (checks, volume, export) read stored silver and
gold tables, as they do in production. Each is landed once per session and folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartlake import schemas as S
from cartlake.config import BRONZE, GOLD, GOLD_MODELS, MONITORING, SILVER, SILVER_MODELS, Storage
from cartlake.functions.typing import utc_wall_clock
from cartlake.operators import checks, export, monitor
from cartlake.plans import gold, silver
from cartlake.plans.declared_checks import CHECKS
from cartlake.plans.medallion import RunLog, attempt_key, bronze_freshness, build_gold, build_silver, raise_on_error, table_counts
from cartlake.session import shared_folder
from cartlake.sources import derived, jsonl
from cartlake.sources.warehouse import Warehouse
from cartlake.streaming import avro, ingest

RUN_ID = "run-1"
AS_OF = "2001-11-05 01:37:30"  # shortly after the newest derived event

# Scratch tables, wire files and lines repeat their field names and payload texts on every row.
COMPACT = {"compression": "zstd"}
COMPACT_LAKE = {**COMPACT, "parquet.compression.codec.zstd.level": "9"}  # written once, kept and read by all
COMPACT_LINES = {"compression": "gzip"}  # the text reader has no zstd without native libraries

_landed: dict[tuple[str, str, str], str] = {}


def _scratch(spark: SparkSession, folder: str, what: str) -> str:
    """A new folder name in the shared folder; never reused, never cleared."""
    tag = hashlib.md5(folder.encode()).hexdigest()[:8]
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/cartlake/{app}/{tag}/{what}-{uuid.uuid4().hex[:8]}"


def _once(
    spark: SparkSession, folder: str, what: str, write: Callable[[str], None] | None = None
) -> str:
    """Folder that `write` fills the first time an application asks for it.

    Only a completed write is remembered; a failed one leaves its folder unused.
    """
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _landed:
        path = _scratch(spark, folder, what)
        if write is not None:
            write(path)
        _landed[key] = path
    return _landed[key]


def _lake(spark: SparkSession, root: str, options: dict = COMPACT) -> Warehouse:
    return Warehouse(spark, Storage(root=root, write_options=options))


def _write_records(wire: DataFrame) -> Callable[[str], None]:
    return wire.write.options(**COMPACT).parquet


def _write_lines(lines: DataFrame) -> Callable[[str], None]:
    return lines.write.options(**COMPACT_LINES).text


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return _lake(spark, _once(spark, folder, "lake"), COMPACT_LAKE)


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The landed event table."""
    lake = warehouse(spark, folder)

    def land(_):
        stage = _scratch(spark, folder, "lines-of-orders")
        try:
            lake.append(BRONZE, "raw_events", derived.events(spark, folder, stage), [S.EVENT_PARTITION])
        finally:
            lake._delete(stage)

    _once(spark, folder, "bronze", land)
    return lake.read(BRONZE, "raw_events")


def stored_layers(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored silver and gold tables."""
    bronze(spark, folder)
    lake = warehouse(spark, folder)

    def land(_):
        raise_on_error(build_silver(lake))
        raise_on_error(build_gold(lake))

    _once(spark, folder, "layers", land)
    kept = {m: lake.read(SILVER, m) for m in SILVER_MODELS}
    return kept | {m: lake.read(GOLD, m) for m in GOLD_MODELS}


def portable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clocks and decimals as doubles, to compare with SQL."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = utc_wall_clock(column)
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(f.name))
    return df.select(*columns)


# Models


def _silver_query(model: str):
    build = silver.SILVER[model]
    return lambda spark, folder: portable(build(silver.raw_events(bronze(spark, folder))))


def _gold_query(model: str):
    build, needs = gold.GOLD[model]

    def run(spark, folder):
        tables = stored_layers(spark, folder)
        return portable(build(*[tables[name] for name in needs]))

    return run


def q_raw_events(spark, folder):
    return silver.raw_events(bronze(spark, folder))


def q_payments_agg(spark, folder):
    return gold.payments_agg(stored_layers(spark, folder)["stg_order_payments"])


def q_delivery_dates(spark, folder):
    return portable(gold.delivery_dates(stored_layers(spark, folder)["stg_order_status_history"]))


def q_order_lines(spark, folder):
    return portable(silver.order_lines(bronze(spark, folder)))


def q_payment_entries(spark, folder):
    return portable(silver.payment_entries(bronze(spark, folder)))


def q_order_totals(spark, folder):
    events = bronze(spark, folder)
    return silver.order_totals(silver.order_lines(events), silver.payment_entries(events))


def q_payload_losses(spark, folder):
    return silver.payload_losses(bronze(spark, folder))


# Checks


def _results(spark, folder, kind: str | None = None) -> DataFrame:
    wanted = [c for c in CHECKS if kind in (None, c.kind)]
    return checks.run_checks(stored_layers(spark, folder), wanted, RUN_ID).drop("tested_at")


def _check_query(kind: str):
    return lambda spark, folder: _results(spark, folder, kind).select(
        "model_name", "column_name", "status", "failure_count"
    )


def q_dq_results(spark, folder):
    return _results(spark, folder)


def q_dq_gate(spark, folder):
    return checks.gate(_results(spark, folder))


def q_repeated_order_keys(spark, folder):
    return checks.repeated_keys(stored_layers(spark, folder)["dim_order_attributes"], "order_id")


def q_orders_without_review(spark, folder):
    """Orders of the fact table that have no kept review."""
    tables = stored_layers(spark, folder)
    reviewers = tables["stg_order_reviews"].select("order_id")
    return checks.orphan_keys(tables["fct_orders"], "order_id", reviewers, "order_id")


# Monitoring


def _history(counts: DataFrame) -> DataFrame:
    """Earlier snapshots, derived from today's counts: ten days of growth at a
    different pace per table, and none for one table."""
    days = counts.withColumn("back", F.explode(F.array(*[F.lit(n) for n in range(1, 11)])))
    pace = F.length("table_name") % 8
    shrunk = F.floor(F.col("record_count") * (100 - F.col("back") * pace) / 100)
    return days.where(F.col("table_name") != "dim_sellers").select(
        "table_name",
        shrunk.alias("record_count"),
        (monitor.instant(AS_OF) - F.make_dt_interval(days=F.col("back"))).alias("snapshot_hour"),
    )


def _counts(spark, folder) -> DataFrame:
    stored_layers(spark, folder)
    return table_counts(warehouse(spark, folder)).drop("count_error")


def _snapshot(spark, folder) -> DataFrame:
    counts = _counts(spark, folder)
    names = [*SILVER_MODELS, *GOLD_MODELS]
    return monitor.volume_snapshot(counts, _history(counts), AS_OF, RUN_ID, tables=names)


def _freshness(spark, folder) -> DataFrame:
    bronze(spark, folder)
    return bronze_freshness(warehouse(spark, folder), AS_OF, RUN_ID)


def q_freshness(spark, folder):
    return portable(_freshness(spark, folder))


def q_volume_snapshot(spark, folder):
    return portable(_snapshot(spark, folder).drop("mean_count", "count_error"))


def q_volume_anomaly(spark, folder):
    return monitor.anomalies(_snapshot(spark, folder)).drop("error")


def q_mean_counts(spark, folder):
    counts = _counts(spark, folder)
    return monitor.mean_counts(_history(counts), AS_OF)


def q_health(spark, folder):
    rows = monitor.health(_freshness(spark, folder), _snapshot(spark, folder), RUN_ID)
    return rows.select(
        "run_id", "task_id", "status", "n_anomalies",
        F.col("error_message").isNotNull().alias("has_detail"),
    )


# Ingest


def q_wire_decode(spark, folder):
    """Every event through the wire form and back."""
    return ingest.decode(ingest.encode_json(bronze(spark, folder)), "json")


def _drain(spark, folder, what: str, source: DataFrame) -> DataFrame:
    target = _lake(spark, _scratch(spark, folder, what))
    query = ingest.write_bronze(
        source, target, _scratch(spark, folder, f"{what}-checkpoint"), available_now=True, name=what
    )
    query.awaitTermination()
    return silver.raw_events(target.read(BRONZE, "raw_events"))


def q_stream_to_bronze(spark, folder):
    """Wire records from files, streamed into a partitioned bronze table."""
    events = bronze(spark, folder)
    wire = _once(spark, folder, "wire", _write_records(ingest.encode_json(events)))
    records = ingest.file_records(spark, wire)
    return _drain(spark, folder, "streamed", ingest.decode(records, "json"))


def q_backfill_then_stream(spark, folder):
    """A third of the events as a batch load, the others streamed at a checkpoint that is lost in between.

    Every job runs twice, as after a crash, and the loads are packed at the end; each event is there once.
    """
    events = bronze(spark, folder).withColumn("_part", F.pmod(F.crc32(F.col("event_id").cast("binary")), F.lit(3)))
    lake = _lake(spark, _scratch(spark, folder, "backfill"))
    checkpoint = _scratch(spark, folder, "backfill-checkpoint")
    for _ in range(2):
        lake.append(BRONZE, "raw_events", events.where("_part = 0"), key="backfill")
    for part in (1, 2):
        rows = events.where(F.col("_part") == part)
        wire = _once(spark, folder, f"wire-{part}", _write_records(ingest.encode_json(rows)))
        records = ingest.decode(ingest.file_records(spark, wire), "json")
        ingest.write_bronze(records, lake, checkpoint, available_now=True, name=f"part-{part}").awaitTermination()
        ingest.bronze_loads(lake, checkpoint)(rows, 0)
        ingest.forget(spark, checkpoint)
    lake.pack(BRONZE, "raw_events")
    return silver.raw_events(lake.read(BRONZE, "raw_events"))


def q_stream_clicks(spark, folder):
    """The click table, streamed as it is, through the wire form into bronze."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # A pattern, since a stream takes a plain path for a folder of files.
    clicks = spark.readStream.schema(schema).parquet(f"{folder}/{{events.parquet}}")
    known = {
        "event_id": F.col("event_id").cast("string"),
        "event_type": F.col("event_type"),
        "timestamp": F.concat(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
        ),
        "user_id": F.col("user_id").cast("string"),
        "payload_items": F.col("props"),
    }
    shaped = clicks.select(
        *[known.get(n, F.lit(None).cast("string")).alias(n) for n in S.EVENT_COLUMNS]
    )
    wire = ingest.encode_json(shaped)
    landed = _drain(spark, folder, "clicks", ingest.decode(wire, "json"))
    return landed.select(*known)


def q_jsonl_load(spark, folder):
    """Events written as JSON lines with nested payloads, read back as text columns."""
    nested = bronze(spark, folder).withColumn(
        "payload_payments",
        F.from_json(
            F.replace("payload_payments", F.lit("'"), F.lit('"')),
            "array<struct<payment_type:string,payment_installments:int,payment_value:double>>",
        ),
    )
    lines = nested.select(F.to_json(F.struct(*S.EVENT_COLUMNS)).alias("value"))
    return jsonl.read_events(spark, _once(spark, folder, "lines", _write_lines(lines)))


def _broken(order: str, breaks: dict[int, object], whole):
    """`whole`, but for orders whose number a key of `breaks` divides, the first one that does."""
    number, chain = F.col(order).cast("bigint"), F
    for divisor, value in breaks.items():
        chain = chain.when(number % divisor == 0, value)
    return chain.otherwise(whole)


def _rejects(lake: Warehouse) -> DataFrame:
    """The rejects of a bronze table, with the counts that its loads kept."""
    kept = lake.loads(BRONZE, "raw_events").agg(F.sum("n_rows").alias("kept"), F.sum("n_rejects").alias("rejected")).first()
    return lake.rejects().select("text", "reason", F.lit(kept.kept).alias("kept"), F.lit(kept.rejected).alias("rejected"))


def q_jsonl_rejects(spark, folder):
    """JSON lines of which some are broken, loaded into bronze: the rejects and the counts of both."""
    whole = F.to_json(F.struct(*S.EVENT_COLUMNS))
    breaks = {
        23: F.concat(F.lit('{"event_id": "'), F.col("event_id")),
        29: F.concat(F.lit('[1, "'), F.col("event_id"), F.lit('"]')),
        31: F.lit("null"),
        37: F.lit("  "),
    }
    lines = bronze(spark, folder).select(_broken("order_id", breaks, whole).alias("value"))
    path = _once(spark, folder, "broken-lines", _write_lines(lines))
    lake = _lake(spark, _scratch(spark, folder, "jsonl-rejects"))
    lake.append(BRONZE, "raw_events", jsonl.read_events(spark, path, on_bad="keep"))
    return _rejects(lake)


def q_wire_rejects(spark, folder):
    """Wire records of which some are broken, streamed into bronze: the rejects and the counts of both."""
    wire = ingest.encode_json(bronze(spark, folder), keep=("event_id", "order_id"))
    header = F.substring("value", 1, ingest.HEADER_BYTES)
    breaks = {
        23: F.substring("value", 1, 3),
        29: F.concat(header, F.concat(F.lit('{"event_id": "'), F.col("event_id")).cast("binary")),
        31: F.lit(None).cast("binary"),
        37: header,
    }
    broken = wire.select(_broken("order_id", breaks, F.col("value")).alias("value"))
    path = _once(spark, folder, "broken-wire", _write_records(broken))
    lake = _lake(spark, _scratch(spark, folder, "wire-rejects"))
    records = ingest.decode(ingest.file_records(spark, path), "json", on_bad="keep")
    checkpoint = _scratch(spark, folder, "wire-rejects-checkpoint")
    ingest.write_bronze(records, lake, checkpoint, available_now=True, name="wire_rejects").awaitTermination()
    return _rejects(lake)


def _second_schema() -> dict:
    """A later version of the event: other order, one field more, one less."""
    first = json.loads(S.avro_schema())
    fields = [f for f in reversed(first["fields"]) if f["name"] != "session_id"]
    return first | {"fields": [*fields[:3], {"name": "campaign", "type": "long"}, *fields[3:]]}


def q_wire_avro(spark, folder):
    """Avro records of two schema versions in one stream, each decoded by the id in its header."""
    events = bronze(spark, folder)
    schemas = {1: json.loads(S.avro_schema()), 300: _second_schema()}
    odd = F.col("order_id").cast("bigint") % 2 == 1
    wire = avro.encode(events.where(odd), schemas[1], 1).unionByName(avro.encode(events.where(~odd), schemas[300], 300))
    path = _once(spark, folder, "wire-avro", _write_records(wire))
    return _drain(spark, folder, "avro", avro.decode(ingest.file_records(spark, path), schemas))


# Export and logs


def q_export_report(spark, folder):
    """Export of the gold tables to folders of the shared store, with counts."""
    tables = stored_layers(spark, folder)
    loaders = {m: (lambda m=m: tables[m]) for m in GOLD_MODELS}
    sink = export.folder_sink(_scratch(spark, folder, "dw"))
    return export.export_tables(spark, loaders, sink).select(
        "table_name", "row_count", "status", "error"
    )


def q_dq_log(spark, folder):
    """The stored check log after two attempts of one run, the second of which is logged twice."""
    lake = _lake(spark, _scratch(spark, folder, "dq-log"))
    results = _results(spark, folder).withColumn("tested_at", monitor.instant(AS_OF))
    for attempt in (1, 2, 2):
        key = attempt_key("checks", RUN_ID, attempt)
        lake.append(MONITORING, "dq_gate_log", checks.to_log(results, attempt), key=key)
    return portable(lake.read(MONITORING, "dq_gate_log"))


def q_run_log(spark, folder):
    """The stored run log of two attempts, one row per checked layer; the second attempt is logged twice."""
    lake = _lake(spark, _scratch(spark, folder, "run-log"))
    gates = checks.gate(_results(spark, folder)).collect()
    for attempt in (1, 2, 2):
        log = RunLog(lake, RUN_ID, attempt=attempt, clock=lambda: datetime.fromisoformat(f"{AS_OF}+00:00"))
        for row in gates:
            error = None if row["open"] else f"{row['failed']} checks failed"
            log.add(f"{row['layer']}_gate", "success" if row["open"] else "failed", log.clock(), error)
        log.flush()
    return portable(lake.read(MONITORING, "pipeline_run_log"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_events": q_raw_events,
    **{model: _silver_query(model) for model in SILVER_MODELS},
    **{model: _gold_query(model) for model in GOLD_MODELS},
    "payments_agg": q_payments_agg,
    "delivery_dates": q_delivery_dates,
    "payload_losses": q_payload_losses,
    "order_lines": q_order_lines,
    "payment_entries": q_payment_entries,
    "order_totals": q_order_totals,
    "dq_unique": _check_query("unique"),
    "dq_not_null": _check_query("not_null"),
    "dq_accepted_values": _check_query("accepted_values"),
    "dq_expression": _check_query("expression_is_true"),
    "dq_relationships": _check_query("relationships"),
    "dq_results": q_dq_results,
    "dq_gate": q_dq_gate,
    "repeated_order_keys": q_repeated_order_keys,
    "orders_without_review": q_orders_without_review,
    "freshness": q_freshness,
    "mean_counts": q_mean_counts,
    "volume_snapshot": q_volume_snapshot,
    "volume_anomaly": q_volume_anomaly,
    "health": q_health,
    "wire_decode": q_wire_decode,
    "stream_to_bronze": q_stream_to_bronze,
    "backfill_then_stream": q_backfill_then_stream,
    "stream_clicks": q_stream_clicks,
    "jsonl_load": q_jsonl_load,
    "jsonl_rejects": q_jsonl_rejects,
    "wire_rejects": q_wire_rejects,
    "wire_avro": q_wire_avro,
    "export_report": q_export_report,
    "run_log": q_run_log,
    "dq_log": q_dq_log,
}
