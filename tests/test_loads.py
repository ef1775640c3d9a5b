"""Batch loads and streams that share the bronze table keep every row."""

from __future__ import annotations

from cartlake import schemas as S
from cartlake.config import BRONZE, Storage
from cartlake.operators import monitor
from cartlake.sources.warehouse import Warehouse
from cartlake.streaming import ingest


def events(spark, tag, n=3):
    rows = [tuple(f"{tag}{i}" if c == "event_id" else "x" for c in S.EVENT_COLUMNS) for i in range(n)]
    return spark.createDataFrame(rows, S.EVENT)


def stream_in(spark, lake, tmp_path, tag, checkpoint):
    folder = str(tmp_path / f"in-{tag}")
    events(spark, tag).write.parquet(folder)
    rows = spark.readStream.schema(S.EVENT).parquet(folder)
    ingest.write_bronze(rows, lake, str(tmp_path / checkpoint), available_now=True).awaitTermination()


def ids(lake):
    return sorted(r.event_id for r in lake.read(BRONZE, "raw_events").select("event_id").collect())


def test_batch_and_streams_share_a_folder(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    lake.append(BRONZE, "raw_events", events(spark, "a"), [S.EVENT_PARTITION])
    stream_in(spark, lake, tmp_path, "b", "c1")
    lake.append(BRONZE, "raw_events", events(spark, "c"), [S.EVENT_PARTITION])
    stream_in(spark, lake, tmp_path, "d", "c2")
    assert ids(lake) == sorted(f"{t}{i}" for t in "abcd" for i in range(3))
    assert lake.read(BRONZE, "raw_events").columns == list(S.EVENT_COLUMNS) or set(
        lake.read(BRONZE, "raw_events").columns
    ) == set(S.EVENT_COLUMNS)


def test_a_load_written_again_replaces_itself(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    for _ in range(2):
        lake.add_load(BRONZE, "raw_events", events(spark, "a"), "stream-1-0")
    lake.add_load(BRONZE, "raw_events", events(spark, "b"), "stream-1-1")
    assert ids(lake) == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_times_west_of_greenwich(spark):
    at = monitor.instant("2024-01-01T09:00:00-03:00").cast("timestamp_ntz").cast("string")
    assert spark.range(1).select(at.alias("t")).first().t == "2024-01-01 12:00:00"
