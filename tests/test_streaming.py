import json
import struct

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartlake import schemas as S
from cartlake.config import BRONZE, Storage
from cartlake.plans.silver import raw_events
from cartlake.sources.warehouse import Warehouse
from cartlake.streaming import ingest
from events import events


class Recorder:
    """Stands in for a stream reader and keeps what it was told."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def load(self):
        return self


class FakeSession:
    def __init__(self):
        self.readStream = Recorder()


def test_kafka_options():
    calls = ingest.kafka_records(FakeSession(), "b1:9092,b2:9092", "shop").calls
    assert calls == {
        "format": "kafka", "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "shop",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    more = ingest.kafka_records(
        FakeSession(), "b", "t", "earliest", True, 500, **{"kafka.security.protocol": "SSL"}
    ).calls
    assert more["failOnDataLoss"] == "true"
    assert more["maxOffsetsPerTrigger"] == 500
    assert more["kafka.security.protocol"] == "SSL"


def test_header_is_cut(spark):
    value = struct.pack(">bI", 0, 300) + b"\x01\xffbody"
    df = spark.createDataFrame([(bytearray(value),)], "value binary")
    assert bytes(df.select(ingest.without_header(F.col("value"))).head()[0]) == b"\x01\xffbody"


def test_avro_decode_gets_body_and_schema(spark, monkeypatch):
    seen = {}

    def fake(column, schema):
        seen["schema"] = json.loads(schema)
        return F.struct(column.cast("string").alias("event_id"))

    monkeypatch.setattr("pyspark.sql.avro.functions.from_avro", fake)
    value = struct.pack(">bI", 0, 7) + b"abc"
    df = spark.createDataFrame([(bytearray(value),)], "value binary")
    assert ingest.decode(df).head()[0] == "abc"
    assert [f["name"] for f in seen["schema"]["fields"]] == S.EVENT_COLUMNS
    assert all(f["type"] == ["null", "string"] for f in seen["schema"]["fields"])


def test_wire_round_trip_has_the_right_header(spark):
    source = events(spark, {"payload_items": "[{'a': 'ü'}]"}, {"event_id": "e2", "user_id": ""})
    wire = ingest.encode_json(source, schema_id=300)
    assert all(bytes(r[0])[:5] == struct.pack(">bI", 0, 300) for r in wire.collect())
    assert sorted(ingest.decode(wire, "json").collect()) == sorted(source.collect())


def test_bad_record_fails(spark):
    df = spark.createDataFrame([(bytearray(b"\0\0\0\0\1{broken"),)], "value binary")
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD_IN_PARSING"):
        ingest.decode(df, "json").collect()
    with pytest.raises(ValueError):
        ingest.decode(df, "xml")


def drain(spark, wire, lake, checkpoint):
    records = ingest.decode(ingest.file_records(spark, wire, max_files_per_trigger=1), "json")
    query = ingest.write_bronze(records, lake, checkpoint, available_now=True)
    assert ingest.run_until_stopped(query, 120)
    return raw_events(lake.read(BRONZE, "raw_events"))


@pytest.mark.parametrize("catalog", [False, True])
def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, catalog):
    rows = [{"event_id": f"e{i}", "event_type": f"t.{i % 3}"} for i in range(30)]
    source = events(spark, *rows)
    wire, checkpoint = str(tmp_path / "wire"), str(tmp_path / "checkpoint")
    ingest.encode_json(source.repartition(3)).write.parquet(wire)
    lake = Warehouse(spark, Storage() if catalog else Storage(root=str(tmp_path / "lake")))
    lake.create_layers()
    lake.create_raw_events()

    first = sorted(drain(spark, wire, lake, checkpoint).collect())
    assert first == sorted(source.collect())
    assert sorted(drain(spark, wire, lake, checkpoint).collect()) == first

    ingest.encode_json(events(spark, {"event_id": "late"})).write.mode("append").parquet(wire)
    third = drain(spark, wire, lake, checkpoint)
    assert third.count() == 31
    plan = third.where("event_type = 't.1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan
    if catalog:
        spark.sql("DROP TABLE bronze.raw_events")


def test_duplicates_land_twice(spark, tmp_path):
    wire = str(tmp_path / "wire")
    ingest.encode_json(events(spark, {}, {})).write.parquet(wire)
    lake = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    assert drain(spark, wire, lake, str(tmp_path / "checkpoint")).count() == 2


def test_interval_trigger_runs_until_stopped(spark, tmp_path):
    wire = str(tmp_path / "wire")
    ingest.encode_json(events(spark, {})).write.parquet(wire)
    lake = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    records = ingest.decode(ingest.file_records(spark, wire), "json")
    query = ingest.write_bronze(records, lake, str(tmp_path / "c"), interval="1 second")
    query.processAllAvailable()
    assert not ingest.run_until_stopped(query, 0.1)
    query.stop()
    assert lake.read(BRONZE, "raw_events").count() == 1
