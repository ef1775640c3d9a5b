"""Avro records of several schema versions."""

from __future__ import annotations

import json
import struct

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cartlake import schemas as S
from cartlake.config import BRONZE, Storage
from cartlake.sources.warehouse import Warehouse
from cartlake.streaming import avro, ingest
from events import events

FIRST = json.loads(S.avro_schema())


def wire(spark, *values):
    return spark.createDataFrame([(None if v is None else bytearray(v),) for v in values], "value binary")


def test_known_bytes(spark):
    """A record written by hand from the format's description."""
    schema = {
        "type": "record",
        "name": "e",
        "fields": [
            {"name": "event_id", "type": "string"}, {"name": "unknown", "type": ["string", "null"]}, {"name": "order_id", "type": "long"},
            {"name": "customer_latitude", "type": ["null", "double"]}, {"name": "user_id", "type": ["null", "string"]},
            {"name": "order_status", "type": "boolean"}, {"name": "session_id", "type": "float"}, {"name": "metadata_os", "type": "null"},
        ],
    }
    body = b"\x06a\xc3\xa9" + b"\x00\x04zz" + b"\xad\x02" + b"\x02" + struct.pack("<d", 1.5) + b"\x00" + b"\x01" + struct.pack("<f", 0.5)
    row = avro.decode(wire(spark, b"\0" + (7).to_bytes(4, "big") + body), {7: schema}).first()
    got = (row.event_id, row.order_id, row.customer_latitude, row.user_id, row.order_status, row.session_id, row.metadata_os)
    assert got == ("aé", "-151", "1.5", None, "true", "0.5", None) and row.timestamp is None


texts = st.one_of(st.none(), st.text(max_size=5), st.text(alphabet="ab", min_size=60, max_size=200))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(S.EVENT_COLUMNS), texts), min_size=1, max_size=6))
def test_round_trip(spark, rows):
    df = spark.createDataFrame([tuple(r.get(c) for c in S.EVENT_COLUMNS) for r in rows], S.EVENT)
    df = df.where(f"{S.EVENT_PARTITION} IS NULL OR {S.EVENT_PARTITION} <> '{S.REJECTED}'")
    back = avro.decode(avro.encode(df, FIRST, 9), {9: FIRST})
    assert back.schema.names == list(S.EVENT_COLUMNS)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_bad_records(spark, tmp_path):
    good = avro.encode(events(spark, {"event_id": "1"}), FIRST, 1)
    head = b"\0\0\0\0\1"
    bad = wire(spark, None, b"\0", b"\0\0\0\0\2x", head, head + b"\x09", head + b"\x02\x7f", head + b"\x02\x04\xff\xfe", head + b"\xff" * 12)
    rows = good.unionByName(bad)
    kept = avro.decode(rows, {1: FIRST}, on_bad="keep")
    reasons = [r[0] for r in kept.where(f"{S.REJECT_REASON} IS NOT NULL").select(S.REJECT_REASON).collect()]
    assert sorted(reasons) == sorted(["no value", "no header", "unknown schema id"] + ["unreadable body"] * 5)
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    lake.append(BRONZE, "raw_events", kept)
    assert [r.event_id for r in lake.read(BRONZE, "raw_events").collect()] == ["1"] and lake.rejects().count() == 8
    assert avro.decode(rows, {1: FIRST}, on_bad="drop").count() == 1
    with pytest.raises(Exception, match="unreadable body|no value|no header|unknown"):
        avro.decode(rows, {1: FIRST}).collect()
    assert avro.decode(wire(spark).where(F.lit(False)), {1: FIRST}).count() == 0


def test_schemas_that_are_no_flat_record():
    with pytest.raises(ValueError):
        avro.fields_of('"string"')
    with pytest.raises(ValueError):
        avro.fields_of({"type": "record", "fields": [{"name": "a", "type": {"type": "array", "items": "string"}}]})


def test_two_versions_in_one_stream(spark, tmp_path):
    second = FIRST | {"fields": FIRST["fields"][::-1]}
    both = avro.encode(events(spark, {"event_id": "1"}), FIRST, 1).unionByName(avro.encode(events(spark, {"event_id": "2"}), second, 2))
    both.write.parquet(str(tmp_path / "in"))
    lake = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    records = avro.decode(ingest.file_records(spark, str(tmp_path / "in")), {1: FIRST, 2: second})
    ingest.write_bronze(records, lake, str(tmp_path / "c"), available_now=True).awaitTermination()
    found = lake.read(BRONZE, "raw_events").collect()
    assert sorted((r.event_id, r.user_id, r.order_id) for r in found) == [("1", "u1", "o1"), ("2", "u1", "o1")]


def test_texts_are_written_by_spark_and_read_a_field_at_a_time(spark):
    """Lengths of one to four bytes, versions in one batch, and records that are read one by one beside them."""
    df = events(spark, {"event_id": "1"}).crossJoin(spark.createDataFrame([(n,) for n in (0, 1, 63, 64, 8191, 8192, 1048575, 1048576)], "n int"))
    df = df.withColumn("payload_items", F.expr("repeat('é', n div 2) || repeat('x', n % 2)")).withColumn("session_id", F.lit(""))
    wire_rows = avro.encode(df, FIRST, 1)
    assert "MapInArrow" not in wire_rows._jdf.queryExecution().executedPlan().toString()
    second = FIRST | {"fields": [{"name": "user_id", "type": ["long", "string"]}, *FIRST["fields"][:2]]}
    odd = [b"\0\0\0\1\2" + b"\x00\x0e" + b"\x02\x02a\x02\x02b", b"\0\0\0\1\2" + b"\x02\x04uu" + b"\x02\x02c\x00tail"]
    both = wire_rows.unionByName(wire(spark, *odd, b"\0\0\0\1\2\x02\x04\xff\xfe\x00\x00")).coalesce(1)
    kept = avro.decode(both, {1: FIRST, 258: second}, on_bad="keep").collect()
    assert sorted(len(r.payload_items.encode()) for r in kept if r.payload_items is not None) == [0, 1, 63, 64, 8191, 8192, 1048575, 1048576]
    assert {(r.event_id, r.user_id, r.event_type) for r in kept if r.payload_items is None} == {("a", "7", "b"), ("c", "uu", None), (None, None, S.REJECTED)}
    assert all(r.session_id == "" for r in kept if r.payload_items is not None)
