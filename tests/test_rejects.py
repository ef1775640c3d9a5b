"""Records that cannot be read are kept beside the events and counted."""

from __future__ import annotations

import base64
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from cartlake import schemas as S
from cartlake.config import BRONZE, Storage
from cartlake.sources import jsonl
from cartlake.sources.warehouse import Warehouse
from cartlake.streaming import ingest
from events import events

LINES = [
    '{"event_id": "1", "event_type": "a"}', "", "   ", "{broken", '{"event_id": "2"', "[1]", "null", "7", '"x"', "{}",
    '{"event_id": "3"}', '{"event_id": "4", "event_type": "__rejected__"}', '{"event_id": 5, "payload_items": [{"a": "it\'s"}]}',
]
REJECTS = sorted([(x, "not a JSON object") for x in ("{broken", '{"event_id": "2"', "[1]", "null", "7", '"x"')] + [(LINES[11], "reserved event type")])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "lines.jsonl").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(tmp_path / "in")


def ids(df):
    return sorted(str(r.event_id) for r in df.select("event_id").collect())


def test_modes(spark, folder):
    seen = Observation()
    good = jsonl.read_events(spark, folder, seen=seen)
    assert good.schema == S.EVENT and ids(good) == ["1", "3", "5", "None"]
    assert seen.get == {"events": 4, "rejects": 7}
    both = jsonl.read_events(spark, folder, on_bad="keep")
    bad = both.where(F.col(S.REJECT_REASON).isNotNull())
    assert sorted((r[S.REJECT_TEXT], r[S.REJECT_REASON]) for r in bad.collect()) == REJECTS
    assert both.count() == 11
    with pytest.raises((PySparkException, Py4JJavaError), match="not a JSON object"):
        jsonl.read_events(spark, folder, on_bad="fail").collect()
    with pytest.raises(ValueError):
        jsonl.read_events(spark, folder, on_bad="ignore")


def test_lines_are_parsed_once(spark, folder):
    plan = jsonl.read_events(spark, folder, on_bad="keep")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("stream", [False, True])
def test_rejects_are_stored_beside_the_events(spark, folder, tmp_path, stream):
    lake = Warehouse(spark, Storage(root=str(tmp_path / "lake")))
    lake.append(BRONZE, "raw_events", events(spark, {"event_id": "0", "event_type": None}))
    if stream:
        rows = jsonl.stream_events(spark, folder, on_bad="keep")
        ingest.write_bronze(rows, lake, str(tmp_path / "c"), available_now=True).awaitTermination()
    else:
        lake.append(BRONZE, "raw_events", jsonl.read_events(spark, folder, on_bad="keep"))
    for _ in range(2):
        stored = lake.read(BRONZE, "raw_events")
        assert ids(stored) == ["0", "1", "3", "5", "None"] and stored.columns == list(S.EVENT_COLUMNS)
        assert sorted(tuple(r) for r in lake.rejects().collect()) == REJECTS
        counts = lake.loads(BRONZE, "raw_events").agg(F.sum("n_rows"), F.sum("n_rejects")).first()
        assert tuple(counts) == (5, 7) and lake.row_count(BRONZE, "raw_events") == 5
        lake.pack(BRONZE, "raw_events")
    # Rejects lie under a partition value of their own, which readers of events never open.
    files = lake.read(BRONZE, "raw_events")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(event_type" in files


def wire(spark, *values):
    return spark.createDataFrame([(None if v is None else bytearray(v),) for v in values], "value binary")


def test_wire_rejects(spark):
    header, good = b"\0\0\0\0\1", json.dumps({"event_id": "1"}).encode()
    bad = [b"", b"\0\0\0", header, header + b"{x", header + b"\xff\xfe", header + b"[1]"]
    rows = ingest.decode(wire(spark, header + good, None, *bad), "json", on_bad="keep")
    found = {(r[S.REJECT_TEXT], r[S.REJECT_REASON]) for r in rows.where(f"{S.REJECT_REASON} IS NOT NULL").collect()}
    text = lambda b: base64.b64encode(b).decode()
    want = {(None, "no value"), (text(b""), "no header"), (text(bad[1]), "no header")}
    assert found == want | {(text(b), "unreadable body") for b in bad[2:]}
    assert ids(ingest.decode(wire(spark, header + good, *bad), "json", on_bad="drop")) == ["1"]


def test_avro_rejects(spark, monkeypatch):
    seen = {}

    def fake(column, schema, options=None):
        seen["options"] = options
        read = column.cast("string")
        return F.when(read != "bad", F.struct(*[(read if c == "event_id" else F.lit(None).cast("string")).alias(c) for c in S.EVENT_COLUMNS]))

    monkeypatch.setattr("pyspark.sql.avro.functions.from_avro", fake)
    rows = ingest.decode(wire(spark, b"\0\0\0\0\1abc", b"\0\0\0\0\1bad"), on_bad="keep").collect()
    assert seen["options"] == {"mode": "PERMISSIVE"}
    assert [(r.event_id, r[S.REJECT_REASON]) for r in rows] == [("abc", None), (None, "unreadable body")]
