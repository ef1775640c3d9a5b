import json

import pytest

from cartlake import schemas as S
from cartlake.config import BRONZE, GOLD, SILVER, Storage, layer_of
from cartlake.session import shared_folder
from cartlake.sources import derived, jsonl
from cartlake.sources.warehouse import MissingTables, Warehouse
from events import events


def test_names():
    assert Storage().table_name("silver", "stg_customers") == "silver.stg_customers"
    assert Storage(catalog="lake").table_name("gold", "x") == "lake.gold.x"
    assert Storage(root="/a/").path("bronze", "raw_events_copy") == "/a/bronze/raw_events_view"
    assert [layer_of(m) for m in ("stg_a", "dim_a", "fct_a", "raw_events", "dq_gate_log")] == [
        "silver", "gold", "gold", "bronze", "monitoring",
    ]
    with pytest.raises(ValueError):
        Storage().path("gold", "x")


@pytest.mark.parametrize("catalog", [False, True])
def test_replace_append_require(spark, tmp_path, catalog):
    lake = Warehouse(spark, Storage() if catalog else Storage(root=str(tmp_path)))
    lake.create_layers()
    rows = spark.createDataFrame([("k", "toys")], S.TABLES["dim_categories"])
    assert not lake.exists(GOLD, "dim_categories")
    with pytest.raises(MissingTables):
        lake.require(GOLD, ["dim_categories"])
    lake.replace(GOLD, "dim_categories", rows)
    lake.replace(GOLD, "dim_categories", rows)
    assert lake.read(GOLD, "dim_categories").count() == 1
    lake.append(GOLD, "dim_categories", rows)
    assert lake.read(GOLD, "dim_categories").count() == 2
    lake.append_rows(GOLD, "dim_categories", [], S.TABLES["dim_categories"])
    lake.append_rows(GOLD, "dim_categories", [("a", "b")], S.TABLES["dim_categories"])
    assert lake.read(GOLD, "dim_categories").count() == 3
    lake.require(GOLD, ["dim_categories"])
    if catalog:
        assert [r["tableName"] for r in lake.list_tables(GOLD).collect()] == ["dim_categories"]
        spark.sql("DROP TABLE gold.dim_categories")
    else:
        with pytest.raises(ValueError):
            lake.list_tables(GOLD)


def test_bronze_table_is_made_once_and_partitioned(spark):
    lake = Warehouse(spark)
    lake.create_layers()
    lake.create_raw_events()
    lake.append(BRONZE, "raw_events", events(spark, {}), [S.EVENT_PARTITION])
    lake.create_raw_events()
    stored = lake.read(BRONZE, "raw_events")
    assert stored.count() == 1
    assert sorted(stored.columns) == sorted(S.EVENT_COLUMNS)
    described = spark.sql("DESCRIBE bronze.raw_events").collect()
    assert [r["col_name"] for r in described][-1] == S.EVENT_PARTITION
    spark.sql("DROP TABLE bronze.raw_events")


def test_partition_values_stay_text(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    lake.replace(BRONZE, "raw_events", events(spark, {"event_type": "007"}), [S.EVENT_PARTITION])
    assert lake.read(BRONZE, "raw_events").head()["event_type"] == "007"


LINES = [
    {"event_id": "1", "user_id": 5, "payload_items": [{"price": 1.5, "name": "it's"}]},
    {"event_id": "2", "payload_review": {"review_score": 4}, "session_id": None, "other": 1},
]


def write_lines(path):
    text = json.dumps(LINES[0]) + "\n\n   \n{broken\n" + json.dumps(LINES[1]) + "\n[1]\n"
    path.write_text(text, encoding="utf-8")


def check_lines(rows):
    by_id = {r["event_id"]: r for r in rows}
    assert set(by_id) == {"1", "2"}
    assert by_id["1"]["user_id"] == "5"
    assert json.loads(by_id["1"]["payload_items"]) == LINES[0]["payload_items"]
    assert json.loads(by_id["2"]["payload_review"]) == {"review_score": 4}
    assert by_id["2"]["session_id"] is None and by_id["2"]["timestamp"] is None


def test_json_lines_in_batch(spark, tmp_path):
    write_lines(tmp_path / "events.jsonl")
    df = jsonl.read_events(spark, str(tmp_path))
    assert df.schema == S.EVENT
    check_lines(df.collect())
    assert df.count() == 2


def test_json_lines_as_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_lines(folder / "events.jsonl")
    out = str(tmp_path / "out")
    query = (
        jsonl.stream_events(spark, str(folder), 1)
        .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination(120)
    check_lines(spark.read.schema(S.EVENT).parquet(out).collect())


def test_derived_events_of_the_given_tables(spark):
    rows = derived.events(spark, "/root/testdata/sf0.01").groupBy("event_type").count().collect()
    assert {r["event_type"]: r["count"] for r in rows} == {
        "order.created": 15000, "payment.processed": 16636, "order.delivered": 14743,
        "order.reviewed": 4918,
    }


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert layer_of("stg_x") == SILVER
