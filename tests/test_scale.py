"""What jobs move and write: each of these grew faster than the data."""

import re
from pathlib import Path

import pytest

from cartlake import catalogue
from cartlake.config import BRONZE, Storage
from cartlake.sources import derived
from cartlake.sources.warehouse import Warehouse
from events import events

FOLDER = "/root/testdata/sf0.001"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def test_items_are_dealt_once_and_never_moved_as_text(spark):
    plan = derived.events(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", plan)) == 1
    # Orders by buyer and by order, customers, lines: nothing else is shuffled while parts and sellers are small.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4
    # The text of an item is made above every exchange, sort and aggregation.
    made = [line for line in plan.splitlines() if "product_category_name" in line]
    moved = min(i for i, line in enumerate(plan.splitlines()) if re.search(r"Exchange|Sort|Aggregate", line))
    assert made and all(plan.splitlines().index(line) < moved for line in made)


@pytest.mark.parametrize("before", ["0", "5"])
def test_a_partitioned_write_keeps_its_files_open(spark, tmp_path, monkeypatch, before):
    had, seen = spark.conf.get(OPEN_FILES), []
    write = Warehouse._writer
    monkeypatch.setattr(Warehouse, "_writer", lambda *a: seen.append(spark.conf.get(OPEN_FILES)) or write(*a))
    try:
        spark.conf.set(OPEN_FILES, before)
        Warehouse(spark, Storage(root=str(tmp_path))).append(BRONZE, "raw_events", events(spark, {}))
        assert seen == ["16" if before == "0" else before]
        assert spark.conf.get(OPEN_FILES) == before
    finally:
        spark.conf.set(OPEN_FILES, had)


@pytest.mark.parametrize(("query", "what"), [("jsonl_load", "lines"), ("jsonl_rejects", "broken-lines")])
def test_lines_are_written_compressed(spark, query, what):
    rows = catalogue.QUERIES[query](spark, FOLDER)
    assert rows.count() > 0
    path = catalogue._once(spark, FOLDER, what)
    text = spark.read.text(path).agg({"value": "count"}).head()[0], sum(len(r.value) for r in spark.read.text(path).collect())
    files = [x for x in Path(path).iterdir() if x.name.startswith("part-")]
    assert text[0] > 1000 and all(x.suffix == ".gz" for x in files)
    assert sum(x.stat().st_size for x in files) * 5 < text[1]


def test_scratch_tables_are_written_compact(spark):
    catalogue.bronze(spark, FOLDER)
    place = catalogue.warehouse(spark, FOLDER).location(BRONZE, "raw_events")
    files = list(Path(place).rglob("*.parquet"))
    assert files and all(x.name.endswith(".zstd.parquet") for x in files)


def test_packing_shuffles_nothing(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    for n in range(3):
        rows = events(spark, *[{"event_id": f"{n}{k}", "event_type": k} for k in (None, "", "a b/c", "7", "Ä=")])
        lake.append(BRONZE, "raw_events", rows)
    place, parts = lake.location(BRONZE, "raw_events"), lake.version(BRONZE, "raw_events").loads
    plan = lake._by_value(place, "raw_events", parts, 1 << 20, ("event_type",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    before = sorted(lake.read(BRONZE, "raw_events").collect(), key=str)
    packed = lake.pack(BRONZE, "raw_events")
    assert (packed.loads_before, packed.loads_after, packed.rows) == (3, 1, 15)
    assert sorted(lake.read(BRONZE, "raw_events").collect(), key=str) == before
    files = list((Path(place) / lake.version(BRONZE, "raw_events").loads[0].folder).rglob("part-*.parquet"))
    assert len(files) == len({x.parent for x in files}) == 4
