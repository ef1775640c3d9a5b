"""Loads that count once, refreshes in one step and packing, in folders and in a catalog."""

from __future__ import annotations

import shutil
import threading

import pytest
from pyspark.sql import functions as F

from cartlake import schemas as S
from cartlake.config import BRONZE, GOLD, Storage
from cartlake.sources.ledger import Conflict, Ledger, Load, Version, added
from cartlake.sources.warehouse import MissingTables, Warehouse
from cartlake.streaming import ingest
from events import events


def named(spark, *ids, kind="a"):
    return events(spark, *[{"event_id": i, "event_type": kind} for i in ids])


@pytest.fixture(params=["folder", "catalog"])
def lake(spark, tmp_path, request):
    if request.param == "folder":
        yield Warehouse(spark, Storage(root=str(tmp_path / "lake")))
        return
    lake = Warehouse(spark)
    lake.create_layers()
    lake.create_raw_events()
    yield lake
    for layer in (BRONZE, "silver", GOLD):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def ids(lake):
    return sorted(r.event_id for r in lake.read(BRONZE, "raw_events").select("event_id").collect())


def plain_sql(lake):
    """What a user of plain SQL sees, where there is a catalog."""
    if lake.storage.root is not None:
        return ids(lake)
    return sorted(r.event_id for r in lake.spark.sql("SELECT event_id FROM bronze.raw_events").collect())


def stream_in(spark, lake, folder, checkpoint):
    rows = spark.readStream.schema(S.EVENT).parquet(str(folder))
    ingest.write_bronze(rows, lake, str(checkpoint), available_now=True).awaitTermination()


def test_a_reset_checkpoint_keeps_every_row(spark, lake, tmp_path):
    lake.append(BRONZE, "raw_events", named(spark, "before"))
    named(spark, "a", "b").write.parquet(str(tmp_path / "one"))
    stream_in(spark, lake, tmp_path / "one", tmp_path / "c")
    shutil.rmtree(tmp_path / "c")
    named(spark, "c", kind="it's 100%").write.parquet(str(tmp_path / "two"))
    stream_in(spark, lake, tmp_path / "two", tmp_path / "c")
    lake.append(BRONZE, "raw_events", named(spark, "after", kind=None))
    assert ids(lake) == plain_sql(lake) == ["a", "after", "b", "before", "c"]


def test_replayed_batches_add_nothing(spark, lake, tmp_path):
    for i in range(3):
        named(spark, f"e{i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_in(spark, lake, tmp_path / "in", tmp_path / "c")
    # The last batch's own commit is lost, so the stream runs it again.
    last = max((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    stream_in(spark, lake, tmp_path / "in", tmp_path / "c")
    assert ids(lake) == plain_sql(lake) == ["e0", "e1", "e2"]
    # Batches told again by hand, older ones too.
    load = ingest.bronze_loads(lake, str(tmp_path / "c"))
    for number in range(3):
        load(named(spark, "other"), number)
    assert ids(lake) == ["e0", "e1", "e2"]


def test_a_job_that_dies_before_its_commit_leaves_no_rows(spark, lake, monkeypatch):
    lake.append(BRONZE, "raw_events", named(spark, "a"))

    def dies(self, change):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Ledger, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            lake.add_load(BRONZE, "raw_events", named(spark, "b"), "k")
    assert ids(lake) == plain_sql(lake) == ["a"]
    assert lake.add_load(BRONZE, "raw_events", named(spark, "b"), "k")
    assert not lake.add_load(BRONZE, "raw_events", named(spark, "b"), "k")
    assert ids(lake) == plain_sql(lake) == ["a", "b"]
    assert lake.vacuum(BRONZE, "raw_events") == 0
    assert lake.vacuum(BRONZE, "raw_events", hours=-1) == 1
    assert ids(lake) == ["a", "b"]


def test_a_refresh_killed_midway_leaves_the_old_table(spark, lake, monkeypatch):
    schema = S.TABLES["dim_categories"]
    assert not lake.exists(GOLD, "dim_categories")
    lake.replace(GOLD, "dim_categories", spark.createDataFrame([("k", "old")], schema))
    reader = lake.read(GOLD, "dim_categories")

    def dies(self, change):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Ledger, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            lake.replace(GOLD, "dim_categories", spark.createDataFrame([("k", "half")], schema))
    broken = spark.createDataFrame([("k", "x")], schema).withColumn("category_name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        lake.replace(GOLD, "dim_categories", broken)
    assert [r.category_name for r in lake.read(GOLD, "dim_categories").collect()] == ["old"]
    lake.replace(GOLD, "dim_categories", spark.createDataFrame([("k", "new"), ("l", "new")], schema))
    # A reader that began before keeps its rows; the next one has the new ones.
    assert [r.category_name for r in reader.collect()] == ["old"]
    assert [r.category_name for r in lake.read(GOLD, "dim_categories").collect()] == ["new", "new"]
    assert lake.row_count(GOLD, "dim_categories") == 2
    if lake.storage.root is None:
        assert spark.sql("SELECT category_name FROM gold.dim_categories").count() == 2
        wider = spark.createDataFrame([(1, "k")], "n int, category_name string")
        lake.replace(GOLD, "other", wider.drop("n"))
        assert lake.replace(GOLD, "other", wider).columns == ["n", "category_name"]


def test_files_of_a_dead_job_are_no_table(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    (tmp_path / "gold" / "dim_sellers" / "_temporary" / "0").mkdir(parents=True)
    (tmp_path / "gold" / "dim_sellers" / "load=x").mkdir()
    assert not lake.exists(GOLD, "dim_sellers")
    with pytest.raises(MissingTables):
        lake.read(GOLD, "dim_sellers")
    with pytest.raises(MissingTables):
        lake.row_count(GOLD, "dim_sellers")


def test_many_loads_become_few_files(spark, lake, tmp_path):
    for i in range(12):
        named(spark, f"s{i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema(S.EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ingest.write_bronze(rows, lake, str(tmp_path / "c"), available_now=True).awaitTermination()
    for i in range(8):
        lake.append(BRONZE, "raw_events", named(spark, f"b{i}", kind=["x", "y", None][i % 3]), key=f"k{i}")
    want = sorted([f"s{i}" for i in range(12)] + [f"b{i}" for i in range(8)])
    reader = lake.read(BRONZE, "raw_events")
    done = lake.pack(BRONZE, "raw_events")
    assert (done.loads_before, done.loads_after, done.rows) == (20, 1, 20)
    assert len(lake.read(BRONZE, "raw_events").inputFiles()) <= 4
    assert ids(lake) == plain_sql(lake) == want == sorted(r.event_id for r in reader.collect())
    # Keys and batches that were packed are still known.
    assert not lake.add_load(BRONZE, "raw_events", named(spark, "again"), "k3")
    ingest.bronze_loads(lake, str(tmp_path / "c"))(named(spark, "again"), 5)
    assert ids(lake) == want
    assert lake.pack(BRONZE, "raw_events").loads_after == 1
    assert lake.vacuum(BRONZE, "raw_events", hours=-1) == 20
    assert ids(lake) == plain_sql(lake) == want


def test_packs_are_bounded_and_full_loads_stay(spark, tmp_path):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    for i in range(6):
        lake.append(BRONZE, "raw_events", named(spark, f"e{i}"))
    size = max(x.bytes for x in lake.version(BRONZE, "raw_events").loads)
    assert lake.pack(BRONZE, "raw_events", full_bytes=1).loads_after == 6
    assert lake.pack(BRONZE, "raw_events", pack_bytes=2 * size).loads_after == 3
    assert ids(lake) == [f"e{i}" for i in range(6)]


def test_a_refresh_during_a_packing_wins(spark, tmp_path, monkeypatch):
    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    for i in "ab":
        lake.append(BRONZE, "raw_events", named(spark, i))
    write = Warehouse._write_load

    def slow(self, *args, **options):
        load = write(self, *args, **options)
        with monkeypatch.context() as m:
            m.setattr(Warehouse, "_write_load", write)
            lake.replace(BRONZE, "raw_events", named(spark, "new"))
        return load

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_write_load", slow)
        lake.pack(BRONZE, "raw_events")
    assert ids(lake) == ["new"]


def test_writers_at_once_lose_nothing(spark, lake):
    work = [threading.Thread(target=lake.append, args=(BRONZE, "raw_events", named(spark, f"t{i}"))) for i in range(6)]
    work += [threading.Thread(target=lake.add_load, args=(BRONZE, "raw_events", named(spark, "one"), "same")) for _ in range(3)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert ids(lake) == sorted(["one", *[f"t{i}" for i in range(6)]])


def test_versions(spark, tmp_path):
    one, two = Ledger(spark, str(tmp_path / "t")), Ledger(spark, f"file:{tmp_path}/t")
    assert one.read() == Version()
    one.commit(added(Load("load=a", ("k",), 1, 1)))
    assert not two._write(Version(1))  # taken
    assert two.commit(added(Load("load=b", ("k",), 1, 1))).number == 1  # known key
    for i in range(30):
        two.commit(added(Load(f"load={i}", (f"k{i}",), 1, 1, {"newest": None}), ("s", i)))
    assert one.read().streams == {"s": 29} and len(one.read().loads) == 31
    assert len(list((tmp_path / "t" / "_ledger").glob("0*.json"))) <= 22
    assert two.commit(lambda now: None) == one.read()


def test_a_writer_that_never_wins_says_so(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, str(tmp_path))
    monkeypatch.setattr(Ledger, "_write", lambda self, version: False)
    with pytest.raises(Conflict):
        ledger.commit(added(Load("load=a", ("k",), 1, 1)))


def test_empty_loads(spark, lake):
    lake.append(BRONZE, "raw_events", events(spark).limit(0))
    assert ids(lake) == []
    lake.append(BRONZE, "raw_events", named(spark, "a"))
    number = lake.version(BRONZE, "raw_events").number
    lake.append(BRONZE, "raw_events", events(spark).limit(0))
    assert lake.version(BRONZE, "raw_events").number == number and ids(lake) == ["a"]


def test_tables_made_by_others_are_read_and_not_written(spark):
    lake = Warehouse(spark)
    lake.create_layers()
    spark.range(3).write.saveAsTable("gold.theirs")
    assert lake.exists(GOLD, "theirs") and lake.row_count(GOLD, "theirs") == 3
    with pytest.raises(ValueError):
        lake.append(GOLD, "theirs", spark.range(1))
    spark.sql("DROP DATABASE gold CASCADE")


def test_freshness_and_counts_open_no_data(spark, lake):
    """Files of the loads are gone, yet the verdict is that of a full scan made before."""
    from cartlake.operators import monitor
    from cartlake.plans.medallion import bronze_freshness

    now = "2024-01-01 01:00:00"
    times = ["2024-01-01T00:10:00+00:00", "2023-12-31T23:50:00-01:00", None]
    for i, t in enumerate(times):
        lake.append(BRONZE, "raw_events", events(spark, {"event_id": str(i), "timestamp": t}))
    full = monitor.freshness(lake.read(BRONZE, "raw_events"), now, "r").collect()
    kept = bronze_freshness(lake, now, "r")
    assert kept.collect() == full and full[0].status == "fresh" and float(full[0].freshness_min) == 10.0
    assert "FileScan" not in kept._jdf.queryExecution().executedPlan().toString()
    assert lake.row_count(BRONZE, "raw_events") == 3
    for load in lake.version(BRONZE, "raw_events").loads:
        lake._delete(f"{lake.location(BRONZE, 'raw_events')}/{load.folder}")
    assert bronze_freshness(lake, now, "r").collect() == full and lake.row_count(BRONZE, "raw_events") == 3
    lake.append(BRONZE, "raw_events", events(spark, {"timestamp": "no time"}))
    assert bronze_freshness(lake, now, "r").first().status == "critical"


def test_upkeep(spark, tmp_path):
    from cartlake.plans.medallion import run_upkeep

    lake = Warehouse(spark, Storage(root=str(tmp_path)))
    run_upkeep(lake)
    for i in "abc":
        lake.append(BRONZE, "raw_events", named(spark, i))
        lake.append_rows("monitoring", "freshness_log", [(i, "t", None, None, "fresh", 60, None, 1)], S.TABLES["freshness_log"])
    run_upkeep(lake, hours=-1)
    assert ids(lake) == list("abc") and lake.read("monitoring", "freshness_log").count() == 3
    assert len(list((tmp_path / "bronze" / "raw_events").glob("load=*"))) == 1
    assert len(lake.version("monitoring", "freshness_log").loads) == 1
