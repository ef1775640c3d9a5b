"""Tables of the lake: create, scan, replace, append, pack, list.

Tables in plain file formats are folders of loads with a ledger that says which of them count, in a
folder tree and in a catalog alike. Every write is a new folder first and a line in the ledger last, so a
reader sees a load whole or not at all, and a refresh replaces a table in one step. A reader takes one
version and keeps it, whatever is committed meanwhile. In a catalog the live loads are also
registered as partitions of an external table, for plain SQL; that follows the ledger by a moment.
Formats with transactions of their own (Iceberg, Delta) need none of this and are written as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from cartlake import schemas as S
from cartlake.config import BRONZE, LAYERS, Storage
from cartlake.session import REQUIRED_CONF, no_shuffle_left, setting
from cartlake.sources.ledger import FOLDER, Ledger, Load, Version, added, only, packed

TRANSACTIONAL = ("iceberg", "delta")
LOAD = "load"  # folder level that tells loads apart
_ROOT = "lake.root"
_NULL = ("__HIVE_DEFAULT_PARTITION__", "null")  # how folders and SHOW PARTITIONS write a null value
FULL_BYTES = 128 << 20
PACK_BYTES = 64 * FULL_BYTES
MOST_VALUES = 32  # partition values that a packing reads one by one


class MissingTables(RuntimeError):
    pass


@dataclass(frozen=True)
class Packing:
    """What a packing did to a table."""

    loads_before: int
    loads_after: int
    rows: int


def event_facts() -> list[Column]:
    """Counts that bronze keeps with each load, so that monitoring need not read the events again."""
    text = F.col("timestamp")
    time = F.try_to_timestamp(text)
    return [
        F.unix_micros(F.max(time)).alias("newest"),
        F.count_if(text.isNotNull() & time.isNull()).alias("unreadable"),
        F.count_if(F.col(S.EVENT_PARTITION).eqNullSafe(S.REJECTED)).alias("rejects"),
    ]


@contextmanager
def _open_files(spark: SparkSession | None) -> Iterator[None]:
    """Lets tasks of a partitioned write keep a file open per value, so that wide rows are not sorted by it.

    Sessions of `build_session` have the setting; others get it for the write. Tasks that meet more values sort.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name) if spark else None
    if before is None or int(before) > 0:
        yield
        return
    with setting(spark, name, REQUIRED_CONF[name]):
        yield


def _partition(folder: str) -> str:
    """SQL of the partition that a path of name=value levels stands for."""
    parts = []
    for level in folder.split("/"):
        name, value = (unquote(x) for x in level.split("=", 1))
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{name}` = " + ("null" if value in _NULL else f"'{text}'"))
    return f"PARTITION ({', '.join(parts)})"


class Warehouse:
    """Reads and writes tables by layer and model name.

    With a root folder in `storage` tables are folders below it, else they are
    catalog tables in one database per layer.
    """

    def __init__(self, spark: SparkSession, storage: Storage = Storage()):
        self.spark = spark
        self.storage = storage
        self.plain = storage.fmt not in TRANSACTIONAL

    # Set-up

    def _namespace(self, layer: str) -> str:
        return f"{self.storage.catalog}.{layer}" if self.storage.catalog else layer

    def create_layers(self, layers=LAYERS) -> None:
        if self.storage.root is None:
            for layer in layers:
                self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self._namespace(layer)}")

    def create_raw_events(self) -> None:
        """Bronze table of text columns, partitioned by event type, if absent."""
        if self.storage.root is not None:
            return
        if self.plain:
            self._register(BRONZE, "raw_events", S.STORED_EVENT, self._partitions("raw_events"))
            return
        columns = ", ".join(f"`{c}` STRING" for c in S.EVENT_COLUMNS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.storage.table_name(BRONZE, 'raw_events')} "
            f"({columns}) USING {self.storage.fmt} PARTITIONED BY ({S.EVENT_PARTITION})"
        )

    def _register(self, layer: str, model: str, schema: T.StructType, partition_by) -> None:
        """Makes the external catalog table of a model, with a folder of its own, if it is not there."""
        name = self.storage.table_name(layer, model)
        if self.spark.catalog.tableExists(name):
            return
        home = self.spark.catalog.getDatabase(self._namespace(layer)).locationUri.rstrip("/")
        root = f"{home}/{model}-{uuid.uuid4().hex[:8]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = ", ".join((LOAD, *partition_by))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {LOAD} STRING) USING {self.storage.fmt} "
            f"PARTITIONED BY ({parts}) LOCATION '{root}' TBLPROPERTIES ('{_ROOT}' = '{root}')"
        )

    # Reading

    def location(self, layer: str, model: str) -> str | None:
        """Folder of a plain table; none for catalog tables that are absent or not written by this class."""
        if self.storage.root is not None:
            return self.storage.path(layer, model)
        name = self.storage.table_name(layer, model)
        if not self.spark.catalog.tableExists(name):
            return None
        found = self.spark.sql(f"SHOW TBLPROPERTIES {name} ('{_ROOT}')").head()
        return found["value"] if found and not found["value"].startswith("Table ") else None

    def version(self, layer: str, model: str) -> Version:
        """The live loads of a plain table; without loads where there is none."""
        place = self.location(layer, model) if self.plain else None
        return Ledger(self.spark, place).read() if place else Version()

    def read(self, layer: str, model: str) -> DataFrame:
        """The table's rows as of now. Rejected events are not part of bronze; see `rejects`."""
        rows = self._rows(layer, model)
        if model != "raw_events" or not self.plain:
            return rows
        kind = F.col(S.EVENT_PARTITION)
        return rows.where(kind.isNull() | (kind != S.REJECTED)).select(*S.EVENT_COLUMNS)

    def rejects(self) -> DataFrame:
        """(text, reason) of the records that bronze loads could not read."""
        rows = self._rows(BRONZE, "raw_events").where(F.col(S.EVENT_PARTITION) == S.REJECTED)
        return rows.select(F.col(S.REJECT_TEXT).alias("text"), F.col(S.REJECT_REASON).alias("reason"))

    def loads(self, layer: str, model: str) -> DataFrame:
        """One row per live load of a plain table: folder, rows, rejects, bytes and newest event time."""
        rows = [
            (x.folder, x.rows, int(x.facts.get("rejects") or 0), x.bytes, x.facts.get("newest"))
            for x in self.version(layer, model).loads
        ]
        found = self.spark.createDataFrame(rows, "folder string, n_rows bigint, n_rejects bigint, n_bytes bigint, newest bigint")
        return found.withColumn("newest", F.timestamp_micros("newest"))

    def _rows(self, layer: str, model: str) -> DataFrame:
        place = self.location(layer, model) if self.plain else None
        if place is None:
            if self.storage.root is None:
                return self.spark.read.table(self.storage.table_name(layer, model))
            return self._reader(model).load(self.storage.path(layer, model))
        version = Ledger(self.spark, place).read()
        if not version.number and self.storage.root is not None:
            raise MissingTables(f"{layer}: {model}")
        return self._loaded(place, model, version.loads)

    def _reader(self, model: str):
        # Schemas are fixed, so no file is opened to infer them and partition values
        # that look like numbers stay text.
        reader = self.spark.read.format(self.storage.fmt)
        schema = self._schema(model)
        return reader.schema(schema) if schema is not None else reader

    def _schema(self, model: str):
        return S.STORED_EVENT if model == "raw_events" and self.plain else S.EVENT if model == "raw_events" else S.TABLES.get(model)

    def _loaded(self, place: str, model: str, loads) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], self._schema(model))
        return self._reader(model).option("basePath", place).load([f"{place}/{x.folder}" for x in loads]).drop(LOAD)

    def exists(self, layer: str, model: str) -> bool:
        """Whether a complete write of the table was ever made; files alone are no table."""
        if self.plain and self.storage.root is not None:
            return self.version(layer, model).number > 0
        if self.plain:
            return self.spark.catalog.tableExists(self.storage.table_name(layer, model))
        try:
            self.read(layer, model)
        except AnalysisException:
            return False
        return True

    def require(self, layer: str, models) -> None:
        """Stops a job early when tables it needs are not there."""
        missing = [m for m in models if not self.exists(layer, m)]
        if missing:
            raise MissingTables(f"{layer}: {', '.join(missing)}")

    def row_count(self, layer: str, model: str) -> int:
        """Rows of a table, from what was counted while it was written; other formats are scanned."""
        if self.plain:
            self.require(layer, [model])
            if self.location(layer, model):
                return sum(x.rows for x in self.version(layer, model).loads)
        return self.read(layer, model).count()

    def list_tables(self, layer: str) -> DataFrame:
        """Tables of a layer in the catalog."""
        if self.storage.root is not None:
            raise ValueError("folders are not listed; use exists() or require()")
        return self.spark.sql(f"SHOW TABLES IN {self._namespace(layer)}")

    # Writing

    def _partitions(self, model: str, partition_by=()) -> tuple[str, ...]:
        return (S.EVENT_PARTITION,) if model == "raw_events" else tuple(partition_by)

    def _writer(self, df: DataFrame, mode: str, partition_by=()):
        writer = df.write.format(self.storage.fmt).mode(mode).options(**self.storage.write_options)
        return writer.partitionBy(*partition_by) if partition_by else writer

    def _folder(self, path: str):
        """Hadoop path and the file system it is on."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        folder, fs = self._folder(path)
        fs.delete(folder, True)

    def _write_load(self, place: str, model: str, df: DataFrame, keys, partition_by=()) -> Load:
        """Writes rows to a new folder, counting them on the way. Nothing refers to it yet."""
        folder = f"{LOAD}={uuid.uuid4().hex}"
        path = f"{place}/{folder}"
        facts = event_facts() if model == "raw_events" else []
        if model == "raw_events":
            kept = [F.col(f.name) if f.name in df.columns else F.lit(None).cast("string").alias(f.name) for f in S.STORED_EVENT]
            df = df.select(*kept)
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *facts)
        parts = self._partitions(model, partition_by)
        try:
            with _open_files(df.sparkSession if parts else None), no_shuffle_left(df.sparkSession):
                self._writer(counted, "errorifexists", parts).save(path)
        except Exception:
            self._delete(path)
            raise
        found = dict(seen.get)
        rows = int(found.pop("rows")) - int(found.get("rejects") or 0)
        folder_path, fs = self._folder(path)
        return Load(folder, tuple(keys), rows, int(fs.getContentSummary(folder_path).getLength()), found)

    def _place(self, layer: str, model: str, df: DataFrame, partition_by) -> str:
        """Folder of the plain table that `df` goes to, registered where there is a catalog."""
        place = self.location(layer, model)
        if place is None:
            schema = S.STORED_EVENT if model == "raw_events" else df.schema
            self._register(layer, model, schema, self._partitions(model, partition_by))
            place = self.location(layer, model)
            if place is None:
                raise ValueError(f"{self.storage.table_name(layer, model)} was made by other means and cannot be written here")
        return place

    def _publish(self, layer: str, model: str, place: str, new=(), gone=()) -> None:
        """Registers loads as partitions for plain SQL; readers of this class do not depend on it."""
        if self.storage.root is not None:
            return
        name = self.storage.table_name(layer, model)
        levels = self.spark.catalog.listColumns(name)
        nested = [c.name for c in levels if c.isPartition and c.name != LOAD]
        specs = []
        for load in new:
            folders = [load.folder]
            if nested:
                folder, fs = self._folder(f"{place}/{load.folder}")
                inner = [x.getPath().getName() for x in fs.listStatus(folder) if x.isDirectory()]
                folders = [f"{load.folder}/{x}" for x in inner if x.startswith(f"{nested[0]}=")]
            specs += [_partition(x) for x in folders]
        if specs:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
        dead = {x.folder for x in gone}
        held = [r["partition"] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()] if dead else []
        old = [_partition(x) for x in held if x.split("/")[0] in dead]
        if old:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(old)}")

    def replace(self, layer: str, model: str, df: DataFrame, partition_by=()) -> DataFrame:
        """Full refresh of a table; returns the stored table.

        The new rows are written to a folder of their own. One commit makes them the table, so a refresh
        that fails or is killed leaves the old one, and a reader never meets half of either.
        """
        if not self.plain:
            self._replace_transactional(layer, model, df, partition_by)
            return self.read(layer, model)
        if self.storage.root is None and self._columns_differ(layer, model, df):
            self.spark.sql(f"DROP TABLE {self.storage.table_name(layer, model)}")
        place = self._place(layer, model, df, partition_by)
        load = self._write_load(place, model, df, [f"refresh-{uuid.uuid4().hex}"], partition_by)
        old = self.version(layer, model).loads
        Ledger(self.spark, place).commit(only(load))
        self._publish(layer, model, place, [load], old)
        return self.read(layer, model)

    def _columns_differ(self, layer: str, model: str, df: DataFrame) -> bool:
        name = self.storage.table_name(layer, model)
        if model == "raw_events" or not self.spark.catalog.tableExists(name):
            return False
        kept = {(f.name, f.dataType.simpleString()) for f in self.spark.table(name).schema.fields if f.name != LOAD}
        return kept != {(f.name, f.dataType.simpleString()) for f in df.schema.fields}

    def _replace_transactional(self, layer: str, model: str, df: DataFrame, partition_by) -> None:
        if self.storage.root is not None:
            self._writer(df, "overwrite", partition_by).save(self.storage.path(layer, model))
            return
        target = self.storage.table_name(layer, model)
        writer = df.writeTo(target).using(self.storage.fmt).options(**self.storage.write_options)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()

    def add_load(
        self, layer: str, model: str, df: DataFrame, key: str, partition_by=(), stream: tuple[str, int] | None = None
    ) -> bool:
        """Adds rows under a key; false, and nothing written, where the key is there already.

        stream names a stream and the number of its batch: numbers up to the last one kept count as there.
        """
        place = self._place(layer, model, df, partition_by)
        ledger = Ledger(self.spark, place)
        now = ledger.read()
        if now.holds(key) or (stream is not None and now.streams.get(stream[0], -1) >= stream[1]):
            return False
        # A stream's keys are its numbers; they are not listed one by one.
        load = self._write_load(place, model, df, [] if stream else [key], partition_by)
        if not load.rows and not load.facts.get("rejects") and now.number:
            self._delete(f"{place}/{load.folder}")
            return False
        then = ledger.commit(added(load, stream))
        if all(x.folder != load.folder for x in then.loads):
            self._delete(f"{place}/{load.folder}")  # another writer was first
            return False
        self._publish(layer, model, place, [load])
        return True

    def append(self, layer: str, model: str, df: DataFrame, partition_by=(), key: str | None = None) -> None:
        """Adds rows; with a key, once only (plain formats)."""
        if self.plain:
            self.add_load(layer, model, df, key or f"batch-{uuid.uuid4().hex}", partition_by)
            return
        writer = self._writer(df, "append", partition_by)
        if self.storage.root is None:
            writer.saveAsTable(self.storage.table_name(layer, model))
        else:
            writer.save(self.storage.path(layer, model))

    def append_rows(self, layer: str, model: str, rows: list, schema: str, key: str | None = None) -> None:
        """Appends a few driver-made log rows; nothing happens without rows."""
        if rows:
            self.append(layer, model, self.spark.createDataFrame(rows, schema).coalesce(1), key=key)

    # Upkeep

    def pack(
        self, layer: str, model: str, full_bytes: int = FULL_BYTES, pack_bytes: int = PACK_BYTES, partition_by=()
    ) -> Packing:
        """Writes small loads together into full files and puts them in the place of these loads.

        Loads below full_bytes are dealt, oldest first, to packs of at most pack_bytes, a Spark job each. The files of a
        partition value are read by a task per half a full file, so files are large where there are rows enough and
        no row is shuffled; tables of many values are rebalanced instead. Readers see the same rows before and after;
        the old files stay until `vacuum`.
        """
        place = self.location(layer, model) if self.plain else None
        if place is None:
            raise ValueError("only plain tables are packed; other formats have upkeep of their own")
        ledger = Ledger(self.spark, place)
        before = ledger.read()
        packs: list[list[Load]] = [[]]
        for load in (x for x in before.loads if x.bytes < full_bytes):
            if packs[-1] and sum(x.bytes for x in packs[-1]) + load.bytes > pack_bytes:
                packs.append([])
            packs[-1].append(load)
        for parts in packs:
            if len(parts) > 1:
                self._pack(layer, model, place, ledger, parts, full_bytes, partition_by)
        after = ledger.read()
        return Packing(len(before.loads), len(after.loads), sum(x.rows for x in after.loads))

    def _pack(self, layer, model, place, ledger, parts, full_bytes, partition_by) -> None:
        by = self._partitions(model, partition_by)
        if by:
            rows = self._by_value(place, model, parts, full_bytes, by)
        else:
            rows = self._loaded(place, model, parts).coalesce(-(-sum(x.bytes for x in parts) // full_bytes))
        new = self._write_load(place, model, rows, [k for x in parts for k in x.keys], partition_by)
        if new.rows != sum(x.rows for x in parts):
            self._delete(f"{place}/{new.folder}")
            raise RuntimeError(f"packing {layer}.{model} gave {new.rows} rows for {sum(x.rows for x in parts)}")
        then = ledger.commit(packed(new, parts))
        if all(x.folder != new.folder for x in then.loads):
            self._delete(f"{place}/{new.folder}")  # a part was replaced meanwhile
            return
        self._publish(layer, model, place, [new], parts)

    def _by_value(self, place, model, parts, full_bytes, by) -> DataFrame:
        """The rows of loads, each partition value in tasks of its own."""
        folders: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        for load in parts:
            folder, fs = self._folder(f"{place}/{load.folder}")
            for found in fs.listStatus(folder):
                name = found.getPath().getName()
                if found.isDirectory() and "=" in name:
                    folders.setdefault(name, []).append(f"{place}/{load.folder}/{name}")
                    sizes[name] = sizes.get(name, 0) + int(fs.getContentSummary(found.getPath()).getLength())
        if len(by) > 1 or not 0 < len(folders) <= MOST_VALUES:
            # Rebalancing splits a large partition value over several tasks and lets small ones share one.
            return self._loaded(place, model, parts).hint("rebalance", *by)
        reader = self._reader(model).option("basePath", place)
        # Half a full file a task: a task writes its file alone, and compact files take long to write.
        each = [reader.load(paths).drop(LOAD).coalesce(-(-2 * max(sizes[x], 1) // full_bytes)) for x, paths in folders.items()]
        return reduce(DataFrame.unionByName, each)

    def vacuum(self, layer: str, model: str, hours: float = 168) -> int:
        """Deletes folders that no version has held for so long, and what dead jobs left; returns how many.

        Give more hours than the longest job runs: its reader, or a write not yet committed, needs its files.
        """
        place = self.location(layer, model) if self.plain else None
        if place is None or not self._folder(place)[1].exists(self._folder(place)[0]):
            return 0
        folder, fs = self._folder(place)
        live = {x.folder for x in Ledger(self.spark, place).read().loads}
        limit = self.spark._jvm.System.currentTimeMillis() - int(hours * 3_600_000)
        dead = [
            x.getPath() for x in fs.listStatus(folder)
            if x.getPath().getName() not in live | {FOLDER} and x.getModificationTime() <= limit
        ]
        for path in dead:
            fs.delete(path, True)
        return len(dead)
