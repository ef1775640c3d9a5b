"""Stream of wire records into the bronze table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cartlake import schemas as S
from cartlake.config import BRONZE
from cartlake.operators.rejects import BAD_BODY, NO_HEADER, NO_VALUE, PARSED, UNREADABLE, chosen, settled
from cartlake.sources.warehouse import Warehouse

HEADER_BYTES = 5  # Fixed value: magic byte and four bytes of schema id.


def kafka_records(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Wire records of one topic. Needs the Kafka connector on the class path.

    Offsets lost to retention do not stop the query unless asked to.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_records(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Wire records from files with a binary `value` column, as a stream."""
    reader = spark.readStream.format(fmt).schema("value binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def without_header(value: Column) -> Column:
    return F.substring(value, HEADER_BYTES + 1, 2147483647)


def decode(
    records: DataFrame, fmt: str = "avro", avro_schema: str | None = None, on_bad: str = "fail"
) -> DataFrame:
    """Wire records to event columns; a record that cannot be read fails the query.

    With `on_bad="keep"` such records become rejects in two more columns, their bytes as base64, which bronze
    stores beside the events; "drop" leaves them out. The schema id in the header is not looked up:
    one reader schema decodes all records. `avro` needs the Avro connector on the class path.
    """
    body = without_header(F.col("value"))
    strict = on_bad == "fail"
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        data = from_avro(body, avro_schema or S.avro_schema(), *([] if strict else [{"mode": "PERMISSIVE"}]))
    elif fmt == "json" and strict:
        data = F.from_json(body.cast("string"), S.EVENT, {"mode": "FAILFAST"})
    elif fmt == "json":
        fields = T.StructType(S.EVENT.fields + [T.StructField(UNREADABLE, T.StringType())])
        data = F.from_json(F.try_validate_utf8(body.cast("string")), fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})
    else:
        raise ValueError(f"wire format must be avro or json, not {fmt!r}")
    if strict:
        return records.select(data.alias("data")).select("data.*")
    parsed = records.select("value", F.inline(F.array(F.struct(data.alias(PARSED)))))
    read = F.col(PARSED)
    bad = read.isNull() | read[UNREADABLE].isNotNull() if fmt == "json" else read.isNull()
    reason = (
        F.when(F.col("value").isNull(), NO_VALUE)
        .when(F.octet_length("value") < HEADER_BYTES, NO_HEADER)
        .when(bad, BAD_BODY)
    )
    return chosen(settled(parsed, F.base64("value"), reason), on_bad)


def encode_json(events: DataFrame, schema_id: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as JSON wire records, the inverse of `decode` for tests and replays; `keep` names columns to keep beside."""
    header = F.to_binary(F.lit(f"00{schema_id:08x}"), F.lit("hex"))
    body = F.to_json(F.struct(*S.EVENT_COLUMNS)).cast("binary")
    return events.select(*keep, F.concat(header, body).alias("value"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started query keeps in its checkpoint. A checkpoint that is reset gets another one."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").head()[0])["id"]


def forget(spark: SparkSession, checkpoint: str) -> None:
    """Deletes a stopped query's checkpoint, so that its source is read from the start offsets again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bronze_loads(warehouse: Warehouse, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Adds each batch of a query to the bronze table once.

    A batch is known by the query's own id and its number, so one that is replayed after a crash adds nothing, and
    a query that starts anew at the same checkpoint path never meets the batches of the one before.
    """

    def load(batch: DataFrame, number: int) -> None:
        stream = stream_id(warehouse.spark, checkpoint)
        warehouse.add_load(BRONZE, "raw_events", batch, f"stream-{stream}-{number}", stream=(stream, number))

    return load


def write_bronze(
    events: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    interval: str = "10 seconds",
    available_now: bool = False,
    name: str = "events_to_bronze",
) -> StreamingQuery:
    """Appends the stream to the bronze table, every batch once, and starts the query.

    `available_now` drains what is there and ends, for backfills.
    """
    storage = warehouse.storage
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    if warehouse.plain:
        writer = events.writeStream.queryName(name).trigger(**trigger)
        writer = writer.option("checkpointLocation", checkpoint)
        return writer.foreachBatch(bronze_loads(warehouse, checkpoint)).start()
    writer = (
        events.writeStream.queryName(name)
        .format(storage.fmt)
        .outputMode("append")
        .trigger(**trigger)
        .option("checkpointLocation", checkpoint)
        .options(**storage.write_options)
        .partitionBy(S.EVENT_PARTITION)
    )
    if storage.root is None:
        return writer.toTable(storage.table_name(BRONZE, "raw_events"))
    return writer.start(storage.path(BRONZE, "raw_events"))


def run_until_stopped(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Waits for the query; true when it ended within the timeout (seconds)."""
    if timeout is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout))
