"""Helpers the operators share: landed tables, Arrow batches, tie keys."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartlake.session import shared_folder

BATCH_ROWS = 256
CHUNK_BYTES = 1 << 20
#: A side of a join is broadcast only when it was counted and has no more rows than this;
#: beyond it the same join shuffles.
BROADCAST_ROWS = 2_000_000


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name below the folder all executors share; never reused."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/cartlake-llm/{app}/{what}-{uuid.uuid4().hex[:12]}"


def land(df: DataFrame, what: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


_shipped: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once when texts are long, and sends this package's code to the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = os.path.join(tempfile.mkdtemp(prefix="cartlake-code-"), "cartlake.zip")
    with zipfile.ZipFile(code, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(code)
    _shipped.add(app)


def bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """`df` with a broadcast hint if its counted rows are within the bound, unchanged beyond it.

    `df` should be landed, since it is counted here.
    """
    limit = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.count() <= limit else df


def text_hash(text: Column) -> Column:
    """Tie key of a text; null and empty differ."""
    return F.xxhash64(F.coalesce(text, F.lit("\0null")), text.isNull())


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null gives empty bytes."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunked(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about `most` bytes, one row at least."""
    begin, size = 0, 0
    for i, x in enumerate(texts):
        if size and size + len(x) > most:
            yield begin, i
            begin, size = i, 0
        size += len(x)
    if begin < len(texts):
        yield begin, len(texts)


def per_batch(work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]) -> Callable:
    """A `mapInArrow` function from one that turns a batch into batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return run
