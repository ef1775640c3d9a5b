"""Copies gold tables to a serving store and reports on each."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cartlake import schemas as S


class ExportFailed(RuntimeError):
    pass


def jdbc_sink(
    url: str, properties: Mapping[str, str], schema: str = "dw", max_connections: int | None = None,
    batch_size: int = 10000, keep_table: bool = False,
) -> Callable[[DataFrame, str], str]:
    """Overwrites `schema.table` over JDBC.

    Each write task holds one connection. `max_connections` bounds their number, and with it
    the tasks of the scan and write; by default both are as many as the table has partitions.
    `keep_table` empties the target instead of dropping it.
    """

    def write(df: DataFrame, table: str) -> str:
        target = f"{schema}.{table}"
        options = {
            **properties,
            "batchsize": str(batch_size),
            "truncate": str(keep_table).lower(),
        }
        if max_connections is not None:
            options["numPartitions"] = str(max_connections)
        df.write.jdbc(url=url, table=target, mode="overwrite", properties=options)
        return target

    return write


def folder_sink(root: str, fmt: str = "parquet") -> Callable[[DataFrame, str], str]:
    """Overwrites a folder per table below `root`."""

    def write(df: DataFrame, table: str) -> str:
        df.write.format(fmt).mode("overwrite").save(f"{root.rstrip('/')}/{table}")
        return table

    return write


def export_tables(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    sink: Callable[[DataFrame, str], str],
    threads: int = 4,
) -> DataFrame:
    """Exports the tables side by side and returns one report row each, in the order given.

    Rows are counted while they are written, so each table is scanned once. A
    table that fails is reported and the rest go on.
    """

    def export(name: str) -> tuple:
        try:
            seen = Observation(f"export_{name}")
            rows = tables[name]().observe(seen, F.count(F.lit(1)).alias("n"))
            return name, sink(rows, name), int(seen.get["n"]), "ok", None
        except Exception as error:
            return name, None, None, "failed", str(error)

    with ThreadPoolExecutor(threads) as pool:
        report = list(pool.map(export, tables))
    return spark.createDataFrame(report, S.EXPORT_REPORT)


def raise_on_failure(report: DataFrame) -> None:
    """Fails the job after the fact when any table failed."""
    failed = [r["table_name"] for r in report.where("status = 'failed'").select("table_name").collect()]
    if failed:
        raise ExportFailed(f"failed tables: {', '.join(failed)}")
