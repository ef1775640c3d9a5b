import pytest

from cartlake.operators import export


def test_report_and_isolation(spark, tmp_path):
    def broken():
        raise RuntimeError("x" * 3000)

    failing = spark.range(3).selectExpr("raise_error('bad row') AS id")
    tables = {
        "good": lambda: spark.range(5), "gone": broken, "failing": lambda: failing,
        "last": lambda: spark.range(0),
    }
    report = export.export_tables(spark, tables, export.folder_sink(str(tmp_path)))
    rows = {r["table_name"]: r for r in report.collect()}
    assert (rows["good"]["status"], rows["good"]["row_count"]) == ("ok", 5)
    assert (rows["last"]["status"], rows["last"]["row_count"]) == ("ok", 0)
    assert rows["gone"]["status"] == rows["failing"]["status"] == "failed"
    assert len(rows["gone"]["error"]) > 2000
    assert "bad row" in rows["failing"]["error"]
    assert spark.read.parquet(str(tmp_path / "good")).count() == 5
    with pytest.raises(export.ExportFailed, match="gone, failing"):
        export.raise_on_failure(report)


def test_export_replaces(spark, tmp_path):
    sink = export.folder_sink(str(tmp_path))
    export.export_tables(spark, {"t": lambda: spark.range(5)}, sink)
    report = export.export_tables(spark, {"t": lambda: spark.range(2)}, sink)
    export.raise_on_failure(report)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_jdbc_arguments(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(
        "pyspark.sql.DataFrameWriter.jdbc",
        lambda self, url, table, mode=None, properties=None: calls.append((url, table, mode, properties)),
    )
    sink = export.jdbc_sink("jdbc:x:y", {"user": "u"}, max_connections=4)
    assert sink(spark.range(1), "dim_sellers") == "dw.dim_sellers"
    url, table, mode, properties = calls[0]
    assert (url, table, mode) == ("jdbc:x:y", "dw.dim_sellers", "overwrite")
    assert properties == {"user": "u", "numPartitions": "4", "batchsize": "10000", "truncate": "false"}


def test_unreachable_database_is_reported(spark):
    sink = export.jdbc_sink("jdbc:nosuch:db", {})
    row = export.export_tables(spark, {"t": lambda: spark.range(1)}, sink).head()
    assert (row["status"], row["row_count"]) == ("failed", None)
    assert row["error"]
