"""Archives of a table whose scans do not number rows alike."""

import os

from cartlake.llm import warc


def test_every_payload_has_a_response_when_scans_differ(spark, tmp_path):
    path = str(tmp_path / "scans")

    def turned(batches):
        n = len(os.listdir(path)) if os.path.isdir(path) else 0
        os.makedirs(f"{path}/{n}")
        for batch in batches:
            yield batch if n % 2 else batch.take(list(reversed(range(batch.num_rows))))

    rows = [(9, "o", "other"), (3, "a", "x" * 200), (4, "b", "x" * 200), (5, "c", "y" * 300), (5, "d", "y" * 300), (6, "e", "z" * 150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    pages = pages.mapInArrow(turned, pages.schema)
    found = sorted((r.page_id, r.record_type, r.refers_to or 0) for r in warc.read(warc.write(pages)).collect())
    assert found == [
        (3, "response", 0), (4, "revisit", 3), (5, "response", 0), (5, "revisit", 5), (6, "response", 0), (9, "response", 0)
    ]
    assert len(os.listdir(path)) > 1
