"""Rows that repeat a doc_id: a match of one text does not hide that of another."""

from cartlake.llm import licenses

NAME, TEXT = licenses.TEMPLATES[1]


def test_a_whole_match_beside_a_part_of_it_is_found(spark):
    part = " ".join(TEXT.split()[:12])
    for texts in ([part, TEXT], [TEXT, part]):
        rows = [(i, t) for i in (1, None) for t in texts]
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        found = {(r.doc_id, r.license_id, r.shared, r.shingles) for r in licenses.scan(docs).collect()}
        assert {(i, n) for i, n, *_ in found} == {(1, NAME), (None, NAME)}
        assert all(shared == whole for *_, shared, whole in found)
