"""The training sample of the quality classifier where texts do not fit its bounds."""

import pytest

from cartlake.llm import quality


def _tables(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int")
    return docs, labels


def test_texts_beyond_the_bound_are_passed_over(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 20_000)
    short = ["good words here" if i % 2 else "BAD!! STUFF??" for i in range(100)]
    docs, labels = _tables(spark, short)
    order = [t.decode() for t in quality.sample(docs, labels)[0]]
    assert len(order) > 50
    first = docs.orderBy(quality.F.xxhash64("doc_id")).where("doc_id % 4 <> 2").first().doc_id
    for size in (30_000, 19_990):
        docs, labels = _tables(spark, [t if i != first else "x" * size for i, t in enumerate(short)])
        texts, marks = quality.sample(docs, labels)
        assert len(texts) == len(order) - 1 and set(marks) == {0, 1}
        assert sum(map(len, texts)) <= 20_000
        found = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
        assert len(set(found.values())) > 1


def test_a_repeated_doc_id_brings_only_the_texts_that_fit(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 20_000)
    docs, labels = _tables(spark, ["good words here" if i % 2 else "BAD!! STUFF??" for i in range(20)])
    docs = docs.union(spark.createDataFrame([(1, "y" * 30_000)], docs.schema))
    assert sum(map(len, quality.sample(docs, labels)[0])) <= 20_000


def test_a_class_that_does_not_fit_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 20_000)
    docs, labels = _tables(spark, ["good" if i % 2 else "z" * 30_000 for i in range(20)])
    with pytest.raises(ValueError, match="one class"):
        quality.sample(docs, labels)
    assert quality.sample(docs.where("doc_id % 2 = 1"), labels)[1] and quality.sample(docs.limit(0), labels) == ([], [])
