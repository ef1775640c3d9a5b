"""Crowded buckets of the edit distance search: every link is found, without a row for each pair of a group."""

import random

from pyspark.sql import functions as F

from cartlake.llm import links
from cartlake.llm.common import land
from cartlake.llm.links import confirmed, edit_pairs, linked, words_alike
from cartlake.llm.words import few_edits


def rows_of(spark, texts):
    return spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "node long, text binary")


def test_splitting_loses_no_pair(spark, monkeypatch):
    monkeypatch.setattr(links, "CROWD", 0, raising=False)
    rng = random.Random(8)
    phrase = [f"p{i}" for i in range(9)]
    texts = {" ".join([f"h{rng.randrange(9)}" for _ in range(rng.randrange(0, 7))] + phrase) for _ in range(90)}
    texts |= {" ".join(phrase[:i] + ["the"] * rng.randrange(2, 5) + phrase[i:]) for i in range(9)}
    texts = sorted(texts)
    rows = rows_of(spark, texts)
    live = rows.select("node", F.col("node").alias("root"))
    near = confirmed(edit_pairs(rows, 80)(live), rows, words_alike(80))
    words = [t.encode().split() for t in texts]
    want = {(a, b) for b in range(len(words)) for a in range(b) if few_edits(words[a], words[b], 80)}
    assert {(r.a, r.b) for r in near.collect()} == want and len(want) > 100


def test_a_group_of_variants_is_not_compared_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(links, "CROWD", 1, raising=False)
    compared = []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(links, "confirmed", counted)
    n = 120
    # Two words before a common phrase: any two variants are within the distance.
    texts = land(rows_of(spark, [f"a{i} b{i} p q r s t u v w x" for i in range(n)]), "texts")
    members = land(texts.select(F.lit(1).cast("long").alias("bucket"), "node"), "members")
    roots = linked(members, texts, words_alike(80), rounds=0, narrow=edit_pairs(texts, 80)).collect()
    assert len({r.node for r in roots}) == n and {r.root for r in roots} == {0}
    assert sum(compared) < 20 * n  # all pairs: 7,140
