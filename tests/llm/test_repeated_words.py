"""Long texts that repeat words: every link is found, without a row for each two occurrences or each two texts of a group."""

import random

import pytest
from pyspark.sql import functions as F

from cartlake.llm import links
from cartlake.llm.common import land
from cartlake.llm.links import confirmed, edit_pairs, linked, words_alike
from cartlake.llm.words import few_edits


def rows_of(spark, texts):
    return spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "node long, text binary")


def repeating(rng: random.Random) -> list[str]:
    """Texts of runs of one word or of two in turn, moved, cut, lengthened and with other words between."""
    texts = set()
    for family in range(12):
        a, b, c = (f"r{family % 5}{x}" for x in "abc")
        base = [[a] * rng.randrange(8, 30), [b, c] * rng.randrange(0, 9), [c] * rng.randrange(0, 8)]
        for i in range(12):
            runs = [[*run, *run[: rng.randrange(3)]] for run in base]
            if i % 4 == 0:
                rng.shuffle(runs)
            words = [w for run in runs for w in run]
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = [f"new{rng.randrange(40)}"]
            texts.add(" ".join(words))
    return sorted(texts)


@pytest.mark.parametrize("percent", [67, 80, 92])
def test_repeated_word_pairs_lose_no_text(spark, percent):
    texts = repeating(random.Random(percent))
    rows = rows_of(spark, texts)
    live = rows.select("node", F.col("node").alias("root"))
    near = confirmed(edit_pairs(rows, percent)(live), rows, words_alike(percent))
    words = [t.encode().split() for t in texts]
    want = {(a, b) for b in range(len(words)) for a in range(b) if few_edits(words[a], words[b], percent)}
    assert {(r.a, r.b) for r in near.collect()} == want and len(want) > 50


def test_leaders_lose_no_component(spark, monkeypatch):
    monkeypatch.setattr(links, "MANY", 1, raising=False)
    texts = repeating(random.Random(4))
    rows = land(rows_of(spark, texts), "texts")
    members = land(rows.select(F.lit(1).cast("long").alias("bucket"), "node"), "members")
    got = linked(members, rows, words_alike(80), rounds=0, narrow=edit_pairs(rows, 80)).collect()
    words = [t.encode().split() for t in texts]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if root[a] != root[b] and few_edits(words[a], words[b], 80):
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    assert {r.node: r.root for r in got} == {i: x for i, x in enumerate(root) if root.count(x) > 1}
    assert 5 < len(set(root)) < len(texts)


def test_a_word_repeated_is_not_joined_occurrence_by_occurrence(spark):
    rows = rows_of(spark, ["x " * n for n in (1000, 1100)] + ["", "x"])
    columns = "node long, pair long, weight long, lo long, hi long, n long, reach long, w0 long, w1 long"
    listed = land(rows.mapInArrow(links._word_pairs(80), columns), "listed")
    assert {r.node: r.s for r in listed.groupBy("node").agg(F.sum("weight").alias("s")).collect()} == {0: 999, 1: 1099}
    assert listed.join(listed.select("pair"), "pair").count() < 50  # one by one: 4,401,604


def test_texts_of_one_repeated_word_are_not_compared_pair_by_pair(spark, monkeypatch):
    compared = []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(links, "confirmed", counted)
    n = 120
    texts = land(rows_of(spark, [f"a{i} b{i}" + " x" * (40 + i % 12) for i in range(n)]), "texts")
    members = land(texts.select(F.lit(1).cast("long").alias("bucket"), "node"), "members")
    roots = linked(members, texts, words_alike(80), rounds=0, narrow=edit_pairs(texts, 80)).collect()
    assert len({r.node for r in roots}) == n and {r.root for r in roots} == {0}
    assert sum(compared) < 10 * n  # all pairs: 7,140


def test_choices_among_a_repeated_word_are_joined_once(spark, monkeypatch):
    monkeypatch.setattr(links, "CROWD", 0)
    seen = []

    def landed(df, what):
        out = land(df, what)
        if what == "calm":
            seen.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(links, "land", landed)
    texts = [f"a{i}" + " x" * (12 + i % 3) for i in range(6)]
    rows = rows_of(spark, texts)
    near = confirmed(edit_pairs(rows, 80)(rows.select("node", F.col("node").alias("root"))), rows, words_alike(80))
    words = [t.encode().split() for t in texts]
    want = {(a, b) for b in range(6) for a in range(b) if few_edits(words[a], words[b], 80)}
    assert {(r.a, r.b) for r in near.collect()} == want and want
    assert len(seen) > 1 and all(n == distinct for n, distinct in seen)
