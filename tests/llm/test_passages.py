"""Substring dedup against all pairs of paragraphs compared one by one."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlake.llm import passages
from cartlake.llm.links import confirmed, edit_pairs, words_alike
from cartlake.llm.words import document_words, few_edits, split_words

DOCS = "doc_id long, text string, extra string, th string, n long"


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    out = list(words)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        out[at : at + (kind > 0)] = [f"new{rng.randrange(10**6)}"] if kind < 2 else []
    return out


@pytest.mark.parametrize("percent", [67, 75, 80, 90])
def test_narrowing_keeps_every_pair_within_the_distance(spark, percent):
    rng = random.Random(percent)
    texts = []
    for family in range(30):
        # Few words, so that word pairs recur within a text and between families.
        base = [f"w{rng.randrange(12 if family % 2 else 60)}" for _ in range(rng.randrange(1, 32))]
        texts += [edited(rng, base, rng.randrange(0, len(base) * 2 // 5 + 1)) for _ in range(7)]
    texts = [list(t) for t in dict.fromkeys(tuple(t) for t in texts if t)]
    rows = spark.createDataFrame([(i, bytearray(" ".join(t).encode())) for i, t in enumerate(texts)], "node long, text binary")
    live = rows.select("node", F.col("node").alias("root"))
    near = confirmed(edit_pairs(rows, percent)(live), rows, words_alike(percent))
    words = [[w.encode() for w in t] for t in texts]
    want = {(a, b) for b in range(len(words)) for a in range(b) if few_edits(words[a], words[b], percent)}
    assert {(r.a, r.b) for r in near.collect()} == want and len(want) > 10


def test_narrowing_skips_pairs_of_one_component(spark):
    rows = spark.createDataFrame([(i, bytearray(f"a b c d e f g h {i}".encode())) for i in range(6)], "node long, text binary")
    live = rows.select("node", (F.col("node") % 2).alias("root"))
    got = {(r.a, r.b) for r in edit_pairs(rows, 80)(live).collect()}
    assert got == {(a, b) for b in range(6) for a in range(b) if (b - a) % 2}
    with pytest.raises(ValueError):
        edit_pairs(rows, 60)


def brute_force(rows: list[tuple[int, str]]) -> dict[tuple[int, int], tuple[int, int]]:
    """(doc, word) of every reported paragraph to the (doc, word) that stays, from all pairs."""
    units = []
    for doc, text in dict.fromkeys(rows):
        hashes, bounds, *_ = document_words([text.encode()])
        begin = passages.cuts(hashes, bounds)
        words = split_words(text.encode())
        units += [(doc, int(a), words[a:b]) for a, b in zip(begin, np.append(begin[1:], len(hashes)))]
    root = list(range(len(units)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(units)):
        for a in range(b):
            if units[a][2] == units[b][2] or few_edits(units[a][2], units[b][2], passages.PERCENT):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    groups: dict[int, list[int]] = {}
    for x in range(len(units)):
        groups.setdefault(find(x), []).append(x)
    keep = {x: min(units[y][:2] for y in group) for group in groups.values() if len(group) > 1 for x in group}
    out: dict[tuple[int, int], tuple[int, int]] = {}
    run: list[int] = []
    for x in [*sorted(keep, key=lambda x: units[x][:2]), None]:
        if run and (x is None or units[x][0] != units[run[-1]][0] or units[run[-1]][1] + len(units[run[-1]][2]) != units[x][1]):
            if sum(len(units[y][2]) for y in run) >= passages.MIN_WORDS:
                out |= {units[y][:2]: keep[y] for y in run}
            run = []
        run.append(x)
    return out


def test_passages_equal_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(900)]
    passage = [[rng.choice(vocabulary) for _ in range(n)] for n in (50, 60, 90)]
    rows = []
    for i in range(60):
        middle = passage[i % 3] if i % 4 else edited(rng, passage[i % 3], 1)
        around = [[rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))] for _ in range(2)]
        rows.append((i, " ".join(around[0] + middle + around[1])))
    rows += [rows[7], rows[7], (70, "")]  # rows equal in id and text are one document
    given = spark.createDataFrame([(i, t, "x", "y", 3) for i, t in rows], DOCS)
    found = passages.repeated_paragraphs(given).collect()
    got = {(r.doc_id, r.word): (r.keep_doc_id, r.keep_word) for r in found}
    assert len(got) == len(found)
    want = brute_force(rows[:-1])
    # Banding may miss a variant; what repeats word for word is never missed, and nothing else is reported.
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want)
    assert all(r.removed == ((r.doc_id, r.word) != (r.keep_doc_id, r.keep_word)) for r in found)
    assert len({r.doc_id for r in found}) == 60


def test_a_row_given_twice_is_no_repetition(spark):
    text = " ".join(f"only{i}" for i in range(80))
    given = spark.createDataFrame([(1, text, "x", "y", 3)] * 3 + [(None, text + " more", "x", "y", 3)] * 2, DOCS)
    found = passages.repeated_paragraphs(given).collect()
    assert {r.doc_id for r in found} == {1, None} and len(found) == len({(r.doc_id, r.word) for r in found})
    assert all(r.keep_doc_id == 1 and r.removed == (r.doc_id is None) for r in found)
    assert passages.repeated_paragraphs(given.where("doc_id = 1")).count() == 0
