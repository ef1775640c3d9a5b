"""A group of variants around the threshold: the prefix search must lose no link."""

import random

from cartlake.llm import minhash
from cartlake.llm.words import alike, exact_shingles


def _variants(n: int) -> list[str]:
    rng = random.Random(3)
    base = [f"w{i}" for i in range(140)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice([2, 5, 9, 11, 13, 15])):
            words[rng.randrange(140)] = f"x{rng.randrange(100_000)}" if rng.random() < 0.7 else rng.choice("abcdef")
        out.append(" ".join(words))
    return out


def test_group_around_the_threshold_matches_brute_force(spark):
    texts = _variants(300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2, 80).collect()}
    sets = [exact_shingles(t.encode(), 2) for t in texts]
    least = list(range(len(texts)))

    def root(x: int) -> int:
        while least[x] != x:
            x = least[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if alike(sets[a], sets[b], 80):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    assert got == {i: root(i) for i in range(len(texts))}


def test_prefix_pairs_hold_every_alike_pair_of_different_roots(spark):
    texts = _variants(120)
    given = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "node long, text binary")
    live = spark.createDataFrame([(i, i if i % 3 else 0) for i in range(len(texts))], "node long, root long")
    pairs = {(r.a, r.b) for r in minhash.prefix_pairs(given, 2, 80)(live).collect()}
    sets = [exact_shingles(t.encode(), 2) for t in texts]
    root = [i if i % 3 else 0 for i in range(len(texts))]
    must = {
        (a, b) for b in range(len(texts)) for a in range(b) if root[a] != root[b] and alike(sets[a], sets[b], 80)
    }
    assert must and must <= pairs
