"""SimHash fingerprints and links against brute force."""

import random
import re

import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from cartlake.llm import simhash
from cartlake.llm.common import land
from cartlake.llm.links import components
from cartlake.llm.queries import op13_simhash_near_dedup

DOCS = "doc_id long, text string, fp string, component_id long, seg long"


def plainly(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def roots(prints, bits):
    """Smallest member reachable over links of at most `bits` bits, for distinct prints."""
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ordered = sorted(prints)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in ordered}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé \t\n\x0b\x1c z"), max_size=60), st.integers(1, 4))
def test_fingerprint(text, k):
    assert simhash.fingerprint(text.encode(), k) == plainly(text, k)


def test_fingerprint_of_long_texts(monkeypatch):
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    rng = random.Random(5)
    text = "  ".join(rng.choice("ab cd ef gh Ij".split()) for _ in range(500))
    assert simhash.fingerprint(text.encode()) == plainly(text)


def test_rows(spark):
    rng = random.Random(1)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(3000))
    rows = [(5, None), (4, ""), (9, " \n"), (3, "one"), (2, "ONE"), (None, "one"), (8, "two words"), (None, "alone without id"), (11, "x" * 2_000_000)]
    rows += [(12, base), (20, base.replace("w17 ", "q "))] + [(30 + i, base.rsplit(" ", i + 1)[0]) for i in range(4)]
    rows += [(2, "ONE")]  # a repeated row
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fp", "component_id"]
    prints = {t: plainly(t) for _, t in rows}
    top = roots(set(prints.values()), 2)
    least = {}
    for i, t in rows:
        r = top[prints[t]]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted((str(i), prints[t], str(least[top[prints[t]]])) for i, t in rows)
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found.collect()) == want
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("crowd", [1, 64, 10**6])
def test_links_reach_all_pairs(spark, monkeypatch, crowd):
    """Crowded and sparse values give the same components, whatever is split."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(6)
    prints = {0, 2**64 - 1, 2**63, 2**31, 2**32}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):  # clouds around a centre, some in one segment only
            mask = rng.choice([2**64 - 1, 2**32 - 1, (2**32 - 1) << 32])
            x = centre
            for _ in range(rng.randrange(0, 6)):
                x ^= (1 << rng.randrange(64)) & mask
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(100)}
    classes = land(spark.createDataFrame([(signed(x),) for x in prints], "fp long"), "classes")
    found = land(simhash.near_links(classes), "links")
    assert all((r.a ^ r.b) % 2**64 and ((r.a ^ r.b) % 2**64).bit_count() <= 2 for r in found.collect())
    top = {r.node % 2**64: r.root % 2**64 for r in components(found).collect()}
    groups = {}
    for x in prints:
        groups.setdefault(top.get(x, x), set()).add(x)
    want = {}
    for x, r in roots(prints, 2).items():
        want.setdefault(r, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_crowds_stay_linear(spark):
    """Two thousand fingerprints share their first segment: no list of all their pairs is made."""
    rng = random.Random(2)
    prints = {(12345 << 32) | rng.getrandbits(32) for _ in range(2000)}
    classes = land(spark.createDataFrame([(signed(x),) for x in prints], "fp long"), "classes")
    assert simhash.near_links(classes).count() < 33 * len(prints)


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plainly(r.text) for r in rows}
    top, least = roots(set(prints.values()), 2), {}
    for i, x in sorted(prints.items()):
        least.setdefault(top[x], i)
    found = op13_simhash_near_dedup(spark, folder).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(i, f"{x:016x}", least[top[x]]) for i, x in prints.items()}
    assert len(found) == len(rows)
