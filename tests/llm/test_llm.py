"""Operators of the training-data subpackage against brute force, round trips and planted cases."""

from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings, strategies as st

from cartlake.llm import chat, decontaminate, exact, langid, licenses, minhash, passages, pieces, quality, warc
from cartlake.llm.words import alike, exact_shingles, few_edits

DOCS = "doc_id long, text string, extra string, th string, n long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 3) for i, t in rows], DOCS)


ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "some words here"), (4, "one"), (4, "one"), (5, "x" * 50_000)]
PASSAGE = prose(99, 60)


def test_exact_groups_and_ties(spark):
    rows = docs(spark, [*ODD, (6, "one"), (None, "one"), (7, None)])
    found = {(r.doc_id, r.group_size): r for r in exact.exact_groups(rows).collect()}
    assert found[(6, 4)].kept and not found[(None, 4)].kept
    assert found[(7, 4 - 1)].kept and not found[(1, 3)].kept  # null counts as empty: 1, 2, 7
    out = exact.exact_dedup(docs(spark, [(1, "a"), (1, "a"), (2, "b")]))
    assert sorted(r.doc_id for r in out.collect()) == [1, 2]
    assert out.columns == ["doc_id", "text", "extra", "th", "n"]
    assert exact.exact_dedup(docs(spark, [])).count() == 0


@pytest.mark.parametrize("most", [0, 100])
def test_exact_checks_full_bytes(spark, monkeypatch, most):
    """With a digest that collides, texts still decide, be the hits few or many."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact, "BROADCAST_ROWS", most)
    weak = lambda text: F.encode(F.length(text).cast("string"), "utf-8")
    rows = docs(spark, [(1, "ab"), (2, "cd"), (3, "ab"), (4, "xyz")])
    found = {r.doc_id: (r.keep.doc_id, r.group_size, r.kept) for r in exact.exact_groups(rows, weak).collect()}
    assert found == {1: (3, 2, False), 3: (3, 2, True), 2: (2, 1, True), 4: (4, 1, True)}


def near_rows():
    rng = random.Random(3)
    rows = list(ODD)
    for base in range(12):
        words = prose(base, 120).split()
        for copy in range(6):
            own = list(words)
            for _ in range(rng.randrange(0, 9)):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
            rows.append((100 + base * 10 + copy, " ".join(own)))
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_match_brute_force(spark, k):
    rows = [(i, t) for i, t in near_rows() if i is not None and i != 4]
    sets = {i: exact_shingles((t or "").encode(), k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and alike(sets[x], sets[y], 80):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    found = {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in minhash.near_duplicates(docs(spark, rows), k).collect()}
    assert found == {i: (find(i), len(sets[i]), find(i) == i) for i in ids}


def test_near_dedup_odd_rows(spark):
    out = minhash.near_dedup(docs(spark, near_rows()))
    assert out.columns == ["doc_id", "text", "extra", "th", "n"]
    kept = [r.doc_id for r in out.collect()]
    assert {1, 2, 3, 5, None} <= set(kept) and len(kept) < len(near_rows())
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12))
def test_word_edits(a, b):
    want = bool(a) and bool(b) and brute_edits(a, b) <= 20 * max(len(a), len(b)) // 100
    assert few_edits(a, b, 80) == want


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=8), st.text("abc", max_size=16))
def test_edit_match(item, text):
    want = min(brute_edits(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
    assert decontaminate.edit_match(item, text)[0] == want


def test_leaks(spark):
    rng = random.Random(8)
    items = [(i, prose(1000 + i, n)) for i, n in enumerate((12, 20, 35, 60))] + [(9, None), (10, " "), (11, "Short item")]
    edited = list(items[3][1])
    for _ in range(8):
        edited[rng.randrange(len(edited))] = "q"
    rows = [
        *ODD,
        (20, prose(1, 80) + " " + items[0][1] + " " + prose(2, 50)),
        (21, items[1][1].upper().replace(" ", "\n ")),
        (22, prose(3, 31) + " " + "".join(edited)),
        (23, prose(4, 200)),
        (24, "a short item."),
        (20, items[0][1]),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.distance == 0) for r in decontaminate.leaks(docs(spark, rows), bench).collect())
    assert found == [(20, 0, True), (21, 1, True), (22, 3, False), (24, 11, True)]
    left = decontaminate.decontaminate(docs(spark, rows), bench)
    assert left.columns == ["doc_id", "text", "extra", "th", "n"] and left.count() == len(rows) - 5
    assert decontaminate.leaks(docs(spark, rows), bench.limit(0)).count() == 0


def test_repeated_passages(spark):
    rows = [*ODD]
    for i in range(8):
        rows.append((30 + i, prose(2000 + i, 70 + i) + " " + PASSAGE.replace(" ", "\n" if i % 2 else " ") + " " + prose(3000 + i, 40)))
    rows += [(50 + i, prose(4000 + i, 150)) for i in range(5)]
    found = passages.repeated_paragraphs(docs(spark, rows)).collect()
    assert {r.doc_id for r in found} == set(range(30, 38))
    assert {r.keep_doc_id for r in found} == {30} and not any(r.removed for r in found if r.doc_id == 30)
    left = {r.doc_id: r.text for r in passages.without_repeats(docs(spark, rows)).where("doc_id >= 30").collect()}
    assert left[30] == dict(rows)[30] and len(left[31].split()) < len(dict(rows)[31].split()) - 15
    assert all(left[i] == dict(rows)[i] for i in range(50, 55))
    assert passages.repeated_paragraphs(docs(spark, [])).count() == 0


def test_chat_snapshots(spark):
    turns = [
        (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),
        (4, 0, "user", None), (5, 0, "user", ""), (None, 0, "user", "z"), (7, None, None, None),
        (8, 5, "user", "a"), (8, 5000, "assistant", "b"), (9, 1, "user", "a"), (9, 2, "assistant", "b"), (9, 3, "user", "c"),
    ]
    rows = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, n long")
    assert sorted((r.conv_id or 0, r.n_turns) for r in chat.maximal(rows).collect()) == [(0, 1), (4, 1), (5, 1), (7, 1), (9, 3)]
    text = {r.conv_id: r.text for r in chat.format_chats(rows).collect()}
    assert text[9] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n" and text[7] == "<||>\n<|end|>\n"
    assert chat.format_chats(rows.limit(0)).count() == 0


def test_language(spark):
    rng = random.Random(1)
    say = {"xx": "thr ing ould wha".split(), "yy": "eau oux ette ois".split()}
    rows = [(i, " ".join(rng.choice(say[x]) for _ in range(30)), x) for i in range(120) for x in [("xx", "yy")[i % 2]]]
    rows += [(500, None, "xx"), (501, "123 !!", "xx"), (502, "", None), (None, "thr ing", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.identify(table).collect()}
    assert all(found[i].lang_pred == x and 0 <= found[i].score <= 1 for i, _, x in rows[:120])
    assert [found[i].lang_pred for i in (500, 501, 502, None)] == ["und", "und", "und", "xx"]
    assert 10 < sum(r.held_out for r in found.values()) < 80
    assert {r.lang_pred for r in langid.identify(table.where("lang = 'none'")).collect()} == set()
    assert {r.lang_pred for r in langid.identify(table.withColumn("lang", table.text.substr(1, 0).substr(5, 1))).collect()} <= {"", "und"}


def test_quality(spark):
    good = [(i, prose(i, 40)) for i in range(80)]
    bad = [(100 + i, prose(100 + i, 40).upper().replace(" ", "!! ")) for i in range(80)]
    table = docs(spark, [*good, *bad, (300, None), (301, ""), (None, "alpha1")])
    marks = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good + bad] + [(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality.classify(table, marks).collect()}
    right = sum(found[i].predicted == int(i < 100) for i, _ in good + bad if found[i].held_out)
    held = sum(found[i].held_out for i, _ in good + bad)
    assert held > 10 and right >= 0.95 * held
    assert found[300].score == found[301].score and 0 <= found[300].score <= 1
    assert quality.keep_good(table, marks).columns == table.columns
    assert {r.score for r in quality.classify(table, marks.limit(0)).collect()} == {0.5}


def test_warc(spark):
    rows = [(1, None, None), (None, "a\r\nb", "x" * 200), (3, "u", "x" * 200), (4, "u", "x" * 200), (4, "u", "é" * 90), (9, "v", "é" * 90), (5, "s", "small"), (6, "s", "small")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, header string")
    archive = warc.write(pages)
    found = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read(archive).collect()), key=repr)
    assert found == sorted(
        [(1, "response", None, 0), (0, "response", None, 200), (3, "response", None, 200), (4, "revisit", 3, 200), (4, "response", None, 180),
         (9, "revisit", 4, 180), (5, "response", None, 5), (6, "response", None, 5)], key=repr)
    record = next(bytes(r.record) for r in warc.read(archive, True).collect() if r.page_id == 4 and r.record_type == "response")
    head, _, body = record.partition(b"\r\n\r\n")
    assert body == ("é" * 90).encode() + b"\r\n\r\n" and b"Content-Length: 180" in head
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_licenses_match_brute_force(spark):
    names = dict(enumerate(licenses.TEMPLATES))
    rows = list(ODD)
    for i, (_, text) in names.items():
        words = text.split()
        rows.append((60 + i, prose(i, 37 + i) + " " + text.upper() + " " + prose(i + 50, 20)))
        if len(words) >= 12:
            rows.append((80 + i, prose(i, 11) + " " + " ".join([*words[:-1], "changed"]) + " " + prose(i, 9)))
            rows.append((100 + i, " ".join(words[: len(words) // 2])))
    rows.append((150, prose(5, 300) + " licensed released reserved"))
    found = {(r.doc_id, r.license_id) for r in licenses.scan(docs(spark, rows)).collect()}
    want = set()
    for i, text in rows:
        own = licenses.words_of(text)
        for name, template in licenses.TEMPLATES:
            t = licenses.words_of(template)
            k = min(5, len(t))
            whole = {tuple(t[j : j + k]) for j in range(len(t) - k + 1)}
            # Any stretch of the template's length lies in a window; a match found there is a match here.
            best = max((len(whole & {tuple(own[s : s + len(t)][j : j + k]) for j in range(len(t) - k + 1)}) for s in range(len(own))), default=0)
            if 100 * best >= 80 * len(whole):
                want.add((i, name))
    assert found == want and len(want) >= len(set(n for n, _ in licenses.TEMPLATES))
    none = spark.createDataFrame([(None, "x"), ("a", None)], "license_id string, text string")
    assert licenses.scan(docs(spark, rows), none).count() == 0


needs_model = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no tokenizer files")


@needs_model
def test_pieces_equal_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    vocabulary = pieces.load()
    texts = ["", " ", "   x ", "a\n\nb\t", "é日本🎉\x00", "a" * 3000, "ab" * 999 + " " * 37 + "the", "-" * 500, prose(1, 200)]
    rng = random.Random(2)
    texts += ["".join(rng.choice("aabcdeTh  \n\té中🎉.,ingou") for _ in range(rng.randrange(80))) for _ in range(800)]
    for text in texts:
        ids = vocabulary.encode(text).tolist()
        assert ids == library.encode(text), text
        assert vocabulary.decode(ids) == text
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, None, 1)], "doc_id long, text string, ids long")
    out = pieces.decode(pieces.encode(rows, vocabulary), vocabulary).collect()
    assert {r.doc_id: r.text for r in out} == {**dict(enumerate(texts)), None: None}
    assert sorted(pieces.round_trip(rows, vocabulary).collect(), key=str) == sorted(out, key=str)
    with pytest.raises(ValueError):
        vocabulary.decode([10**6])


@needs_model
def test_pieces_commit_early():
    """Long stretches are committed while they are read."""
    vocabulary = pieces.load()

    class Watched(str):
        furthest = 0

        def __getitem__(self, at):
            Watched.furthest = max(Watched.furthest, at if isinstance(at, int) else at.start or 0)
            return str.__getitem__(self, at)

    first = next(vocabulary.stream(Watched("hahaha" * 2000)))
    assert first and Watched.furthest < 600


@needs_model
def test_pipeline_stages(spark):
    """Each stage, on what the one before kept, against a plain statement of its rule."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    from cartlake.llm.common import land

    rows = spark.read.parquet(f"{folder}/documents.parquet")
    columns = rows.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in rows.collect()}
        rows = land(stage(spark, rows, folder), name)
        after = {r.doc_id: r.text for r in rows.collect()}
        assert all(before[i] == t for i, t in after.items())
        if name == "sentencepiece":
            assert set(after) == set(before) and rows.columns == ["doc_id", "ids", "text"]
            continue
        assert rows.columns == columns
        if name == "exact_dedup":
            last = {}
            for i, t in before.items():
                last[t] = max(i, last.get(t, i))
            assert set(after) == set(last.values())
        if name == "minhash_near_dedup":
            sets = {i: exact_shingles(t.encode(), 5) for i, t in before.items()}
            kept = sorted(after)
            assert not any(alike(sets[x], sets[y], 80) for x in kept for y in kept if x < y)
            assert all(any(alike(sets[g], sets[i], 80) for i in before if i != g) for g in set(before) - set(after))
        if name == "benchmark_decontamination":
            items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            dirty = {i for i, t in before.items() if any(x in decontaminate.normal(t) for x in items)}
            assert dirty <= set(before) - set(after)


def test_exact_state_of_a_folder_meets_later_batches(spark, tmp_path):
    prints, state = str(tmp_path / "prints"), str(tmp_path / "state")

    def batch(rows):
        table = spark.createDataFrame([(t.encode(), i, f"{i}-{t}") for i, t in rows], "digest binary, doc_id long, locator string")
        table.coalesce(1).write.mode("append").parquet(prints)
        stored = exact.keyed_state(spark.read.parquet(prints), state).collect()
        return {bytes(r.digest).decode(): (r.n, r.keep.doc_id) for r in stored}

    assert batch([(1, "a"), (2, "a"), (3, "b")]) == {"a": (2, 2), "b": (1, 3)}
    assert batch([(9, "b"), (4, "c")]) == {"a": (2, 2), "b": (2, 9), "c": (1, 4)}
    assert batch([]) == {"a": (2, 2), "b": (2, 9), "c": (1, 4)}
