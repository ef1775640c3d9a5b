"""Fill-in-middle forms against a plain walk over the units."""

import hashlib
import re

from hypothesis import given, settings, strategies as st
import numpy as np
import pyarrow as pa

from cartlake.llm import infill

DOCS = "doc_id long, text string, n long, form string, h1 string"


def plainly(doc_id, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    draws = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    one, two = sorted(x % (len(units) + 1) for x in draws[:2])
    prefix, middle, suffix = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if not text or re.search("<[PSM]>", text) or draws[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if draws[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_odd_rows_and_round_trip(spark):
    texts = [None, "", " ", "\n\n", "word", "a<P>b", "x <M", "é ü 日本 \U0001f600!", "A-b_c\r\n\t9", "<", "z" * 300_000, "a1 " * 700_000]
    rows = [(i, t, 7, "given", "h") for i, t in enumerate(texts)] + [(3, "same row", 1, "f", "h")] * 2 + [(None, "no id here", 1, "f", "h")]
    rows += [(1000 + i, f"Text {i} has <S and P> in it, {i * 37}", 0, "f", "h") for i in range(300)]
    found = infill.restore(infill.transform(spark.createDataFrame(rows, DOCS))).collect()
    got = sorted((r.doc_id is None, r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found if r.doc_id is not None)
    want = sorted((False, i, *plainly(i, t)) for i, t, *_ in rows if i is not None)
    assert [x[:6] for x in got] == [x[:6] for x in want] and got == want
    none = [r for r in found if r.doc_id is None]
    assert [(r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in none] == [plainly(None, "no id here")]
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    by_id = {(i, t or "") for i, t, *_ in rows}
    assert all((r.doc_id, r.restored) in by_id for r in found)
    assert infill.transform(spark.createDataFrame([], DOCS)).count() == 0


def test_other_markers_and_rates(spark):
    rows = [(i, f"some text number {i} <P> goes on", 0, "f", "h") for i in range(60)]
    markers = ("[pre]", "[suf]", "[mid]")
    docs = spark.createDataFrame(rows, DOCS)
    found = infill.restore(infill.transform(docs, seed=9, plain_percent=0, spm_percent=100, markers=markers), markers).collect()
    assert {r.form for r in found} == {"spm"} and all("[suf]" in r.output for r in found)
    assert {(r.doc_id, r.restored) for r in found} == {(i, t) for i, t, *_ in rows}
    assert {r.form for r in infill.transform(docs, plain_percent=100).collect()} == {"plain"}


def test_bytes_that_are_no_text_are_replaced(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61ff6220c3' AS STRING) AS text")
    row = infill.restore(infill.transform(docs, plain_percent=0)).first()
    assert row.restored == "a�b �" and row.n == 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abZ <>PSM\n\x00"), st.characters(exclude_categories=["Cs"])), max_size=30), min_size=1, max_size=5))
def test_batches_match_the_plain_walk(texts):
    draws = [[int(hashlib.sha256(f"1:{d}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for d in range(len(texts))] for i in range(4)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": np.arange(len(texts)), "text": texts, **{f"h{i + 1}": pa.array(x, pa.int64()) for i, x in enumerate(draws)}}
    )
    out = infill._cut(batch, 10, 20, ("<P>", "<S>", "<M>")).to_pylist()
    assert [(r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out] == [plainly(i, t) for i, t in enumerate(texts)]
