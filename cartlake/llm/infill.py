"""Fill-in-middle transformation with Arrow compute kernels.

Each text is split into units, runs of A-Z and a-z or single other code points. A batch of
texts becomes one list array of units; flattened, every unit has the index of its text and its
ordinal there. The ordinal against the two cut points gives its role (prefix, middle, suffix).
The units of a role are filtered out, put back into one list a text and joined. All of this
runs on whole batches; nothing loops over units or texts in Python.

Cut points and form come from a digest of a seed and doc_id, so an executor that is lost and
replaced cuts every text in the same place again. `restore` rebuilds the texts from output and
form alone: a text that holds a marker stays plain, so markers in other outputs are the
operator's own.

Results for odd input: null text counts as empty and gives an empty plain output. Bytes that are
not UTF-8 count as U+FFFD. A row without doc_id is cut by the digest of the bare seed. Rows
that repeat are transformed alike, each on its own. Columns other than doc_id and text are
ignored. A table without rows gives none. A text is held whole; batches are cut at 1 MiB of text,
so memory grows with the longest text and not with the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cartlake.llm.common import CHUNK_BYTES, per_batch, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
# A unit as UTF-8 bytes. 0xFF is in no UTF-8 text, so it can mark the end of each unit.
_UNIT = rb"([A-Za-z]+|[\x00-\x7f]|[\xc0-\xf7][\x80-\xbf]*)"
_END = b"\xff"

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 that only depend on the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about CHUNK_BYTES together, one at least."""
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > CHUNK_BYTES:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(units, index of the text of each)."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT, replacement=rb"\1" + _END)
    lists = pc.split_pattern(marked, pattern=_END)
    units, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(units), 0)  # the last end mark of a text leaves an empty entry
    return units.filter(real), text.filter(real)


def _counts(text: pa.Array, rows: int) -> np.ndarray:
    return np.bincount(text.to_numpy(), minlength=rows).astype(np.int64)


def _joined(units: pa.Array, text: pa.Array, role: pa.Array, wanted: int, rows: int) -> pa.Array:
    """The units of one role, joined text by text."""
    keep = pc.equal(role, wanted)
    offsets = np.concatenate([[0], np.cumsum(_counts(text.filter(keep), rows))])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), units.filter(keep))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))


def _chars(pieces: pa.Array) -> pa.Array:
    return pc.utf8_length(pieces.cast(pa.large_string())).cast(pa.int64())


def _cut(batch: pa.RecordBatch, plain_percent: int, spm_percent: int, markers: tuple[str, str, str]) -> pa.RecordBatch:
    rows = batch.num_rows
    texts = batch.column("text").cast(pa.large_binary())
    h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
    units, text = _units(texts)
    n = _counts(text, rows)
    begins = pa.array(np.cumsum(n) - n)
    ordinal = pc.subtract(pa.array(np.arange(len(units))), begins.take(text))
    one, two = h1 % (n + 1), h2 % (n + 1)
    role = pc.add(
        pc.greater_equal(ordinal, pa.array(np.minimum(one, two)).take(text)).cast(pa.int8()),
        pc.greater_equal(ordinal, pa.array(np.maximum(one, two)).take(text)).cast(pa.int8()),
    )
    prefix, middle, suffix = (_joined(units, text, role, r, rows) for r in range(3))

    plain = pc.or_(pa.array(n == 0), pa.array(h3 % 100 >= 100 - plain_percent))
    for marker in markers:
        plain = pc.or_(plain, pc.match_substring(texts, pattern=marker.encode()))
    spm = pa.array(h4 % 100 < spm_percent)
    p, s, m, none = (pa.scalar(x.encode(), pa.large_binary()) for x in (*markers, ""))
    output = pc.if_else(
        plain,
        texts,
        pc.if_else(
            spm,
            pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
            pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none),
        ),
    )
    nothing = pa.scalar(None, pa.int64())
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id"),
            "n": pa.array(n, pa.int64()),
            "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            "prefix_chars": pc.if_else(plain, nothing, _chars(prefix)),
            "middle_chars": pc.if_else(plain, nothing, _chars(middle)),
            "output": output.cast(pa.binary()).cast(pa.string()),
        }
    )


def transform(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of docs(doc_id, text, ...).

    form is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle). markers are those of
    prefix, suffix and middle; a marker's first character may not occur again within any marker.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text"),
        *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id").cast("long"), seed), 1)],
    )

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = pc.binary_length(batch.column("text")).to_numpy()
        for i, j in _pieces(sizes):
            yield _cut(batch.slice(i, j - i), plain_percent, spm_percent, markers)

    return rows.mapInArrow(per_batch(work), SCHEMA)


def restore(rows: DataFrame, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """rows(form, output, ...) with the column `restored`: the text before the transformation."""
    any_marker = "|".join(rf"\Q{m}\E" for m in markers)
    part = F.split("output", any_marker)  # what is before the first marker, which is empty, then three pieces
    return rows.withColumn(
        "restored",
        F.when(F.col("form") == "psm", F.concat(part[1], part[3], part[2]))
        .when(F.col("form") == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(F.col("output")),
    )
