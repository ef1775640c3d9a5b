"""SimHash near-dedup by multi-index hashing.

A fingerprint has a bit for each bit of the 64-bit shingle hashes: 1 if set in over half of them. Two
fingerprints link if at most BITS bits differ. Equal fingerprints are one class, so only distinct ones
are searched.

Multi-index hashing: the 64 bits are two segments. Of two fingerprints that differ in at
most two bits, either the first segments differ in at most one, or they take both
differences and the second segments are equal. So a table of first segments is searched with
a small Hamming ball around each fingerprint's own segment, a table of second segments with the
segment itself, and every match is verified on the complete distance. A pair is found from its
smaller first segment only. 32-bit segments keep entries few per value: a billion distinct
fingerprints leave a quarter of an entry for each.

Some values may be held by very many fingerprints all the same (copies that differ in one half). Above
CROWD entries a value is split: its entries are also listed by the other segment, with each of their
balls of radius one, and matches are looked up there. Every lookup then meets at most the 33
entries around one point, so a crowd of m costs about 33 m rows instead of m * m pairs, and no
link is lost: segments that differ in two bits share a point one bit from both.
Links within a crowd go to the smallest member of each such point.

Results for odd input: null, empty and blank texts have fingerprint zero and link like any other.
Texts of fewer than k words have one shingle, the whole sequence. Rows without doc_id take part; a component's
id is its smallest known doc_id, null if there is none. Rows that repeat are in one component.
Extra columns are ignored. A table without rows gives none. A text is held whole in a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cartlake.llm.common import bounded, chunked, land, per_batch, small_batches, texts_of
from cartlake.llm.links import components

SHINGLE = 3
BITS = 2  # what two segments and balls of one bit find
SEED = 42
CROWD = 64
_BLOCK = 1 << 16  # shingles whose bits are spread out at once

_BLANKS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")


def spaced(text: bytes) -> bytes:
    """The words of a text in lower case (A-Z), one space apart."""
    data = np.frombuffer(text.translate(_BLANKS), np.uint8)
    blank = data == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return data[keep].tobytes().strip(b" ")


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The fingerprint of a text, unsigned."""
    line = spaced(text)
    if not line:
        return 0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    n = len(gaps) + 2 - k
    if n <= 1:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(line)]])[k - 1 :]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        spans = zip(starts[i : min(i + _BLOCK, n)].tolist(), ends[i : i + _BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row of docs(doc_id, text, ...); fp is the signed form."""
    small_batches(docs.sparkSession)

    def work(batch: pa.RecordBatch):
        texts = texts_of(batch.column("text"))
        for i, j in chunked(texts):
            found = np.array([fingerprint(x, k) for x in texts[i:j]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(i, j - i), "fp": pa.array(found)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(per_batch(work), "doc_id long, fp long")


_LOW = 0xFFFFFFFF
_FLIPS = [1 << i for i in range(32)]


def _first(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _second(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(_LOW).cast("long"))


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= BITS


def _ball(value: Column) -> Column:
    """A segment's value and those one bit from it."""
    return F.transform(F.array(*[F.lit(m).cast("long") for m in [0, *_FLIPS]]), lambda m: value.bitwiseXOR(m))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _crowds(table: DataFrame) -> DataFrame:
    """Values of a segment table that more than CROWD fingerprints hold."""
    return land(table.groupBy("seg").agg(F.count("*").alias("c")).where(f"c > {CROWD}").select("seg"), "crowds")


def _same_value(table: DataFrame, crowds: DataFrame) -> DataFrame:
    """Links between fingerprints with equal segments: table(seg, rest, fp)."""
    few = table.join(bounded(crowds), "seg", "left_anti")
    other = few.select("seg", F.col("fp").alias("_fp"))
    pairs = few.join(other, "seg").where((F.col("fp") < F.col("_fp")) & _near("fp", "_fp"))
    many = table.join(bounded(crowds), "seg", "left_semi")
    # Members around one point are at most two bits apart. Stars around the points reach all links.
    points = many.select("seg", "fp", F.explode(_ball(F.col("rest"))).alias("point"))
    heads = land(points.groupBy("seg", "point").agg(F.min("fp").alias("_fp"), F.count("*").alias("c")).where("c > 1"), "points")
    stars = points.join(heads, ["seg", "point"]).where((F.col("fp") != F.col("_fp")) & _near("fp", "_fp"))
    return pairs.select(*_pair("fp", "_fp")).unionByName(stars.select(*_pair("fp", "_fp")))


def _next_values(table: DataFrame, crowds: DataFrame) -> DataFrame:
    """Links between fingerprints whose segments differ in one bit."""
    # From the value without the bit to the one with it: each pair is met once.
    unset = F.filter(F.array(*[F.lit(m).cast("long") for m in _FLIPS]), lambda m: F.col("seg").bitwiseAND(m) == 0)
    probes = table.select(
        F.explode(F.transform(unset, lambda m: F.col("seg") + m)).alias("seg"), F.col("rest").alias("_rest"), F.col("fp").alias("_fp")
    )
    few = table.join(bounded(crowds), "seg", "left_anti")
    pairs = probes.join(few, "seg").where(_near("fp", "_fp"))
    many = table.join(bounded(crowds), "seg", "left_semi")
    listed = many.select("seg", "fp", F.explode(_ball(F.col("rest"))).alias("_rest"))
    asked = probes.join(bounded(crowds), "seg", "left_semi")
    split = asked.join(listed, ["seg", "_rest"]).where(_near("fp", "_fp"))
    return pairs.select(*_pair("fp", "_fp")).unionByName(split.select(*_pair("fp", "_fp")))


def near_links(classes: DataFrame) -> DataFrame:
    """(a, b) links of landed distinct fingerprints classes(fp) that connect all pairs of at most BITS bits."""
    fp = F.col("fp")
    first = classes.select(_first(fp).alias("seg"), _second(fp).alias("rest"), "fp")
    second = classes.select(_second(fp).alias("seg"), _first(fp).alias("rest"), "fp")
    crowds = _crowds(first)
    found = _same_value(first, crowds).unionByName(_same_value(second, _crowds(second)))
    return found.unionByName(_next_values(first, crowds))


def near_duplicates(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs(doc_id, text, ...)."""
    sketch = land(fingerprints(docs, k), "fingerprints")
    classes = land(sketch.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "classes")
    found = land(near_links(classes.select("fp")).distinct(), "links")
    roots = components(found)
    heads = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    heads = land(heads.withColumn("root", F.coalesce("root", "fp")), "heads")
    least = land(heads.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    named = land(heads.join(bounded(least), "root").select("fp", "component_id"), "named")
    return sketch.join(bounded(named), "fp").select("doc_id", "fp", "component_id")
