"""MinHash near-dedup by min-max hashing.

Each permutation is evaluated once per shingle and gives two signature values, the smallest
and the largest image. A band joins four permutations (eight values); 64 bands miss a pair
of similarity 0.8 with a chance below 1e-5, while unrelated texts rarely share a band.
Candidates are confirmed on their full shingle sets. Buckets that leaders cannot resolve are
searched by an exact prefix filter, so a group whose members differ by just too much is not
compared pair by pair.

Results for odd input: null, empty and blank texts have no shingles, are linked with nothing
and are kept. Texts of fewer than k words have one shingle, the whole sequence. Rows without
doc_id take part; a component's id is its smallest known doc_id, null if there is none. Of
rows that tie on the smallest doc_id, the one with the smallest text hash stays; rows equal in
doc_id and text stay or go together (run exact dedup before). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartlake.llm.common import bounded, chunked, land, per_batch, small_batches, text_hash, texts_of
from cartlake.llm.links import linked, shared_buckets, shingles_alike
from cartlake.llm.words import document_words, mix, shingle_hashes, shingle_set

SHINGLE = 5
PERCENT = 80
BANDS = 64
PERMS_PER_BAND = 4  # each gives a minimum and a maximum

_perms = np.random.RandomState(20240117).randint(0, 1 << 32, size=(2, BANDS * PERMS_PER_BAND), dtype=np.uint64)
_TIMES, _PLUS = (_perms[0] | np.uint64(1)).astype(np.uint32), _perms[1].astype(np.uint32)
_BLOCK = 2048


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """The band hashes of a set of 64-bit shingle hashes."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(len(_TIMES), 0xFFFFFFFF, np.uint32), np.zeros(len(_TIMES), np.uint32)
    for i in range(0, len(values), _BLOCK):
        images = values[i : i + _BLOCK, None] * _TIMES + _PLUS
        np.minimum(low, images.min(axis=0), out=low)
        np.maximum(high, images.max(axis=0), out=high)
    both = np.stack([low, high], axis=1).astype(np.uint64).reshape(BANDS, 2 * PERMS_PER_BAND)
    total = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for j in range(both.shape[1]):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + both[:, j])
    return total


def _sketcher(k: int, banded: bool):
    def work(batch: pa.RecordBatch):
        texts = texts_of(batch.column("text"))
        for i, j in chunked(texts):
            hashes, bounds, *_ = document_words(texts[i:j])
            shingles = shingle_hashes(hashes, k)
            n, one, two, bands = [], [], [], []
            for d in range(j - i):
                own = shingle_set(hashes, shingles, bounds[d], bounds[d + 1], k)
                n.append(len(own))
                one.append(int(own.sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(mix(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64).astype(np.int64)))
                if banded:
                    bands.append(bands_of(own).view(np.int64) if len(own) else None)
            columns = {x: batch.column(x).slice(i, j - i) for x in batch.schema.names if x != "text"}
            columns |= {"n": pa.array(n, pa.int64()), "k1": pa.array(one, pa.int64()), "k2": pa.array(two, pa.int64())}
            if banded:
                columns["bands"] = pa.array(bands, pa.list_(pa.int64()))
            else:
                columns["text"] = pa.array(texts[i:j], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return per_batch(work)


def _listed(k: int):
    """Turns (node, text) into one row per distinct shingle, with the size of its set."""

    def work(batch: pa.RecordBatch):
        texts, nodes = texts_of(batch.column("text")), batch.column("node").to_numpy(zero_copy_only=False)
        for i, j in chunked(texts):
            hashes, bounds, *_ = document_words(texts[i:j])
            shingles = shingle_hashes(hashes, k)
            sets = [shingle_set(hashes, shingles, bounds[d], bounds[d + 1], k) for d in range(j - i)]
            sizes = np.array([len(x) for x in sets], np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array(np.repeat(nodes[i:j], sizes)),
                    "shingle": pa.array(np.concatenate(sets).view(np.int64)),
                    "n": pa.array(np.repeat(sizes, sizes)),
                }
            )

    return per_batch(work)


def prefix_pairs(texts: DataFrame, k: int, percent: int):
    """For `linked`: all pairs of different roots that can be alike, found without comparing the rest.

    Shingles are put in one order, rarest first. Two sets that are alike share so many that the
    first one they share leaves enough places behind it in both; it lies among the first
    (100 - percent) % of each. Sets join on such shingles only, and members of the root that
    holds most of a shingle are not joined with each other.
    """

    def pairs(live: DataFrame, settle: Callable | None = None) -> DataFrame:
        listed = texts.join(live.select("node"), "node", "left_semi")
        listed = land(listed.mapInArrow(_listed(k), "node long, shingle long, n long"), "listed")
        often = listed.groupBy("shingle").agg(F.count("*").alias("often"))
        place = F.row_number().over(Window.partitionBy("node").orderBy("often", "shingle"))
        first = listed.join(often, "shingle").withColumn("place", place)
        first = first.where(F.expr(f"place <= n - ({percent} * n + 99) div 100 + 1"))
        first = land(first.join(live, "node").select("node", "root", "n", "place", "shingle"), "prefixes")
        held = first.groupBy("shingle", "root").agg(F.count("*").alias("c"))
        main = held.groupBy("shingle").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"))
        first = land(first.join(main.where("roots > 1").select("shingle", "main"), "shingle"), "shared")
        odd = first.where("root <> main").select(
            "shingle", F.col("node").alias("_node"), F.col("root").alias("_root"), F.col("n").alias("_n"), F.col("place").alias("_place")
        )
        both = first.join(odd, "shingle").where("root <> _root").withColumn(
            "need", F.expr(f"({percent} * (n + _n) + {99 + percent}) div {100 + percent}")
        )
        both = both.where("n - place + 1 >= need and _n - _place + 1 >= need")
        return both.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()

    return pairs


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of docs(doc_id, text, ...)."""
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("th"), "text")
    sketch = land(
        given.mapInArrow(_sketcher(k, True), "doc_id long, th long, n long, k1 long, k2 long, bands array<long>")
        .withColumn("row", F.monotonically_increasing_id()),
        "sketch",
    )
    some = sketch.where("n > 0")
    # Equal sets are one class; its row with the smallest doc_id stands for it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "row")).alias("f")
    classes = land(
        some.groupBy("k1", "k2").agg(first).select("k1", "k2", "f.doc_id", "f.th", F.col("f.row").alias("node")), "classes"
    )
    chosen = some.select("row", "bands").join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    members = shared_buckets(chosen.select(F.explode("bands").alias("bucket"), F.col("row").alias("node")))
    # Texts of the classes that share a bucket: found by doc_id, then matched by their sets.
    needed = land(classes.join(members.select("node").distinct(), "node", "left_semi"), "needed")
    ids = bounded(needed.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")))
    found = given.join(ids, given.doc_id.eqNullSafe(F.col("_id")) & (given.th == F.col("_th")), "left_semi")
    found = found.mapInArrow(_sketcher(k, False), "doc_id long, th long, n long, k1 long, k2 long, text binary")
    texts = found.join(bounded(needed.select("k1", "k2", "node")), ["k1", "k2"]).select("node", "text")
    texts = land(texts.dropDuplicates(["node"]), "texts")
    roots = linked(members, texts, shingles_alike(k, percent), narrow=prefix_pairs(texts, k, percent))

    best = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("f")
    heads = best.groupBy("root").agg(head).select("root", F.col("f.doc_id").alias("component_id"), F.col("f.th").alias("_th"))
    best = best.join(heads, "root").select("k1", "k2", "component_id", "_th")
    linked_rows = some.select("doc_id", "th", "n", "k1", "k2").join(best, ["k1", "k2"])
    out = ["doc_id", F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), "component_id"]
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("_th"))
    alone = sketch.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return linked_rows.select(*out, kept.alias("kept")).unionByName(alone.select(*out, F.lit(True).alias("kept")))


def near_dedup(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns, of which one document of each group stays."""
    gone = land(near_duplicates(docs, k, percent).where("not kept").select("doc_id", "text_hash").distinct(), "gone")
    gone = bounded(gone)
    same = docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (text_hash(docs["text"]) == gone["text_hash"])
    return docs.join(gone, same, "left_anti")
