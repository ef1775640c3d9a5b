"""Substring dedup: MinHash banding over content-defined paragraphs.

Passages are copied into the middle of lines, so line breaks do not delimit them. A text's word
sequence is cut into paragraphs where the hash of two neighbouring words is the smallest within
`REACH` words on both sides. Inside a repeated passage the cuts fall on the same words whatever
surrounds it; paragraphs have 7 words at least, 13 on average. A passage is found by the whole
paragraphs in it: the words at its edges stay, and a passage without a run of `MIN_WORDS` words in
whole paragraphs is not found.

Paragraphs of equal words are one class. Classes that share a MinHash band over five-word
shingles (three bands of one value: over 99 of 100 pairs of shingle similarity 0.8 meet, but an
edit in a paragraph of 13 words leaves less, so many edited variants never meet) are compared
with a leader, confirmed by their exact word edit distance (20 % of the longer at most), and
joined to components. In each
component the first paragraph stays and the others go, if they are part of a run of at least
`MIN_WORDS` repeated words of their document.

Results for odd input: null, empty and blank texts have no paragraphs; case and the kind of
white space do not matter. Rows without doc_id take part. Rows that repeat a doc_id are told
apart by their text; rows equal in both are one document. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartlake.llm.common import bounded, chunked, land, per_batch, small_batches, text_hash, texts_of
from cartlake.llm.links import edit_pairs, linked, shared_buckets, words_alike
from cartlake.llm.words import document_words, mix, shingle_hashes, span_hashes

REACH = 6
SHINGLE = 5
PERCENT = 80
BANDS = 3
MIN_WORDS = 15
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_SALTS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def cuts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Word numbers at which paragraphs begin, the first word of every non-empty text included."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    pairs = np.full(n, _TOP)
    pairs[:-1] = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    first = bounds[:-1][np.diff(bounds) > 0]
    pairs[np.append(first[1:], n) - 1] = _TOP  # the last word of a text has no neighbour
    # Texts are set apart so that none is seen by the next.
    shift = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * REACH + REACH
    place = np.arange(n) + shift
    line = np.full(place[-1] + REACH + 1, _TOP)
    line[place] = pairs
    lowest = np.ones(n, bool)
    for d in range(1, REACH + 1):
        lowest &= pairs < line[place - d]
        lowest &= pairs <= line[place + d]
    lowest[first] = True
    return np.flatnonzero(lowest)


def _paragraphs(with_text: bool):
    def work(batch: pa.RecordBatch):
        texts = texts_of(batch.column("text"))
        for i, j in chunked(texts):
            hashes, bounds, starts, ends, offsets = document_words(texts[i:j])
            begin = cuts(hashes, bounds)
            if not len(begin):
                continue
            end = np.append(begin[1:], len(hashes))
            doc = np.searchsorted(bounds, begin, "right") - 1
            size = end - begin
            k1 = span_hashes(hashes, begin, end)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(doc + i)),
                "th": batch.column("th").take(pa.array(doc + i)),
                "word": pa.array(begin - bounds[doc], pa.int64()),
                "words": pa.array(size, pa.int64()),
                "k1": pa.array(k1.view(np.int64)),
                "k2": pa.array(span_hashes(hashes, begin, end, second=True).view(np.int64)),
            }
            if with_text:
                data = b"\n".join(texts[i:j])
                columns = {x: columns[x] for x in ("k1", "k2")}
                columns["text"] = pa.array([data[a:b] for a, b in zip(starts[begin], ends[end - 1])], pa.binary())
            else:
                shingles = np.full(len(hashes), _TOP)
                own = shingle_hashes(hashes, SHINGLE)
                shingles[: len(own)] = own
                inside = np.arange(len(hashes)) + SHINGLE <= np.repeat(end, size)
                for band, salt in enumerate(_SALTS):
                    image = np.where(inside, mix(shingles ^ salt), _TOP)
                    low = np.minimum.reduceat(image, begin)
                    low = np.where(size < SHINGLE, k1, low)
                    columns[f"b{band}"] = pa.array(mix(low * np.uint64(BANDS) + np.uint64(band)).view(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    return per_batch(work)


_PLACE = "doc_id long, th long, word long, words long, k1 long, k2 long"


def repeated_paragraphs(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, word, words, cluster, keep_doc_id, keep_word, removed) of paragraphs that recur.

    `word` counts the document's words from 0; `cluster` names the component.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("th"), "text")
    bands = [f"b{i}" for i in range(BANDS)]
    units = given.mapInArrow(_paragraphs(False), f"{_PLACE}, " + ", ".join(f"{b} long" for b in bands))

    same = units.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    same = land(same, "same")
    rows = units.select(F.explode(F.array(*bands)).alias("bucket"), F.col("k1").alias("node"))
    members = shared_buckets(rows)
    needed = land(members.select(F.col("node").alias("k1")).distinct(), "needed")
    texts = given.mapInArrow(_paragraphs(True), "k1 long, k2 long, text binary")
    texts = texts.join(bounded(needed), "k1", "left_semi").groupBy("k1").agg(F.min("text").alias("text"))
    texts = land(texts.select(F.col("k1").alias("node"), "text"), "texts")
    roots = linked(members, texts, words_alike(percent), narrow=edit_pairs(texts, percent))

    # Classes that recur, alone or through links, with the component each belongs to.
    known = same.select("k1").union(roots.select("node")).distinct()
    known = known.join(roots.withColumnRenamed("node", "k1"), "k1", "left")
    known = land(known.select("k1", F.coalesce("root", "k1").alias("cluster")), "known")
    found = units.select("doc_id", "th", "word", "words", "k1").join(bounded(known), "k1")
    found = land(found.dropDuplicates(["doc_id", "th", "word"]), "found")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "word")
    heads = found.groupBy("cluster").agg(F.min(place).alias("f"), F.count("*").alias("copies")).where("copies > 1")
    heads = heads.select("cluster", F.col("f.doc_id").alias("keep_doc_id"), F.col("f.th").alias("_th"), F.col("f.word").alias("keep_word"))
    heads = land(heads, "heads")  # landed, so that a cluster of many copies is split in the join
    found = found.join(heads, "cluster")
    # Runs of paragraphs that follow each other without a gap; a document's paragraphs come from one row.
    order = Window.partitionBy("doc_id", "th").orderBy("word")
    gap = F.coalesce((F.lag(F.col("word") + F.col("words")).over(order) != F.col("word")).cast("int"), F.lit(1))
    found = found.withColumn("_run", F.sum(gap).over(order))
    total = F.sum("words").over(Window.partitionBy("doc_id", "th", "_run"))
    other = ~(F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("th") == F.col("_th")) & (F.col("word") == F.col("keep_word")))
    found = found.withColumn("_long", total >= min_words).where("_long")
    return found.select(
        "doc_id", F.col("th").alias("text_hash"), "word", "words", "cluster", "keep_doc_id", "keep_word", other.alias("removed")
    )


def _cut(batch: pa.RecordBatch):
    texts = texts_of(batch.column("text"))
    out = []
    column = batch.column("text").is_valid().to_pylist()
    for text, known, gone in zip(texts, column, batch.column("_gone").to_pylist()):
        if not gone:
            out.append(text if known else None)
            continue
        _, _, starts, ends, _ = document_words([text])
        keep, at = [], 0
        for word, words in sorted((g["word"], g["words"]) for g in gone):
            keep.append(text[at : starts[word]])
            at = starts[word + words] if word + words < len(starts) else len(text)
        out.append(b"".join([*keep, text[at:]]))
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "text"]
    )


def without_repeats(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text): every document with its removed paragraphs cut out."""
    gone = repeated_paragraphs(docs, percent, min_words).where("removed")
    spans = gone.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("word", "words")).alias("_gone"))
    spans = land(spans, "spans")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    same = given["doc_id"].eqNullSafe(spans["doc_id"]) & (text_hash(given["text"]) == spans["text_hash"])
    rows = given.join(spans, same, "left").select(given["doc_id"], given["text"], spans["_gone"])
    return rows.mapInArrow(per_batch(_cut), "doc_id long, text binary").withColumn("text", F.decode("text", "utf-8"))
