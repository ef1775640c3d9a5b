"""Quality classifier: supervised subword embeddings.

Each hashed word and byte n-gram has a learned vector; a document is the average of the
vectors of its whole text, followed by a softmax. Vectors and output layer are trained with
stochastic gradient descent in numpy on the driver, on a bounded sample of labelled rows: at
most `SAMPLE_ROWS` rows and `SAMPLE_BYTES` bytes of whole texts, those with the smallest hash
of doc_id. Texts of more than a `LONG_SHARE`th of these bytes come after all others, and a text
that no longer fits is passed over for the next. For two classes the softmax depends on each feature only through the projection of
its vector on the difference of the output rows, so one number per feature is broadcast
(2^17 floats), whatever the size of the corpus.

Results for odd input: null and empty texts have no features and get the score of the bias.
Labels that are null, or contradict each other for one doc_id, are not learned from. Without
any label of both classes every score is 0.5; documents of both classes of which the sample can hold
only one are an error. Rows without doc_id are scored, never held out.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartlake.llm.common import per_batch, small_batches
from cartlake.llm.langid import remainder

BUCKETS = 1 << 17
DIMENSIONS = 16
ORDERS = (2, 3, 4)
SAMPLE_ROWS = 4_000
SAMPLE_BYTES = 12 << 20
LONG_SHARE = 16
EPOCHS = 6
RATE = 3.0
THRESHOLD = 0.7
SAME, OTHER = 0, 1  # buckets of word pairs
_SLICE = 1 << 18
_SHIFT = np.uint32(32 - 17)


def feature_slices(text: bytes):
    """Bucket numbers of the byte n-grams and words of a whole text, a slice at a time."""
    data = np.frombuffer(text, np.uint8)
    for order in ORDERS:
        for begin in range(0, len(data) - order + 1, _SLICE):
            part = data[begin : begin + _SLICE + order - 1]
            n = len(part) - order + 1
            total = np.full(n, order, np.uint32)
            for j in range(order):
                total = (total ^ part[j : j + n]) * np.uint32(0x9E3779B1)
                total ^= total >> np.uint32(15)
            yield ((total * np.uint32(0x85EBCA77)) >> _SHIFT).astype(np.intp)
    # Words, case kept: sums of byte times a power of the place in the word.
    gap = np.ones(len(data) + 2, np.int8)
    gap[1:-1] = (data == 32) | ((data - np.uint8(9)) <= 4)
    turn = np.diff(gap)
    starts, ends = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
    if len(starts):
        place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.append(np.append(0, starts), len(data))))
        worth = (data.astype(np.uint32) + 1) * _POWERS[place & 1023]
        worth[gap[1:-1] == 1] = 0
        total = np.add.reduceat(worth, starts, dtype=np.uint32)
        total ^= (ends - starts).astype(np.uint32)
        total ^= total >> np.uint32(15)
        yield ((total * np.uint32(0x85EBCA77)) >> _SHIFT).astype(np.intp)
        # The pair (word, next word) counts only by whether both are the same.
        same = int((total[1:] == total[:-1]).sum())
        yield np.repeat(np.array([SAME, OTHER]), [same, len(total) - 1 - same])


_POWERS = np.cumprod(np.full(1024, 0x01000193, np.uint32), dtype=np.uint32)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their shares."""
    if not text:
        return np.zeros(0, np.intp), np.zeros(0, np.float32)
    counts = sum(np.bincount(x, minlength=BUCKETS) for x in feature_slices(text))
    used = np.flatnonzero(counts)
    return used, (counts[used] / counts.sum()).astype(np.float32)


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> tuple[np.ndarray, float]:
    """(weight of each feature, bias) of label 1 against 0."""
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS, np.float32), 0.0
    rng = np.random.RandomState(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    known = [features(t) for t in texts]
    steps, at = EPOCHS * len(known), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(known)):
            rate = RATE * (1 - at / steps)
            at += 1
            used, share = known[i]
            hidden = share @ vectors[used] if len(used) else np.zeros(DIMENSIONS, np.float32)
            logits = output @ hidden + bias
            chance = np.exp(logits - logits.max())
            wrong = chance / chance.sum()
            wrong[labels[i]] -= 1
            if len(used):
                # The step of a feature is its share scaled by the text's number of features, bounded by one.
                push = np.minimum(1.0, share * np.sqrt(len(used)))
                vectors[used] -= rate * push[:, None] * (wrong @ output)
            output -= rate * 0.1 * np.outer(wrong, hidden)
            bias -= rate * 0.01 * wrong
    return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> tuple[list[bytes], list[int]]:
    """The bounded training sample: whole texts and their labels, learnable folds only."""
    spark = docs.sparkSession
    told = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("q"))
    told = told.where(F.col("q").isin(0, 1) & (remainder(F.col("id"), folds) != held_out))
    told = told.groupBy("id").agg(F.min("q").alias("q"), F.max("q").alias("_q")).where("q = _q")
    first = told.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("id", "q").collect()
    chosen = F.broadcast(spark.createDataFrame(first, "id long, q int"))  # SAMPLE_ROWS rows at most
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    given = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).join(chosen, "id")
    # Repeated documents could pass the bound, so rows and bytes are counted before texts are fetched.
    n = F.length("text")
    order = [n > SAMPLE_BYTES // LONG_SHARE, F.xxhash64("id"), F.col("id"), n]
    sizes = given.orderBy(*order).limit(SAMPLE_ROWS).select("id", "q", n.alias("n")).collect()
    room, kept, count = SAMPLE_BYTES, [], 0
    for (i, q, size), same in groupby(sizes):
        rows = len(list(same))
        if rows * size <= room:
            room -= rows * size
            kept.append((i, q, size))
            count += rows
    if len({q for _, q, _ in kept}) < 2:
        found = docs.select(F.col("doc_id").cast("long").alias("id")).join(told, "id").agg(F.min("q"), F.max("q")).first()
        if found[0] != found[1]:
            raise ValueError("documents of both classes are labelled, but the training sample holds one class at most")
    chosen = F.broadcast(spark.createDataFrame([(i, size) for i, _, size in kept], "_id long, _n int"))
    given = given.join(chosen, (F.col("id") == F.col("_id")) & (n == F.col("_n")), "left_semi")
    rows = given.orderBy(*order, "text").limit(count).collect()
    return [bytes(r.text) for r in rows], [r.q for r in rows]


def _score(texts: list[bytes], weights: np.ndarray, bias: float) -> list[float]:
    out = []
    for text in texts:
        total, n = 0.0, 0
        for found in feature_slices(text) if text else ():
            total += float(weights[found].sum(dtype=np.float64))
            n += len(found)
        out.append(float(1 / (1 + np.exp(-(total / max(1, n) + bias)))))
    return out


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) from docs(doc_id, text); nothing else of a row is looked at."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def work(batch):
        texts = [x or b"" for x in batch.column("text").cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(_score(texts, *sent.value), pa.float64())], ["doc_id", "score"]
        )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return given.mapInArrow(per_batch(work), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    out = score(docs, train(*sample(docs, labels)))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose score reaches the threshold."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(train(*sample(docs, labels)))
    at = docs.columns.index("text")

    def work(batch):
        texts = [x or b"" for x in batch.column(at).cast(pa.large_binary()).to_pylist()]
        good = [x >= THRESHOLD for x in _score(texts, *sent.value)]
        yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(per_batch(work), docs.schema)
