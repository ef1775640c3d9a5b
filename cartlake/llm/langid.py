"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting runs inside the tasks, one table of `BUCKETS` counts per language and partition, and
combines in Spark. The log-probability matrix (BUCKETS x languages, a size fixed by two
parameters) is the only thing that is collected and broadcast. Texts are read whole, in slices
of bounded size.

Results for odd input: null texts and texts without a letter are `und` with score 0, and so is
everything when nothing could be learned. Ties go to the language that sorts first. Rows
without doc_id are scored, but neither learned from nor held out. Repeated rows count as often
as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartlake.llm.common import per_batch, small_batches

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MOST_LANGS = 500
SMOOTHING = 0.5
_CELLS = 1 << 21
_SLICE = 1 << 18
UNKNOWN = "und"


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text; empty when it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return np.zeros(0, np.uint32)
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def gram_slices(points: np.ndarray):
    """Bucket numbers of all n-grams, a slice of the text at a time."""
    for order in ORDERS:
        for begin in range(0, len(points) - order + 1, _SLICE):
            part = points[begin : begin + _SLICE + order - 1]
            n = len(part) - order + 1
            total = np.full(n, order, np.uint32)
            for j in range(order):
                total = (total ^ part[j : j + n]) * np.uint32(0x9E3779B1)
                total ^= total >> np.uint32(15)
            total *= np.uint32(0x85EBCA77)
            yield (total >> np.uint32(32 - 15)).astype(np.intp) & (BUCKETS - 1)


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            points = letters(text)
            if not len(points):
                continue
            if lang not in totals:
                if len(totals) >= MOST_LANGS:
                    raise ValueError(f"more than {MOST_LANGS} languages to learn")
                totals[lang], docs[lang] = np.zeros(BUCKETS, np.int64), 0
            docs[lang] += 1
            for grams in gram_slices(points):
                totals[lang] += np.bincount(grams, minlength=BUCKETS)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (len(used) + 1), pa.string()),
                pa.array(np.append(used, -1), pa.int32()),
                pa.array(np.append(counts[used], docs[lang]), pa.int64()),
            ],
            ["lang", "bucket", "n"],
        )


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log probabilities by bucket and language) from rows(text, lang)."""
    small_batches(rows.sparkSession)
    counted = rows.select("text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    counted = counted.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    if len(langs) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages to learn")
    number = {x: i for i, x in enumerate(langs)}
    column = np.array([number[x] for x in table.column("lang").to_pylist()], np.intp)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts, prior = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    gram = bucket >= 0
    counts[bucket[gram], column[gram]] = n[gram]
    prior[column[~gram]] = n[~gram]
    chance = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)) if langs else counts
    return langs, np.log(prior / prior.sum()) if langs else prior, chance


def _scores(texts, langs, prior, chance):
    """(language, probability) of each text."""
    step = max(1, _CELLS // max(1, len(langs)))
    for text in texts:
        points = letters(text)
        if not len(points) or not langs:
            yield UNKNOWN, 0.0
            continue
        total = prior.copy()
        for grams in gram_slices(points):
            for i in range(0, len(grams), step):
                total += chance[grams[i : i + step]].sum(axis=0)
        best = int(total.argmax())
        yield langs[best], float(1.0 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) from docs(doc_id, text); nothing else of a row is looked at."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def work(batch):
        pairs = list(_scores(batch.column("text").to_pylist(), *sent.value))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([x for x, _ in pairs], pa.string()), pa.array([x for _, x in pairs], pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return given.mapInArrow(per_batch(work), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learns from the folds that are not held out, predicts all."""
    fold = remainder(F.col("doc_id"), folds)
    out = predict(docs, learn(docs.where(fold != held_out)))
    return out.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
