"""Exact dedup as a stream over keyed state that never expires.

Rows stream through a stateful aggregation keyed by the text's digest. Its state lives in
RocksDB on the executors' disks with checkpoints in the shared folder, holds one entry per
distinct text (digest, stable identifier and content locator of the row that stays, count)
and is read back as a table. Digest hits are then checked on their full bytes; other texts
are not shuffled while the hits are few enough to be broadcast.
`keyed_state` goes on with the state of a given folder, so that later batches meet the digests of
earlier ones. All steps are built-in functions; equal digests combine before every shuffle, so one
text may fill any share of the rows.

Results for odd input: a null text counts as empty. Rows without doc_id take part; the row
with the largest doc_id stays, one without only if none has any. Rows that repeat a doc_id
within equal texts are told apart by their locator; one of them stays. An empty table gives
no rows. Further columns are carried by `exact_dedup` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartlake.llm.common import BROADCAST_ROWS, land, scratch

ID, DIGEST = "__cartlake_id", "__cartlake_digest"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def keyed_state(prints: DataFrame, folder: str | None = None, files_per_batch: int = 10_000) -> DataFrame:
    """(digest, n, keep) after streaming landed fingerprints (digest, doc_id, locator) through keyed state.

    `keep` is the struct (doc_id, locator) of the row that stays. The stream ends when all files
    are read; started again on the same state folder, it goes on with the files that are new. Without a
    folder the state is new.
    """
    spark = prints.sparkSession
    folder = folder or scratch(spark, "exact-state")
    source = {f.rpartition("/")[0] for f in prints.inputFiles()}
    if not source:
        keep = "struct<doc_id: bigint, locator: string>"
        return prints.select("digest").limit(0).selectExpr("digest", "0L AS n", f"CAST(NULL AS {keep}) AS keep")
    (path,) = source
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Many small stores must not preallocate log files of megabytes each.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    stream = spark.readStream.schema(prints.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    state = stream.groupBy("digest").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "locator")).alias("keep")
    )
    query = (
        state.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = spark.read.format("statestore").load(folder)
    value = [f.name for f in stored.schema["value"].dataType.fields]
    return stored.select(
        F.col("key.digest").alias("digest"), F.col("value")[value[0]].alias("n"), F.col("value")[value[1]].alias("keep")
    )


def exact_groups(docs: DataFrame, digest=sha256) -> DataFrame:
    """(digest, doc_id, locator, keep, group_size, kept) for every row of docs(doc_id, text, ...).

    `digest` makes a binary key of a text column. Equal digests of different texts are found
    by the byte check and told apart by the texts themselves.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    locator = F.format_string("%d", F.monotonically_increasing_id())
    prints = land(rows.select("digest", "doc_id", locator.alias("locator")), "prints")
    state = land(keyed_state(prints), "state")

    # Full bytes of the hits: within a digest all texts are equal if the smallest is the largest.
    hits = land(state.where("n > 1").select("digest"), "hits")
    # Few hits go to the texts. Otherwise all texts are aggregated, so that copies combine before the shuffle.
    few = hits.count() <= BROADCAST_ROWS
    ends = rows.join(F.broadcast(hits), "digest", "left_semi") if few else rows
    ends = ends.groupBy("digest").agg(F.min("text").alias("_lo"), F.max("text").alias("_hi"))
    clash = land(ends.where("_lo <> _hi").select("digest"), "clash")
    out = ["digest", "doc_id", "locator", "keep", "group_size", "kept"]
    if clash.isEmpty():
        sure = prints.join(state, "digest")
    else:
        sure = prints.join(state, "digest").join(clash, "digest", "left_anti")
    sure = sure.withColumn("group_size", F.col("n")).withColumn("kept", F.col("locator") == F.col("keep.locator"))
    if clash.isEmpty():
        return sure.select(*out)
    told = rows.select("digest", "text", "doc_id", locator.alias("locator")).join(clash, "digest", "left_semi")
    told = land(told, "told")
    by_text = told.groupBy("text").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "locator")).alias("keep"))
    told = told.join(by_text, "text").withColumn("group_size", F.col("n"))
    return sure.select(*out).unionByName(
        told.withColumn("kept", F.col("locator") == F.col("keep.locator")).select(*out)
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, of which one of each group of equal texts stays."""
    groups = exact_groups(docs)
    keep = land(groups.where("kept").select(F.col("keep.doc_id").alias("doc_id"), "digest"), "keep")
    found = docs.withColumns({ID: docs["doc_id"].cast("long"), DIGEST: sha256(F.coalesce(docs["text"], F.lit("")))})
    found = found.join(keep, found[ID].eqNullSafe(keep["doc_id"]) & (found[DIGEST] == keep["digest"]), "left_semi")
    twins = land(groups.groupBy("doc_id", "digest").count().where("count > 1"), "twins")
    if not twins.isEmpty():  # rows that repeat both doc_id and text: any one of them
        same = found[ID].eqNullSafe(twins["doc_id"]) & (found[DIGEST] == twins["digest"])
        one = found.join(twins, same, "left_semi").dropDuplicates([ID, DIGEST])
        found = found.join(twins, same, "left_anti").unionByName(one)
    return found.drop(ID, DIGEST)
