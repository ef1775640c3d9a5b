"""WARC archives with content-addressed payloads.

An archive is two tables. `payloads` holds each distinct payload once under its SHA-256;
`headers` holds the exact header block of every record. Records are put together again by a
join on the digest: a response is header, payload and end mark, a revisit has no payload and
names the record it refers to. Before a payload is stored, all payloads of its digest are
compared byte by byte (smallest equals largest), and when it is read its digest is computed
again. Equal payloads combine before the shuffle, and the join is a plain one that adaptive
execution splits, so one payload may belong to any share of the records.

Results for odd input: null html is an empty payload. Pages without page_id are archived as
responses with an empty record id; page_id null stays null. Pages that repeat a page_id are
separate records; of equal payloads below the same smallest page_id one is the response. Null
urls give an empty target. An empty table gives empty archives. Line breaks in urls are percent-encoded,
so that they cannot end the header.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartlake.llm.common import land, scratch

LEAST_BYTES = 100
VERSION = "WARC/1.1"
END = "\r\n\r\n"


@dataclass
class Archive:
    """Folders of the two tables."""

    spark: SparkSession
    payloads: str
    headers: str


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> Archive:
    """Archives pages(page_id, url, html); payloads of fewer bytes are never referred to."""
    spark = pages.sparkSession
    archive = Archive(spark, scratch(spark, "warc-payloads"), scratch(spark, "warc-headers"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    # Another scan may number rows in another way, so records and the firsts of their payloads come from the same landed rows.
    light = rows.withColumn("at", F.monotonically_increasing_id())
    light = land(light.select("page_id", "url", "digest", "at", F.length("payload").cast("long").alias("bytes")), "warc-records")
    unique = rows.groupBy("digest").agg(F.min("payload").alias("payload"), F.max("payload").alias("_other"))
    same = F.assert_true(F.col("payload") == F.col("_other"), F.lit("two payloads share a digest"))
    unique = unique.withColumn("payload", F.when(same.isNull(), F.col("payload")))
    unique.select("digest", "payload").write.option("compression", "zstd").parquet(archive.payloads)

    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "at")).alias("first")
    firsts = light.groupBy("digest").agg(first)
    records = light.join(firsts, "digest")
    lead = (F.col("page_id").eqNullSafe(F.col("first.page_id"))) & (F.col("at") == F.col("first.at"))
    response = (F.col("bytes") < least_bytes) | lead | F.col("page_id").isNull()
    kind = F.when(response, F.lit("response")).otherwise(F.lit("revisit"))
    hexed = F.lower(F.hex("digest"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    text = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number(F.col("page_id")), F.lit(">"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), hexed)),
        F.when(response, F.lit("")).otherwise(
            _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), number(F.col("first.page_id")), F.lit(">")))
        ),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(response, F.col("bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit("\r\n"),
    )
    records.select("digest", text.cast("binary").alias("header")).write.option("compression", "zstd").parquet(archive.headers)
    return archive


def _field(header: Column, name: str, value: str) -> Column:
    """The part of a header line that `value` matches; null without such a line."""
    found = F.regexp_extract(header, f"\r\n{name}: {value}\r\n", 1)
    return F.when(found != "", found)


def read(archive: Archive, with_records: bool = False) -> DataFrame:
    """One row per record, parsed from its header and checked against its payload.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest, and with
    `with_records` record: the record's exact bytes). Sizes and digests are computed from the
    stored payload; a payload that does not match the digest it is stored under, or a header
    that gives another size or has no payload, fails the read.
    """
    spark = archive.spark
    headers = spark.read.schema("digest binary, header binary").parquet(archive.headers)
    stored = spark.read.schema("digest binary, payload binary").parquet(archive.payloads)
    found = F.sha2("payload", 256)
    checked = stored.select(
        "digest",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(
            F.assert_true(F.unhex(found) == F.col("digest"), F.lit("a stored payload does not match its digest")).isNull(), found
        ).alias("payload_digest"),
        *(["payload"] if with_records else []),
    )
    text = F.decode("header", "utf-8")
    fields = headers.select(
        "digest",
        *(["header"] if with_records else []),
        _field(text, "WARC-Record-ID", "<urn:page:(-?[0-9]*)>").cast("long").alias("page_id"),
        F.regexp_extract(text, "\r\nWARC-Target-URI: ([^\r]*)\r\n", 1).alias("url"),
        _field(text, "WARC-Type", "([a-z]+)").alias("record_type"),
        _field(text, "WARC-Refers-To", "<urn:page:(-?[0-9]*)>").cast("long").alias("refers_to"),
        _field(text, "WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("_told"),
        _field(text, "Content-Length", "([0-9]+)").cast("long").alias("_length"),
    )
    rows = fields.join(checked, "digest", "left")
    whole = F.col("record_type") == "response"
    right = (F.col("_told") == F.col("payload_digest")) & (
        F.col("_length") == F.when(whole, F.col("payload_bytes")).otherwise(F.lit(0))
    )
    rows = rows.where(F.assert_true(right, F.lit("a header does not match its payload")).isNull())
    out = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    if with_records:
        body = F.when(whole, F.col("payload")).otherwise(F.lit(b""))
        rows = rows.withColumn("record", F.concat(F.col("header"), body, F.lit(END.encode())))
        out.append("record")
    return rows.select(*out)
