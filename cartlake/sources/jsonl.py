"""Events from JSON lines, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from cartlake import schemas as S
from cartlake.operators.rejects import NOT_AN_OBJECT, PARSED, UNREADABLE, chosen, settled


def parse_lines(lines: DataFrame, text: str = "value", on_bad: str = "drop", seen: Observation | None = None) -> DataFrame:
    """One event per line; nested values become JSON text, other values plain text.

    Missing fields are null. Blank lines are skipped. Lines that are no JSON object are left out, kept as
    rejects in two more columns (`on_bad="keep"`), or fail the job ("fail"); `seen` counts them in
    each case.
    """
    fields = T.StructType(S.EVENT.fields + [T.StructField(UNREADABLE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    filled = lines.where(F.trim(F.col(text)) != "")
    # The parse sits in a generator, so no later expression repeats it.
    record = F.struct(F.from_json(F.col(text), fields, options).alias(PARSED))
    parsed = filled.select(text, F.inline(F.array(record)))
    bad = F.col(PARSED).isNull() | F.col(PARSED)[UNREADABLE].isNotNull()
    return chosen(settled(parsed, F.col(text), F.when(bad, F.lit(NOT_AN_OBJECT))), on_bad, seen)


def read_events(spark: SparkSession, path: str, on_bad: str = "drop", seen: Observation | None = None) -> DataFrame:
    return parse_lines(spark.read.text(path), on_bad=on_bad, seen=seen)


def stream_events(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, on_bad: str = "drop"
) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(reader.load(path), on_bad=on_bad)
