"""Records that cannot be read, kept beside the events instead of failing the job or vanishing.

A record is parsed once and becomes one row either way: an event, or a reject with its text and a reason.
Both are written by the same job into one load, so they are committed together and counted while
they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from cartlake import schemas as S

UNREADABLE = "_unreadable"
PARSED = "_event"
MODES = ("fail", "drop", "keep")

NOT_AN_OBJECT = "not a JSON object"
NO_VALUE, NO_HEADER, BAD_BODY = "no value", "no header", "unreadable body"
RESERVED_TYPE = "reserved event type"


def settled(parsed: DataFrame, text: Column, reason: Column) -> DataFrame:
    """Rows of the stored event columns from parsed(_event, ...).

    reason is null for records that could be read. An event under the type that marks rejects is one itself.
    """
    reserved = F.col(PARSED)[S.EVENT_PARTITION] == S.REJECTED
    why = F.coalesce(reason, F.when(reserved, F.lit(RESERVED_TYPE)))
    rows = parsed.select(PARSED, text.alias(S.REJECT_TEXT), why.alias(S.REJECT_REASON))
    bad = F.col(S.REJECT_REASON).isNotNull()
    kind = F.when(bad, F.lit(S.REJECTED)).otherwise(F.col(PARSED)[S.EVENT_PARTITION])
    return rows.select(
        *[(kind if c == S.EVENT_PARTITION else F.when(~bad, F.col(PARSED)[c])).alias(c) for c in S.EVENT_COLUMNS],
        F.when(bad, F.col(S.REJECT_TEXT)).alias(S.REJECT_TEXT),
        S.REJECT_REASON,
    )


def counted(rows: DataFrame, seen: Observation | None) -> DataFrame:
    """The rows, with events and rejects counted into `seen` by the first job that reads them all."""
    if seen is None:
        return rows
    bad = F.col(S.REJECT_REASON).isNotNull()
    return rows.observe(seen, F.count_if(~bad).alias("events"), F.count_if(bad).alias("rejects"))


def events_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(S.REJECT_REASON).isNull()).select(*S.EVENT_COLUMNS)


def chosen(rows: DataFrame, mode: str, seen: Observation | None = None) -> DataFrame:
    """What a source returns: all rows (keep), events only (drop), or an error at the first reject (fail)."""
    if mode not in MODES:
        raise ValueError(f"bad records are one of {', '.join(MODES)}, not {mode!r}")
    rows = counted(rows, seen)
    if mode == "keep":
        return rows
    if mode == "drop":
        return events_only(rows)
    message = F.concat(F.col(S.REJECT_REASON), F.lit(": "), F.coalesce(S.REJECT_TEXT, F.lit("null")))
    first = S.EVENT_COLUMNS[0]
    checked = F.when(F.col(S.REJECT_REASON).isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col(first))
    return rows.select(checked.alias(first), *S.EVENT_COLUMNS[1:])
