"""Casts from text: strict as in the models, or null on bad values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ON_BAD_VALUE = ("error", "null")


def _check(on_bad_value: str) -> None:
    if on_bad_value not in ON_BAD_VALUE:
        raise ValueError(f"on_bad_value must be one of {ON_BAD_VALUE}, not {on_bad_value!r}")


def number(text: Column, to: str = "double", on_bad_value: str = "error") -> Column:
    """Text to number. Under ANSI a bad text fails the job unless told otherwise."""
    _check(on_bad_value)
    return text.cast(to) if on_bad_value == "error" else text.try_cast(to)


def iso_timestamp(text: Column, on_bad_value: str = "error") -> Column:
    """ISO-8601 text with offset to an instant."""
    _check(on_bad_value)
    return F.to_timestamp(text) if on_bad_value == "error" else F.try_to_timestamp(text)


def wall_clock(text: Column) -> Column:
    """Text to a timestamp without zone; empty or unreadable text is null."""
    return F.nullif(text, F.lit("")).try_cast("timestamp_ntz")


def utc_wall_clock(instant: Column) -> Column:
    """Instant to its UTC wall clock, whatever the session time zone is."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def age_minutes(instant: Column, as_of: Column) -> Column:
    """Minutes from `instant` to `as_of`, two decimals."""
    return F.round((F.unix_micros(as_of) - F.unix_micros(instant)) / F.lit(6e7), 2)


def percent_change(current: Column, mean: Column) -> Column:
    """Change against a mean in per cent, two decimals; null without a usable mean."""
    return F.when(mean != 0, F.round((current - mean) / mean * 100, 2))


def floor_to_minutes(instant: Column, minutes: int) -> Column:
    width = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(instant) / width) * width)
