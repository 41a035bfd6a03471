"""Time expressions. Comparisons use whole microseconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

MICROS = 1_000_000


def micros(moment: Column) -> Column:
    """A TIMESTAMP as microseconds since the epoch."""
    return F.unix_micros(moment)


def local_micros(moment: Column) -> Column:
    """A TIMESTAMP_NTZ as microseconds since the epoch, read as UTC."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, moment)


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value)


def moment(as_of) -> Column:
    """``as_of`` as a TIMESTAMP column: a column, a datetime, ISO text, or None for now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, (dt.datetime, str)):
        return F.lit(as_of).cast("timestamp")
    return as_of


def iso_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def from_iso(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, with or without a fraction or a zone."""
    return text.cast("timestamp")


def capture_time(text: Column, zone: str = "UTC") -> Column:
    """Display text of a capture tool, such as ``Jan  1, 2024 00:00:07.179575000 UTC``.

    The day may be padded with two blanks and the zone name is not trusted: ``zone`` says
    what the clock means.
    """
    clock = F.substring_index(F.regexp_replace(F.trim(text), " +", " "), " ", 4)
    parsed = F.try_to_timestamp(clock, F.lit("MMM d, yyyy HH:mm:ss[.SSSSSSSSS]"))
    local = parsed.cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.current_timezone(), local).cast("timestamp")


def expired(block_time: Column, duration: Column, as_of: Column) -> Column:
    """True strictly after ``duration`` seconds have passed."""
    return micros(as_of) - micros(block_time) > duration.cast("bigint") * MICROS


def remaining_seconds(block_time: Column, duration: Column, as_of: Column) -> Column:
    """Seconds left, cut towards zero; negative once the block is over."""
    left = duration.cast("bigint") * MICROS - (micros(as_of) - micros(block_time))
    return (left / MICROS).cast("int")
