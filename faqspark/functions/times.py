"""Event times: message timestamps are decimal epoch strings, other sources send ISO dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_time(raw: Column) -> Column:
    """Epoch seconds first, ISO date second, else null. Exact to the microsecond."""
    seconds = raw.try_cast("decimal(20,6)")
    micros = (seconds * F.lit(1_000_000)).try_cast("bigint")
    return F.coalesce(F.timestamp_micros(micros), F.try_to_timestamp(raw))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Year, month and day of the UTC day, zero-padded as the stored paths have them."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def minute_of(ts: Column) -> Column:
    """Whole minutes since the epoch: cuts any group into ordered slices of one minute."""
    return F.floor(F.unix_seconds(ts) / 60)


def stamp(ts: Column) -> Column:
    """Readable UTC text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
