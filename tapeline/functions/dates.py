"""Date expressions; day arithmetic runs on epoch seconds and so does not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from tapeline.functions.numbers import SECONDS_PER_DAY

LOOKBACK_DAYS = 7


def epoch_to_date(seconds: Column) -> Column:
    """Epoch seconds to their UTC day."""
    return F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).cast("int"))


def date_to_epoch(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * SECONDS_PER_DAY


def as_moment(as_of: datetime | Column) -> Column:
    """The run moment as a column. Without a zone the session's zone applies."""
    return as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def lookback_bounds(as_of: datetime | Column, days: int = LOOKBACK_DAYS) -> tuple[Column, Column]:
    """Whole epoch seconds of the run moment minus ``days``, and of the run moment."""
    end = F.unix_seconds(as_moment(as_of))
    return end - F.lit(days * SECONDS_PER_DAY), end


def lookback_days(as_of: datetime | Column, days: int = LOOKBACK_DAYS) -> tuple[Column, Column]:
    """The first and the last UTC day that begin within ``lookback_bounds``."""
    start, end = lookback_bounds(as_of, days)
    return epoch_to_date(start + F.lit(SECONDS_PER_DAY - 1)), epoch_to_date(end)


def run_stamp(as_of: datetime | Column) -> Column:
    return F.date_format(as_moment(as_of), "yyyyMMdd")


def run_title(as_of: datetime | Column) -> Column:
    return F.date_format(as_moment(as_of), "MMMM dd, yyyy")


def coerce_date(value: Column, dtype: str) -> Column:
    """A date from a date, a timestamp or an ISO text; unreadable text is NULL."""
    return F.try_to_timestamp(value).cast("date") if dtype == "string" else value.cast("date")


def midnight_text(day: Column) -> Column:
    return F.concat(day.cast("string"), F.lit(" 00:00:00"))
