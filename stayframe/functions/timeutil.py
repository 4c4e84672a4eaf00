"""Time columns on TIMESTAMP_NTZ that do not depend on the session time zone.

Differences go through day-time intervals, never through a zoned timestamp, so
a session zone with summer time cannot shift them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86_400.0
DAYS_PER_YEAR = 365.242


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds from start to end as DECIMAL(18,6); sums stay exact."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def position(time: str, tie: str) -> str:
    """SQL of one number that orders rows by (time, tie); NULL when the time is.

    Microseconds and a non-negative id in one DECIMAL(38, 0). Unlike a struct it
    fits a fixed-width buffer, so min_by and max_by over it hash and combine map-side.
    """
    since = f"CAST({time} - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    micros = f"CAST(CAST({since} AS DECIMAL(18, 6)) * 1000000 AS DECIMAL(18, 0))"
    return f"CAST({micros} * 10000000000000000000 AS DECIMAL(38, 0)) + CAST({tie} AS DECIMAL(19, 0))"


def days_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(SECONDS_PER_DAY)


def years_between(start: Column, end: Column) -> Column:
    """Age-style years of 365.242 days."""
    return days_between(start, end) / F.lit(DAYS_PER_YEAR)


def hours(n: float) -> Column:
    return F.make_dt_interval(secs=F.lit(n * 3600).cast("decimal(18,6)"))


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def years(n: int) -> Column:
    return F.make_ym_interval(years=F.lit(n))


def day_floor(ts: Column) -> Column:
    """Midnight of the day. date_trunc would return a zoned timestamp."""
    return ts.cast("date").cast("timestamp_ntz")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(ts) - 1


def day_name(ts: Column) -> Column:
    """Lower-case English day name, not padded."""
    return F.lower(F.date_format(ts, "EEEE"))


def with_clock(date: Column, clock: Column) -> Column:
    """Midnight of ``date`` plus an ``H:MM`` / ``HH:MM[:SS]`` text (seconds ignored).

    NULL when the text is not a clock time of the day.
    """
    pattern = r"^([0-9]{1,2}):([0-9]{1,2})"
    hour = F.regexp_extract(clock, pattern, 1).try_cast("int")
    minute = F.regexp_extract(clock, pattern, 2).try_cast("int")
    valid = (hour <= 23) & (minute <= 59)
    return F.when(valid, day_floor(date) + F.make_dt_interval(hours=hour, mins=minute))
