"""Time expressions. All keep TIMESTAMP_NTZ input as TIMESTAMP_NTZ, so no result
depends on the session time zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_HOUR = timedelta(minutes=30)
# No zone is further from UTC than this.
LARGEST_OFFSET = timedelta(hours=18)


def ntz(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ literal; folded at planning time, so it reaches the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day_literal(day: date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def half_hour_floor(ts: Column) -> Column:
    """The half-hour bucket a time falls into."""
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts) % 30, F.extract(F.lit("SECOND"), ts)
    )


def half_hour_floor_of(moment: datetime) -> datetime:
    """The same bucket for a parameter known when the plan is built."""
    return moment.replace(minute=30 if moment.minute >= 30 else 0, second=0, microsecond=0)


def bucket_at_most(ts: Column, cutoff: datetime) -> Column:
    """Half-hour bucket of ts not after the cutoff, as a plain comparison of ts."""
    return ts < ntz(half_hour_floor_of(cutoff) + HALF_HOUR)


def bucket_is(ts: Column, bucket: datetime) -> Column:
    """Half-hour bucket of ts equal to the given one, as a range of ts."""
    return (ts >= ntz(bucket)) & (ts < ntz(bucket + HALF_HOUR))


def second_floor(ts: Column) -> Column:
    whole = F.extract(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), whole - F.floor(whole))


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries between two times, not the rounded-down duration."""
    return F.timestamp_diff("SECOND", second_floor(start), second_floor(end))


def to_report_tz(utc: Column, zone: str) -> Column:
    """UTC wall time to wall time of the report's zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_bucket_at_most(utc: Column, zone: str, cutoff: datetime) -> Column:
    """Half-hour bucket of the local time not after the cutoff.

    The plain test on the stored time comes first: it is wide enough for every zone and
    lets the scan skip what cannot qualify.
    """
    possible = utc < ntz(half_hour_floor_of(cutoff) + HALF_HOUR + LARGEST_OFFSET)
    return possible & bucket_at_most(to_report_tz(utc, zone), cutoff)


def local_bucket_is(utc: Column, zone: str, bucket: datetime) -> Column:
    """Half-hour bucket of the local time equal to the given one, with the same first test.

    Counting buckets from the wanted one converts each time once; a range would do it twice.
    """
    possible = (utc >= ntz(bucket - LARGEST_OFFSET)) & (utc < ntz(bucket + HALF_HOUR + LARGEST_OFFSET))
    distance = F.timestamp_diff("MICROSECOND", ntz(bucket), to_report_tz(utc, zone))
    return possible & (F.floor(distance / (HALF_HOUR // timedelta(microseconds=1))) == 0)


def ymd_window(first: date | None, last: date, year="year", month="month", day="day") -> Column:
    """Rows whose split date columns lie in [first, last].

    The bare year/month tests let a metastore drop partitions before listing files;
    the date test makes the window exact. Both are partition filters.
    """
    y, m, d = F.col(year), F.col(month), F.col(day)
    exact = F.make_date(y, m, d) <= day_literal(last)
    if first is None:
        return (y <= last.year) & exact
    coarse = y.between(first.year, last.year)
    if first.year == last.year:
        coarse &= m.between(first.month, last.month)
    return coarse & exact & (F.make_date(y, m, d) >= day_literal(first))


def on_days(ts: Column, first: date, before: date) -> Column:
    """Calendar day of ts in [first, before), as a range test the scan can use."""
    return (ts >= F.lit(first.isoformat()).cast("timestamp_ntz")) & (
        ts < F.lit(before.isoformat()).cast("timestamp_ntz")
    )
