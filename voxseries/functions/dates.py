"""Date expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxseries import constants as K


_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def epoch_date(seconds: Column, zone: str = "UTC") -> Column:
    """Calendar date of an epoch second in ``zone``, whatever the session zone is.

    Null outside the years 1 to 9999, as for an epoch in milliseconds; it never raises.
    """
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    known = F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds)
    utc = start + F.make_dt_interval(secs=known)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")


def iso_week(date: Column) -> Column:
    """ISO week number; the year is not part of it."""
    return F.weekofyear(date)


def iso_year(date: Column) -> Column:
    """The year an ISO week belongs to, for series that span years."""
    return F.extract(F.lit("YEAROFWEEK"), date)


def running_week(date: Column) -> Column:
    """Whole ISO weeks since the one of 1969-12-29: one number per ISO year and week, without a jump at new year."""
    return F.floor(F.date_diff(date, F.lit("1969-12-29").cast("date")) / 7).cast("int")


def running_week_of(year: Column, week: Column) -> Column:
    """The same from an ISO year and week number. January 4th always lies in the first ISO week of its year."""
    return running_week(F.make_date(year, F.lit(1), F.lit(4))) + week - 1


def week_axis_date(week: Column, first: str = K.WEEK_ONE) -> Column:
    """First day drawn for a week label, counted in sevens from ``first``."""
    return F.date_add(F.lit(first).cast("date"), ((week - 1) * 7).cast("int"))


def within_series(day: Column, first: Column, last: Column, slack: int = 1) -> Column:
    """Whether ``day`` falls inside a series, give or take ``slack`` days."""
    return day.between(F.date_sub(first, slack), F.date_add(last, slack))
