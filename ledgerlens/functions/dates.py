"""Calendar expressions: shift, date parts, session of day, month cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shift_hours(c: Column | str, hours: int) -> Column:
    """Fixed-offset shift of a zone-naive timestamp (C5 uses -8 h)."""
    return _c(c) + F.make_interval(hours=F.lit(hours))


def parse_timestamp(c: Column | str) -> Column:
    """Text to timestamp_ntz; unparsable text becomes null."""
    return F.try_to_timestamp(_c(c).cast("string")).cast("timestamp_ntz")


def timestamp_of(df: DataFrame, c: str) -> Column:
    """I3 for any input type: typed columns are cast, text is parsed."""
    dt = df.schema[c].dataType
    if isinstance(dt, (TimestampNTZType, TimestampType, DateType)):
        return F.col(c).cast("timestamp_ntz")
    return parse_timestamp(c)


def session_of_day(hour: Column | str) -> Column:
    """C14: hour of day to a named session (fixed boundaries of the reference)."""
    h = _c(hour)
    return (F.when(h <= 4, "Late Night")
            .when(h <= 8, "Early Morning")
            .when(h <= 12, "Morning")
            .when(h <= 16, "Noon")
            .when(h <= 20, "Evening")
            .when(h <= 24, "Night"))


def add_dateparts(df: DataFrame, ts: str) -> DataFrame:
    """Year, Month, ISO Week, Day, Dayofweek (Mon=0), Dayofyear of ``ts``."""
    t = F.col(ts)
    return df.withColumns({
        "year": F.year(t),
        "month": F.month(t),
        "week": F.weekofyear(t),
        "day": F.dayofmonth(t),
        "dayofweek": F.weekday(t),
        "dayofyear": F.dayofyear(t),
    })


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    """C6 + C8-C14: every calendar attribute the sales table carries."""
    t = F.col(ts)
    df = add_dateparts(df, ts)
    return df.withColumns({
        "just_date": F.to_date(t),
        "year_month": F.date_format(t, "yyyy-MM"),
        "month_abbr": F.date_format(t, "MMM"),
        "day_abbr": F.date_format(t, "E"),
        "hour": F.hour(t),
        "quater": F.quarter(t),
    }).withColumn("session", session_of_day("hour"))


def last_full_month_end(max_day: Column | str) -> Column:
    """H2/F1: ``max - day(max)`` days, i.e. the last day of the previous month."""
    d = _c(max_day)
    return F.date_sub(d, F.dayofmonth(d))


def months_back_start(last_day: Column | str, months: int) -> Column:
    """H4/H5: first day of the month ``months`` before the month of ``last_day``."""
    return F.add_months(F.trunc(_c(last_day), "MM"), -months)
