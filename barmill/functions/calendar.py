"""Dates, sessions and weekdays; the present is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exchange session, minutes after midnight.
OPEN, CLOSE = 9 * 60 + 15, 15 * 60 + 30


def date_parts(date: str = "date") -> dict[str, Column]:
    return {"year": F.year(date), "month": F.month(date), "quarter": F.quarter(date), "year_month": F.date_format(date, "yyyy-MM")}


def months_back(date: Column, months: int) -> Column:
    """So many calendar months back, clamped to the month's end."""
    return F.add_months(date, -months)


def weekdays_between(start: Column, end: Column) -> Column:
    """Weekdays after start up to end, 0 if end isn't later."""
    days = F.sequence(F.date_add(start, 1), end)
    return F.when(end > start, F.size(F.filter(days, lambda d: F.weekday(d) < 5))).otherwise(0)


def minute_of_day(as_of: Column) -> Column:
    return F.hour(as_of) * 60 + F.minute(as_of)


def newest_session(as_of: Column) -> Column:
    """Latest date whose session can be final: today if a weekday and past the close, else the day before, never a weekend. Holidays are ignored."""
    today = F.to_date(as_of)
    day = F.when((F.weekday(today) < 5) & (minute_of_day(as_of) >= CLOSE), today).otherwise(F.date_sub(today, 1))
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def market_open(as_of: Column) -> Column:
    return (F.weekday(F.to_date(as_of)) < 5) & minute_of_day(as_of).between(OPEN, CLOSE - 1)


def date_dimension(dates: DataFrame) -> DataFrame:
    """Every day from the least to the latest date, with its parts."""
    span = dates.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a is not null")
    return span.select(F.explode(F.sequence("a", "b")).alias("date")).withColumns(date_parts())
