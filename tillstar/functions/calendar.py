"""Date expressions. All of them read a DATE, so no session time zone is involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(date: Column) -> Column:
    """Smart key yyyymmdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def calendar_columns(date: Column) -> list[Column]:
    """The calendar attributes of a date; weekdays count from Monday = 0."""
    return [
        date_key(date).alias("date_key"),
        date.alias("full_date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.dayofmonth(date).alias("day_of_month"),
        F.weekday(date).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        (F.weekday(date) >= 5).alias("is_weekend"),
    ]


def year_month_label(year: Column, month: Column) -> Column:
    """`2024-03` from 2024 and 3."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def time_of_day(ts: Column) -> Column:
    """Morning before 12:00, noon before 18:00, evening after that."""
    hour = F.hour(ts)
    return F.when(hour < 12, "morning").when(hour < 18, "noon").otherwise("evening")
