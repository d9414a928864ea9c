"""Date expressions. All take and return columns and stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def moment(at: datetime) -> Column:
    """A point in time as a literal without a zone. Goes by text, which no time-zone setting changes."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic: no text formatting and no time-zone cast."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(key: Column) -> Column:
    """yyyymm of a yyyymmdd key; the partition column of the sales fact."""
    return F.floor(key / 100).cast("int")


def key_to_date(key: Column) -> Column:
    """The date of a yyyymmdd key; NULL for NULL and for the placeholder 0."""
    real = F.nullif(key, F.lit(0))
    return F.make_date(F.floor(real / 10000).cast("int"), (F.floor(real / 100) % 100).cast("int"),
                       (real % 100).cast("int"))


def days_between(start: Column, end: Column) -> Column:
    """Day boundaries crossed from ``start`` to ``end``."""
    return F.datediff(end, start)


def add_days(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days if isinstance(days, Column) else F.lit(days))


def add_minutes(moment: Column, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), moment)


def weekday_number(day: Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(day)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def calendar_columns(day: Column) -> list[Column]:
    """Every attribute of the date dimension for one date column."""
    return [
        date_key(day).alias("DateKey"),
        day.alias("FullDate"),
        weekday_number(day).cast("short").alias("DayOfWeek"),
        F.date_format(day, "EEEE").alias("DayName"),
        F.dayofmonth(day).cast("short").alias("DayOfMonth"),
        F.month(day).cast("short").alias("MonthNumber"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.quarter(day).cast("short").alias("Quarter"),
        F.year(day).cast("short").alias("Year"),
        is_weekend(day).alias("IsWeekend"),
    ]
