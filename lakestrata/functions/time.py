"""Time expressions. The current time is always a parameter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def ntz(value: datetime | str | Column) -> Column:
    """A ``timestamp_ntz`` literal or cast."""
    col = value if isinstance(value, Column) else F.lit(str(value))
    return col.cast("timestamp_ntz")


def default_ts(col: Column, as_of: datetime | str | Column) -> Column:
    """Parse a timestamp; ``as_of`` where it is missing or unreadable."""
    return F.coalesce(col.try_cast("timestamp_ntz"), ntz(as_of))


def reformat_ts(col: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(col.cast("timestamp_ntz"), fmt)


def date_key(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(col, fmt)


def version_stamp(col: Column) -> Column:
    """``v20240131235959`` style version names."""
    return F.concat(F.lit("v"), F.date_format(col, "yyyyMMddHHmmss"))


def add_days(col: Column, days: int) -> Column:
    """Add whole days, keeping the time of day."""
    return col + F.make_interval(days=F.lit(days))


def month_start(col: Column) -> Column:
    return F.to_date(F.date_trunc("month", col))


def stamp(df: DataFrame, name: str, as_of: datetime | str | None = None) -> DataFrame:
    """Add a processing-time column (``as_of`` makes it repeatable)."""
    return df.withColumn(name, F.localtimestamp() if as_of is None else ntz(as_of))
