"""Lenient casts, key clean-up and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURS = (0, 23)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_num(c: Column | str, kind: str = "double") -> Column:
    """Number, or null when the text is not one."""
    return col(c).try_cast(kind)


def to_date(c: Column | str, fmt: str | None = None) -> Column:
    """Date, or null when the text does not parse."""
    parsed = F.try_to_timestamp(col(c), F.lit(fmt)) if fmt else col(c).try_cast("timestamp")
    return parsed.cast("date")


def norm_code(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def hhmm_hour(c: Column | str, clip: bool = True) -> Column:
    """Hour of an HHMM number; 2400 counts as 23 when clipped."""
    hour = F.floor(to_num(c) / 100).cast("int")
    if clip:
        low, high = HOURS
        return F.when(hour.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), hour)))
    return hour


def in_hours(hour: Column | str) -> Column:
    return col(hour).between(*HOURS)


def calendar(df: DataFrame, c: str = "FlightDate") -> DataFrame:
    """Add calendar parts of date column ``c``."""
    d = F.col(c).cast("date")
    weekday = F.weekday(d)
    return df.withColumns(
        {
            "f_date": d,
            "year": F.year(d),
            "quarter": F.quarter(d),
            "month": F.month(d),
            "day_of_month": F.dayofmonth(d),
            "iso_dow": weekday + 1,
            "day_of_week": weekday,
            "day_name": F.date_format(d, "EEEE"),
            "month_name": F.date_format(d, "MMMM"),
            "is_weekend": (weekday >= 5).cast("int"),
            "period": F.date_format(d, "yyyy-MM"),
        }
    )
