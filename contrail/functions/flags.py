"""Yes/no features and the weather severity index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.casts import col

# fixed values: what a missing measure is taken to be
CALM = {"sknt": 0.0, "gust": 0.0, "vsby": 10.0, "p01i": 0.0}


def as_flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _known(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(CALM[name]))


def time_flags(df: DataFrame, hour: str = "dep_hour", peaks: str = "boosted") -> DataFrame:
    """Time-of-day flags; ``peaks`` picks the peak hours of the boosted-tree or the forest feature set."""
    h = F.col(hour)
    # fixed values: first and last hour of the two peaks
    (m0, m1), (e0, e1) = {"boosted": ((8, 11), (17, 20)), "forest": ((6, 9), (17, 23))}[peaks]
    return df.withColumns(
        {
            "is_early_morning": as_flag(h.between(5, 7)),
            "is_evening": as_flag(h >= 18),
            "is_morning_peak": as_flag(h.between(m0, m1)),
            "is_evening_peak": as_flag(h.between(e0, e1)),
            "is_red_eye": as_flag(h.between(0, 4)),
        }
    )


def season_flags(df: DataFrame, month: Column | str = "month") -> DataFrame:
    m = col(month)
    return df.withColumns(
        {
            "is_summer": as_flag(m.isin(6, 7, 8)),
            "is_holiday_season": as_flag(m.isin(11, 12, 1)),
            "is_winter": as_flag(m.isin(12, 1, 2)),
        }
    )


def weather_flags(df: DataFrame, style: str = "boosted") -> DataFrame:
    """Threshold flags over the raw measures. ``style='linear'`` uses the half-open rain classes and the
    wind-or-gust rule of the linear model."""
    wind, gust, sight, rain = (_known(c) for c in ("sknt", "gust", "vsby", "p01i"))
    flags = {
        "high_wind": wind > 20,
        "extreme_wind": wind > 30,
        "wind_gust_severe": gust > 35,
        "low_visibility": sight < 3,
        "very_low_visibility": sight < 1,
        "freezing": F.col("tmpf") < 32,
        "has_precip": rain > 0,
        "heavy_rain": rain > 0.5,
        "very_heavy_rain": rain > 1.0,
        "precip_light": (rain > 0) & (rain <= 0.1),
        "precip_moderate": (rain > 0.1) & (rain <= 0.5),
        "precip_heavy": rain > 0.5,
    }
    if style == "linear":
        flags |= {
            "high_wind": (wind > 20) | (gust > 35),
            "precip_light": (rain >= 0.01) & (rain < 0.1),
            "precip_moderate": (rain >= 0.1) & (rain < 0.5),
            "precip_heavy": rain >= 0.5,
        }
    return df.withColumns({name: as_flag(test) for name, test in flags.items()})


def weather_severity() -> Column:
    """Mean of four scaled hazards; calm values stand in for missing ones."""
    hazards = (
        _known("sknt") / 30 + _known("gust") / 50 + (1 - _known("vsby") / 10) + F.least(_known("p01i"), F.lit(2.0)) / 2
    )
    return hazards / 4
