"""Hourly weather rollups and the two-step enrichment of flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.operators.lookups import HotKeys, Skew, lookup

_AGG = {"avg": F.avg, "sum": F.sum, "max": F.max}
HOUR_KEYS = ["w_date", "w_hour"]


def measures_in(df: DataFrame) -> list[str]:
    present = [c for c in K.WEATHER if c in df.columns]
    if not present:
        raise ValueError("no weather measure among the columns")
    return present


def rollup_exprs(measures: Sequence[str], zero_if_empty: bool = False) -> list:
    """Mean of state measures, sum of rain, maximum gust. An all-null sum is null unless asked otherwise."""
    out = [_AGG[K.HOURLY_RULES[m]](m).alias(m) for m in measures]
    if zero_if_empty and "p01i" in measures:
        out[list(measures).index("p01i")] = F.coalesce(F.sum("p01i"), F.lit(0.0)).alias("p01i")
    return out


def hourly_weather(
    obs: DataFrame, station: str = "airport_code", zero_if_empty: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per station and hour; ``carry`` names columns that depend on the station alone."""
    keyed = obs.where(F.col("valid").isNotNull() & F.col(station).isNotNull())
    return keyed.groupBy(
        F.col(station).alias("airport_code"),
        *carry,
        F.to_date("valid").alias("w_date"),
        F.hour("valid").alias("w_hour"),
    ).agg(*rollup_exprs(measures_in(obs), zero_if_empty))


def station_regions(df: DataFrame, station: str = "airport_code") -> DataFrame:
    """Add ``region`` of a weather station from the fixed station and census tables."""
    spark = df.sparkSession
    regions = {s: r for r, states in K.CENSUS_REGIONS.items() for s in states}
    rows = [(code, regions[state]) for code, state in K.STATION_STATES.items()]
    dim = spark.createDataFrame(rows, f"{station} string, region string")
    return df.join(F.broadcast(dim), station, "left")  # fifty rows


def map_region(df: DataFrame, state: str = "OriginState") -> DataFrame:
    """Add ``region`` of a state; unknown states get null."""
    rows = [(s, r) for r, states in K.CENSUS_REGIONS.items() for s in states]
    dim = df.sparkSession.createDataFrame(rows, f"{state} string, region string")
    return df.join(F.broadcast(dim), state, "left")  # fifty-odd rows


def region_hourly(hourly: DataFrame) -> DataFrame:
    """Mean of the station-hour values (each station counts once) per region and hour."""
    return (
        hourly.where("region is not null")
        .groupBy("region", *HOUR_KEYS)
        .agg(*[F.avg(m).alias(m) for m in measures_in(hourly)])
    )


def enrich_airport_hour(
    flights: DataFrame,
    hourly: DataFrame,
    origin: str = "Origin",
    day: str = "f_date",
    hour: str = "dep_hour",
    hot: HotKeys | Skew | None = None,
) -> DataFrame:
    """Attach the station's weather of the departure hour."""
    side = hourly.select(
        F.col("airport_code").alias(origin), F.col("w_date").alias(day), F.col("w_hour").alias(hour), *measures_in(hourly)
    )
    return lookup(flights, side, [origin, day, hour], hot)


def enrich_with_fallback(
    flights: DataFrame,
    hourly: DataFrame,
    by_region: DataFrame,
    origin: str = "Origin",
    day: str = "f_date",
    hour: str = "dep_hour",
    anchor: str = "tmpf",
    hot: HotKeys | Skew | None = None,
    hot_region: HotKeys | Skew | None = None,
) -> DataFrame:
    """Station weather, each missing measure filled from the region's mean, and where it came from."""
    measures = measures_in(hourly)
    anchor = anchor if anchor in measures else measures[0]
    first = enrich_airport_hour(flights, hourly, origin, day, hour, hot)
    side = by_region.select(
        "region",
        F.col("w_date").alias(day),
        F.col("w_hour").alias(hour),
        *[F.col(m).alias(f"_reg_{m}") for m in measures],
    )
    both = lookup(first, side, ["region", day, hour], hot_region)
    filled = {m: F.coalesce(F.col(m), F.col(f"_reg_{m}")) for m in measures}
    source = weather_source(F.col(anchor), filled[anchor])
    return both.withColumn("weather_source", source).withColumns(filled).drop(*[f"_reg_{m}" for m in measures])


def weather_source(before, after):
    """Provenance from the anchor measure before and after the fallback."""
    airport, region, missing = K.WEATHER_SOURCES
    return F.when(before.isNotNull(), airport).when(after.isNotNull(), region).otherwise(missing)


def weather_by_hour(obs: DataFrame) -> DataFrame:
    """Mean of the measures by hour of day."""
    measures = [m for m in measures_in(obs) if m != "relh"]
    return (
        obs.where("valid is not null").groupBy(F.hour("valid").alias("hour")).agg(*[F.avg(m).alias(m) for m in measures])
    )
