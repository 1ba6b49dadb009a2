"""Traffic, delay causes, airport master data and runways attached to flights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions.casts import to_num
from contrail.functions.values import has_value
from contrail.operators.lookups import HotKeys, Skew, dedup_first, lookup


def join_traffic(
    flights: DataFrame, opsnet: DataFrame, airport: str = "Origin", day: str = "FlightDate", hot: HotKeys | Skew | None = None
) -> DataFrame:
    """Attach the airport's operations of the day and whether there were any on record."""
    side = opsnet.where("airport is not null").select(
        F.col("airport").alias(airport), F.col("date").alias(day), "airport_operations"
    )
    return lookup(flights, side, [airport, day], hot).withColumn("has_opsnet", has_value("airport_operations"))


def causes_by_month(
    delay: DataFrame, first: int = 2018, last: int = 2022, without: Sequence[int] = tuple(K.EXCLUDED_YEARS)
) -> DataFrame:
    """Delay minutes by cause, airport and month; causes absent from the input are skipped."""
    causes = [c for c in K.DELAY_CAUSES if c in delay.columns]
    kept = delay.where(F.col("year").between(first, last) & ~F.col("year").isin(*without))
    return kept.groupBy("airport", "year", "month").agg(*[F.sum(c).alias(c) for c in causes])


def join_causes(
    flights: DataFrame, monthly: DataFrame, airport: str = "Origin", day: str = "FlightDate", hot: HotKeys | Skew | None = None
) -> DataFrame:
    side = monthly.where("airport is not null").withColumnsRenamed(
        {"airport": airport, "year": "_year", "month": "_month"}
    )
    dated = flights.withColumns({"_year": F.year(day), "_month": F.month(day)})
    return lookup(dated, side, [airport, "_year", "_month"], hot).drop("_year", "_month")


def airport_master(airports: DataFrame) -> DataFrame:
    """One row per airport code: trimmed, null codes dropped, lowest id first where codes repeat."""
    coded = airports.where("iata_code is not null").select(
        F.trim("iata_code").alias("airport"),
        "id",
        F.col("latitude_deg").alias("airport_lat"),
        F.col("longitude_deg").alias("airport_lon"),
        F.col("elevation_ft").alias("airport_elevation"),
        F.col("type").alias("airport_type"),
    )
    return dedup_first(coded, ["airport"], ["id"])


def join_airports(
    flights: DataFrame, airports: DataFrame, airport: str = "Origin", hot: HotKeys | Skew | None = None
) -> DataFrame:
    side = airport_master(airports).drop("id").withColumnRenamed("airport", airport)
    return lookup(flights, side, [airport], hot)


def runway_profile(runways: DataFrame, airports: DataFrame) -> DataFrame:
    """Number, mean and greatest length of the open runways of each airport code.

    The runways are summed up by their own key first, on the map side, so they are neither moved nor stored.
    """
    codes = airports.where("ident is not null and iata_code is not null").select(
        F.trim("ident").alias("airport_ident"), F.trim("iata_code").alias("airport"), "id"
    )
    codes = dedup_first(codes, ["airport_ident"], ["id"]).drop("id")
    usable = runways.select("airport_ident", to_num("length_ft").alias("length_ft"), "closed").where(
        "length_ft is not null and (closed is null or closed <> 1)"
    )
    sums = usable.groupBy("airport_ident").agg(
        F.count("*").alias("_n"), F.sum("length_ft").alias("_total"), F.max("length_ft").alias("_max")
    )
    return (
        sums.withColumn("airport_ident", F.trim("airport_ident"))
        .join(codes, "airport_ident")
        .groupBy("airport")
        .agg(
            F.sum("_n").alias("num_runways"),
            (F.sum("_total") / F.sum("_n")).alias("avg_runway_length_ft"),
            F.max("_max").alias("max_runway_length_ft"),
        )
    )


def join_runways(
    flights: DataFrame, profile: DataFrame, airport: str = "Origin", hot: HotKeys | Skew | None = None
) -> DataFrame:
    return lookup(flights, profile.withColumnRenamed("airport", airport), [airport], hot)


def match_rate(df: DataFrame, anchors: Mapping[str, str]) -> DataFrame:
    """Share of rows, in percent, for which each enrichment's anchor column is present."""
    one = df.agg(
        F.count("*").alias("n"), *[(F.avg(has_value(a)) * 100).alias(f"m_{name}") for name, a in anchors.items()]
    )
    cells = F.array(*[F.struct(F.lit(n).alias("enrichment"), F.col(f"m_{n}").alias("match_pct")) for n in anchors])
    return one.select("n", F.explode(cells).alias("c")).select("c.*", "n")


def match_bias(df: DataFrame, anchor: str, value: str, k: int | None = None) -> DataFrame:
    """Mix of ``value`` with and without the anchor: share within each side, optionally the ``k`` largest."""
    counts = df.groupBy(F.col(anchor).isNotNull().alias("matched"), value).agg(F.count("*").alias("n"))
    sides = counts.groupBy("matched").agg(F.sum("n").alias("_side"))
    shares = counts.join(F.broadcast(sides), "matched")  # two rows
    shares = shares.select("matched", value, "n", (F.col("n") / F.col("_side")).alias("share"))
    if k is None:
        return shares
    tops = [
        shares.where(F.col("matched") == side).orderBy(F.desc("n"), value).limit(k) for side in (True, False)
    ]
    return tops[0].unionByName(tops[1])


def combine_counts(df: DataFrame, keys: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    """Total and flagged rows per group in one pass; groups without a flagged row show 0."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("total"), *[F.sum(F.col(f).cast("long")).alias(name) for name, f in flags.items()]
    )
