"""Data-quality report: one long table (check, column, n_bad, n_total)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.casts import to_num
from contrail.operators.clean import union_parts

# fixed values: the columns that identify a flight, and the checks' limits
IDENTITY = ["FlightDate", "Airline", "Origin", "Dest", "CRSDepTime", "Flight_Number_Marketing_Airline"]
CODE = "^[A-Z]{3}$"
DELAY_RANGE = (-60, 1440)
CLOCK_RANGE = (0, 2359)
CLOCK_COLUMNS = ["CRSDepTime", "DepTime", "ArrTime", "CRSArrTime"]
ACTUAL_COLUMNS = ["DepTime", "ArrTime", "AirTime", "WheelsOff", "WheelsOn"]
PAIRS = [("DepDelay", "DepDelayMinutes"), ("ArrDelay", "ArrDelayMinutes")]


def duplicates(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows (or rows with equal ``key``).

    Equal rows are counted on the map side, so a row copied a billion times costs one row per task.
    """
    cols = [c for c in (key or df.columns) if c in df.columns]
    groups = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    name = "duplicate_key" if key else "duplicate_row"
    return groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_bad"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_total")
    ).select(F.lit(name).alias("check"), F.lit("+".join(cols) if key else "*").alias("column"), "n_bad", "n_total")


def run_checks(df: DataFrame, checks: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Count the rows failing each named condition, all in one pass; null conditions do not count."""
    items = list(checks.items())
    one = df.agg(
        F.count("*").alias("n"), *[F.count_if(test).alias(f"k{i}") for i, (_, test) in enumerate(items)]
    )
    cells = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"k{i}").alias("n_bad"))
        for i, ((check, column), _) in enumerate(items)
    ])
    return one.select(F.explode(cells).alias("c"), F.col("n").alias("n_total")).select("c.*", "n_total")


def pattern_checks(cols: Sequence[str], pattern: str = CODE) -> dict:
    """Codes that do not match the pattern; a missing code is invalid too."""
    return {("bad_code", c): ~F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in cols}


def range_checks(columns: Sequence[str]) -> dict:
    low, high = DELAY_RANGE
    first, last = CLOCK_RANGE
    checks = {}
    if "Distance" in columns:
        checks["not_positive", "Distance"] = F.col("Distance") <= 0
    for c in ("DepDelay", "ArrDelay"):
        if c in columns:
            checks["too_early", c] = F.col(c) < low
            checks["too_late", c] = F.col(c) > high
    for c in CLOCK_COLUMNS:
        if c in columns:
            checks["not_a_time", c] = (to_num(c) < first) | (to_num(c) > last)
    return checks


def label_checks(columns: Sequence[str], cancelled: str = "Cancelled") -> dict:
    """Cancelled flights with actual times, flown flights without, and cancelled flights that were late."""
    gone = F.coalesce(F.col(cancelled).cast("boolean"), F.lit(False))
    checks = {("cancelled_with_time", c): gone & F.col(c).isNotNull() for c in ACTUAL_COLUMNS if c in columns}
    checks |= {("flown_without_time", c): ~gone & F.col(c).isNull() for c in ("DepTime", "ArrTime") if c in columns}
    for c in ("DepDelayMinutes", "DepDelay"):
        if c in columns:
            checks["cancelled_and_late", c] = gone & (F.col(c) > 0)
    return checks


def pair_checks(columns: Sequence[str], pairs: Sequence[tuple[str, str]] = tuple(PAIRS)) -> dict:
    """Pairs that differ after rounding half to even, where both are present."""
    return {
        ("pair_mismatch", f"{a}/{b}"): F.bround(to_num(a), 0) != F.bround(to_num(b), 0)
        for a, b in pairs
        if a in columns and b in columns
    }


def cancelled_late_share(df: DataFrame, delay: str = "DepDelay", cancelled: str = "Cancelled") -> DataFrame:
    """Share of cancelled flights that carry a positive delay."""
    gone = df.where(F.col(cancelled).cast("boolean"))
    late = F.coalesce(F.col(delay) > 0, F.lit(False)).cast("int")
    return gone.agg(F.count("*").alias("n_cancelled"), F.avg(late).alias("late_share"))


def quality_report(df: DataFrame, codes: Sequence[str] = ("Origin", "Dest"), identity: Sequence[str] = tuple(IDENTITY)) -> DataFrame:
    """All checks in one table."""
    checks = (
        pattern_checks([c for c in codes if c in df.columns])
        | range_checks(df.columns)
        | label_checks(df.columns)
        | pair_checks(df.columns)
    )
    parts = [run_checks(df, checks), duplicates(df)]
    present = [c for c in identity if c in df.columns]
    if len(present) >= 4:
        parts.append(duplicates(df, present))
    return union_parts(*parts)
