"""Schema guards, scope filters, fills and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions.flags import as_flag
from contrail.functions.values import ordinal_map
from contrail.operators.ordered import quantile_row, unpivot


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")
    return df


def optional_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def in_year(c: str, year: int) -> Column:
    """Whether a date falls in the year, as a range comparison."""
    day = F.col(c)
    return (day >= F.lit(f"{year}-01-01").cast("date")) & (day < F.lit(f"{year + 1}-01-01").cast("date"))


def exclude_years(df: DataFrame, c: str = "FlightDate", years: Sequence[int] = tuple(K.EXCLUDED_YEARS)) -> DataFrame:
    """Drop the given years, as date ranges so that a parquet scan can skip row groups; null dates are kept."""
    for y in years:
        df = df.where(F.col(c).isNull() | ~in_year(c, y))
    return df


def exclude_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return df.where(F.col(c).isNull() | ~F.col(c).isin(*values))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows in which every one of ``cols`` is null."""
    return df.dropna(how="all", subset=list(cols))


def drop_leakage(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.drop(*K.LEAKAGE, *K.DUPLICATES, *extra)


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent value of each column as text; ties go to the smallest."""
    counts = unpivot(df, cols, kind="string").groupBy("column", "value").agg(F.count("*").alias("n"))
    top = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
    return top.agg(*[F.max(F.when(F.col("column") == c, F.col("best.value"))).alias(c) for c in cols])


def statistic_row(df: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    if how == "median":
        return quantile_row(df, cols)
    if how == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in cols])
    if how == "most_frequent":
        return most_frequent(df, cols)
    raise ValueError(f"unknown statistic: {how}")


def fill_stat(df: DataFrame, cols: Sequence[str], how: str = "median", scope: Column | None = None) -> DataFrame:
    """Fill nulls with a statistic of the rows in ``scope`` (all rows if none).

    The statistic enters as a scalar subquery: one plan, no join, nothing collected.
    """
    stats = statistic_row(df if scope is None else df.where(scope), cols, how)
    kinds = dict(df.dtypes)
    values = stats.select(F.struct(*cols)).scalar()  # one subquery, used once per column
    return df.withColumns({c: F.coalesce(F.col(c), values[c].cast(kinds[c])) for c in cols})


def label_flights(
    df: DataFrame,
    threshold: float = K.DELAY_MINUTES,
    delay: str = "DepDelay",
    cancelled: str = "Cancelled",
    names: Mapping[int, str] = K.TARGET_NAMES,
) -> DataFrame:
    """Class of a flight: cancelled wins, then late by ``threshold`` or more, else on time. Never null."""
    is_cancelled = as_flag(F.col(cancelled).cast("boolean"))
    late = as_flag(F.col(delay) >= threshold)
    is_delayed = late * (1 - is_cancelled)
    target = 2 * is_cancelled + is_delayed
    return df.withColumns(
        {
            "is_cancelled": is_cancelled,
            "is_delayed": is_delayed,
            "is_on_time": 1 - is_cancelled - is_delayed,
            "target": target,
            "target_name": ordinal_map(target, names),
        }
    )


def temporal_split(
    df: DataFrame, years: Mapping[str, Sequence[int]] = K.SPLIT_YEARS, c: str = "FlightDate"
) -> DataFrame:
    """Add ``split`` by year and drop the years in no split.

    Each split is a union of date ranges, which a scan of a date column can push down to skip row groups.
    """
    chain, kept = F, F.lit(False)
    for name, members in years.items():
        inside = reduce(or_, [in_year(c, y) for y in members])
        chain, kept = chain.when(inside, name), kept | inside
    return df.where(kept).withColumn("split", chain)


def split_of(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def complement(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") != name)


def union_parts(first: DataFrame, *others: DataFrame) -> DataFrame:
    out = first
    for other in others:
        out = out.unionByName(other)
    return out
