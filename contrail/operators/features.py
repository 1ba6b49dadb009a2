"""Leakage-free statistics of past flights and the encodings built from them.

Every statistic takes a ``scope``: ``'train'`` uses training rows only, ``'all'`` uses every row.

Operators that attach a statistic take an optional ``source``, the table to learn it from (by default the table it is
attached to). When several are chained, pass the stored table they all start from: otherwise each one computes the
joins of those before it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.operators.lookups import HotKeys, Skew, join_back, lookup, prior_day, prior_month
from contrail.operators.ordered import quantile_row, running_totals
from contrail.session import materialize

SEASON_EDGES = [0, 3, 6, 9, 12]
SEASONS = ["winter", "spring", "summer", "fall"]


def in_scope(df: DataFrame, scope: str) -> DataFrame:
    if scope == "all":
        return df
    return df.where(F.col("split") == scope)


def label_index(df: DataFrame, c: str, missing: str = "Unknown") -> DataFrame:
    """Distinct values of ``c`` with their index in binary order."""
    values = df.select(F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c)).groupBy(c).agg(F.lit(1).alias("_one"))
    return running_totals(values, c, ["_one"]).select(
        c, (F.col("cum__one") - 1).cast("int").alias(f"{c}_enc")
    )


def label_encode(
    df: DataFrame, c: str, hot: HotKeys | Skew | None = None, missing: str = "Unknown", source: DataFrame | None = None
) -> DataFrame:
    """Add ``<c>_enc``; a null counts as the category ``missing``."""
    index = label_index(df if source is None else source, c, missing).withColumnRenamed(c, f"_{c}")
    keyed = df.withColumn(f"_{c}", F.coalesce(F.col(c).cast("string"), F.lit(missing)))
    if hot:
        hot = hot.renamed(f"_{c}")
    return lookup(keyed, index, [f"_{c}"], hot).drop(f"_{c}")


def encoding_table(
    df: DataFrame, keys: Sequence[str], labels: dict[str, str], m: float, scope: str = "train"
) -> DataFrame:
    """Smoothed rate per group: ``(positives + m * global) / (n + m)``.

    ``labels`` maps output name to a 0/1 column. The global rate is taken from the group totals, so the rows
    are read once.
    """
    totals = (
        in_scope(df, scope)
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"), *[F.sum(y).alias(f"_s_{name}") for name, y in labels.items()])
    )
    overall = global_rates(df, labels, scope)
    return totals.select(
        *keys,
        *[
            ((F.col(f"_s_{name}") + m * overall[name]) / (F.col("_n") + m)).alias(name)
            for name in labels
        ],
    )


def global_rates(df: DataFrame, labels: dict[str, str], scope: str = "train"):
    """Overall rate of each label as a scalar struct column."""
    return in_scope(df, scope).agg(F.struct(*[F.avg(y).alias(name) for name, y in labels.items()])).scalar()


def target_encode(
    df: DataFrame,
    keys: Sequence[str],
    labels: dict[str, str],
    m: float,
    scope: str = "train",
    hot: HotKeys | Skew | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Attach smoothed rates; groups never seen in scope get the global rate."""
    source = df if source is None else source
    overall = global_rates(source, labels, scope)
    table = encoding_table(source, keys, labels, m, scope)
    return join_back(df, table, keys, {name: overall[name] for name in labels}, hot)


def daily_stats(df: DataFrame, keys: Sequence[str] = ("Origin", "FlightDate")) -> DataFrame:
    """Flights, cancellations and delays per airport and day, with rates."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("is_cancelled").alias("n_cancelled"),
        F.sum("is_delayed").alias("n_delayed"),
        F.avg("is_cancelled").alias("cancel_rate"),
        F.avg("is_delayed").alias("delay_rate"),
    )


def lag_table(daily: DataFrame, day: str = "FlightDate", origin: str = "Origin") -> DataFrame:
    """Daily statistics moved one calendar day ahead."""
    return prior_day(daily, day).select(
        *[c for c in ("split", origin, day) if c in daily.columns],
        F.col("cancel_rate").alias("lag1_cancel_rate"),
        F.col("delay_rate").alias("lag1_delay_rate"),
        F.col("n").cast("double").alias("lag1_volume"),
        (F.col("n_cancelled") > 0).cast("double").alias("cancelled_yesterday"),
    )


def prior_day_features(
    df: DataFrame, per_split: bool = True, hot: HotKeys | Skew | None = None, source: DataFrame | None = None
) -> DataFrame:
    """Yesterday's rates and volume at the origin, from the same split; without a yesterday, training averages.

    ``per_split=False`` is the earlier variant: only training days are looked up, and the volume falls back
    to the mean over training rows that did have a yesterday.
    """
    keys = ["split", "Origin", "FlightDate"] if per_split else ["Origin", "FlightDate"]
    source = df if source is None else source
    source = source if per_split else in_scope(source, "train")
    daily = materialize(daily_stats(source, keys), "daily")  # one row per airport and day, read three times
    lag = lag_table(daily)
    n = F.sum("n")
    rates = (in_scope(daily, "train") if per_split else daily).agg(
        F.struct((F.sum("n_cancelled") / n).alias("cancel"), (F.sum("n_delayed") / n).alias("delay"))
    ).scalar()
    if per_split:
        volume = quantile_row(in_scope(daily, "train"), ["n"]).select("n").scalar()
    else:
        # a day's rows all see the same yesterday, so weigh each day by its own row count
        today = daily.select("Origin", "FlightDate", F.col("n").alias("_rows"))
        both = today.join(lag, ["Origin", "FlightDate"])
        volume = both.agg(F.sum(F.col("_rows") * F.col("lag1_volume")) / F.sum("_rows")).scalar()
    return join_back(
        df,
        lag,
        keys,
        {
            "lag1_cancel_rate": rates["cancel"],
            "lag1_delay_rate": rates["delay"],
            "lag1_volume": volume,
            "cancelled_yesterday": F.lit(0.0),
        },
        hot,
    )


def hourly_counts(df: DataFrame, scope: str = "train") -> DataFrame:
    return in_scope(df, scope).groupBy("Origin", "FlightDate", "dep_hour").agg(
        F.count("*").cast("double").alias("hourly_flights")
    )


def hourly_congestion(
    df: DataFrame, scope: str = "train", hot: HotKeys | Skew | None = None, source: DataFrame | None = None
) -> DataFrame:
    """Flights leaving the same airport in the same hour; 1 where unknown."""
    return join_back(
        df, hourly_counts(df if source is None else source, scope), ["Origin", "FlightDate", "dep_hour"], {"hourly_flights": F.lit(1.0)}, hot
    )


def cause_lag_table(df: DataFrame, scope: str = "train") -> DataFrame:
    """Last month's cause minutes by airport and month.

    The causes were attached per airport and month, so they are equal within a group; ``min`` picks the value,
    skips nulls and combines on the map side.
    """
    causes = [c for c in K.DELAY_CAUSES if c in df.columns]
    first = (
        in_scope(df, scope)
        .groupBy("Origin", F.year("FlightDate").alias("_year"), F.month("FlightDate").alias("_month"))
        .agg(*[F.min(c).alias(f"lag1m_{c}") for c in causes])
    )
    return prior_month(first, "_year", "_month")


def prior_month_causes(
    df: DataFrame, scope: str = "train", hot: HotKeys | Skew | None = None, source: DataFrame | None = None
) -> DataFrame:
    dated = df.withColumns({"_year": F.year("FlightDate"), "_month": F.month("FlightDate")})
    table = cause_lag_table(df if source is None else source, scope)
    zeros = {c: F.lit(0.0) for c in table.columns if c.startswith("lag1m_")}
    out = join_back(dated, table, ["Origin", "_year", "_month"], zeros, hot).drop("_year", "_month")
    absent = [f"lag1m_{c}" for c in K.DELAY_CAUSES if c not in df.columns]
    return out.withColumns({c: F.lit(0.0) for c in absent}) if absent else out


def prev_day_failure(df: DataFrame, hot: HotKeys | Skew | None = None, source: DataFrame | None = None) -> DataFrame:
    """1 if any flight failed on the origin's previous *recorded* day, however long ago; 0 on its first day.

    Only the airport-day table is ordered, never the flights.
    """
    days = (df if source is None else source).groupBy("Origin", "FlightDate").agg(
        F.max(F.greatest("is_cancelled", "is_delayed")).alias("_failed")
    )
    before = F.lag("_failed", 1, 0).over(Window.partitionBy("Origin").orderBy("FlightDate"))
    table = days.select("Origin", "FlightDate", before.alias("prev_day_failure_origin"))
    return join_back(df, table, ["Origin", "FlightDate"], {"prev_day_failure_origin": F.lit(0)}, hot)


def group_demean(
    df: DataFrame, key: str, c: str, out: str, hot: HotKeys | Skew | None = None, source: DataFrame | None = None
) -> DataFrame:
    """``c`` minus its group mean; the mean is aggregated and looked up, so no group lands in one task."""
    source = df if source is None else source
    means = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(c).alias("_mean"))
    return lookup(df, means, [key], hot).withColumn(out, F.col(c) - F.col("_mean")).drop("_mean")


# fixed values: the federal holidays as (name, first year, month, rule); a rule is a day of the month, or
# (weekday 1=Monday, occurrence) with -1 for the last one
FEDERAL_HOLIDAYS = [
    ("New Year's Day", 1870, 1, 1),
    ("Martin Luther King Jr. Day", 1986, 1, (1, 3)),
    ("Washington's Birthday", 1971, 2, (1, 3)),
    ("Memorial Day", 1971, 5, (1, -1)),
    ("Juneteenth National Independence Day", 2021, 6, 19),
    ("Independence Day", 1870, 7, 4),
    ("Labor Day", 1894, 9, (1, 1)),
    ("Columbus Day", 1971, 10, (1, 2)),
    ("Veterans Day", 1978, 11, 11),
    ("Thanksgiving Day", 1942, 11, (4, 4)),
    ("Christmas Day", 1870, 12, 25),
]


def holiday_dates(spark, first: int, last: int) -> DataFrame:
    """Federal holidays of the years ``first`` to ``last``, by rule: a fixed-date holiday on a Saturday is also
    observed on Friday, one on a Sunday on Monday (New Year's Day of the next year may fall on 31 December)."""
    years = spark.range(first, last + 2).select(F.col("id").cast("int").alias("y"))
    parts = []
    for name, since, month, rule in FEDERAL_HOLIDAYS:
        start = F.make_date("y", F.lit(month), F.lit(1))
        rows = years.where(F.col("y") >= since)
        if isinstance(rule, int):
            day = F.date_add(start, rule - 1)
            shift = F.when(F.weekday(day) == 5, -1).when(F.weekday(day) == 6, 1).otherwise(0)
            days = F.array_distinct(F.array(day, F.date_add(day, shift)))
        else:
            weekday, nth = rule
            into = F.pmod(F.lit(weekday - 1) - F.weekday(start), F.lit(7))
            day = F.date_add(start, into + 7 * (nth - 1))
            if nth < 0:
                end = F.last_day(start)
                day = F.date_add(end, -F.pmod(F.weekday(end) - (weekday - 1), F.lit(7)))
            days = F.array(day)
        parts.append(rows.select(F.explode(days).alias("holiday"), F.lit(name).alias("holiday_name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.year("holiday").between(first, last)).groupBy("holiday").agg(
        F.min("holiday_name").alias("holiday_name")
    )


def holiday_flag(df: DataFrame, c: str, holidays: DataFrame) -> DataFrame:
    """1 on a holiday; ``holidays`` has about a dozen rows per year."""
    marks = holidays.select(F.col("holiday").alias("_day"), F.lit(1).alias("is_holiday"))
    keyed = df.withColumn("_day", F.col(c).cast("date"))
    joined = keyed.join(marks, "_day", "left").drop("_day")
    return joined.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
