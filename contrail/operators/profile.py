"""Descriptive tables: rates, distributions, missingness, quantiles, time series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.functions.values import bin_equal_width, bin_right_closed
from contrail.operators.ordered import exact_quantiles, unpivot

DISTANCE_EDGES = [0, 250, 500, 750, 1000, 1500, 2000, 3000, 6000]
RAIN_EDGES = [0, 0.01, 0.1, 0.5, 1.0, float("inf")]
RAIN_LABELS = ["0-0.01", "0.01-0.1", "0.1-0.5", "0.5-1.0", ">1.0"]
WEEK = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
CLASSES = ["on_time", "delayed", "cancelled"]


def rate_by(
    df: DataFrame, keys: Sequence[str | Column], min_n: int = 0, rates: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows, delay rate and cancel rate per group."""
    rates = rates or {"delay_rate": "is_delayed", "cancel_rate": "is_cancelled"}
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(y).alias(name) for name, y in rates.items()])
    return out.where(F.col("n") >= min_n) if min_n else out


def top_k(df: DataFrame, c: str, k: int, desc: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``c``; each task keeps its own ``k`` and only those are merged."""
    return df.orderBy(F.desc(c) if desc else F.asc(c), *ties).limit(k)


def top_groups(df: DataFrame, keys: Sequence[str], metric: str, min_n: int = 50, k: int = 10) -> DataFrame:
    """Groups of at least ``min_n`` rows with the highest ``metric`` (a rate, or ``n``)."""
    return top_k(rate_by(df, keys, min_n), metric, k, ties=keys)


def busiest_by_rate(df: DataFrame, key: str, metric: str, k: int = 20) -> DataFrame:
    """The ``k`` largest groups, ordered by ``metric``."""
    return top_k(rate_by(df, [key]), "n", k, ties=[key]).orderBy(F.desc(metric), key)


def filter_to_top(df: DataFrame, c: str, k: int) -> DataFrame:
    """Rows whose ``c`` is among its ``k`` most frequent values."""
    top = value_counts(df.where(F.col(c).isNotNull()), c).orderBy(F.desc("n"), c).limit(k)
    return df.join(F.broadcast(top.select(c)), c, "left_semi")  # k rows


def value_counts(df: DataFrame, c: str, share: bool = False) -> DataFrame:
    counts = df.groupBy(c).agg(F.count("*").alias("n"))
    if not share:
        return counts
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """Largest class over smallest, and the class counts behind it."""
    return value_counts(df, label).agg(
        F.max("n").alias("largest"), F.min("n").alias("smallest"), (F.max("n") / F.min("n")).alias("ratio")
    )


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives over positives of a 0/1 label."""
    pos = F.sum(F.col(label).cast("long"))
    return df.agg((F.count(label) - pos).alias("negatives"), pos.alias("positives")).withColumn(
        "pos_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))
    )


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence | None = None, normalize: str | None = None
) -> DataFrame:
    """Contingency table.

    With ``values`` (the known few categories) it is wide, one column per value; without, it is long, so an
    open set of categories never becomes columns. ``normalize`` is None, ``'all'`` or ``'index'``.
    """
    counts = df.where(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row, column).agg(
        F.count("*").alias("n")
    )
    if normalize == "all":
        total = counts.agg(F.sum("n")).scalar()
        counts = counts.select(row, column, (F.col("n") / total).alias("n"))
    elif normalize == "index":
        sums = counts.groupBy(row).agg(F.sum("n").alias("_n"))
        counts = counts.join(sums, row).select(row, column, (F.col("n") / F.col("_n")).alias("n"))
    if values is None:
        return counts
    return counts.groupBy(row).agg(
        *[F.coalesce(F.sum(F.when(F.col(column) == v, F.col("n"))), F.lit(0)).alias(str(v)) for v in values]
    )


def missingness(df: DataFrame, above: float | None = None) -> DataFrame:
    """Type, null count and null percentage of every column, from one pass."""
    one = df.agg(F.count("*").alias("n"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), (F.col("n") - F.col(f"c{i}")).alias("n_null"))
        for i, (c, t) in enumerate(df.dtypes)
    ])
    out = one.select("n", F.explode(cells).alias("c")).select("c.*", "n")
    out = out.withColumn("missing_pct", 100 * F.col("n_null") / F.greatest(F.col("n"), F.lit(1)))
    return out.where(F.col("missing_pct") > above) if above is not None else out


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns, and the number of columns of each type."""
    types: dict[str, int] = {}
    for _, t in df.dtypes:
        types[t] = types.get(t, 0) + 1
    cells = F.array(*[F.struct(F.lit(t).alias("dtype"), F.lit(n).alias("n_columns")) for t, n in types.items()])
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.explode(cells).alias("c")).select("n_rows", "c.*")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    moments = unpivot(df, cols).groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    wide = q.groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    return moments.join(wide, "column")


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    if approx:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_unique")) for c in cols])
        return one.select(F.explode(cells).alias("c")).select("c.*")
    pairs = unpivot(df, cols, kind="string").groupBy("column", "value").agg(F.lit(1).alias("_one"))
    return pairs.groupBy("column").agg(F.count("*").alias("n_unique"))


def binned_delay(df: DataFrame) -> DataFrame:
    """Coverage and mean delay by distance bin, cancelled flights left out."""
    kept = df.where("is_cancelled = 0 and Distance is not null")
    binned = kept.withColumn("dist_bin", bin_right_closed("Distance", DISTANCE_EDGES, include_lowest=True))
    delays = [c for c in ("DepDelay", "ArrDelay") if c in df.columns]
    out = binned.where("dist_bin is not null").groupBy("dist_bin").agg(
        F.count("*").alias("n_all"),
        *[F.count(c).alias(f"{c}_nonnull") for c in delays],
        *[F.avg(c).alias(f"mean_{c}") for c in delays],
    )
    return out.withColumns(
        {f"{c}_coverage_pct": F.bround(100 * F.col(f"{c}_nonnull") / F.col("n_all"), 2) for c in delays}
    )


def flag_impact(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How common each flag is, the class mix when it is set, and the overall rates as a baseline row."""
    labels = ("is_on_time", "is_delayed", "is_cancelled")
    cells = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("on")) for f in flags],
                    F.struct(F.lit("baseline").alias("flag"), F.lit(1).alias("on")))
    long = df.select(F.explode(cells).alias("c"), *labels).select("c.*", *labels)
    return long.groupBy("flag").agg(
        F.avg("on").alias("prevalence"), *[F.avg(F.when(F.col("on") == 1, F.col(y))).alias(y) for y in labels]
    )


def interaction_rates(df: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """Label rate in the cells of two flags, with margins (null in the place of the flag left out)."""
    return df.cube(a, b).agg(F.count("*").alias("n"), F.avg(label).alias("rate"))


def histogram(df: DataFrame, c: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """Counts in equal-width bins, left-closed, the last closed on both sides; empty bins are shown."""
    kept = df.where(F.col(c).isNotNull() & ~F.isnan(c))
    if low is None or high is None:
        ends = kept.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
        lo, hi = ends["lo"], ends["hi"]
    else:
        lo, hi = F.lit(float(low)), F.lit(float(high))
    width = (hi - lo) / bins
    inside = kept.where(F.col(c).between(lo, hi))
    counts = inside.groupBy(
        F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col(c) - lo, width)).cast("int"), F.lit(0))).alias("bin")
    ).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("left_edge"),
        (lo + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, c: str, by: str) -> DataFrame:
    """Quartiles, spread and whiskers (furthest values within 1.5 spreads of the box) per class."""
    q = exact_quantiles(df, [c], [0.25, 0.5, 0.75], by=[by])
    box = q.groupBy(by).agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    near = df.join(box, by).where(
        F.col(c).between(F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr"))
    )
    whiskers = near.groupBy(by).agg(F.min(c).alias("whisker_low"), F.max(c).alias("whisker_high"))
    return box.join(whiskers, by)


def delay_vs_visibility(df: DataFrame) -> DataFrame:
    """Delay rate and visibility, scaled to its own maximum, by departure hour."""
    hours = df.groupBy("dep_hour").agg(F.avg("is_delayed").alias("delay_rate"), F.avg("vsby").alias("_v"))
    top = hours.agg(F.max("_v")).scalar()
    return hours.select("dep_hour", "delay_rate", F.try_divide("_v", top).alias("visibility"))


def split_summary(df: DataFrame, keys: Sequence[str] = ("split",), day: str = "FlightDate") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        (F.avg("is_cancelled") * 100).alias("cancel_pct"),
        (F.avg("is_delayed") * 100).alias("delay_pct"),
        (F.avg("is_on_time") * 100).alias("on_time_pct"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def row_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows per parquet table; counts come from file footers, no column is read."""
    parts = [
        spark.read.parquet(p).groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name, p in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reindex(df: DataFrame, c: str, order: Sequence) -> DataFrame:
    """Every entry of ``order`` in its place; entries absent from ``df`` get nulls."""
    dim = df.sparkSession.createDataFrame(list(enumerate(order)), f"position int, {c} {dict(df.dtypes)[c]}")
    return dim.join(df, c, "left")


def rates_by_class_bins(df: DataFrame, c: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Class mix, in percent, within right-closed bins of ``c``."""
    binned = df.withColumn("bin", bin_right_closed(c, edges, labels, include_lowest=True))
    mix = crosstab(binned, "bin", "target_name", values=CLASSES, normalize="index")
    return mix.select("bin", *[(F.col(k) * 100).alias(k) for k in CLASSES])


def rates_by_equal_bins(df: DataFrame, c: str, bins: int, label: str) -> DataFrame:
    """Label rate in ``bins`` equal-width intervals over the range of ``c``."""
    ends = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
    binned = df.withColumn("bin", bin_equal_width(c, ends["lo"], ends["hi"], bins)).where("bin is not null")
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.avg(label).alias("rate"))


def acf(series: DataFrame, value: str, order: str, nlags: int = 30) -> DataFrame:
    """Autocorrelation by position, nulls dropped first, with the simple 95 % bound.

    ``series`` has one row per step (a day), so its length is bounded by the calendar, not by the flights.
    """
    kept = series.where(F.col(value).isNotNull() & ~F.isnan(value))
    mean = kept.agg(F.avg(value)).scalar()
    steps = kept.select(
        F.row_number().over(Window.orderBy(order)).alias("i"), (F.col(value) - mean).alias("x")
    )
    total = kept.agg(F.struct(F.count("*").alias("n"), (F.var_pop(value) * F.count(value)).alias("ss"))).scalar()
    ahead = steps.select(F.explode(F.sequence(F.lit(0), F.lit(nlags))).alias("lag"), "i", F.col("x").alias("x0"))
    ahead = ahead.select("lag", "x0", (F.col("i") + F.col("lag")).alias("i"))
    pairs = ahead.join(steps, "i").groupBy("lag").agg(F.sum(F.col("x0") * F.col("x")).alias("c"))
    return pairs.select(
        "lag", F.try_divide("c", total["ss"]).alias("acf"), (F.lit(1.96) / F.sqrt(total["n"])).alias("bound")
    )


def pacf(series: DataFrame, value: str, order: str, nlags: int = 30) -> DataFrame:
    """Partial autocorrelation: Durbin-Levinson on the ``nlags + 1`` autocorrelations."""
    r = [row["acf"] for row in acf(series, value, order, nlags).orderBy("lag").collect()]
    partial, phi = [1.0], []
    if None in r:  # a constant series
        return series.sparkSession.createDataFrame([(k, None) for k in range(len(r))], "lag int, pacf double")
    for k in range(1, len(r)):
        top = r[k] - sum(p * r[k - 1 - j] for j, p in enumerate(phi))
        bottom = 1 - sum(p * r[j + 1] for j, p in enumerate(phi))
        last = top / bottom
        phi = [p - last * q for p, q in zip(phi, reversed(phi))] + [last]
        partial.append(last)
    return series.sparkSession.createDataFrame(list(enumerate(partial)), "lag int, pacf double")
