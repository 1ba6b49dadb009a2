"""Association of features with the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.lookups import HotKeys, lookup
from contrail.operators.ordered import running_totals, unpivot
from contrail.session import materialize


def corr_with(df: DataFrame, cols: Sequence[str], y: str, min_non_null: int = 0) -> DataFrame:
    """Pearson correlation of each column with ``y`` over rows where both are present."""
    one = df.agg(
        *[F.corr(F.col(c).cast("double"), F.col(y).cast("double")).alias(f"r_{c}") for c in cols],
        *[F.count(c).alias(f"n_{c}") for c in cols],
    )
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"r_{c}").alias("r"), F.col(f"n_{c}").alias("n")) for c in cols
    ])
    out = one.select(F.explode(cells).alias("c")).select("c.*").where(F.col("n") > min_non_null)
    return out.withColumn("abs_r", F.abs("r"))


def average_ranks(weighted: DataFrame, cols: Sequence[str], weight: str) -> DataFrame:
    """Average rank of every distinct value of every column: (column, value, n, avg_rank)."""
    values = unpivot(weighted, cols, [weight]).groupBy("column", "value").agg(F.sum(weight).alias("n"))
    run = running_totals(values, "value", ["n"], by=["column"])
    return run.select(
        "column", "value", "n", "all_n", (F.col("cum_n") - (F.col("n") - 1) / 2).alias("avg_rank")
    )


def spearman(
    df: DataFrame, xs: Sequence[str], ys: Sequence[str] = (), complete: Sequence[str] | None = None, share: float = 0.01
) -> DataFrame:
    """Rank correlation of every x with every y (with every x when no ``ys``) over complete rows.

    Equal rows are merged first and carried as a weight. Values that hold more than ``share`` of the rows (no
    rain, calm wind) are at most ``1 / share`` per column; their rows are spread before the rank lookup.
    """
    cols = list(dict.fromkeys([*xs, *ys]))
    kept = df.dropna(subset=list(complete or xs)).select(*[F.col(c).cast("double").alias(c) for c in cols])
    kept = kept.dropna(subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("_w"))
    kept = materialize(kept, "rows")  # read once per column below
    ranks = materialize(average_ranks(kept, cols, "_w"), "ranks")
    common = ranks.where(F.col("n") >= F.lit(share) * F.col("all_n")).select("column", "value").collect()
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranked = kept
    for c in cols:
        side = ranks.where(F.col("column") == c).select(F.col("value").alias(c), F.col("avg_rank").alias(f"_r_{c}"))
        hot = HotKeys(c, tuple(r["value"] for r in common if r["column"] == c), salts)
        ranked = lookup(ranked, side, [c], hot)
    pairs = [(x, y) for x in xs for y in (ys or xs)]
    w = F.col("_w")
    mean = {c: F.sum(w * F.col(f"_r_{c}")) / F.sum(w) for c in cols}

    def moment(a: str, b: str):
        return F.sum(w * F.col(f"_r_{a}") * F.col(f"_r_{b}")) / F.sum(w) - mean[a] * mean[b]

    one = ranked.agg(*[
        F.try_divide(moment(x, y), F.sqrt(moment(x, x) * moment(y, y))).alias(f"p{i}") for i, (x, y) in enumerate(pairs)
    ])
    cells = F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"p{i}").alias("rho"))
        for i, (x, y) in enumerate(pairs)
    ])
    return one.select(F.explode(cells).alias("c")).select("c.*")


def anova_f(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """One-way F of each numeric feature over the classes of ``y``; nulls count as 0."""
    zero = df.select(y, *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in xs])
    groups = unpivot(zero, xs, [y]).groupBy("column", y).agg(
        F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v")
    )
    each = Window.partitionBy("column")  # one row per class
    mean = F.sum(F.col("n") * F.col("m")).over(each) / F.sum("n").over(each)
    groups = groups.withColumn("off", F.col("m") - mean)
    n, k = F.sum("n"), F.count("*")
    between = F.sum(F.col("n") * F.col("off") * F.col("off"))
    within = F.sum(F.col("n") * F.col("v"))
    return groups.groupBy("column").agg(F.try_divide(F.try_divide(between, k - 1), F.try_divide(within, n - k)).alias("f"))


def cramers_v(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Bias-corrected Cramér's V of each categorical column with ``y``.

    Cells without rows add their expectation to chi-squared; the sum over all cells is found from the filled
    ones alone, as ``n * (sum(o^2 / (row * column)) - 1)``, so no grid is built. A two-by-two table gets the
    continuity correction.
    """
    kept = df.where(F.col(y).isNotNull())
    cell = unpivot(kept, cols, [y], kind="string").groupBy("column", "value", y).agg(
        F.count("*").cast("double").alias("o")  # products of counts outgrow a long
    )
    by_row = cell.groupBy("column", "value").agg(F.sum("o").alias("r"))
    by_col = cell.groupBy("column", y).agg(F.sum("o").alias("c"))
    sizes = by_row.groupBy("column").agg(F.count("*").alias("rows"), F.sum("r").alias("n")).join(
        by_col.groupBy("column").agg(F.count("*").alias("cols")), "column"
    )
    terms = cell.join(by_row, ["column", "value"]).join(by_col, ["column", y])
    chi = terms.groupBy("column").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("t"),
        F.max(F.struct("o", "r", "c")).alias("any"),
    )
    n, r, k = F.col("n"), F.col("rows"), F.col("cols")
    plain = n * (F.col("t") - 1)
    # in a two-by-two table every |observed - expected| is the same number d, and chi-squared = d^2 * sum(1 / expected)
    gap = F.abs(F.col("any.o") - F.col("any.r") * F.col("any.c") / n)
    corrected = F.when(gap > 0, plain * F.pow((gap - F.least(F.lit(0.5), gap)) / gap, 2)).otherwise(0.0)
    chi2 = F.when((r == 2) & (k == 2), corrected).otherwise(plain)
    phi = F.greatest(F.lit(0.0), chi2 / n - F.try_divide((k - 1) * (r - 1), n - 1))
    rows_adj, cols_adj = r - F.try_divide((r - 1) * (r - 1), n - 1), k - F.try_divide((k - 1) * (k - 1), n - 1)
    v = F.sqrt(F.try_divide(phi, F.least(rows_adj - 1, cols_adj - 1)))
    return chi.join(sizes, "column").select("column", v.alias("v"))


def rank_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str, k: int | None = None) -> DataFrame:
    """F values and V values in one descending list; the two scales are not comparable, as in the original."""
    both = anova_f(df, numeric, y).select("column", F.col("f").alias("score")).unionByName(
        cramers_v(df, categorical, y).select("column", F.col("v").alias("score"))
    )
    ordered = both.orderBy(F.desc("score"), "column")
    return ordered.limit(k) if k else ordered
