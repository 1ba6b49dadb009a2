"""Classification metrics from one reduced table: never a second pass over the scores per threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions.values import ordinal_map
from contrail.operators.ordered import running_totals

CLASSES = sorted(K.TARGET_NAMES)


def cascade_predict(
    df: DataFrame,
    ta: float = 0.5,
    tb: float = 0.5,
    cancel: str = "prob_cancel",
    delay: str = "prob_delay",
    out: str = "prediction",
) -> DataFrame:
    """Cancelled when its score reaches ``ta``, else delayed when that score reaches ``tb``, else on time."""
    return df.withColumn(out, F.when(F.col(cancel) >= ta, 2).when(F.col(delay) >= tb, 1).otherwise(0))


def decode(df: DataFrame, c: str = "prediction", out: str = "Prediction") -> DataFrame:
    """Class name of a class code. ``out`` may differ from ``c`` only by case, so the code is replaced."""
    rest = [x for x in df.columns if x.lower() != out.lower()]
    return df.select(*rest, ordinal_map(c, K.TARGET_NAMES).alias(out))


def prediction_counts(df: DataFrame, c: str = "Prediction") -> DataFrame:
    return df.groupBy(c).agg(F.count("*").alias("n"))


def confusion(
    df: DataFrame,
    label: str = "target",
    pred: str = "prediction",
    classes: Sequence[int] = tuple(CLASSES),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Count and row share of every (label, prediction) cell, empty cells included."""
    counts = df.groupBy(*keys, label, pred).agg(F.count("*").alias("n"))
    cells = [(a, b) for a in classes for b in classes]
    wide = counts.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when((F.col(label) == a) & (F.col(pred) == b), F.col("n"))), F.lit(0)).alias(f"c_{a}_{b}")
        for a, b in cells
    ])
    rows = {a: sum((F.col(f"c_{a}_{b}") for b in classes), F.lit(0)) for a in classes}
    long = wide.select(
        *keys,
        F.explode(F.array(*[
            F.struct(
                F.lit(a).alias("label"),
                F.lit(b).alias("prediction"),
                F.col(f"c_{a}_{b}").alias("n"),
                F.when(rows[a] > 0, F.col(f"c_{a}_{b}") / rows[a]).otherwise(0.0).alias("share"),
            )
            for a, b in cells
        ])).alias("c"),
    )
    return long.select(*keys, "c.*")


def per_class(cells: DataFrame, keys: Sequence[str] = (), n: str = "n") -> DataFrame:
    """Precision, recall, F1 and support per class from (label, prediction, n) rows; 0 where undefined."""
    roles = cells.select(
        *keys,
        n,
        F.explode(F.array(
            F.struct(F.col("label").alias("class"), F.lit("label").alias("role")),
            F.struct(F.col("prediction").alias("class"), F.lit("prediction").alias("role")),
        )).alias("r"),
        (F.col("label") == F.col("prediction")).alias("hit"),
    )
    count = F.col(n)
    sums = roles.groupBy(*keys, "r.class").agg(
        F.coalesce(F.sum(F.when(F.col("r.role") == "label", count)), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(F.col("r.role") == "prediction", count)), F.lit(0)).alias("predicted"),
        F.coalesce(F.sum(F.when(F.col("hit") & (F.col("r.role") == "label"), count)), F.lit(0)).alias("hits"),
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    f1 = F.when(
        F.col("support") + F.col("predicted") > 0, 2 * F.col("hits") / (F.col("support") + F.col("predicted"))
    ).otherwise(0.0)
    return sums.select(
        *keys, "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "predicted"
    )


def scalar_metrics(classes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy, their gap, and macro and weighted averages.

    Macro averages run over classes seen among labels or predictions; balanced accuracy over labels only.
    """
    seen = classes.where("support > 0 or predicted > 0")
    total = F.sum("support")
    weighted = {c: F.sum(F.col(c) * F.col("support")) / total for c in ("precision", "recall", "f1")}
    balanced = F.avg(F.when(F.col("support") > 0, F.col("recall")))
    return seen.groupBy(*keys).agg(
        weighted["recall"].alias("accuracy"),
        balanced.alias("balanced_accuracy"),
        (weighted["recall"] - balanced).alias("gap"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[e.alias(f"weighted_{c}") for c, e in weighted.items()],
        total.alias("n"),
    )


def outcome_counts(df: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): all that the class metrics need."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages: (name, precision, recall, f1, support)."""
    classes = per_class(outcome_counts(df, label, pred))
    one = scalar_metrics(classes)
    rows = classes.select(F.col("class").cast("string").alias("name"), "precision", "recall", "f1", "support")
    averages = one.select(F.explode(F.array(
        F.struct(
            F.lit("accuracy").alias("name"),
            *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1")],
            F.col("n").alias("support"),
        ),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("name"),
                *[F.col(f"{kind}_{c}").alias(c) for c in ("precision", "recall", "f1")],
                F.col("n").alias("support"),
            )
            for kind in ("macro", "weighted")
        ],
    )).alias("r")).select("r.*")
    return rows.unionByName(averages)


def summary_metrics(df: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    return scalar_metrics(per_class(outcome_counts(df, label, pred)))


def _passed(score: str, grid: Sequence[int]):
    """How many of the ascending thresholds (in hundredths) the score reaches."""
    return sum(((F.col(score) >= t / 100).cast("int") for t in grid), F.lit(0))


def threshold_sweep(
    df: DataFrame,
    tas: Sequence[int] = tuple(K.TUNED_GRID[0]),
    tbs: Sequence[int] = tuple(K.TUNED_GRID[1]),
    label: str = "target",
    cancel: str = "prob_cancel",
    delay: str = "prob_delay",
    by: Sequence[str] = (),
) -> DataFrame:
    """Metrics of every threshold pair (thresholds in hundredths), for each group of ``by``.

    A row's outcome at every pair depends only on how many thresholds each score passes, so rows are counted
    by (label, passed_a, passed_b) first: at most 3 * (len(tas) + 1) * (len(tbs) + 1) groups, one small shuffle.
    The grid is laid over those counts, not over the rows.
    """
    tas, tbs = sorted(tas), sorted(tbs)
    passed = df.groupBy(
        *by, F.col(label).alias("label"), _passed(cancel, tas).alias("a"), _passed(delay, tbs).alias("b")
    ).agg(F.count("*").alias("n"))
    grid = F.array(*[
        F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"), F.lit(ta / 100).alias("ta"), F.lit(tb / 100).alias("tb"))
        for i, ta in enumerate(tas)
        for j, tb in enumerate(tbs)
    ])
    laid = passed.withColumn("g", F.explode(grid)).select(
        *by,
        F.col("g.ta").alias("thresh_a"),
        F.col("g.tb").alias("thresh_b"),
        "label",
        F.when(F.col("a") >= F.col("g.i"), 2).when(F.col("b") >= F.col("g.j"), 1).otherwise(0).alias("prediction"),
        "n",
    )
    keys = [*by, "thresh_a", "thresh_b"]
    cells = laid.groupBy(*keys, "label", "prediction").agg(F.sum("n").alias("n"))
    classes = per_class(cells, keys).where("support > 0 or predicted > 0")

    def of(c: str, value: int):
        return F.coalesce(F.max(F.when(F.col("class") == value, F.col(c))), F.lit(0.0))

    return classes.groupBy(*keys).agg(
        F.round(F.avg("f1"), 4).alias("macro_f1"),
        F.round(of("recall", 0), 3).alias("ontime_recall"),
        F.round(of("recall", 1), 3).alias("delayed_recall"),
        F.round(of("recall", 2), 3).alias("cancelled_recall"),
        F.round(of("precision", 2), 3).alias("cancelled_precision"),
        F.round(of("f1", 1), 4).alias("delayed_f1"),
        F.round(of("f1", 2), 4).alias("cancelled_f1"),
    )


def delay_sweep(df: DataFrame, tbs: Sequence[int] = tuple(K.DELAY_ONLY_GRID), **names: str) -> DataFrame:
    """Sweep of the delay threshold with the cancel threshold at one half."""
    return threshold_sweep(df, [50], tbs, **names)


def best_pair(sweep: DataFrame) -> DataFrame:
    """The pair with the highest macro F1; ties go to the lower thresholds."""
    return sweep.orderBy(F.desc("macro_f1"), "thresh_a", "thresh_b").limit(1)


def best_vs_default(val: DataFrame, test: DataFrame, tas=None, tbs=None, **names: str) -> DataFrame:
    """Choose thresholds on ``val``, then compare them with one half each on ``test``."""
    tas = tas or K.TUNED_GRID[0]
    tbs = tbs or K.TUNED_GRID[1]
    best = best_pair(threshold_sweep(val, tas, tbs, **names)).select("thresh_a", "thresh_b").first()
    rows = []
    for name, ta, tb in (("default", 0.5, 0.5), ("tuned", best["thresh_a"], best["thresh_b"])):
        scored = cascade_predict(test, ta, tb)
        rows.append(
            summary_metrics(scored).select(
                F.lit(name).alias("model"),
                F.lit(ta).alias("thresh_a"),
                F.lit(tb).alias("thresh_b"),
                F.round("macro_f1", 4).alias("macro_f1"),
            )
        )
    return rows[0].unionByName(rows[1])


def score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores, descending totals: rows and positives at or above each score."""
    ties = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    run = running_totals(ties, "score", ["n", "pos"])
    return run.select(
        "score",
        "n",
        "pos",
        F.col("all_n").alias("total"),
        F.col("all_pos").alias("positives"),
        (F.col("all_n") - F.col("cum_n") + F.col("n")).alias("taken"),
        (F.col("all_pos") - F.col("cum_pos") + F.col("pos")).alias("hits"),
    )


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum over distinct scores of the recall gained times the precision there; 0 without positives."""
    t = score_table(df, score, label)
    return t.agg(
        F.coalesce(
            F.sum(F.when(F.col("positives") > 0, F.col("pos") / F.col("positives") * F.col("hits") / F.col("taken"))),
            F.lit(0.0),
        ).alias("average_precision")
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half; null for a single class."""
    t = score_table(df, score, label)
    neg = F.col("n") - F.col("pos")
    above = F.col("hits") - F.col("pos")
    area = F.sum(neg.cast("double") * (above + F.col("pos") / 2))
    pairs = F.max(F.col("positives").cast("double") * (F.col("total") - F.col("positives")))
    return t.agg(F.when(pairs > 0, area / pairs).alias("roc_auc"))


def best_f1_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """The score at which predicting positive from there up gives the highest F1; ties go to the higher score."""
    f1 = 2 * F.col("hits") / (F.col("taken") + F.col("positives"))
    best = score_table(df, score, label).select("score", f1.alias("f1")).orderBy(F.desc("f1"), F.desc("score")).limit(1)
    return best.select(F.col("score").alias("best_threshold"), F.col("f1").alias("best_f1"))


def score_summary(df: DataFrame, score: str, label: str) -> DataFrame:
    """Average precision, ROC area, best F1 and its threshold in one row, from one table of distinct scores."""
    neg = F.col("n") - F.col("pos")
    pairs = F.max(F.col("positives").cast("double") * (F.col("total") - F.col("positives")))
    area = F.sum(neg.cast("double") * (F.col("hits") - F.col("pos") / 2))
    gained = F.when(F.col("positives") > 0, F.col("pos") / F.col("positives") * F.col("hits") / F.col("taken"))
    f1 = 2 * F.col("hits") / (F.col("taken") + F.col("positives"))
    best = F.max(F.struct(f1.alias("f1"), "score"))
    return score_table(df, score, label).agg(
        F.coalesce(F.sum(gained), F.lit(0.0)).alias("pr_auc"),
        F.when(pairs > 0, area / pairs).alias("roc_auc"),
        best["f1"].alias("best_f1"),
        best["score"].alias("best_threshold"),
    )


def f1_at(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """F1 of the positive class when predicting positive from ``threshold`` up."""
    y, p = F.col(label).cast("long"), (F.col(score) >= threshold).cast("long")
    total = F.sum(y) + F.sum(p)
    return df.agg(F.when(total > 0, 2 * F.sum(y * p) / total).otherwise(0.0).alias("f1"))


def rank_trials(trials: DataFrame, by: str = "val_pr_auc", floor: tuple[str, float] | None = None) -> DataFrame:
    """Trials best first; with ``floor`` = (metric, minimum) only those above the minimum."""
    kept = trials.where(F.col(floor[0]) > floor[1]) if floor else trials
    return kept.orderBy(F.desc(by), *[c for c in ("trial", "thresh_a", "thresh_b", "name") if c in trials.columns])


def compare_runs(runs: DataFrame, metric: str = "test_macro_f1") -> DataFrame:
    """Runs with their rank by ``metric`` and the gain over the best run listed before (by ``step``).

    A list of runs is a handful of rows.
    """
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select(
        "*",
        F.rank().over(Window.orderBy(F.desc(metric))).alias("place"),
        (F.col(metric) - F.max(metric).over(before)).alias("gain"),
    )
