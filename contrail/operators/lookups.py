"""Many-to-one joins that survive a hot key, and the key clean-up they need."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.session import materialize

SALT = "_salt_"


@dataclass(frozen=True)
class HotKeys:
    """Values of one column that hold a large share of the rows: never more than ``1 / share`` of them."""

    column: str
    values: tuple = field(default=())
    salts: int = 32  # of the largest value
    each: tuple = field(default=())  # salts of each value; all have ``salts`` where this is empty

    def salts_of(self) -> Column:
        """Number of salts of a row's key; 1 unless the key is hot."""
        pairs = [F.lit(x) for v, n in zip(self.values, self.each or [self.salts] * len(self.values)) for x in (v, n)]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(self.column)), F.lit(1))

    def renamed(self, column: str) -> HotKeys:
        return replace(self, column=column)


class Skew:
    """Hot values of a column that are looked for only once a join needs them, and then only once."""

    def __init__(self, column: str, find: Callable[[], HotKeys]):
        self.column, self._find = column, find

    @classmethod
    def of(cls, df: DataFrame, column: str, weight: str | None = None) -> Skew:
        return cls(column, lambda: find_hot(df, column, weight=weight))

    @cached_property
    def keys(self) -> HotKeys:
        return self._find()

    def renamed(self, column: str) -> Skew:
        return Skew(column, lambda: self.keys.renamed(column))


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of ``df``; of a stored table that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """Bytes up to which the planner broadcasts a side of a join."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` only reads files, so that its planned size is measured and not guessed."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() == "Project":
        plan = plan.child()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def fits_broadcast(df: DataFrame) -> tuple[bool, DataFrame]:
    """Whether ``df`` can be broadcast, by its measured size; and ``df``, stored if its size was not known."""
    limit = broadcast_limit(df)
    if planned_bytes(df) > limit and limit > 0 and not is_stored(df):
        df = materialize(df, "lookup")
    return planned_bytes(df) <= limit, df


def find_hot(
    df: DataFrame, column: str, share: float | None = None, salts: int | None = None, weight: str | None = None
) -> HotKeys:
    """Values of ``column`` holding at least ``share`` of the rows (of ``weight``, on a table of counts).

    By default a value is hot when it holds four times what a shuffle partition should, and it gets as many salts
    as partitions it should fill. One aggregate over a single column; at most ``1 / share``
    values reach the driver. Ask once, on the base table, and hand the answer to every later lookup.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    share = share or min(0.5, 4 / partitions)
    counts = df.groupBy(column).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    hot = counts.where(F.col("n") >= total * F.lit(share)).where(F.col(column).isNotNull())
    found = hot.select(column, (F.col("n") / total).alias("part")).collect()
    each = tuple(salts or max(2, math.ceil(float(r["part"]) * partitions)) for r in found)
    return HotKeys(column, tuple(r[0] for r in found), max(each, default=2), each)


def spread(df: DataFrame, hot: HotKeys, out: str = SALT) -> DataFrame:
    """Add the salt of each row: 0 unless its key is hot.

    The salt counts the rows of an input partition, so no other column is read and equal copies of a row are spread
    too.
    """
    return df.withColumn(out, F.pmod(F.monotonically_increasing_id(), hot.salts_of()).cast("int"))


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    hot: HotKeys | Skew | None = None,
    how: str = "left",
) -> DataFrame:
    """Join ``left`` with ``right``, which must be unique in ``on``; null keys match nothing.

    A ``right`` that is small enough by its measured size is broadcast, and a hot key does no harm; whether there are any is
    not even asked. Otherwise, with ``hot`` keys, left rows of a hot value are spread over salts (see ``spread``; a salt column already
    there is used as it is) and the right rows of just those values are repeated once per salt. Only a join on the
    hot column alone is salted: further columns spread its rows already. The repeated side is never broadcast, since
    the planner does not see how often it is repeated.
    """
    on = list(on)
    if not hot or on != [hot.column]:
        return left.join(right, on, how)
    small, right = fits_broadcast(right)
    hot = hot.keys if isinstance(hot, Skew) and not small else hot
    if small or not hot.values:
        return left.join(right, on, how)
    salt = f"{SALT}{hot.column}"
    keep = salt in left.columns
    salted = left if keep else spread(left, hot, salt)
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), hot.salts_of() - 1)))
    joined = salted.join(repeated.hint("merge"), [*on, salt], how)
    return joined if keep else joined.drop(salt)


def join_back(
    df: DataFrame,
    stats: DataFrame,
    on: Sequence[str],
    defaults: dict[str, Column],
    hot: HotKeys | Skew | None = None,
) -> DataFrame:
    """Attach statistics; where the group was never seen use the default (a literal or a scalar query)."""
    joined = lookup(df, stats, on, hot)
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the total order (order..., all other columns).

    A ``min`` over a struct combines on the map side, so a key with many copies sends one row per task.
    """
    rest = [c for c in order if c not in key] + [c for c in df.columns if c not in key and c not in order]
    first = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*key, *[F.col(f"_first.{c}") for c in rest]).select(*df.columns)


def prior_day(stats: DataFrame, day: str) -> DataFrame:
    """Shift so that joining on ``day`` finds the day before; a missing day stays missing."""
    return stats.withColumn(day, F.date_add(day, 1))


def prior_month(stats: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Shift so that joining on (year, month) finds the month before; December carries over to January."""
    last = F.col(month) == 12
    return stats.withColumns(
        {
            year: F.when(last, F.col(year) + 1).otherwise(F.col(year)),
            month: F.when(last, 1).otherwise(F.col(month) + 1),
        }
    )
