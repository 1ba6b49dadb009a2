"""Ranks, running totals, exact quantiles and exact-size cuts without a one-task sort.

A window with no partition sorts everything in one task, and a window over a key that holds a third of the
rows is almost as bad. The helpers below work in two levels: values are first put into ordered blocks, the
counts per block (a small table of bounded size) give each block's offset, and only then are rows ordered,
each block on its own. Everything is a lazy plan and depends on nothing random.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.casts import col
from contrail.session import materialize

STEPS_PER_OCTAVE = 256
OFFSET = 1_100 * STEPS_PER_OCTAVE  # keeps the exponent part positive over the whole double range
EVEN_STEPS = 1 << 16
HASH_BLOCKS_BITS = 16


def number_block(c: Column | str, low: Column | None = None, high: Column | None = None) -> Column:
    """Order-preserving block of a number.

    By magnitude: sign, exponent and eight further bits. Between ``low`` and ``high``, the range of the finite values, also
    by ``EVEN_STEPS`` even steps, which keep apart what is crowded into few magnitudes (times, years, numbers with an
    offset). Infinities are blocks at the ends. Both parts rise with the value, so there are at most
    2 * 2,200 * 256 + 3 + ``EVEN_STEPS`` blocks that hold something, whatever the data size.
    """
    v = col(c).cast("double")
    infinite = F.abs(v) == F.lit(float("inf"))
    size = F.floor(F.log2(F.when(~infinite, F.abs(v))) * STEPS_PER_OCTAVE) + F.lit(OFFSET)
    size = F.when(v == 0, F.lit(0)).when(infinite, F.lit(2 * OFFSET)).otherwise(size)
    block = F.when(v < 0, -size).otherwise(size).cast("long")
    if low is None:
        return block
    share = F.try_divide(v / 2 - low / 2, high / 2 - low / 2)  # halves, since the range itself may be too large
    step = F.floor(F.least(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * (EVEN_STEPS - 1))
    return block * EVEN_STEPS + F.when(infinite, 0).otherwise(step).cast("long")


def _window(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by) if by else Window.partitionBy()


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<s>`` (up to and including the row, ascending ``value``) and ``all_<s>`` for each sum column.

    ``df`` must hold one row per (by, value); ``value`` must not be null, but may be of any type that has an order. The rows are dealt
    out by ranges whose bounds Spark takes from a sample of them, so values crowded together or with one long prefix
    in common spread as evenly as others. The dealt rows are stored with their range's number, which is then the same for all that reads it.
    """
    by = list(by)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    parts = df.repartitionByRange(ranges, *by, value).withColumn("_block", F.spark_partition_id())
    parts = materialize(parts, "ranges")
    inside = Window.partitionBy(*by, "_block").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    earlier = _window(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = parts.groupBy(*by, "_block").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    blocks = blocks.select(
        *by,
        "_block",
        *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(_window(by)).alias(f"all_{s}") for s in sums],
    )
    local = parts.select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    out = local.join(blocks, [*by, "_block"])
    return out.select(
        *df.columns,
        *[(F.col(f"_before_{s}") + F.col(f"_in_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"all_{s}" for s in sums],
    )


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), kind: str = "double") -> DataFrame:
    """Rows (keep..., column, value), one per listed column; nulls and NaN are left out."""
    long = df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in cols
    ])).alias("_cell")).select(*keep, "_cell.column", "_cell.value").where("value is not null")
    return long.where(~F.isnan("value")) if kind == "double" else long


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    bounded_by: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (by..., column, p, q, n).

    Three passes over the input, none of which shuffles it: for the range of each column, for the number of rows in each value
    block, and for the values of the one or two blocks that hold each wanted rank. ``bounded_by`` says that the groups
    are few by nature (classes, flags), so the list of wanted blocks may be broadcast.
    """
    by = list(by)
    finite = [F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")) for c in cols]
    spans = df.agg(*[F.struct(F.lit(c).alias("column"), F.min(v).alias("_low"), F.max(v).alias("_high")).alias(f"_{i}") for i, (c, v) in enumerate(zip(cols, finite))])
    spans = spans.select(F.inline(F.array(*[f"_{i}" for i in range(len(cols))])))
    # one row per column; a scalar query per column and use would be planned some hundred times
    long = unpivot(df, cols, by).join(F.broadcast(spans), "column")
    long = long.select(*by, "column", "value", number_block("value", F.col("_low"), F.col("_high")).alias("_block"))
    group = [*by, "column"]
    blocks = long.groupBy(*group, "_block").agg(F.count("*").alias("_n"))
    ordered = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *group,
        "_block",
        "_n",
        F.coalesce(F.sum("_n").over(ordered), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("n"),
    )
    # which of the wanted ranks touch the block
    touched = [
        F.when((F.col("_before") <= F.ceil(_rank(p))) & (F.col("_before") + F.col("_n") > F.floor(_rank(p))), i)
        for i, p in enumerate(probs)
    ]
    spots = blocks.withColumn("_wanted", F.array_compact(F.array(*touched))).where(F.size("_wanted") > 0).drop("_n")
    if bounded_by or not by:
        spots = F.broadcast(spots)  # at most two rows per group, column and probability
    near = (
        long.join(spots, [*group, "_block"])
        .groupBy(*group, "_block", "_before", "n", "_wanted", "value")
        .agg(F.count("*").alias("_c"))
    )
    upto = Window.partitionBy(*group, "_block").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_before") + F.sum("_c").over(upto)
    found = near.select(*group, "value", "n", "_wanted", "_c", end.alias("_end")).select(
        *group, "value", "n", "_end", (F.col("_end") - F.col("_c")).alias("_start"), F.explode("_wanted").alias("_i")
    )
    found = found.withColumn("p", F.array(*[F.lit(float(p)) for p in probs])[F.col("_i")])
    at = _rank(F.col("p"))

    def value_at(place: Column) -> Column:
        return F.max(F.when((F.col("_start") <= place) & (F.col("_end") > place), F.col("value")))

    low, high, share = value_at(F.floor(at)), value_at(F.ceil(at)), F.max(at - F.floor(at))
    between = F.when((low == high) | (share == 0), low).otherwise(low + (high - low) * share)  # infinities have no middle
    return found.groupBy(*group, "p").agg(between.alias("q"), F.max("n").alias("n"))


def _rank(p: Column | float) -> Column:
    """Place of quantile ``p`` among ``n`` ordered rows, counted from 0."""
    return (F.col("n") - 1) * p


def quantile_row(df: DataFrame, cols: Sequence[str], p: float = 0.5) -> DataFrame:
    """One row holding the exact ``p`` quantile of each column under the column's own name."""
    found = exact_quantiles(df, cols, [p])
    return found.agg(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in cols])


def cut_by_hash(
    df: DataFrame,
    limits: Sequence[Callable[[Column], Column]],
    keys: Sequence[str],
    by: Sequence[str] = (),
    seed: int = 42,
    out: str = "part",
) -> DataFrame:
    """Cut each group into parts of exact size, in the order of a seeded hash of ``keys``.

    ``limits`` are ascending functions of the group's row count: part 0 holds the first ``limits[0]`` rows,
    part 1 those up to ``limits[1]``, and so on; the last part holds the rest. ``keys`` must identify a row.
    Only the hash blocks in which a cut falls (about one row in 65,536 each) are ever sorted; every other row
    learns its part by comparing block numbers.
    """
    by = list(by)
    group = by or ["_all"]
    rows = df.withColumns(
        {"_hash": F.xxhash64(F.lit(seed), *keys), **({} if by else {"_all": F.lit(0)})}
    ).withColumn("_block", F.shiftright("_hash", 64 - HASH_BLOCKS_BITS).cast("int"))
    counts = rows.groupBy(*group, "_block").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group)
    counts = counts.select(
        *group,
        "_block",
        "_c",
        F.sum("_c").over(w.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("_c").over(w).alias("_total"),
    )
    wanted = F.array(*[limit(F.col("_total")).cast("long") for limit in limits])
    room = F.col("_limit") - F.col("_upto") + F.col("_c")
    cuts = (
        counts.select("*", F.posexplode(wanted).alias("_i", "_limit"))
        .where("_upto > _limit")
        .groupBy(*group, "_i")
        .agg(F.min(F.struct("_block", room.alias("_room"))).alias("_cut"))
        .groupBy(*group)
        .agg(F.collect_list("_cut").alias("_cuts"))  # one entry per limit
    )
    if by:
        cuts = materialize(cuts, "cuts")  # one row for each group: broadcast by its size, so the rows stay where they are
        # null labels are a stratum of their own
        cuts = cuts.withColumnsRenamed({c: f"_of_{c}" for c in by})
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
        marked = rows.join(cuts, same, "left").drop(*[f"_of_{c}" for c in by])
    else:
        marked = rows.withColumn("_cuts", cuts.select("_cuts").scalar())
    has_cut = F.col("_cuts").isNotNull()
    on_cut = has_cut & F.exists("_cuts", lambda x: x["_block"] == F.col("_block"))

    def part(after: Callable[[Column], Column]) -> Column:
        return F.when(has_cut, F.size(F.filter("_cuts", after))).otherwise(0)

    plain = marked.where(~on_cut).withColumn(out, part(lambda x: F.col("_block") > x["_block"]))
    order = Window.partitionBy(*group, "_block").orderBy("_hash", *keys)
    edge = marked.where(on_cut).withColumn("_rank", F.row_number().over(order))
    edge = edge.withColumn(
        out,
        part(
            lambda x: (F.col("_block") > x["_block"])
            | ((F.col("_block") == x["_block"]) & (F.col("_rank") > x["_room"]))
        ),
    )
    return plain.select(*df.columns, out).unionByName(edge.select(*df.columns, out))


def keep_n(df: DataFrame, n: int, keys: Sequence[str], by: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """A random but repeatable subset of exactly ``n`` rows per group; smaller groups are kept whole."""
    cut = cut_by_hash(df, [lambda total: F.lit(n)], keys, by, seed, out="_part")
    return cut.where("_part = 0").select(*df.columns)
