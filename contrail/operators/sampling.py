"""Exact-size samples, class balance and synthetic minority rows."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from decimal import Decimal
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.ordered import cut_by_hash, keep_n
from contrail.session import materialize

# The helpers below run in Python workers; sending them by value spares executors an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 2048  # points per neighbour-search group
MAX_PIVOTS = 1024
SLICE = 512  # rows of one distance matrix


def cap_per_group(df: DataFrame, key: str, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most ``n`` random rows per group; rows without a group are left out."""
    return keep_n(df.where(F.col(key).isNotNull()), n, keys, by=[key], seed=seed)


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows uniformly without replacement."""
    return keep_n(df, n, keys, seed=seed)


def stratified_split(
    df: DataFrame, label: str, fracs: Mapping[str, float], keys: Sequence[str], seed: int = 42
) -> DataFrame:
    """Add ``part``: each class is cut at the rounded cumulative fractions of its size, in seeded random order."""
    names = list(fracs)
    bounds = list(accumulate(Decimal(str(fracs[n])) for n in names))[:-1]  # exact, so that halves round up
    limits = [lambda total, b=b: F.round(total.cast("decimal(20,0)") * F.lit(b)) for b in bounds]
    cut = cut_by_hash(df, limits, keys, [label], seed, out="_part")
    return cut.withColumn("part", F.array(*[F.lit(n) for n in names])[F.col("_part")]).drop("_part")


def sample_multistage(
    df: DataFrame,
    total: int,
    keys: Sequence[str],
    label: str = "target",
    day: str = "FlightDate",
    origin: str = "Origin",
    region: str | None = "region",
    max_origin_frac: float = 0.05,
    max_region_frac: float = 0.30,
    seed: int = 42,
) -> DataFrame:
    """Balance months, cap origins, cap regions, then even out the classes.

    Each stage's cap depends on the size of the stage before, so stages are written out in between; only their
    row counts reach the driver. Rows without a region leave at the region stage.
    """
    dated = df.withColumn("month", F.date_format(day, "yyyy-MM"))
    months = dated.agg(F.count_distinct("month")).first()[0]
    stage = materialize(cap_per_group(dated, "month", max(1, total // max(1, months)), keys, seed), "months")
    for column, frac in ((origin, max_origin_frac), (region, max_region_frac)):
        if column and column in stage.columns:
            cap = int(stage.count() * frac)
            stage = materialize(cap_per_group(stage, column, cap, keys, seed), "capped")
    n, classes = stage.agg(F.count("*"), F.count_distinct(label)).first()
    return cap_per_group(stage, label, n // max(1, classes), keys, seed)


def undersample(df: DataFrame, label: str, ratio: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Keep the minority of a 0/1 label and cut the majority to ``int(minority / ratio)`` rows."""
    sizes = {bool(r[0]): r[1] for r in df.groupBy(label).count().collect()}
    minority = min(sizes, key=lambda v: (sizes[v], not v))
    small = F.col(label).cast("boolean") == minority
    kept = keep_n(df.where(~small), int(sizes[minority] / ratio), keys, seed=seed)
    return df.where(small).unionByName(kept)


def class_weights(df: DataFrame, label: str, how: str | Mapping = "balanced", out: str = "weight") -> DataFrame:
    """Row weight by class: ``n / (classes * n_class)``, ``neg / pos`` for positives, or given weights."""
    if not isinstance(how, str):
        chain = F
        for value, weight in how.items():
            chain = chain.when(F.col(label) == value, float(weight))
        return df.withColumn(out, chain.otherwise(1.0))
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    if how == "positive":
        neg = F.sum(F.when(F.col(label) == 0, F.col("_n")))
        pos = F.sum(F.when(F.col(label) == 1, F.col("_n")))
        ratio = counts.agg(neg / F.greatest(pos, F.lit(1))).scalar()
        return df.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(1.0))
    total = counts.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k"))).scalar()
    weights = counts.select(label, (total["n"] / (total["k"] * F.col("_n"))).alias(out))
    return df.join(F.broadcast(weights), label)  # one row per class


# --- synthetic minority rows ------------------------------------------------------------------


def _squared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between the rows of ``a`` and ``b``, and a bound on their rounding error per row of ``a``."""
    na, nb = (a * a).sum(1), (b * b).sum(1)
    gaps = na[:, None] + nb[None, :] - 2 * a @ b.T
    return np.maximum(gaps, 0.0), 1e-12 * (na + nb.max())


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, 0))


def _slices(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrow batches in pieces, so that a matrix of distances does not grow with both the batch and the pivots."""
    for pdf in batches:
        for start in range(0, len(pdf), SLICE):
            yield pdf.iloc[start : start + SLICE]


def nearest_neighbours(points: DataFrame, k: int, queries: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Exact ``k`` nearest points of every query point: (id, rank, near_id, distance).

    ``points`` has (id long, x array<double>); ``queries`` is a subset of it (all by default). Points are put
    in the cell of their nearest pivot. A query's own chunk gives an upper bound on its k-th distance, and by
    the triangle inequality only cells that can hold something closer are visited. Every search group holds
    at most about ``CHUNK`` points and as many queries, however uneven the cells are. Only the pivots and
    one row of statistics per cell reach the driver.
    """
    spark = points.sparkSession
    total = points.count()
    wanted = max(2, min(MAX_PIVOTS, total // CHUNK))
    chosen = keep_n(points, wanted, ["id"], seed=seed).orderBy("id").select("x").collect()
    pivots = np.array([r["x"] for r in chosen], dtype=float)

    def to_cells(batches):
        for pdf in _slices(batches):
            x = _matrix(pdf["x"])
            cell = _squared(x, pivots)[0].argmin(1)
            yield pdf.assign(cell=cell.astype("int32"), far=np.linalg.norm(x - pivots[cell], axis=1))

    placed = points.select("id", "x").mapInPandas(to_cells, "id long, x array<double>, cell int, far double")
    placed = materialize(placed, "cells")
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    chunks = {r["cell"]: max(1, -(-r["n"] // CHUNK)) for r in stats}
    radius = np.full(len(pivots), -np.inf)
    for r in stats:
        radius[r["cell"]] = r["radius"]

    per_cell = spark.createDataFrame(list(chunks.items()), "cell int, chunks int")
    chunked = placed.join(F.broadcast(per_cell), "cell").withColumn(  # at most MAX_PIVOTS rows
        "chunk", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("chunks")).cast("int")
    )
    ask = queries.select("id").withColumn("asks", F.lit(True)) if queries is not None else None
    asked = chunked.hint("merge").join(ask, "id", "left") if ask is not None else chunked.withColumn("asks", F.lit(True))

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        mine = pdf[pdf["asks"].eq(True)]
        if not len(mine):
            return mine[["id", "x", "cell"]].assign(limit=0.0)
        limits = []
        everyone, ids = _matrix(pdf["x"]), pdf["id"].to_numpy()
        for start in range(0, len(mine), SLICE):
            part = mine.iloc[start : start + SLICE]
            gap, slack = _squared(_matrix(part["x"]), everyone)
            gap[part["id"].to_numpy()[:, None] == ids[None, :]] = np.inf
            kth = np.partition(gap, k - 1, axis=1)[:, k - 1] if len(ids) > k else np.full(len(part), np.inf)
            limits.append(np.sqrt(kth + slack))
        return pd.DataFrame({"id": mine["id"], "x": mine["x"], "cell": mine["cell"], "limit": np.concatenate(limits)})

    bounded = asked.groupBy("cell", "chunk").applyInPandas(bound, "id long, x array<double>, cell int, limit double")

    def to_visits(batches):
        for pdf in _slices(batches):
            gap, slack = _squared(_matrix(pdf["x"]), pivots)
            nearest = np.sqrt(np.maximum(gap - slack[:, None], 0.0)) - radius[None, :] * (1 + 1e-9)
            reach = (nearest <= pdf["limit"].to_numpy()[:, None]) & np.isfinite(radius)[None, :]
            yield pd.DataFrame({"id": pdf["id"], "x": pdf["x"], "cells": [np.flatnonzero(r) for r in reach]})

    visits = bounded.mapInPandas(to_visits, "id long, x array<double>, cells array<int>")
    visits = materialize(visits, "visits")
    loads = visits.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()
    batches = [(r["cell"], max(1, -(-r["n"] // CHUNK))) for r in loads]
    per_visit = spark.createDataFrame(batches, "cell int, batches int")
    sizes = F.broadcast(per_cell.join(per_visit, "cell"))  # at most MAX_PIVOTS rows
    asking = (
        visits.select("id", "x", F.explode("cells").alias("cell"))
        .join(sizes, "cell")
        .withColumn("batch", F.pmod(F.xxhash64("id"), F.col("batches")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("cell", "chunk", "batch", "id", "x")
    )
    there = (
        chunked.drop("chunks")
        .join(sizes, "cell")
        .withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)))
        .select("cell", "chunk", "batch", "id", "x")
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return left[["id"]].assign(near_id=left["id"], distance=0.0).iloc[:0]
        found = []
        all_points, ids = _matrix(right["x"]), right["id"].to_numpy()
        take = min(k, len(ids))
        for start in range(0, len(left), SLICE):
            part = left.iloc[start : start + SLICE]
            x, mine = _matrix(part["x"]), part["id"].to_numpy()
            gap, slack = _squared(x, all_points)
            gap[mine[:, None] == ids[None, :]] = np.inf
            kth = np.partition(gap, take - 1, axis=1)[:, take - 1] + 2 * slack
            for i, limit in enumerate(kth):
                near = np.flatnonzero(gap[i] <= limit) if np.isfinite(limit) else np.flatnonzero(ids != mine[i])
                exact = np.sqrt(((all_points[near] - x[i]) ** 2).sum(1))
                order = np.lexsort((ids[near], exact))[:take]
                found.append((np.full(len(order), mine[i]), ids[near][order], exact[order]))
        return pd.DataFrame(dict(zip(("id", "near_id", "distance"), map(np.concatenate, zip(*found)))))

    key = ["cell", "chunk", "batch"]
    near = asking.groupBy(*key).cogroup(there.groupBy(*key)).applyInPandas(search, "id long, near_id long, distance double")
    best = Window.partitionBy("id").orderBy("distance", "near_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "id", "rank", "near_id", "distance"
    )


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    ratio: float = 1.0,
    k: int = 5,
    seed: int = 42,
    minority: int = 1,
    majority_n: int | None = None,
) -> DataFrame:
    """Add synthetic minority rows ``x + u * (neighbour - x)`` until there are ``int(ratio * majority)``.

    Returns (features..., label, synthetic, row_id, base, near, u). Every minority row is the base of ``q`` or ``q + 1``
    synthetic rows; the extra ones, the neighbour and ``u`` come from seeded hashes of its key, so the result does
    not depend on partitioning. Fewer than ``k + 1`` minority rows are an error if synthetic rows are needed. Tables with a row
    for each minority row are merged and never broadcast, since the driver would hold them whole, several at a time.
    """
    counts = df.groupBy((F.col(label) == minority).alias("m")).count().collect()
    sizes = {r["m"]: r["count"] for r in counts}
    n_min = sizes.get(True, 0)
    n_maj = sizes.get(False, 0) if majority_n is None else majority_n
    need = max(0, int(n_maj * ratio) - n_min)
    own = df.select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label).cast("int").alias(label),
        F.lit(0).alias("synthetic"),
        F.col(key).cast("string").alias("row_id"),
        F.lit(None).cast("long").alias("base"),
        F.lit(None).cast("long").alias("near"),
        F.lit(None).cast("double").alias("u"),
    )
    if need == 0:
        return own
    if n_min < 2:
        raise ValueError("at least two minority rows are needed")
    if n_min <= k:
        raise ValueError(f"{k} neighbours need more than {k} minority rows, there are {n_min}")
    points = df.where(F.col(label) == minority).select(
        F.col(key).cast("long").alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    )
    points = materialize(points, "minority")
    q, extra = divmod(need, n_min)
    more = keep_n(points.select("id"), extra, ["id"], seed=seed).withColumn("_more", F.lit(1))
    bases = points.select("id").hint("merge").join(more, "id", "left").withColumn("times", F.lit(q) + F.coalesce("_more", F.lit(0)))
    bases = materialize(bases.where("times > 0").select("id", "times"), "bases")
    near = nearest_neighbours(points, k, bases, seed)
    draws = bases.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "id",
        "j",
        (F.pmod(F.xxhash64(F.lit(seed), "id", "j"), F.lit(k)) + 1).cast("int").alias("rank"),
        (F.pmod(F.xxhash64(F.lit(seed + 1), "id", "j"), F.lit(1 << 30)) / float(1 << 30)).alias("u"),
    )
    picked = draws.hint("merge").join(near.select("id", "rank", "near_id"), ["id", "rank"])
    others = points.select(F.col("id").alias("near_id"), F.col("x").alias("y"))
    ends = picked.hint("merge").join(points, "id").hint("merge").join(others, "near_id")
    mixed = ends.withColumn("z", F.zip_with("x", "y", lambda a, b: a + (b - a) * F.col("u")))
    made = mixed.select(
        *[F.col("z")[i].alias(c) for i, c in enumerate(features)],
        F.lit(minority).alias(label),
        F.lit(1).alias("synthetic"),
        F.concat_ws(":", "id", "j").alias("row_id"),
        F.col("id").alias("base"),
        F.col("near_id").alias("near"),
        "u",
    )
    return own.unionByName(made)


def smote_all(
    df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """Raise every class to the size of the largest."""
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    top = max(sizes.values())
    parts = []
    for value in sorted(sizes):
        rows = df.where(F.col(label) == value)
        parts.append(smote(rows, features, label, key, 1.0, k, seed, minority=value, majority_n=top))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hybrid_resample(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    over: float = 0.3,
    under: float = 0.7,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Synthetic rows up to ``over``, then the majority cut until minority / majority is ``under``."""
    grown = smote(df, features, label, key, over, k, seed)
    grown = materialize(grown, "grown")
    return undersample(grown, label, under, ["row_id"], seed)


def resample(
    df: DataFrame, features: Sequence[str], label: str, key: str, over: float | None = None, under: float | None = None, seed: int = 42
) -> DataFrame:
    """Features and label after synthetic rows up to ``over`` and a cut of the majority to ``under``, each only if given."""
    if over is not None and under is not None:
        return hybrid_resample(df, features, label, key, over, under, seed=seed)
    if over is not None:
        return smote(df, features, label, key, over, seed=seed)
    own = df.select(key, label, *features)
    return own if under is None else undersample(own, label, under, [key], seed)
