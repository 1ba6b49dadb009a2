"""Binning, encodings, ratios and text keys."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.casts import col


def bin_right_closed(
    c: Column | str,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    include_lowest: bool = False,
) -> Column:
    """Label of the interval ``(edge, next]`` holding ``c``; null outside. The first may be closed below."""
    value = col(c)
    names = list(labels) if labels else [f"({a:g}, {b:g}]" for a, b in zip(edges, edges[1:])]
    if len(names) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    chain = None
    for i, (low, high, name) in enumerate(zip(edges, edges[1:], names)):
        above = value >= low if include_lowest and i == 0 else value > low
        hit = above if math.isinf(high) else above & (value <= high)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return F.when(F.isnan(value), None).otherwise(chain)


def bin_equal_width(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """0-based index of ``bins`` equal intervals over [low, high], closed on the right, the first closed below."""
    value = col(c)
    place = F.coalesce(F.ceil(F.try_divide(value - low, (high - low) / bins)).cast("int"), F.lit(1)) - 1
    return F.when(value.between(low, high), F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)))


def cyclic(c: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the position of ``c`` on a circle of length ``period``."""
    angle = col(c) * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def ordinal_map(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Value of ``mapping`` at ``c``, else ``default``."""
    chain = reduce(lambda w, kv: w.when(col(c) == kv[0], F.lit(kv[1])), mapping.items(), F)
    return chain.otherwise(F.lit(default))


def interactions(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: F.col(a) * F.col(b) for name, (a, b) in pairs.items()})


def canon_city(c: Column | str) -> Column:
    """``CITY, st`` to ``City, ST``; any other number of parts keeps only the first, in title case."""
    parts = F.split(col(c), ", ")
    runs = F.regexp_extract_all(F.lower(parts[0]), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    title = F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substring(run, F.lit(2), F.length(run)))), ""
    )
    return F.when(F.size(parts) == 2, F.concat(title, F.lit(", "), F.upper(F.get(parts, F.lit(1))))).otherwise(title)


def route_key(origin: Column | str, dest: Column | str) -> Column:
    return F.concat(col(origin), F.lit(" → "), col(dest))


def short_name(c: Column | str, longest: int = 12) -> Column:
    """First word of a name longer than ``longest`` characters, else the name."""
    return F.when(F.length(col(c)) > longest, F.split(F.trim(col(c)), r"\s+")[0]).otherwise(col(c))


def has_value(c: Column | str) -> Column:
    return col(c).isNotNull().cast("int")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / max(den, 1)``, 0 when either is missing."""
    ratio = F.when(col(den).isNotNull(), col(num) / F.greatest(F.lit(1.0), col(den)))
    return F.coalesce(ratio, F.lit(0.0))
