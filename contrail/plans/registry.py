"""Registered queries: a DataFrame function, the SQL that must agree with it, and the columns of both.

A column spec is a list of ``name:kind`` with kind ``s`` text, ``i`` integer, ``f`` number rounded to six
places, ``d`` date. It is applied to both sides, so names and types are the same by construction.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.plans.adapters import with_views

SPARK_KINDS = {"s": "string", "i": "bigint", "f": "double", "d": "date"}
SQL_KINDS = {"s": "VARCHAR", "i": "BIGINT", "f": "DOUBLE", "d": "DATE"}
DIGITS = 6
NUDGE = 1e-9  # added before rounding, so that a value halfway between two results rounds the same way on both sides


@dataclass(frozen=True)
class Query:
    name: str
    spec: tuple[tuple[str, str], ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        """The DataFrame with the columns of the spec."""
        cols = []
        for name, kind in self.spec:
            c = F.col(name).cast(SPARK_KINDS[kind])
            cols.append((F.round(c + F.lit(NUDGE), DIGITS) + F.lit(0.0) if kind == "f" else c).alias(name))
        return self.build(spark, folder).select(*cols)

    def oracle(self) -> str:
        """The SQL with the same names, types and rounding."""
        cols = []
        for name, kind in self.spec:
            c = f'CAST("{name}" AS {SQL_KINDS[kind]})'
            cols.append((f"round({c} + {NUDGE}, {DIGITS}) + 0.0" if kind == "f" else c) + f' AS "{name}"')
        return f"SELECT {', '.join(cols)}\nFROM (\n{with_views(self.sql)}\n) AS q"


QUERIES: dict[str, Query] = {}


def query(name: str, spec: str, sql: str | None = None):
    """Register the decorated function under ``name``."""
    columns = tuple(tuple(part.split(":")) for part in spec.split())

    def keep(build):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = Query(name, columns, build, sql)
        return build

    return keep
