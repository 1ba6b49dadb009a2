"""Adapter tables in the form the operators expect; shared by the query modules.

The adapter views stand in for tables that a user has as files, so each is stored once per session and folder, and the
queries scan it like any table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.casts import hhmm_hour
from contrail.operators.clean import label_flights, temporal_split
from contrail.operators.weather import enrich_with_fallback, hourly_weather, region_hourly
from contrail.plans.adapters import view
from contrail.session import materialize

# the adapter's year roles, in place of the flight data's own
YEARS = {"train": [1995, 1996, 1998, 1999], "val": [2000], "test": [2001]}
YEARS_OUT = [1997]
CAUSE_YEARS = (1995, 2001)

HOLIDAY_SQL = """
WITH d AS (SELECT DISTINCT FlightDate AS d, month(FlightDate) AS m, day(FlightDate) AS k, isodow(FlightDate) AS w FROM flights)
SELECT d AS FlightDate, CASE
  WHEN (m, k) IN ((1, 1), (7, 4), (11, 11), (12, 25)) THEN 1
  WHEN w = 5 AND (m, k) IN ((12, 31), (7, 3), (11, 10), (12, 24)) THEN 1
  WHEN w = 1 AND (m, k) IN ((1, 2), (7, 5), (11, 12), (12, 26)) THEN 1
  WHEN w = 1 AND m = 1 AND k BETWEEN 15 AND 21 THEN 1
  WHEN w = 1 AND m = 2 AND k BETWEEN 15 AND 21 THEN 1
  WHEN w = 1 AND m = 5 AND k >= 25 THEN 1
  WHEN w = 1 AND m = 9 AND k <= 7 THEN 1
  WHEN w = 1 AND m = 10 AND k BETWEEN 8 AND 14 THEN 1
  WHEN w = 4 AND m = 11 AND k BETWEEN 22 AND 28 THEN 1 ELSE 0 END AS is_holiday FROM d"""

_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STORED:
        _STORED[key] = materialize(view(spark, folder, name), name)
    return _STORED[key]


def flights(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "flights")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return label_flights(flights(spark, folder)).withColumn("dep_hour", hhmm_hour("CRSDepTime"))


def splits(spark: SparkSession, folder: str) -> DataFrame:
    return temporal_split(labelled(spark, folder), YEARS)


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "weather")


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return hourly_weather(weather(spark, folder), carry=["region"])


def merged(spark: SparkSession, folder: str) -> DataFrame:
    hours = hourly(spark, folder)
    return enrich_with_fallback(
        labelled(spark, folder), hours.drop("region"), region_hourly(hours), day="wx_date"
    )


def opsnet(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "opsnet").withColumnRenamed("ops_date", "date")


def table(name: str):
    def load(spark: SparkSession, folder: str) -> DataFrame:
        return stored(spark, folder, name)

    return load


causes = table("delay_cause")
airports = table("airports")


def runways(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the runways view. Its join makes many times the rows of both its tables, so they are not stored but flow
    into what reads them. Columns of one table are computed before the join, and both tables, however few files they come
    in, are dealt over the tasks, rows of one size side by side, so that whichever side is not broadcast is spread."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    part = parquet(spark, folder, "part").selectExpr(
        "p_size", "p_partkey AS id", "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice * 5 END AS length_ft",
        "CASE WHEN p_partkey % 17 = 0 THEN 1 WHEN p_partkey % 19 = 0 THEN NULL ELSE 0 END AS closed",
    )
    ends = parquet(spark, folder, "supplier").selectExpr("s_suppkey % 50 + 1 AS p_size", "concat('K_', s_name) AS airport_ident")
    part, ends = part.repartitionByRange(tasks, "p_size", "id"), ends.repartitionByRange(tasks, "p_size", "airport_ident")
    return part.join(ends, "p_size").select("id", "airport_ident", "length_ft", "closed")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "scored").withColumns(
        {"is_cancelled": (F.col("target") == 2).cast("int"), "is_delayed": (F.col("target") == 1).cast("int")}
    )


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
