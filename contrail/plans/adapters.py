"""Views that give the driver's tables the shapes of the flight tables.

The texts run unchanged in Spark and in DuckDB. ``with_views`` turns the ones a query needs into CTEs. The scores
of ``scored`` are computed in doubles throughout, because decimal literals give the two engines different ties.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS = {
    "flights": """
SELECT o_orderkey AS flight_id, CAST(o_orderdate AS DATE) AS FlightDate,
       DATE '2024-01-01' + CAST((year(o_orderdate) * 366 + dayofyear(o_orderdate)) % 30 AS INT) AS wx_date,
       o_orderpriority AS Airline, n_name AS Origin, r_name AS region,
       concat('NATION_', CAST((n_nationkey * 7 + o_orderkey) % 25 AS STRING)) AS Dest,
       CAST((o_orderkey % 25) * 100 + o_orderkey % 60 AS INT) AS CRSDepTime,
       (o_orderkey % 37 = 0) AS Cancelled,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL
            ELSE CAST((o_custkey * 31 + o_orderkey * 17) % 100 - 65 AS DOUBLE) END AS DepDelay,
       o_totalprice / 100 AS Distance
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
    "weather": """
SELECT n_name AS airport_code, r_name AS region, ts AS valid,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE 20 + least(value, 90) END AS tmpf,
       greatest(10 - value / 20, 0) AS vsby, value / 8 AS sknt,
       CASE WHEN event_type = 'view' THEN NULL ELSE value / 400 END AS p01i,
       least(value, 100) AS relh,
       CASE WHEN event_type IN ('error', 'click') THEN value / 5 END AS gust
FROM events JOIN nation ON n_nationkey = user_id % 30
JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20
""",
    "opsnet": """
SELECT n_name AS airport, CAST(l_shipdate AS DATE) AS ops_date, CAST(count(*) AS DOUBLE) AS airport_operations
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name, CAST(l_shipdate AS DATE)
""",
    "delay_cause": """
SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, l_returnflag AS carrier, n_name AS airport,
       sum(l_quantity) AS carrier_delay, sum(l_tax) AS weather_delay, sum(l_discount) AS nas_delay,
       CAST(count(*) AS DOUBLE) AS security_delay, sum(CAST(l_linenumber AS DOUBLE)) AS late_aircraft_delay
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY year(l_shipdate), month(l_shipdate), l_returnflag, n_name
""",
    "airports": """
SELECT s_suppkey AS id, concat('K_', s_name) AS ident,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE n_name END AS iata_code,
       CAST(s_suppkey * 0.5 AS DOUBLE) AS latitude_deg, CAST(s_suppkey * -0.5 AS DOUBLE) AS longitude_deg,
       s_acctbal AS elevation_ft, 'large_airport' AS type
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""",
    "runways": """
SELECT p_partkey AS id, concat('K_', s_name) AS airport_ident,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice * 5 END AS length_ft,
       CASE WHEN p_partkey % 17 = 0 THEN 1 WHEN p_partkey % 19 = 0 THEN NULL ELSE 0 END AS closed
FROM part JOIN supplier ON s_suppkey % 50 + 1 = p_size
""",
    "scored": """
SELECT flight_id, CASE WHEN Cancelled THEN 2 WHEN coalesce(DepDelay >= 15, FALSE) THEN 1 ELSE 0 END AS target,
       CAST((flight_id * 7919) % 1000 AS DOUBLE) / CAST(2000 AS DOUBLE) + CAST(CASE WHEN Cancelled THEN 0.3 ELSE 0.0 END AS DOUBLE) AS prob_cancel,
       CAST((flight_id * 104729) % 1000 AS DOUBLE) / CAST(1500 AS DOUBLE) + CAST(CASE WHEN coalesce(DepDelay >= 15, FALSE) THEN 0.2 ELSE 0.0 END AS DOUBLE) AS prob_delay
FROM flights
""",
}


# Views used on the SQL side only: what the library computes, written out again in SQL.
ORACLE_VIEWS = {
    "labelled": """
SELECT f.*, CAST(year(FlightDate) AS INT) AS yr, CAST(month(FlightDate) AS INT) AS mon,
       CASE WHEN Cancelled THEN 1 ELSE 0 END AS is_cancelled,
       CASE WHEN NOT Cancelled AND coalesce(DepDelay >= 15, FALSE) THEN 1 ELSE 0 END AS is_delayed,
       CASE WHEN NOT Cancelled AND NOT coalesce(DepDelay >= 15, FALSE) THEN 1 ELSE 0 END AS is_on_time,
       CASE WHEN Cancelled THEN 2 WHEN coalesce(DepDelay >= 15, FALSE) THEN 1 ELSE 0 END AS target,
       CASE WHEN Cancelled THEN 'cancelled' WHEN coalesce(DepDelay >= 15, FALSE) THEN 'delayed' ELSE 'on_time' END AS target_name,
       CAST(least(23, CRSDepTime // 100) AS INT) AS dep_hour
FROM flights AS f
""",
    "splits": """
SELECT *, CASE WHEN yr = 2000 THEN 'val' WHEN yr = 2001 THEN 'test' ELSE 'train' END AS split
FROM labelled WHERE yr IN (1995, 1996, 1998, 1999, 2000, 2001)
""",
    "hourly": """
SELECT airport_code, region, CAST(valid AS DATE) AS w_date, CAST(hour(valid) AS INT) AS w_hour,
       avg(tmpf) AS tmpf, avg(vsby) AS vsby, avg(sknt) AS sknt, sum(p01i) AS p01i, avg(relh) AS relh, max(gust) AS gust
FROM weather GROUP BY airport_code, region, CAST(valid AS DATE), hour(valid)
""",
    "region_hours": """
SELECT region, w_date, w_hour, avg(tmpf) AS tmpf, avg(vsby) AS vsby, avg(sknt) AS sknt, avg(p01i) AS p01i,
       avg(relh) AS relh, avg(gust) AS gust
FROM hourly GROUP BY region, w_date, w_hour
""",
    "merged": """
SELECT f.*, coalesce(h.tmpf, r.tmpf) AS tmpf, coalesce(h.vsby, r.vsby) AS vsby, coalesce(h.sknt, r.sknt) AS sknt,
       coalesce(h.p01i, r.p01i) AS p01i, coalesce(h.relh, r.relh) AS relh, coalesce(h.gust, r.gust) AS gust,
       CASE WHEN h.tmpf IS NOT NULL THEN 'airport_hour_match' WHEN r.tmpf IS NOT NULL THEN 'region_hour_match'
            ELSE 'still_missing' END AS weather_source
FROM labelled AS f
LEFT JOIN hourly AS h ON f.Origin = h.airport_code AND f.wx_date = h.w_date AND f.dep_hour = h.w_hour
LEFT JOIN region_hours AS r ON f.region = r.region AND f.wx_date = r.w_date AND f.dep_hour = r.w_hour
""",
    "causes_month": """
SELECT airport, year, month, sum(carrier_delay) AS carrier_delay, sum(weather_delay) AS weather_delay,
       sum(nas_delay) AS nas_delay, sum(security_delay) AS security_delay, sum(late_aircraft_delay) AS late_aircraft_delay
FROM delay_cause WHERE year BETWEEN 1995 AND 2001 AND year <> 1997 GROUP BY airport, year, month
""",
    "airport_dim": """
SELECT iata_code AS airport, latitude_deg AS airport_lat, longitude_deg AS airport_lon,
       elevation_ft AS airport_elevation, type AS airport_type
FROM airports WHERE iata_code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY iata_code ORDER BY id) = 1
""",
    "runway_dim": """
SELECT iata_code AS airport, count(*) AS num_runways, avg(length_ft) AS avg_runway_length_ft,
       max(length_ft) AS max_runway_length_ft
FROM runways JOIN airports ON airport_ident = ident
WHERE iata_code IS NOT NULL AND length_ft IS NOT NULL AND (closed IS NULL OR closed <> 1) GROUP BY iata_code
""",
    "final": """
SELECT m.*, o.airport_operations, c.carrier_delay, c.weather_delay, c.nas_delay, c.security_delay, c.late_aircraft_delay,
       a.airport_lat, a.airport_lon, a.airport_elevation, a.airport_type,
       w.num_runways, w.avg_runway_length_ft, w.max_runway_length_ft
FROM merged AS m
LEFT JOIN opsnet AS o ON m.Origin = o.airport AND m.FlightDate = o.ops_date
LEFT JOIN causes_month AS c ON m.Origin = c.airport AND m.yr = c.year AND m.mon = c.month
LEFT JOIN airport_dim AS a ON m.Origin = a.airport
LEFT JOIN runway_dim AS w ON m.Origin = w.airport
WHERE m.yr <> 1997
""",
}


def needed(sql: str) -> list[str]:
    """Views named in ``sql``, those they build on first."""
    out: list[str] = []
    for name, text in {**VIEWS, **ORACLE_VIEWS}.items():
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
            out += [v for v in [*needed(text), name] if v not in out]
    return out


def with_views(sql: str) -> str:
    """``sql`` with the views it names put in front as CTEs."""
    names = needed(sql)
    if not names:
        return sql
    every = {**VIEWS, **ORACLE_VIEWS}
    ctes = ",\n".join(f"{n} AS ({every[n].strip()})" for n in names)
    text = sql.strip()
    if text[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{text}"


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Adapter view ``name`` over the parquet tables of ``folder``."""
    text = with_views(f"SELECT * FROM {name}")
    for table in BASE_TABLES:
        text = re.sub(rf"\b(FROM|JOIN)\s+{table}\b", rf"\1 parquet.`{folder}/{table}.parquet` AS {table}", text)
    return spark.sql(text)
