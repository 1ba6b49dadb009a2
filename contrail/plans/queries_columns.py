"""Queries over sources, guards and column expressions (A*, P*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions import casts, flags, values
from contrail.operators import clean, features, profile
from contrail.operators.lookups import find_hot
from contrail.plans import base
from contrail.plans.registry import query
from contrail.session import shared_dir
from contrail.sources import tables, traffic_report


def scratch(spark, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# --- sources -------------------------------------------------------------------------------------


@query("a1_schema_guard", "station:s n:i no_gust:f", """
SELECT airport_code AS station, count(*) AS n, sum(0.5) AS no_gust FROM weather GROUP BY airport_code""")
def _(spark, folder):
    df = clean.require_columns(base.weather(spark, folder), ["airport_code", "valid"])
    df = clean.optional_columns(df, {"no_such_measure": 0.5, "tmpf": -1.0})
    return df.groupBy(F.col("airport_code").alias("station")).agg(
        F.count("*").alias("n"), F.sum("no_such_measure").alias("no_gust")
    )


@query("a2_read_table", "o_orderpriority:s n:i total:f", """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def _(spark, folder):
    df = tables.read_table(
        spark, f"{folder}/orders.parquet", ["o_orderpriority", "o_totalprice", "absent"], required=["o_orderkey"]
    )
    return df.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("o_totalprice").cast("decimal(38,9)")).cast("double"), 2).alias("total")
    )


@query("a3_load_split", "flight_id:i FlightDate:d Origin:s target:i",
       "SELECT flight_id, FlightDate, Origin, target FROM splits WHERE split = 'val'")
def _(spark, folder):
    path = scratch(spark, "splits")
    tables.write_table(base.splits(spark, folder), path, ["split"])
    return tables.load_split(spark, path, "val", ["flight_id", "FlightDate", "Origin", "target", "absent"])


@query("a4_read_csv", "id:i ident:s iata_code:s elevation_ft:f",
       "SELECT id, ident, iata_code, elevation_ft FROM airports")
def _(spark, folder):
    path = scratch(spark, "airports")
    source = base.airports(spark, folder)
    source.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, source.schema, ["id", "ident", "iata_code", "elevation_ft"])


@query("a5_traffic_report", "date:d airport:s airport_operations:f", """
SELECT ops_date AS date, airport, airport_operations FROM opsnet""")
def _(spark, folder):
    path = scratch(spark, "report")
    cells = F.concat(
        F.lit("<tr><td>"), F.date_format("date", "MM/dd/yyyy"), F.lit("</td><td> "), F.col("airport"),
        F.lit(" </td><td>1</td><td>"), F.format_number("airport_operations", 0), F.lit("</td></tr>"),
        # every row is followed by a subtotal, as the report does per facility
        F.lit("<tr><td>Sub-Total for "), F.col("airport"), F.lit("</td><td></td><td>1</td><td>9</td></tr>"),
    )
    head = spark.read.parquet(f"{folder}/region.parquet").where("r_regionkey = 0").select(F.lit(
        "<table><tr><th>x</th><th>x</th><th colspan='2'>Operations</th></tr>"
        "<tr><th>Date</th><th>Facility</th><th>Air Carrier</th><th>Total Operations</th></tr>"
    ))
    body = base.opsnet(spark, folder).select(cells)
    head.union(body).coalesce(4).write.text(path)
    return traffic_report.read_traffic_report(spark, path)


@query("a6_write_table", "split:s n:i delayed:i",
       "SELECT split, count(*) AS n, sum(is_delayed) AS delayed FROM splits GROUP BY split")
def _(spark, folder):
    path = scratch(spark, "modeling")
    tables.write_table(base.splits(spark, folder), path, ["split"])
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"), F.sum("is_delayed").alias("delayed"))


@query("a7_row_id", "n:i first:i last:i ids:i",
       "SELECT count(*) AS n, 0 AS first, count(*) - 1 AS last, count(*) AS ids FROM orders")
def _(spark, folder):
    df = tables.with_row_id(base.parquet(spark, folder, "orders").select("o_orderkey"))
    return df.agg(
        F.count("*").alias("n"), F.min("ID").alias("first"), F.max("ID").alias("last"), F.count_distinct("ID").alias("ids")
    )


# --- casts and keys ------------------------------------------------------------------------------


@query("p1_lenient_cast", "o_orderkey:i num:f day:d", """
SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS DOUBLE) AS num,
       TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN '13/45/2020' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATE) AS day
FROM orders""")
def _(spark, folder):
    df = base.parquet(spark, folder, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_orderkey").cast("string"))
    day = F.when(F.col("o_orderkey") % 5 == 0, "13/45/2020").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return df.select("o_orderkey", casts.to_num(text).alias("num"), casts.to_date(day).alias("day"))


@query("p2_norm_code", "c_custkey:i code:s",
       "SELECT c_custkey, upper(trim(concat('  ', lower(c_mktsegment), ' '))) AS code FROM customer")
def _(spark, folder):
    messy = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return base.parquet(spark, folder, "customer").select("c_custkey", casts.norm_code(messy).alias("code"))


@query("p3_hhmm_hour", "CRSDepTime:i hour:i raw_hour:i inside:i n:i", """
SELECT CRSDepTime, least(23, greatest(0, CRSDepTime // 100)) AS hour, CRSDepTime // 100 AS raw_hour,
       CASE WHEN CRSDepTime // 100 BETWEEN 0 AND 23 THEN 1 ELSE 0 END AS inside, count(*) AS n
FROM flights GROUP BY CRSDepTime""")
def _(spark, folder):
    times = base.flights(spark, folder).groupBy("CRSDepTime").agg(F.count("*").alias("n"))
    raw = casts.hhmm_hour("CRSDepTime", clip=False)
    return times.select(
        "CRSDepTime", "n", casts.hhmm_hour("CRSDepTime").alias("hour"), raw.alias("raw_hour"),
        casts.in_hours(raw).cast("int").alias("inside"),
    )


@query("p4_calendar", "f_date:d year:i quarter:i month:i day_of_month:i iso_dow:i day_of_week:i day_name:s month_name:s is_weekend:i period:s n:i", """
SELECT FlightDate AS f_date, year(FlightDate) AS year, quarter(FlightDate) AS quarter, month(FlightDate) AS month,
       day(FlightDate) AS day_of_month, isodow(FlightDate) AS iso_dow, isodow(FlightDate) - 1 AS day_of_week,
       dayname(FlightDate) AS day_name, monthname(FlightDate) AS month_name,
       CASE WHEN isodow(FlightDate) >= 6 THEN 1 ELSE 0 END AS is_weekend, strftime(FlightDate, '%Y-%m') AS period, count(*) AS n
FROM flights GROUP BY FlightDate""")
def _(spark, folder):
    return casts.calendar(base.flights(spark, folder).groupBy("FlightDate").agg(F.count("*").alias("n")))


@query("p5_scope_filter", "Origin:s yr:i n:i", """
SELECT Origin, year(FlightDate) AS yr, count(*) AS n FROM flights
WHERE year(FlightDate) <> 1997 AND Origin <> 'NATION_3' GROUP BY 1, 2""")
def _(spark, folder):
    df = clean.exclude_years(base.flights(spark, folder), "FlightDate", base.YEARS_OUT)
    df = clean.drop_null(clean.exclude_values(df, "Origin", ["NATION_3"]), ["FlightDate", "Origin"])
    return df.groupBy("Origin", F.year("FlightDate").alias("yr")).agg(F.count("*").alias("n"))


@query("p6_label_flights", "flight_id:i is_cancelled:i is_delayed:i is_on_time:i target:i target_name:s",
       "SELECT flight_id, is_cancelled, is_delayed, is_on_time, target, target_name FROM labelled")
def _(spark, folder):
    return base.labelled(spark, folder)


@query("p7_bin_right_closed", "bin:s n:i lowest:f highest:f", """
SELECT CASE WHEN Distance >= 0 AND Distance <= 250 THEN '(0, 250]' WHEN Distance > 250 AND Distance <= 500 THEN '(250, 500]'
            WHEN Distance > 500 AND Distance <= 1000 THEN '(500, 1000]' WHEN Distance > 1000 AND Distance <= 3000 THEN '(1000, 3000]' END AS bin,
       count(*) AS n, min(Distance) AS lowest, max(Distance) AS highest FROM flights GROUP BY 1""")
def _(spark, folder):
    bins = values.bin_right_closed("Distance", [0, 250, 500, 1000, 3000], include_lowest=True)
    return base.flights(spark, folder).groupBy(bins.alias("bin")).agg(
        F.count("*").alias("n"), F.min("Distance").alias("lowest"), F.max("Distance").alias("highest")
    )


@query("p7_bin_equal_width", "bin:i n:i rate:f", """
SELECT bin, count(*) AS n, avg(is_cancelled) AS rate FROM (
  SELECT is_cancelled, least(4, greatest(0, CAST(ceil((Distance - lo) / ((hi - lo) / 5)) AS INT) - 1)) AS bin
  FROM labelled, (SELECT min(Distance) AS lo, max(Distance) AS hi FROM flights)) GROUP BY bin""")
def _(spark, folder):
    return profile.rates_by_equal_bins(base.labelled(spark, folder), "Distance", 5, "is_cancelled")


@query("p8_drop_leakage", "flight_id:i FlightDate:d Airline:s Origin:s Dest:s CRSDepTime:i Distance:f columns:s", """
SELECT flight_id, FlightDate, Airline, Origin, Dest, CRSDepTime, Distance,
       'flight_id,FlightDate,wx_date,Airline,Origin,region,Dest,CRSDepTime,Distance' AS columns FROM flights""")
def _(spark, folder):
    df = clean.drop_leakage(base.flights(spark, folder))
    return df.withColumn("columns", F.lit(",".join(df.columns)))


@query("p9_cyclic", "f_date:d month_sin:f month_cos:f dow_sin:f dow_cos:f", """
SELECT DISTINCT FlightDate AS f_date, sin(2 * pi() * month(FlightDate) / 12) AS month_sin, cos(2 * pi() * month(FlightDate) / 12) AS month_cos,
       sin(2 * pi() * isodow(FlightDate) / 7) AS dow_sin, cos(2 * pi() * isodow(FlightDate) / 7) AS dow_cos FROM flights""")
def _(spark, folder):
    df = casts.calendar(base.flights(spark, folder).select("FlightDate").distinct())
    (ms, mc), (ds, dc) = values.cyclic("month", 12), values.cyclic("iso_dow", 7)
    return df.select("f_date", ms.alias("month_sin"), mc.alias("month_cos"), ds.alias("dow_sin"), dc.alias("dow_cos"))


@query("p9_cyclic_hour", "dep_hour:i hour_sin:f hour_cos:f n:i", """
SELECT dep_hour, sin(2 * pi() * dep_hour / 24) AS hour_sin, cos(2 * pi() * dep_hour / 24) AS hour_cos, count(*) AS n
FROM labelled GROUP BY dep_hour""")
def _(spark, folder):
    hours = base.labelled(spark, folder).groupBy("dep_hour").agg(F.count("*").alias("n"))
    hour_sin, hour_cos = values.cyclic("dep_hour", 24)
    return hours.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos})


@query("p10_time_flags", "dep_hour:i n:i early:i evening:i morning_peak:i evening_peak:i red_eye:i forest_morning:i forest_evening:i", """
SELECT dep_hour, count(*) AS n, CASE WHEN dep_hour IN (5, 6, 7) THEN 1 ELSE 0 END AS early,
       CASE WHEN dep_hour >= 18 THEN 1 ELSE 0 END AS evening,
       CASE WHEN dep_hour BETWEEN 8 AND 11 THEN 1 ELSE 0 END AS morning_peak,
       CASE WHEN dep_hour BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS evening_peak,
       CASE WHEN dep_hour <= 4 THEN 1 ELSE 0 END AS red_eye,
       CASE WHEN dep_hour BETWEEN 6 AND 9 THEN 1 ELSE 0 END AS forest_morning,
       CASE WHEN dep_hour BETWEEN 17 AND 23 THEN 1 ELSE 0 END AS forest_evening
FROM labelled GROUP BY dep_hour""")
def _(spark, folder):
    hours = base.labelled(spark, folder).groupBy("dep_hour").agg(F.count("*").alias("n"))
    df = flags.time_flags(hours).withColumnsRenamed({
        "is_early_morning": "early", "is_evening": "evening", "is_morning_peak": "morning_peak",
        "is_evening_peak": "evening_peak", "is_red_eye": "red_eye"})
    return flags.time_flags(df, peaks="forest").withColumnsRenamed(
        {"is_morning_peak": "forest_morning", "is_evening_peak": "forest_evening"}
    )


@query("p11_season_flags", "month:i n:i is_summer:i is_holiday_season:i is_winter:i", """
SELECT mon AS month, count(*) AS n, CASE WHEN mon IN (6, 7, 8) THEN 1 ELSE 0 END AS is_summer,
       CASE WHEN mon IN (11, 12, 1) THEN 1 ELSE 0 END AS is_holiday_season,
       CASE WHEN mon IN (12, 1, 2) THEN 1 ELSE 0 END AS is_winter FROM labelled GROUP BY mon""")
def _(spark, folder):
    months = base.flights(spark, folder).groupBy(F.month("FlightDate").alias("month")).agg(F.count("*").alias("n"))
    return flags.season_flags(months)


@query("p12_weather_flags", "airport_code:s high_wind:i extreme_wind:i wind_gust_severe:i low_visibility:i very_low_visibility:i freezing:i has_precip:i heavy_rain:i very_heavy_rain:i precip_light:i precip_moderate:i precip_heavy:i", """
SELECT airport_code, count_if(sknt > 20) AS high_wind, count_if(sknt > 30) AS extreme_wind, count_if(gust > 35) AS wind_gust_severe,
       count_if(vsby < 3) AS low_visibility, count_if(vsby < 1) AS very_low_visibility, count_if(tmpf < 32) AS freezing,
       count_if(p01i > 0) AS has_precip, count_if(p01i > 0.5) AS heavy_rain, count_if(p01i > 1) AS very_heavy_rain,
       count_if(p01i > 0 AND p01i <= 0.1) AS precip_light, count_if(p01i > 0.1 AND p01i <= 0.5) AS precip_moderate,
       count_if(p01i > 0.5) AS precip_heavy FROM weather GROUP BY airport_code""")
def _(spark, folder):
    df = flags.weather_flags(base.weather(spark, folder))
    names = ["high_wind", "extreme_wind", "wind_gust_severe", "low_visibility", "very_low_visibility", "freezing",
             "has_precip", "heavy_rain", "very_heavy_rain", "precip_light", "precip_moderate", "precip_heavy"]
    return df.groupBy("airport_code").agg(*[F.sum(n).alias(n) for n in names])


@query("p12_weather_flags_linear", "airport_code:s high_wind:i precip_light:i precip_moderate:i precip_heavy:i", """
SELECT airport_code, count_if(sknt > 20 OR coalesce(gust, 0) > 35) AS high_wind, count_if(p01i >= 0.01 AND p01i < 0.1) AS precip_light,
       count_if(p01i >= 0.1 AND p01i < 0.5) AS precip_moderate, count_if(p01i >= 0.5) AS precip_heavy FROM weather GROUP BY airport_code""")
def _(spark, folder):
    df = flags.weather_flags(base.weather(spark, folder), style="linear")
    names = ["high_wind", "precip_light", "precip_moderate", "precip_heavy"]
    return df.groupBy("airport_code").agg(*[F.sum(n).alias(n) for n in names])


@query("p13_weather_severity", "airport_code:s mean:f highest:f", """
SELECT airport_code, avg(s) AS mean, max(s) AS highest FROM (
  SELECT airport_code, (coalesce(sknt, 0) / 30 + coalesce(gust, 0) / 50 + (1 - coalesce(vsby, 10) / 10) + least(coalesce(p01i, 0), 2) / 2) / 4 AS s
  FROM weather) GROUP BY airport_code""")
def _(spark, folder):
    df = base.weather(spark, folder).withColumn("s", flags.weather_severity())
    return df.groupBy("airport_code").agg(F.avg("s").alias("mean"), F.max("s").alias("highest"))


@query("p14_fill_const", "airport_code:s gust:f p01i:f vsby:f", """
SELECT airport_code, avg(coalesce(gust, 0)) AS gust, avg(coalesce(p01i, 0)) AS p01i, avg(coalesce(vsby, 10)) AS vsby
FROM weather GROUP BY airport_code""")
def _(spark, folder):
    df = clean.fill_const(base.weather(spark, folder), flags.CALM)
    return df.groupBy("airport_code").agg(*[F.avg(c).alias(c) for c in ("gust", "p01i", "vsby")])


@query("p15_fill_stat", "flight_id:i delay_median:f delay_mean:f", """
SELECT flight_id, coalesce(DepDelay, (SELECT quantile_cont(DepDelay, 0.5) FROM splits WHERE split = 'train')) AS delay_median,
       coalesce(DepDelay, (SELECT avg(DepDelay) FROM splits)) AS delay_mean FROM splits""")
def _(spark, folder):
    df = base.splits(spark, folder).select("flight_id", "split", "DepDelay")
    df = df.withColumns({"delay_median": F.col("DepDelay"), "delay_mean": F.col("DepDelay")})
    df = clean.fill_stat(df, ["delay_median"], "median", F.col("split") == "train")
    return clean.fill_stat(df, ["delay_mean"], "mean")


@query("p15_fill_most_frequent", "event_id:i kind:s", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind FROM events)
SELECT event_id, coalesce(kind, (SELECT kind FROM e WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)) AS kind
FROM e""")
def _(spark, folder):
    df = base.parquet(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 4 == 0, None).otherwise(F.col("event_type")).alias("kind")
    )
    return clean.fill_stat(df, ["kind"], "most_frequent")


@query("p16_ordinal_map", "flight_id:i source:i dow:i", """
SELECT flight_id, CASE weather_source WHEN 'airport_hour_match' THEN 0 WHEN 'region_hour_match' THEN 1 ELSE 2 END AS source,
       isodow(FlightDate) - 1 AS dow FROM merged""")
def _(spark, folder):
    df = casts.calendar(base.merged(spark, folder))
    return df.select(
        "flight_id",
        values.ordinal_map("weather_source", K.WEATHER_SOURCES, 2).alias("source"),
        values.ordinal_map("day_name", {d: i for i, d in enumerate(profile.WEEK)}).alias("dow"),
    )


@query("p17_interactions", "precip_x_peak:i wind_x_peak:i lowvis_x_peak:i precip_x_evening:i wind_x_evening:i nas_x_peak:f lag_cancel_x_winter:f lag_delay_x_peak:f", """
WITH e AS (
  SELECT CASE WHEN coalesce(p01i, 0) > 0 THEN 1 ELSE 0 END AS rain, CASE WHEN coalesce(sknt, 0) > 20 THEN 1 ELSE 0 END AS wind,
         CASE WHEN coalesce(vsby, 10) < 3 THEN 1 ELSE 0 END AS low, CASE WHEN dep_hour BETWEEN 8 AND 11 THEN 1 ELSE 0 END AS peak,
         CASE WHEN dep_hour BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS eve, CASE WHEN mon IN (12, 1, 2) THEN 1 ELSE 0 END AS winter, Distance
  FROM merged)
SELECT sum(rain * peak) AS precip_x_peak, sum(wind * peak) AS wind_x_peak, sum(low * peak) AS lowvis_x_peak,
       sum(rain * eve) AS precip_x_evening, sum(wind * eve) AS wind_x_evening, round(sum(Distance * peak), 2) AS nas_x_peak,
       round(sum(Distance / 2 * winter), 2) AS lag_cancel_x_winter, round(sum(Distance / 4 * peak), 2) AS lag_delay_x_peak FROM e""")
def _(spark, folder):
    df = flags.weather_flags(flags.time_flags(flags.season_flags(base.merged(spark, folder), F.month("FlightDate"))))
    df = df.withColumns({"nas_delay": F.col("Distance"), "lag1_cancel_rate": F.col("Distance") / 2,
                         "lag1_delay_rate": F.col("Distance") / 4})
    df = values.interactions(df, K.INTERACTIONS)
    whole = list(K.INTERACTIONS)[:5]
    return df.agg(*[F.sum(c).alias(c) for c in whole],
                  *[F.round(F.sum(c), 2).alias(c) for c in K.INTERACTIONS if c not in whole])


CITY_FORMS = ["{n}/FORT worth, tx", "o'HARE {n}", "{n} a, b, c", "st. {n} ISLAND, Ny"]


@query("p18_canon_city", "n_nationkey:i city:s", """
WITH c AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN concat(n_name, '/FORT worth, tx') WHEN 1 THEN concat('o''HARE ', n_name)
             WHEN 2 THEN concat(n_name, ' a, b, c') ELSE concat('st. ', n_name, ' ISLAND, Ny') END AS raw FROM nation),
     p AS (SELECT n_nationkey, string_split(raw, ', ') AS parts FROM c),
     t AS (SELECT n_nationkey, parts, array_to_string(list_transform(regexp_extract_all(lower(parts[1]), '([a-z]+|[^a-z]+)'), lambda s: concat(upper(s[1:1]), s[2:])), '') AS title FROM p)
SELECT n_nationkey, CASE WHEN len(parts) = 2 THEN concat(title, ', ', upper(parts[2])) ELSE title END AS city FROM t""")
def _(spark, folder):
    n = F.col("n_name")
    forms = [F.concat(*[n if part == "{n}" else F.lit(part) for part in _pieces(form)]) for form in CITY_FORMS]
    kind = F.col("n_nationkey") % 4
    raw = F.when(kind == 0, forms[0]).when(kind == 1, forms[1]).when(kind == 2, forms[2]).otherwise(forms[3])
    return base.parquet(spark, folder, "nation").select("n_nationkey", values.canon_city(raw).alias("city"))


def _pieces(form: str) -> list[str]:
    before, after = form.split("{n}")
    return [p for p in (before, "{n}", after) if p]


@query("p19_route_key", "route:s n:i", "SELECT concat(Origin, ' → ', Dest) AS route, count(*) AS n FROM flights GROUP BY 1")
def _(spark, folder):
    return base.flights(spark, folder).groupBy(values.route_key("Origin", "Dest").alias("route")).agg(
        F.count("*").alias("n")
    )


@query("p20_holiday_flag", "FlightDate:d is_holiday:i", base.HOLIDAY_SQL)
def _(spark, folder):
    days = base.flights(spark, folder).select("FlightDate").distinct()
    return features.holiday_flag(days, "FlightDate", features.holiday_dates(spark, 1990, 2010))


@query("p21_has_value", "flight_id:i has_delay:i",
       "SELECT flight_id, CASE WHEN DepDelay IS NULL THEN 0 ELSE 1 END AS has_delay FROM flights")
def _(spark, folder):
    return base.flights(spark, folder).select("flight_id", values.has_value("DepDelay").alias("has_delay"))


@query("p22_safe_ratio", "airport:s ops_date:d ratio:f", """
SELECT airport, ops_date, CASE WHEN day(ops_date) % 5 = 4 THEN 0 ELSE airport_operations / greatest(1, day(ops_date) % 5) END AS ratio FROM opsnet""")
def _(spark, folder):
    left = F.dayofmonth("date") % 5
    df = base.opsnet(spark, folder).withColumn("num_runways", F.when(left != 4, left))
    return df.select("airport", F.col("date").alias("ops_date"), values.safe_ratio("airport_operations", "num_runways").alias("ratio"))


@query("p23_short_name", "p_partkey:i short:s",
       "SELECT p_partkey, CASE WHEN length(p_name) > 8 THEN string_split(p_name, ' ')[1] ELSE p_name END AS short FROM part")
def _(spark, folder):
    return base.parquet(spark, folder, "part").select("p_partkey", values.short_name("p_name", 8).alias("short"))


@query("p24_drop_unmatched", "rule:s n:i", """
SELECT 'all' AS rule, count(*) AS n FROM merged WHERE NOT (tmpf IS NULL AND gust IS NULL)
UNION ALL SELECT 'any', count(*) FROM merged WHERE tmpf IS NOT NULL AND gust IS NOT NULL""")
def _(spark, folder):
    df = base.merged(spark, folder)
    kept = clean.drop_all_null(df, ["tmpf", "gust"]).agg(F.count("*").alias("n")).select(F.lit("all").alias("rule"), "n")
    return kept.unionByName(
        clean.drop_null(df, ["tmpf", "gust"]).agg(F.count("*").alias("n")).select(F.lit("any").alias("rule"), "n")
    )


@query("s_hot_keys", "Origin:s", """
SELECT Origin FROM flights GROUP BY Origin HAVING count(*) >= 0.04 * (SELECT count(*) FROM flights)""")
def _(spark, folder):
    df = base.flights(spark, folder)
    hot = find_hot(df, "Origin", share=0.04)
    return df.where(F.col("Origin").isin(*hot.values)).select("Origin").distinct()
