"""Queries over joins and aggregations (J*, G*, S*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.operators import clean, enrich, features, lookups, profile, weather
from contrail.operators.lookups import find_hot
from contrail.functions.values import route_key
from contrail.plans import base
from contrail.plans.registry import query

W = "tmpf:f vsby:f sknt:f p01i:f relh:f gust:f"


# --- flagship -------------------------------------------------------------------------------------


@query("flagship_disruption_by_weather_source", "weather_source:s region:s dep_hour:i n:i delay_rate:f cancel_rate:f tmpf:f", """
SELECT weather_source, region, dep_hour, count(*) AS n, avg(is_delayed) AS delay_rate, avg(is_cancelled) AS cancel_rate, avg(tmpf) AS tmpf
FROM merged WHERE yr <> 1997 GROUP BY weather_source, region, dep_hour""")
def flagship(spark, folder):
    hours = base.hourly(spark, folder)
    kept = clean.exclude_years(base.labelled(spark, folder), "FlightDate", base.YEARS_OUT)
    df = weather.enrich_with_fallback(kept, hours.drop("region"), weather.region_hourly(hours), day="wx_date")
    return df.groupBy("weather_source", "region", "dep_hour").agg(
        F.count("*").alias("n"), F.avg("is_delayed").alias("delay_rate"),
        F.avg("is_cancelled").alias("cancel_rate"), F.avg("tmpf").alias("tmpf"),
    )


# --- joins ----------------------------------------------------------------------------------------


@query("j1_enrich_airport_hour", f"flight_id:i {W}", """
SELECT flight_id, h.* FROM labelled AS f LEFT JOIN hourly AS h
ON f.Origin = h.airport_code AND f.wx_date = h.w_date AND f.dep_hour = h.w_hour""")
def _(spark, folder):
    return weather.enrich_airport_hour(base.labelled(spark, folder), base.hourly(spark, folder), day="wx_date")


@query("j1_enrich_airport_hour_salted", f"flight_id:i {W}", """
SELECT flight_id, h.* FROM labelled AS f LEFT JOIN hourly AS h
ON f.Origin = h.airport_code AND f.wx_date = h.w_date AND f.dep_hour = h.w_hour""")
def _(spark, folder):
    df = base.labelled(spark, folder)
    hot = find_hot(base.flights(spark, folder), "Origin", share=0.02, salts=4)
    return weather.enrich_airport_hour(df, base.hourly(spark, folder), day="wx_date", hot=hot)


@query("j2_enrich_with_fallback", f"flight_id:i {W}",
       "SELECT flight_id, tmpf, vsby, sknt, p01i, relh, gust FROM merged")
def _(spark, folder):
    return base.merged(spark, folder)


@query("j3_weather_source", "flight_id:i weather_source:s", "SELECT flight_id, weather_source FROM merged")
def _(spark, folder):
    return base.merged(spark, folder)


@query("j4_map_region", "OriginState:s region:s n:i", """
SELECT OriginState, CASE WHEN OriginState IN ('NY', 'VT') THEN 'Northeast' WHEN OriginState = 'IL' THEN 'Midwest'
       WHEN OriginState IN ('DC', 'PR', 'VI') THEN 'South' WHEN OriginState = 'WA' THEN 'West' END AS region, count(*) AS n
FROM (SELECT ['NY', 'VT', 'IL', 'DC', 'PR', 'VI', 'WA', 'TT', NULL][n_nationkey % 9 + 1] AS OriginState FROM nation JOIN customer ON c_nationkey = n_nationkey)
GROUP BY 1, 2""")
def _(spark, folder):
    codes = F.array(*[F.lit(s) for s in ("NY", "VT", "IL", "DC", "PR", "VI", "WA", "TT", None)])
    df = base.parquet(spark, folder, "customer").select(F.get(codes, F.col("c_nationkey") % 9).alias("OriginState"))
    return weather.map_region(df).groupBy("OriginState", "region").agg(F.count("*").alias("n"))


@query("j4_station_regions", "airport_code:s region:s n:i", """
SELECT airport_code, CASE airport_code WHEN 'ATL' THEN 'South' WHEN 'ORD' THEN 'Midwest' WHEN 'DCA' THEN 'South' WHEN 'SEA' THEN 'West' WHEN 'BOS' THEN 'Northeast' END AS region, count(*) AS n
FROM (SELECT ['ATL', 'ORD', 'DCA', 'SEA', 'BOS', 'XXX'][user_id % 6 + 1] AS airport_code FROM events) GROUP BY 1, 2""")
def _(spark, folder):
    codes = F.array(*[F.lit(s) for s in ("ATL", "ORD", "DCA", "SEA", "BOS", "XXX")])
    df = base.parquet(spark, folder, "events").select(F.get(codes, (F.col("user_id") % 6).cast("int")).alias("airport_code"))
    return weather.station_regions(df).groupBy("airport_code", "region").agg(F.count("*").alias("n"))


@query("j5_join_traffic", "flight_id:i airport_operations:f has_opsnet:i", """
SELECT flight_id, airport_operations, CASE WHEN airport_operations IS NULL THEN 0 ELSE 1 END AS has_opsnet
FROM flights LEFT JOIN opsnet ON Origin = airport AND FlightDate = ops_date""")
def _(spark, folder):
    return enrich.join_traffic(base.flights(spark, folder), base.opsnet(spark, folder))


CAUSES = "carrier_delay:f weather_delay:f nas_delay:f security_delay:f late_aircraft_delay:f"


@query("j6_join_causes", f"flight_id:i {CAUSES}", """
SELECT flight_id, carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay
FROM labelled LEFT JOIN causes_month ON Origin = airport AND yr = year AND mon = month""")
def _(spark, folder):
    monthly = enrich.causes_by_month(base.causes(spark, folder), *base.CAUSE_YEARS, without=base.YEARS_OUT)
    return enrich.join_causes(base.flights(spark, folder), monthly)


@query("j7_join_airports", "flight_id:i airport_lat:f airport_lon:f airport_elevation:f airport_type:s", """
SELECT flight_id, airport_lat, airport_lon, airport_elevation, airport_type FROM flights LEFT JOIN airport_dim ON Origin = airport""")
def _(spark, folder):
    return enrich.join_airports(base.flights(spark, folder), base.airports(spark, folder))


RUNWAY = "num_runways:i avg_runway_length_ft:f max_runway_length_ft:f"


@query("j8_join_runways", f"flight_id:i {RUNWAY}", """
SELECT flight_id, num_runways, avg_runway_length_ft, max_runway_length_ft FROM flights LEFT JOIN runway_dim ON Origin = airport""")
def _(spark, folder):
    profile_ = enrich.runway_profile(base.runways(spark, folder), base.airports(spark, folder))
    return enrich.join_runways(base.flights(spark, folder), profile_)


@query("j9_join_back", "flight_id:i rate:f", """
SELECT flight_id, coalesce(r.rate, (SELECT avg(is_delayed) FROM splits WHERE split = 'train')) AS rate
FROM splits AS s LEFT JOIN (SELECT Airline, Origin, dep_hour, avg(is_delayed) AS rate FROM splits WHERE split = 'train' GROUP BY 1, 2, 3) AS r
ON s.Airline = r.Airline AND s.Origin = r.Origin AND s.dep_hour = r.dep_hour""")
def _(spark, folder):
    df = base.splits(spark, folder)
    train = clean.split_of(df, "train")
    keys = ["Airline", "Origin", "dep_hour"]
    stats = train.groupBy(*keys).agg(F.avg("is_delayed").alias("rate"))
    return lookups.join_back(df, stats, keys, {"rate": train.agg(F.avg("is_delayed")).scalar()})


@query("j10_join_prior_day", "flight_id:i before:i", """
SELECT flight_id, d.n AS before FROM flights AS f LEFT JOIN (SELECT Origin, FlightDate, count(*) AS n FROM flights GROUP BY 1, 2) AS d
ON f.Origin = d.Origin AND f.FlightDate = d.FlightDate + 1""")
def _(spark, folder):
    df = base.flights(spark, folder)
    daily = df.groupBy("Origin", "FlightDate").agg(F.count("*").alias("before"))
    return lookups.lookup(df, lookups.prior_day(daily, "FlightDate"), ["Origin", "FlightDate"])


@query("j10_join_prior_month", "flight_id:i before:i", """
SELECT flight_id, d.n AS before FROM labelled AS f LEFT JOIN (SELECT Origin, yr, mon, count(*) AS n FROM labelled GROUP BY 1, 2, 3) AS d
ON f.Origin = d.Origin AND f.yr * 12 + f.mon = d.yr * 12 + d.mon + 1""")
def _(spark, folder):
    df = base.flights(spark, folder).withColumns({"year": F.year("FlightDate"), "month": F.month("FlightDate")})
    monthly = df.groupBy("Origin", "year", "month").agg(F.count("*").alias("before"))
    return lookups.lookup(df, lookups.prior_month(monthly), ["Origin", "year", "month"])


@query("j11_match_rate", "enrichment:s match_pct:f n:i", """
SELECT 'weather' AS enrichment, 100 * avg(CASE WHEN tmpf IS NULL THEN 0 ELSE 1 END) AS match_pct, count(*) AS n FROM merged
UNION ALL SELECT 'gust', 100 * avg(CASE WHEN gust IS NULL THEN 0 ELSE 1 END), count(*) FROM merged""")
def _(spark, folder):
    return enrich.match_rate(base.merged(spark, folder), {"weather": "tmpf", "gust": "gust"})


@query("j11_match_bias", "matched:i target_name:s n:i share:f", """
SELECT CASE WHEN vsby IS NULL THEN 0 ELSE 1 END AS matched, target_name, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY vsby IS NULL) AS share
FROM merged GROUP BY vsby IS NULL, target_name""")
def _(spark, folder):
    return enrich.match_bias(base.merged(spark, folder), "vsby", "target_name").withColumn("matched", F.col("matched").cast("int"))


@query("j11_match_bias_origins", "matched:i Origin:s n:i share:f", """
SELECT CASE WHEN vsby IS NULL THEN 0 ELSE 1 END AS matched, Origin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY vsby IS NULL) AS share
FROM merged GROUP BY vsby IS NULL, Origin QUALIFY row_number() OVER (PARTITION BY vsby IS NULL ORDER BY count(*) DESC, Origin) <= 10""")
def _(spark, folder):
    df = enrich.match_bias(base.merged(spark, folder), "vsby", "Origin", k=10)
    return df.withColumn("matched", F.col("matched").cast("int"))


@query("j12_combine_counts", "route:s total:i cancelled:i delayed:i", """
SELECT concat(Origin, ' → ', Dest) AS route, count(*) AS total, sum(is_cancelled) AS cancelled, sum(is_delayed) AS delayed FROM labelled GROUP BY 1""")
def _(spark, folder):
    df = base.labelled(spark, folder).withColumn("route", route_key("Origin", "Dest"))
    return enrich.combine_counts(df, ["route"], {"cancelled": "is_cancelled", "delayed": "is_delayed"})


# --- aggregations ---------------------------------------------------------------------------------


@query("g1_hourly_weather", f"airport_code:s w_date:d w_hour:i {W}", "SELECT * FROM hourly")
def _(spark, folder):
    return weather.hourly_weather(base.weather(spark, folder))


@query("g1_hourly_weather_zero_rain", "airport_code:s w_date:d w_hour:i p01i:f",
       "SELECT airport_code, w_date, w_hour, coalesce(p01i, 0) AS p01i FROM hourly")
def _(spark, folder):
    return weather.hourly_weather(base.weather(spark, folder), zero_if_empty=True)


@query("g2_region_hourly", f"region:s w_date:d w_hour:i {W}", "SELECT * FROM region_hours")
def _(spark, folder):
    return weather.region_hourly(base.hourly(spark, folder))


@query("g3_causes_by_month", f"airport:s year:i month:i {CAUSES}", "SELECT * FROM causes_month")
def _(spark, folder):
    return enrich.causes_by_month(base.causes(spark, folder), *base.CAUSE_YEARS, without=base.YEARS_OUT)


@query("g4_runway_profile", f"airport:s {RUNWAY}", "SELECT * FROM runway_dim")
def _(spark, folder):
    return enrich.runway_profile(base.runways(spark, folder), base.airports(spark, folder))


def encode_sql(key_sql: str, keys: str, m: int) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys.split(", "))
    return f"""
WITH s AS (SELECT *, {key_sql} AS bucket FROM splits),
     g AS (SELECT avg(is_cancelled) AS c, avg(is_delayed) AS d FROM splits WHERE split = 'train'),
     t AS (SELECT {keys}, count(*) AS n, sum(is_cancelled) AS c, sum(is_delayed) AS d FROM s WHERE split = 'train' GROUP BY {keys})
SELECT s.flight_id, coalesce((t.c + {m} * g.c) / (t.n + {m}), g.c) AS cancel_rate, coalesce((t.d + {m} * g.d) / (t.n + {m}), g.d) AS delay_rate
FROM s CROSS JOIN g LEFT JOIN t ON {on}"""


LABELS = {"cancel_rate": "is_cancelled", "delay_rate": "is_delayed"}


@query("g5_target_encode_airline", "flight_id:i cancel_rate:f delay_rate:f", encode_sql("0", "Airline", 10000))
def _(spark, folder):
    return features.target_encode(base.splits(spark, folder), ["Airline"], LABELS, 10_000)


@query("g5_target_encode_airport_month", "flight_id:i cancel_rate:f delay_rate:f", encode_sql("mon", "Origin, bucket", 2000))
def _(spark, folder):
    df = base.splits(spark, folder).withColumn("bucket", F.month("FlightDate"))
    return features.target_encode(df, ["Origin", "bucket"], LABELS, 2_000)


@query("g5_target_encode_airport_season", "flight_id:i cancel_rate:f delay_rate:f",
       encode_sql("CASE WHEN mon <= 3 THEN 'winter' WHEN mon <= 6 THEN 'spring' WHEN mon <= 9 THEN 'summer' ELSE 'fall' END", "Origin, bucket", 2000))
def _(spark, folder):
    from contrail.functions.values import bin_right_closed

    season = bin_right_closed(F.month("FlightDate"), features.SEASON_EDGES, features.SEASONS)
    df = base.splits(spark, folder).withColumn("bucket", season)
    return features.target_encode(df, ["Origin", "bucket"], LABELS, 2_000)


@query("g6_daily_stats", "Origin:s FlightDate:d n:i n_cancelled:i n_delayed:i cancel_rate:f delay_rate:f", """
SELECT Origin, FlightDate, count(*) AS n, sum(is_cancelled) AS n_cancelled, sum(is_delayed) AS n_delayed,
       avg(is_cancelled) AS cancel_rate, avg(is_delayed) AS delay_rate FROM labelled GROUP BY 1, 2""")
def _(spark, folder):
    return features.daily_stats(base.labelled(spark, folder))


LAG = "lag1_cancel_rate:f lag1_delay_rate:f lag1_volume:f cancelled_yesterday:f"


@query("g7_prior_day_features", f"flight_id:i {LAG}", """
WITH d AS (SELECT split, Origin, FlightDate, count(*) AS n, sum(is_cancelled) AS c, avg(is_cancelled) AS cr, avg(is_delayed) AS dr FROM splits GROUP BY 1, 2, 3),
     g AS (SELECT avg(is_cancelled) AS cr, avg(is_delayed) AS dr FROM splits WHERE split = 'train'),
     v AS (SELECT quantile_cont(n, 0.5) AS n FROM d WHERE split = 'train')
SELECT flight_id, coalesce(d.cr, g.cr) AS lag1_cancel_rate, coalesce(d.dr, g.dr) AS lag1_delay_rate, coalesce(d.n, v.n) AS lag1_volume,
       coalesce(CASE WHEN d.c > 0 THEN 1.0 WHEN d.c = 0 THEN 0.0 END, 0) AS cancelled_yesterday
FROM splits AS s CROSS JOIN g CROSS JOIN v LEFT JOIN d ON s.split = d.split AND s.Origin = d.Origin AND s.FlightDate = d.FlightDate + 1""")
def _(spark, folder):
    return features.prior_day_features(base.splits(spark, folder))


@query("g7_prior_day_features_train_only", f"flight_id:i {LAG}", """
WITH d AS (SELECT Origin, FlightDate, count(*) AS n, sum(is_cancelled) AS c, avg(is_cancelled) AS cr, avg(is_delayed) AS dr FROM splits WHERE split = 'train' GROUP BY 1, 2),
     g AS (SELECT avg(is_cancelled) AS cr, avg(is_delayed) AS dr FROM splits WHERE split = 'train'),
     j AS (SELECT s.flight_id, s.split, d.* FROM splits AS s LEFT JOIN d ON s.Origin = d.Origin AND s.FlightDate = d.FlightDate + 1),
     v AS (SELECT avg(n) AS n FROM j WHERE split = 'train')
SELECT flight_id, coalesce(j.cr, g.cr) AS lag1_cancel_rate, coalesce(j.dr, g.dr) AS lag1_delay_rate, coalesce(j.n, v.n) AS lag1_volume,
       CASE WHEN j.c > 0 THEN 1.0 ELSE 0.0 END AS cancelled_yesterday FROM j CROSS JOIN g CROSS JOIN v""")
def _(spark, folder):
    return features.prior_day_features(base.splits(spark, folder), per_split=False)


@query("g8_hourly_congestion", "flight_id:i hourly_flights:f", """
SELECT flight_id, coalesce(n, 1) AS hourly_flights FROM splits AS s LEFT JOIN
  (SELECT Origin, FlightDate, dep_hour, count(*) AS n FROM splits WHERE split = 'train' GROUP BY 1, 2, 3) AS h
ON s.Origin = h.Origin AND s.FlightDate = h.FlightDate AND s.dep_hour = h.dep_hour""")
def _(spark, folder):
    return features.hourly_congestion(base.splits(spark, folder))


@query("g8_hourly_congestion_all", "flight_id:i hourly_flights:f", """
SELECT flight_id, count(*) OVER (PARTITION BY Origin, FlightDate, dep_hour) AS hourly_flights FROM splits""")
def _(spark, folder):
    return features.hourly_congestion(base.splits(spark, folder), scope="all")


LAG1M = "lag1m_carrier_delay:f lag1m_weather_delay:f lag1m_nas_delay:f lag1m_security_delay:f lag1m_late_aircraft_delay:f"


def lag1m_sql(where: str) -> str:
    names = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]
    return f"""
WITH f AS (SELECT s.*, {", ".join("c." + n for n in names)} FROM splits AS s LEFT JOIN causes_month AS c ON Origin = airport AND yr = year AND mon = month),
     l AS (SELECT Origin, yr * 12 + mon + 1 AS ym, {", ".join(f"min({n}) AS {n}" for n in names)} FROM f WHERE {where} GROUP BY 1, 2)
SELECT flight_id, {", ".join(f"coalesce(l.{n}, 0) AS lag1m_{n}" for n in names)} FROM f LEFT JOIN l ON f.Origin = l.Origin AND f.yr * 12 + f.mon = l.ym"""


def with_causes(spark, folder):
    monthly = enrich.causes_by_month(base.causes(spark, folder), *base.CAUSE_YEARS, without=base.YEARS_OUT)
    return enrich.join_causes(base.splits(spark, folder), monthly)


@query("g9_prior_month_causes", f"flight_id:i {LAG1M}", lag1m_sql("split = 'train'"))
def _(spark, folder):
    return features.prior_month_causes(with_causes(spark, folder))


@query("g9_prior_month_causes_all", f"flight_id:i {LAG1M}", lag1m_sql("TRUE"))
def _(spark, folder):
    return features.prior_month_causes(with_causes(spark, folder), scope="all")


RATES = "n:i delay_rate:f cancel_rate:f"
RATE_SQL = "count(*) AS n, avg(is_delayed) AS delay_rate, avg(is_cancelled) AS cancel_rate FROM labelled"


@query("g10_rate_by_day", f"FlightDate:d {RATES}", f"SELECT FlightDate, {RATE_SQL} GROUP BY 1")
def _(spark, folder):
    return profile.rate_by(base.labelled(spark, folder), ["FlightDate"])


@query("g10_rate_by_year_month", f"yr:i mon:i {RATES}", f"SELECT yr, mon, {RATE_SQL} GROUP BY 1, 2")
def _(spark, folder):
    return profile.rate_by(
        base.labelled(spark, folder), [F.year("FlightDate").alias("yr"), F.month("FlightDate").alias("mon")]
    )


@query("g10_rate_by_hour", f"dep_hour:i {RATES}", f"SELECT dep_hour, {RATE_SQL} GROUP BY 1")
def _(spark, folder):
    return profile.rate_by(base.labelled(spark, folder), ["dep_hour"])


@query("g10_rate_by_airline", f"Airline:s {RATES}", f"SELECT Airline, {RATE_SQL} GROUP BY 1")
def _(spark, folder):
    return profile.rate_by(base.labelled(spark, folder), ["Airline"])


@query("g10_rate_by_weather_bin", "bin:s n:i delay_rate:f cancel_rate:f", """
SELECT CASE WHEN vsby > 0 AND vsby <= 1 THEN '(0, 1]' WHEN vsby > 1 AND vsby <= 3 THEN '(1, 3]' WHEN vsby > 3 AND vsby <= 5 THEN '(3, 5]'
            WHEN vsby > 5 AND vsby <= 10 THEN '(5, 10]' WHEN vsby > 10 AND vsby <= 100 THEN '(10, 100]' END AS bin,
       count(*) AS n, avg(is_delayed) AS delay_rate, avg(is_cancelled) AS cancel_rate FROM merged GROUP BY 1""")
def _(spark, folder):
    from contrail.functions.values import bin_right_closed

    return profile.rate_by(base.merged(spark, folder), [bin_right_closed("vsby", [0, 1, 3, 5, 10, 100]).alias("bin")])


TOP = f"""
SELECT Origin, Dest, n, delay_rate, cancel_rate FROM (SELECT Origin, Dest, {RATE_SQL} GROUP BY 1, 2)
WHERE n >= 5 ORDER BY %s DESC, Origin, Dest LIMIT 10"""


@query("g11_top_routes_cancelled", f"Origin:s Dest:s {RATES}", TOP % "cancel_rate")
def _(spark, folder):
    return profile.top_groups(base.labelled(spark, folder), ["Origin", "Dest"], "cancel_rate", 5, 10)


@query("g11_top_routes_delayed", f"Origin:s Dest:s {RATES}", TOP % "delay_rate")
def _(spark, folder):
    return profile.top_groups(base.labelled(spark, folder), ["Origin", "Dest"], "delay_rate", 5, 10)


@query("g11_busiest_airports", f"Origin:s {RATES}", f"SELECT Origin, {RATE_SQL} GROUP BY 1 ORDER BY n DESC, Origin LIMIT 7")
def _(spark, folder):
    return profile.busiest_by_rate(base.labelled(spark, folder), "Origin", "delay_rate", 7)


@query("g12_value_counts", "target_name:s n:i share:f", """
SELECT target_name, count(*) AS n, count(*) / (SELECT count(*) FROM labelled) AS share FROM labelled GROUP BY 1""")
def _(spark, folder):
    return profile.value_counts(base.labelled(spark, folder), "target_name", share=True)


@query("g13_imbalance_ratio", "largest:i smallest:i ratio:f negatives:i positives:i pos_weight:f", """
WITH c AS (SELECT target, count(*) AS n FROM labelled GROUP BY 1)
SELECT max(n) AS largest, min(n) AS smallest, max(n) / min(n) AS ratio, (SELECT count(*) - sum(is_cancelled) FROM labelled) AS negatives,
       (SELECT sum(is_cancelled) FROM labelled) AS positives, (SELECT (count(*) - sum(is_cancelled)) / sum(is_cancelled) FROM labelled) AS pos_weight FROM c""")
def _(spark, folder):
    df = base.labelled(spark, folder)
    weights = profile.pos_weight(df, "is_cancelled")
    w = weights.select(F.struct("*")).scalar()
    return profile.imbalance_ratio(df, "target").withColumns(
        {c: w[c] for c in ("negatives", "positives", "pos_weight")}
    )


@query("g14_crosstab", "Airline:s on_time:i delayed:i cancelled:i", """
SELECT Airline, sum(is_on_time) AS on_time, sum(is_delayed) AS delayed, sum(is_cancelled) AS cancelled FROM labelled GROUP BY 1""")
def _(spark, folder):
    return profile.crosstab(base.labelled(spark, folder), "Airline", "target_name", profile.CLASSES)


@query("g14_crosstab_share_all", "Airline:s on_time:f delayed:f cancelled:f", """
SELECT Airline, sum(is_on_time) / t AS on_time, sum(is_delayed) / t AS delayed, sum(is_cancelled) / t AS cancelled
FROM labelled, (SELECT count(*) AS t FROM labelled) GROUP BY Airline, t""")
def _(spark, folder):
    return profile.crosstab(base.labelled(spark, folder), "Airline", "target_name", profile.CLASSES, "all")


@query("g14_crosstab_share_row", "target_name:s Origin:s share:f", """
SELECT target_name, Origin, count(*) / sum(count(*)) OVER (PARTITION BY target_name) AS share FROM labelled GROUP BY 1, 2""")
def _(spark, folder):
    df = profile.crosstab(base.labelled(spark, folder), "target_name", "Origin", normalize="index")
    return df.withColumnRenamed("n", "share")


@query("g14_rain_class_mix", "bin:s on_time:f delayed:f cancelled:f", """
SELECT CASE WHEN p01i <= 0.01 THEN '0-0.01' WHEN p01i <= 0.1 THEN '0.01-0.1' WHEN p01i <= 0.5 THEN '0.1-0.5' WHEN p01i <= 1 THEN '0.5-1.0' ELSE '>1.0' END AS bin,
       100 * avg(is_on_time) AS on_time, 100 * avg(is_delayed) AS delayed, 100 * avg(is_cancelled) AS cancelled FROM merged WHERE p01i > 0 GROUP BY 1""")
def _(spark, folder):
    rain = base.merged(spark, folder).where("p01i > 0")
    return profile.rates_by_class_bins(rain, "p01i", profile.RAIN_EDGES, profile.RAIN_LABELS)


@query("g15_missingness", "column:s n_null:i n:i missing_pct:f", """
SELECT u.col AS column, u.n_null, n, 100 * u.n_null / n AS missing_pct FROM (
  SELECT count(*) AS n, [""" + ", ".join(
    f"{{'col': '{c}', 'n_null': count(*) - count({c})}}"
    for c in ("airport_code", "region", "valid", "tmpf", "vsby", "sknt", "p01i", "relh", "gust")) + """] AS cells FROM weather) AS t, unnest(t.cells) AS x(u)""")
def _(spark, folder):
    return profile.missingness(base.weather(spark, folder))


@query("g15_shape", "dtype:s n_rows:i n_columns:i", """
SELECT d.dtype, n_rows, d.k AS n_columns FROM (SELECT count(*) AS n_rows FROM orders), (VALUES ('bigint', 2), ('string', 2), ('double', 1), ('timestamp_ntz', 1)) AS d(dtype, k)""")
def _(spark, folder):
    return profile.shape(base.parquet(spark, folder, "orders"))


DESC = "column:s count:i mean:f std:f min:f q1:f median:f q3:f max:f"


def describe_sql(cols, source):
    one = "SELECT '{c}' AS column, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3, max({c}) AS max FROM {s}"
    return " UNION ALL ".join(one.format(c=c, s=source) for c in cols)


@query("g16_describe", DESC, describe_sql(["DepDelay", "Distance"], "flights"))
def _(spark, folder):
    return profile.describe(base.flights(spark, folder), ["DepDelay", "Distance"])


@query("g16_describe_weather", DESC, describe_sql(["tmpf", "vsby", "sknt", "gust", "p01i", "relh"], "weather"))
def _(spark, folder):
    return profile.describe(base.weather(spark, folder), ["tmpf", "vsby", "sknt", "gust", "p01i", "relh"])


@query("g18_cardinality", "column:s n_unique:i", """
SELECT 'Origin' AS column, count(DISTINCT Origin) AS n_unique FROM flights UNION ALL SELECT 'Dest', count(DISTINCT Dest) FROM flights
UNION ALL SELECT 'DepDelay', count(DISTINCT DepDelay) FROM flights""")
def _(spark, folder):
    return profile.cardinality(base.flights(spark, folder), ["Origin", "Dest", "DepDelay"])


@query("g19_binned_delay", "dist_bin:s n_all:i DepDelay_nonnull:i mean_DepDelay:f DepDelay_coverage_pct:f", """
SELECT CASE WHEN Distance <= 250 THEN '(0, 250]' WHEN Distance <= 500 THEN '(250, 500]' WHEN Distance <= 750 THEN '(500, 750]' WHEN Distance <= 1000 THEN '(750, 1000]'
            WHEN Distance <= 1500 THEN '(1000, 1500]' WHEN Distance <= 2000 THEN '(1500, 2000]' WHEN Distance <= 3000 THEN '(2000, 3000]' ELSE '(3000, 6000]' END AS dist_bin,
       count(*) AS n_all, count(DepDelay) AS DepDelay_nonnull, avg(DepDelay) AS mean_DepDelay, round_even(100 * count(DepDelay) / count(*), 2) AS DepDelay_coverage_pct
FROM flights WHERE NOT Cancelled AND Distance BETWEEN 0 AND 6000 GROUP BY 1""")
def _(spark, folder):
    return profile.binned_delay(base.labelled(spark, folder))


@query("g20_flag_impact", "flag:s prevalence:f is_on_time:f is_delayed:f is_cancelled:f", """
WITH m AS (SELECT *, CASE WHEN coalesce(vsby, 10) < 3 THEN 1 ELSE 0 END AS low_visibility, CASE WHEN coalesce(sknt, 0) > 10 THEN 1 ELSE 0 END AS windy FROM merged)
SELECT 'baseline' AS flag, 1 AS prevalence, avg(is_on_time) AS is_on_time, avg(is_delayed) AS is_delayed, avg(is_cancelled) AS is_cancelled FROM m
UNION ALL SELECT 'low_visibility', avg(low_visibility), avg(is_on_time) FILTER (low_visibility = 1), avg(is_delayed) FILTER (low_visibility = 1), avg(is_cancelled) FILTER (low_visibility = 1) FROM m
UNION ALL SELECT 'windy', avg(windy), avg(is_on_time) FILTER (windy = 1), avg(is_delayed) FILTER (windy = 1), avg(is_cancelled) FILTER (windy = 1) FROM m""")
def _(spark, folder):
    from contrail.functions.flags import as_flag, weather_flags

    df = weather_flags(base.merged(spark, folder)).withColumn("windy", as_flag(F.col("sknt") > 10))
    return profile.flag_impact(df, ["low_visibility", "windy"])


@query("g21_interaction_rates", "has_precip:i is_morning_peak:i n:i rate:f", """
WITH m AS (SELECT is_delayed, CASE WHEN coalesce(p01i, 0) > 0 THEN 1 ELSE 0 END AS has_precip, CASE WHEN dep_hour BETWEEN 8 AND 11 THEN 1 ELSE 0 END AS is_morning_peak FROM merged)
SELECT has_precip, is_morning_peak, count(*) AS n, avg(is_delayed) AS rate FROM m GROUP BY CUBE (has_precip, is_morning_peak)""")
def _(spark, folder):
    from contrail.functions.flags import time_flags, weather_flags

    df = time_flags(weather_flags(base.merged(spark, folder)))
    return profile.interaction_rates(df, "has_precip", "is_morning_peak", "is_delayed")


@query("g22_histogram", "bin:i left_edge:f right_edge:f n:i", """
WITH e AS (SELECT min(Distance) AS lo, max(Distance) AS hi FROM flights),
     c AS (SELECT least(19, CAST(floor((Distance - lo) / ((hi - lo) / 20)) AS INT)) AS bin, count(*) AS n FROM flights, e GROUP BY 1)
SELECT r.bin, lo + r.bin * ((hi - lo) / 20) AS left_edge, lo + (r.bin + 1) * ((hi - lo) / 20) AS right_edge, coalesce(n, 0) AS n
FROM e CROSS JOIN (SELECT unnest(range(20)) AS bin) AS r LEFT JOIN c ON r.bin = c.bin""")
def _(spark, folder):
    return profile.histogram(base.flights(spark, folder), "Distance", 20)


@query("g22_histogram_trimmed", "bin:i n:i", """
WITH c AS (SELECT least(17, CAST(floor(DepDelay / 10.0) AS INT)) AS bin, count(*) AS n FROM labelled WHERE is_delayed = 1 AND DepDelay BETWEEN 0 AND 180 GROUP BY 1)
SELECT r.bin, coalesce(n, 0) AS n FROM (SELECT unnest(range(18)) AS bin) AS r LEFT JOIN c ON r.bin = c.bin""")
def _(spark, folder):
    return profile.histogram(base.labelled(spark, folder).where("is_delayed = 1"), "DepDelay", 18, 0, 180)


@query("g23_box_stats", "target_name:s q1:f median:f q3:f iqr:f whisker_low:f whisker_high:f", """
WITH b AS (SELECT target_name, quantile_cont(Distance, 0.25) AS q1, quantile_cont(Distance, 0.5) AS median, quantile_cont(Distance, 0.75) AS q3 FROM labelled GROUP BY 1)
SELECT b.target_name, q1, median, q3, q3 - q1 AS iqr, min(Distance) AS whisker_low, max(Distance) AS whisker_high
FROM b JOIN labelled AS l ON b.target_name = l.target_name AND Distance BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""")
def _(spark, folder):
    return profile.box_stats(base.labelled(spark, folder), "Distance", "target_name")


@query("g24_delay_vs_visibility", "dep_hour:i delay_rate:f visibility:f", """
SELECT dep_hour, avg(is_delayed) AS delay_rate, avg(vsby) / max(avg(vsby)) OVER () AS visibility FROM merged GROUP BY 1""")
def _(spark, folder):
    return profile.delay_vs_visibility(base.merged(spark, folder))


@query("g25_weather_by_hour", "hour:i tmpf:f vsby:f sknt:f p01i:f gust:f", """
SELECT hour(valid) AS hour, avg(tmpf) AS tmpf, avg(vsby) AS vsby, avg(sknt) AS sknt, avg(p01i) AS p01i, avg(gust) AS gust FROM weather GROUP BY 1""")
def _(spark, folder):
    return weather.weather_by_hour(base.weather(spark, folder))


@query("g26_split_summary", "split:s n:i cancel_pct:f delay_pct:f on_time_pct:f first_day:d last_day:d", """
SELECT split, count(*) AS n, 100 * avg(is_cancelled) AS cancel_pct, 100 * avg(is_delayed) AS delay_pct, 100 * avg(is_on_time) AS on_time_pct,
       min(FlightDate) AS first_day, max(FlightDate) AS last_day FROM splits GROUP BY 1""")
def _(spark, folder):
    return profile.split_summary(base.splits(spark, folder))


@query("g26_split_summary_by_year", "yr:i split:s n:i cancel_pct:f", """
SELECT yr, split, count(*) AS n, 100 * avg(is_cancelled) AS cancel_pct FROM splits GROUP BY 1, 2""")
def _(spark, folder):
    df = base.splits(spark, folder).withColumn("yr", F.year("FlightDate"))
    return profile.split_summary(df, ["yr", "split"])


@query("g27_row_counts", "table:s n:i", """
SELECT 'orders' AS "table", count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def _(spark, folder):
    return profile.row_counts(spark, {t: f"{folder}/{t}.parquet" for t in ("orders", "events", "lineitem")})


# --- sorts, limits, sets --------------------------------------------------------------------------


@query("s1_top_k", "flight_id:i Distance:f", "SELECT flight_id, Distance FROM flights ORDER BY Distance DESC, flight_id LIMIT 25")
def _(spark, folder):
    return profile.top_k(base.flights(spark, folder), "Distance", 25, ties=["flight_id"])


@query("s2_filter_to_top", "Dest:s target_name:s n:i", """
SELECT Dest, target_name, count(*) AS n FROM labelled WHERE Dest IN (SELECT Dest FROM flights GROUP BY Dest ORDER BY count(*) DESC, Dest LIMIT 5) GROUP BY 1, 2""")
def _(spark, folder):
    df = profile.filter_to_top(base.labelled(spark, folder), "Dest", 5)
    return df.groupBy("Dest", "target_name").agg(F.count("*").alias("n"))


@query("s3_union_parts", "split:s n:i", "SELECT split, count(*) AS n FROM splits GROUP BY 1")
def _(spark, folder):
    df = base.splits(spark, folder)
    parts = [clean.split_of(df, s) for s in ("train", "val", "test")]
    return clean.union_parts(*parts).groupBy("split").agg(F.count("*").alias("n"))


@query("s4_complement", "flight_id:i split:s", "SELECT flight_id, split FROM splits WHERE split <> 'train'")
def _(spark, folder):
    return clean.complement(base.splits(spark, folder), "train")


@query("s5_reindex", "position:i day_name:s n:i rate:f", """
SELECT w.position, w.day_name, count(Origin) AS n, avg(is_delayed) AS rate
FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) AS w(position, day_name)
LEFT JOIN labelled ON isodow(FlightDate) = w.position + 1 GROUP BY 1, 2""")
def _(spark, folder):
    from contrail.functions.casts import calendar

    days = calendar(base.labelled(spark, folder)).groupBy("day_name").agg(
        F.count("*").alias("n"), F.avg("is_delayed").alias("rate")
    )
    return profile.reindex(days, "day_name", profile.WEEK)
