"""Queries over windows, sampling, association and data quality (W*, B*, C*, D*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.operators import association, clean, features, lookups, ordered, profile, quality, sampling
from contrail.plans import base
from contrail.plans.registry import query

# --- windows --------------------------------------------------------------------------------------


@query("w1_prev_day_failure", "flight_id:i prev_day_failure_origin:i", """
WITH d AS (SELECT Origin, FlightDate, max(greatest(is_cancelled, is_delayed)) AS f FROM labelled GROUP BY 1, 2),
     p AS (SELECT Origin, FlightDate, coalesce(lag(f) OVER (PARTITION BY Origin ORDER BY FlightDate), 0) AS prev FROM d)
SELECT flight_id, prev AS prev_day_failure_origin FROM labelled AS l JOIN p ON l.Origin = p.Origin AND l.FlightDate = p.FlightDate""")
def _(spark, folder):
    return features.prev_day_failure(base.labelled(spark, folder))


@query("w2_group_demean", "flight_id:i distance_origin_norm:f",
       "SELECT flight_id, Distance - avg(Distance) OVER (PARTITION BY Origin) AS distance_origin_norm FROM flights")
def _(spark, folder):
    return features.group_demean(base.flights(spark, folder), "Origin", "Distance", "distance_origin_norm")


def daily_delay(spark, folder):
    return base.flights(spark, folder).groupBy("FlightDate").agg(F.avg("DepDelay").alias("avg_delay"))


@query("w3_acf", "lag:i acf:f bound:f", """
WITH d AS (SELECT FlightDate, avg(DepDelay) AS v FROM flights GROUP BY 1 HAVING avg(DepDelay) IS NOT NULL),
     x AS (SELECT row_number() OVER (ORDER BY FlightDate) AS i, v - avg(v) OVER () AS x FROM d),
     t AS (SELECT sum(x * x) AS ss, count(*) AS n FROM x)
SELECT k AS lag, sum(a.x * b.x) / any_value(ss) AS acf, 1.96 / sqrt(any_value(n)) AS bound
FROM (SELECT unnest(range(31)) AS k) CROSS JOIN t CROSS JOIN x AS a JOIN x AS b ON b.i = a.i + k GROUP BY k""")
def _(spark, folder):
    return profile.acf(daily_delay(spark, folder), "avg_delay", "FlightDate")


@query("w4_pacf", "lag:i pacf:f", """
WITH d AS (SELECT FlightDate, avg(DepDelay) AS v FROM flights GROUP BY 1 HAVING avg(DepDelay) IS NOT NULL),
     x AS (SELECT row_number() OVER (ORDER BY FlightDate) AS i, v - avg(v) OVER () AS x FROM d),
     c AS (SELECT k, sum(a.x * b.x) / (SELECT sum(x * x) FROM x) AS r FROM (SELECT unnest(range(31)) AS k) CROSS JOIN x AS a JOIN x AS b ON b.i = a.i + k GROUP BY k),
     acf AS (SELECT list(r ORDER BY k) AS r FROM c)
SELECT lag, pacf FROM (
  WITH RECURSIVE step AS (
    SELECT 0 AS lag, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS pacf
    UNION ALL
    SELECT lag + 1, list_append(list_transform(range(1, lag + 1), lambda j: phi[j] - q * phi[lag + 1 - j]), q), q FROM (
      SELECT lag, phi, (r[lag + 2] - coalesce(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[lag + 2 - j])), 0))
                     / (1 - coalesce(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[j + 1])), 0)) AS q
      FROM step, acf WHERE lag < 30))
  SELECT lag, pacf FROM step)""")
def _(spark, folder):
    return profile.pacf(daily_delay(spark, folder), "avg_delay", "FlightDate")


@query("w5_dedup_first", "l_orderkey:i l_linenumber:i l_partkey:i l_quantity:f l_extendedprice:f", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_quantity, l_extendedprice) = 1""")
def _(spark, folder):
    df = base.parquet(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return lookups.dedup_first(df, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


@query("w6_label_encode", "flight_id:i Origin_enc:i region_enc:i", """
WITH o AS (SELECT Origin, row_number() OVER (ORDER BY Origin) - 1 AS i FROM (SELECT DISTINCT Origin FROM flights)),
     g AS (SELECT region, coalesce(nullif(region, 'ASIA'), 'Unknown') AS r FROM (SELECT DISTINCT region FROM flights)),
     h AS (SELECT region, row_number() OVER (ORDER BY r) - 1 AS i FROM g)
SELECT flight_id, o.i AS Origin_enc, h.i AS region_enc FROM flights AS f JOIN o ON f.Origin = o.Origin JOIN h ON f.region = h.region""")
def _(spark, folder):
    df = base.flights(spark, folder).withColumn("region", F.when(F.col("region") != "ASIA", F.col("region")))
    return features.label_encode(features.label_encode(df, "Origin"), "region")


@query("w6_label_index_many", "value:s position:i",
       "SELECT p_name AS value, row_number() OVER (ORDER BY p_name) - 1 AS position FROM (SELECT DISTINCT concat(p_name, ' ', p_partkey) AS p_name FROM part)")
def _(spark, folder):
    df = base.parquet(spark, folder, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("value"))
    return features.label_index(df, "value").withColumnRenamed("value_enc", "position")


@query("w_exact_quantiles", "column:s p:f q:f n:i",
       " UNION ALL ".join(
           f"SELECT '{c}' AS column, {p} AS p, quantile_cont({c}, {p}) AS q, count({c}) AS n FROM lineitem"
           for c in ("l_extendedprice", "l_quantity", "l_discount") for p in (0.01, 0.5, 0.99)))
def _(spark, folder):
    df = base.parquet(spark, folder, "lineitem")
    return ordered.exact_quantiles(df, ["l_extendedprice", "l_quantity", "l_discount"], [0.01, 0.5, 0.99])


@query("w_running_totals", "value:f cum_n:i all_n:i", """
SELECT l_extendedprice AS value, CAST(sum(count(*)) OVER (ORDER BY l_extendedprice) AS BIGINT) AS cum_n, (SELECT count(*) FROM lineitem) AS all_n
FROM lineitem GROUP BY 1""")
def _(spark, folder):
    df = base.parquet(spark, folder, "lineitem").groupBy(F.col("l_extendedprice").alias("value")).agg(F.count("*").alias("n"))
    return ordered.running_totals(df, "value", ["n"])


@query("w7_cap_per_group", "Origin:s n:i", "SELECT Origin, least(count(*), 30) AS n FROM flights GROUP BY 1")
def _(spark, folder):
    df = sampling.cap_per_group(base.flights(spark, folder), "Origin", 30, ["flight_id"])
    return df.groupBy("Origin").agg(F.count("*").alias("n"))


# --- splits, samples, balance ---------------------------------------------------------------------


@query("b1_temporal_split", "flight_id:i split:s", "SELECT flight_id, split FROM splits")
def _(spark, folder):
    return clean.temporal_split(base.flights(spark, folder), base.YEARS)


@query("b2_stratified_split", "part:s target:i n:i", """
WITH c AS (SELECT target, count(*) AS n FROM labelled GROUP BY 1),
     k AS (SELECT target, n, CAST(round(n * 0.7) AS BIGINT) AS a, CAST(round(n * 0.85) AS BIGINT) AS b FROM c)
SELECT * FROM (SELECT 'train' AS part, target, a AS n FROM k UNION ALL SELECT 'val', target, b - a FROM k UNION ALL SELECT 'test', target, n - b FROM k) WHERE n > 0""")
def _(spark, folder):
    df = base.labelled(spark, folder)
    parts = sampling.stratified_split(df, "target", {"train": 0.7, "val": 0.15, "test": 0.15}, ["flight_id"])
    return parts.groupBy("part", "target").agg(F.count("*").alias("n"))


@query("b2_split_disjoint", "n:i ids:i", "SELECT count(*) AS n, count(*) AS ids FROM labelled")
def _(spark, folder):
    df = base.labelled(spark, folder)
    parts = sampling.stratified_split(df, "target", {"train": 0.8, "test": 0.2}, ["flight_id"])
    return parts.agg(F.count("*").alias("n"), F.count_distinct("flight_id").alias("ids"))


@query("b3_sample_multistage", "n:i ids:i months:i largest_class:i")
def _(spark, folder):
    df = base.labelled(spark, folder)
    out = sampling.sample_multistage(df, 900, ["flight_id"])
    top = out.groupBy("target").agg(F.count("*").alias("n")).agg(F.max("n")).scalar()
    return out.agg(
        F.count("*").alias("n"), F.count_distinct("flight_id").alias("ids"), F.count_distinct("month").alias("months")
    ).withColumn("largest_class", top)


@query("b3_month_stage", "month:s n:i", """
SELECT strftime(FlightDate, '%Y-%m') AS month, least(count(*), 900 // (SELECT count(DISTINCT strftime(FlightDate, '%Y-%m')) FROM flights)) AS n FROM flights GROUP BY 1""")
def _(spark, folder):
    df = base.labelled(spark, folder).withColumn("month", F.date_format("FlightDate", "yyyy-MM"))
    months = df.agg(F.count_distinct("month")).first()[0]
    return sampling.cap_per_group(df, "month", 900 // months, ["flight_id"]).groupBy("month").agg(F.count("*").alias("n"))


@query("b4_sample_n", "n:i ids:i", "SELECT least(count(*), 777) AS n, least(count(*), 777) AS ids FROM flights")
def _(spark, folder):
    df = sampling.sample_n(base.flights(spark, folder), 777, ["flight_id"])
    return df.agg(F.count("*").alias("n"), F.count_distinct("flight_id").alias("ids"))


@query("b5_undersample", "is_cancelled:i n:i", """
WITH c AS (SELECT sum(is_cancelled) AS k, count(*) AS n FROM labelled)
SELECT 1 AS is_cancelled, k AS n FROM c UNION ALL SELECT 0, least(n - k, CAST(floor(k / 0.2) AS BIGINT)) FROM c""")
def _(spark, folder):
    df = sampling.undersample(base.labelled(spark, folder), "is_cancelled", 0.2, ["flight_id"])
    return df.groupBy("is_cancelled").agg(F.count("*").alias("n"))


SMOTE_FEATURES = ["Distance", "dep_hour", "CRSDepTime", "delay"]


def smote_input(spark, folder):
    return base.labelled(spark, folder).select(
        "flight_id", "Distance", "dep_hour", "CRSDepTime", F.coalesce("DepDelay", F.lit(0.0)).alias("delay"),
        "is_cancelled", "target",
    )


@query("b6_smote", "is_cancelled:i synthetic:i n:i", """
WITH c AS (SELECT sum(is_cancelled) AS k, count(*) - sum(is_cancelled) AS m FROM labelled)
SELECT 1 AS is_cancelled, 0 AS synthetic, k AS n FROM c UNION ALL SELECT 0, 0, m FROM c
UNION ALL SELECT 1, 1, CAST(floor(m * 0.2) AS BIGINT) - k FROM c""")
def _(spark, folder):
    df = sampling.smote(smote_input(spark, folder), SMOTE_FEATURES, "is_cancelled", "flight_id", 0.2)
    return df.groupBy("is_cancelled", "synthetic").agg(F.count("*").alias("n"))


@query("b6_nearest_neighbours", "id:i rank:i near_id:i distance:f", """
WITH m AS (SELECT flight_id AS id, Distance AS a, dep_hour AS b, CRSDepTime AS c, coalesce(DepDelay, 0) AS d FROM labelled WHERE is_cancelled = 1),
     p AS (SELECT x.id, y.id AS near_id, sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2 + (x.c - y.c) ** 2 + (x.d - y.d) ** 2) AS distance FROM m AS x JOIN m AS y ON x.id <> y.id)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY distance, near_id) AS rank, near_id, distance FROM p QUALIFY rank <= 5""")
def _(spark, folder):
    points = smote_input(spark, folder).where("is_cancelled = 1").select(
        F.col("flight_id").alias("id"), F.array(*[F.col(c).cast("double") for c in SMOTE_FEATURES]).alias("x")
    )
    return sampling.nearest_neighbours(points, 5)


@query("b6_smote_all_classes", "target:i n:i", """
SELECT target, max(count(*)) OVER () AS n FROM labelled GROUP BY 1""")
def _(spark, folder):
    df = sampling.smote_all(smote_input(spark, folder), SMOTE_FEATURES, "target", "flight_id")
    return df.groupBy("target").agg(F.count("*").alias("n"))


@query("b7_hybrid_resample", "is_cancelled:i n:i", """
WITH c AS (SELECT sum(is_cancelled) AS k, count(*) - sum(is_cancelled) AS m FROM labelled), g AS (SELECT greatest(k, CAST(floor(m * 0.3) AS BIGINT)) AS k, m FROM c)
SELECT 1 AS is_cancelled, k AS n FROM g UNION ALL SELECT 0, least(m, CAST(floor(k / 0.7) AS BIGINT)) FROM g""")
def _(spark, folder):
    df = sampling.hybrid_resample(smote_input(spark, folder), SMOTE_FEATURES, "is_cancelled", "flight_id")
    return df.groupBy("is_cancelled").agg(F.count("*").alias("n"))


@query("b8_class_weights", "flight_id:i balanced:f fixed:f positive:f", """
WITH c AS (SELECT target, count(*) AS n FROM labelled GROUP BY 1), t AS (SELECT sum(n) AS n, count(*) AS k FROM c),
     w AS (SELECT (count(*) - sum(is_cancelled)) / sum(is_cancelled) AS pos FROM labelled)
SELECT flight_id, t.n / (t.k * c.n) AS balanced, CASE l.target WHEN 0 THEN 1.0 WHEN 1 THEN 1.5 ELSE 2.0 END AS fixed,
       CASE WHEN is_cancelled = 1 THEN pos ELSE 1 END AS positive
FROM labelled AS l JOIN c ON l.target = c.target CROSS JOIN t CROSS JOIN w""")
def _(spark, folder):
    df = base.labelled(spark, folder)
    df = sampling.class_weights(df, "target", out="balanced")
    df = sampling.class_weights(df, "target", {0: 1.0, 1: 1.5, 2: 2.0}, out="fixed")
    return sampling.class_weights(df, "is_cancelled", "positive", out="positive")


# --- association ----------------------------------------------------------------------------------


@query("c1_corr_with", "column:s r:f n:i", " UNION ALL ".join(
    f"SELECT '{c}' AS column, corr({c}, DepDelay) AS r, count({c}) AS n FROM merged HAVING count({c}) > 100"
    for c in ("Distance", "dep_hour", "tmpf", "vsby", "sknt", "p01i", "relh", "gust")))
def _(spark, folder):
    cols = ["Distance", "dep_hour", "tmpf", "vsby", "sknt", "p01i", "relh", "gust"]
    return association.corr_with(base.merged(spark, folder), cols, "DepDelay", min_non_null=100)


# Means that agree up to floating noise must tie in both engines, so measures are rounded before ranking.
def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in SPEARMAN_X})


SPEARMAN_X = ["tmpf", "vsby", "sknt", "p01i", "relh"]


def spearman_sql(xs, ys) -> str:
    cols = list(dict.fromkeys([*xs, *ys]))
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r_{c}" for c in cols)
    pairs = " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, corr(r_{x}, r_{y}) AS rho FROM r" for x in xs for y in ys)
    where = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    near = ", ".join(f"round({c}, 6) AS {c}" for c in SPEARMAN_X)
    return f"WITH t AS (SELECT * REPLACE ({near}) FROM merged), r AS (SELECT {ranks} FROM t WHERE {where}) {pairs}"


@query("c2_spearman_target", "x:s y:s rho:f", spearman_sql(SPEARMAN_X, ["is_on_time", "is_delayed", "is_cancelled"]))
def _(spark, folder):
    return association.spearman(rounded(base.merged(spark, folder)), SPEARMAN_X, ["is_on_time", "is_delayed", "is_cancelled"])


@query("c2_spearman_matrix", "x:s y:s rho:f", spearman_sql(SPEARMAN_X, SPEARMAN_X))
def _(spark, folder):
    return association.spearman(rounded(base.merged(spark, folder)), SPEARMAN_X)


ANOVA_X = ["Distance", "dep_hour", "tmpf", "vsby", "sknt", "gust"]


def anova_sql(x: str, y: str = "target") -> str:
    return f"""
SELECT '{x}' AS column, ((sum(n * m * m) - sum(n) * (sum(n * m) / sum(n)) ** 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score
FROM (SELECT {y}, count(*) AS n, avg(coalesce({x}, 0)) AS m, var_pop(coalesce({x}, 0)) AS v FROM merged GROUP BY 1)"""


@query("c3_anova_f", "column:s f:f", f"SELECT q.column, score AS f FROM ({' UNION ALL '.join(map(anova_sql, ANOVA_X))}) AS q")
def _(spark, folder):
    return association.anova_f(base.merged(spark, folder), ANOVA_X, "target")


def cramers_sql(c: str, y: str = "target", yates: bool = False) -> str:
    gap = "abs(coalesce(o, 0) - e)"
    term = f"({gap} - least(0.5, {gap})) ** 2 / e" if yates else f"{gap} ** 2 / e"
    return f"""
SELECT '{c}' AS column, sqrt(greatest(0, chi / n - (k - 1) * (r - 1) / (n - 1)) / least(k - (k - 1) ** 2 / (n - 1) - 1, r - (r - 1) ** 2 / (n - 1) - 1)) AS score
FROM (SELECT sum({term}) AS chi, any_value(n) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM (
  SELECT x.a, y.b, x.c * y.c / t.n AS e, t.n, o.o FROM (SELECT {c} AS a, count(*) AS c FROM merged GROUP BY 1) AS x
  CROSS JOIN (SELECT {y} AS b, count(*) AS c FROM merged GROUP BY 1) AS y CROSS JOIN (SELECT count(*) AS n FROM merged) AS t
  LEFT JOIN (SELECT {c} AS a, {y} AS b, count(*) AS o FROM merged GROUP BY 1, 2) AS o ON o.a = x.a AND o.b = y.b))"""


CRAMERS_X = ["Origin", "Dest", "Airline", "weather_source"]


@query("c4_cramers_v", "column:s v:f", f"SELECT q.column, score AS v FROM ({' UNION ALL '.join(map(cramers_sql, CRAMERS_X))}) AS q")
def _(spark, folder):
    return association.cramers_v(base.merged(spark, folder), CRAMERS_X, "target")


@query("c4_cramers_v_two_by_two", "column:s v:f", f"""
SELECT q.column, score AS v FROM ({cramers_sql("CASE WHEN dep_hour >= 12 THEN 'pm' ELSE 'am' END", "is_delayed", True).replace("'CASE WHEN dep_hour >= 12 THEN 'pm' ELSE 'am' END'", "'half'")}) AS q""")
def _(spark, folder):
    df = base.merged(spark, folder).withColumn("half", F.when(F.col("dep_hour") >= 12, "pm").otherwise("am"))
    return association.cramers_v(df, ["half"], "is_delayed")


@query("c5_rank_features", "column:s score:f", f"""
SELECT q.column, score FROM ({' UNION ALL '.join([*map(anova_sql, ANOVA_X), *map(cramers_sql, CRAMERS_X)])}) AS q ORDER BY score DESC, q.column LIMIT 8""")
def _(spark, folder):
    return association.rank_features(base.merged(spark, folder), ANOVA_X, CRAMERS_X, "target", 8)


# --- data quality ---------------------------------------------------------------------------------

CHECK = "check:s column:s n_bad:i n_total:i"


@query("d1_duplicates", CHECK, """
SELECT 'duplicate_row' AS check, '*' AS column, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_bad, (SELECT count(*) FROM lineitem) AS n_total
UNION ALL SELECT 'duplicate_key', 'l_orderkey+l_linenumber', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)), (SELECT count(*) FROM lineitem)""")
def _(spark, folder):
    df = base.parquet(spark, folder, "lineitem")
    return quality.duplicates(df).unionByName(quality.duplicates(df, ["l_orderkey", "l_linenumber"]))


@query("d2_code_pattern", CHECK, """
SELECT 'bad_code' AS check, 'code' AS column, count(*) - count_if(coalesce(regexp_matches(code, '^[A-Z]{3}$'), FALSE)) AS n_bad, count(*) AS n_total
FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment[:3]) WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_mktsegment[:3] END AS code FROM customer)""")
def _(spark, folder):
    k, s = F.col("c_custkey"), F.substring("c_mktsegment", 1, 3)
    code = F.when(k % 10 == 0, None).when(k % 4 == 0, F.lower(s)).when(k % 3 == 0, F.col("c_mktsegment")).otherwise(s)
    df = base.parquet(spark, folder, "customer").select(code.alias("code"))
    return quality.run_checks(df, quality.pattern_checks(["code"]))


@query("d3_range_checks", CHECK, """
SELECT 'not_positive' AS check, 'Distance' AS column, count_if(Distance <= 0) AS n_bad, count(*) AS n_total FROM flights
UNION ALL SELECT 'too_early', 'DepDelay', count_if(DepDelay < -60), count(*) FROM flights
UNION ALL SELECT 'too_late', 'DepDelay', count_if(DepDelay > 1440), count(*) FROM flights
UNION ALL SELECT 'not_a_time', 'CRSDepTime', count_if(CRSDepTime < 0 OR CRSDepTime > 2359), count(*) FROM flights""")
def _(spark, folder):
    df = base.flights(spark, folder)
    return quality.run_checks(df, quality.range_checks(df.columns))


def with_times(spark, folder):
    """Flights with a departure time that is present for most flown flights and a few cancelled ones."""
    df = base.flights(spark, folder)
    there = (~F.col("Cancelled") & (F.col("flight_id") % 50 != 0)) | (F.col("Cancelled") & (F.col("flight_id") % 3 == 0))
    return df.withColumns({
        "DepTime": F.when(there, F.col("CRSDepTime")),
        "DepDelayMinutes": F.greatest(F.col("DepDelay"), F.lit(0.5)),
    })


TIMES_SQL = """
t AS (SELECT *, CASE WHEN (NOT Cancelled AND flight_id % 50 <> 0) OR (Cancelled AND flight_id % 3 = 0) THEN CRSDepTime END AS DepTime,
             CASE WHEN DepDelay IS NULL THEN 0.5 ELSE greatest(DepDelay, 0.5) END AS DepDelayMinutes FROM flights)"""


@query("d4_label_consistency", CHECK, f"""
WITH {TIMES_SQL.strip()}
SELECT 'cancelled_with_time' AS check, 'DepTime' AS column, count_if(Cancelled AND DepTime IS NOT NULL) AS n_bad, count(*) AS n_total FROM t
UNION ALL SELECT 'flown_without_time', 'DepTime', count_if(NOT Cancelled AND DepTime IS NULL), count(*) FROM t
UNION ALL SELECT 'cancelled_and_late', 'DepDelayMinutes', count_if(Cancelled AND DepDelayMinutes > 0), count(*) FROM t
UNION ALL SELECT 'cancelled_and_late', 'DepDelay', count_if(Cancelled AND DepDelay > 0), count(*) FROM t""")
def _(spark, folder):
    df = with_times(spark, folder)
    return quality.run_checks(df, quality.label_checks(df.columns))


@query("d4_cancelled_late_share", "n_cancelled:i late_share:f", """
SELECT count(*) AS n_cancelled, avg(CASE WHEN DepDelay > 0 THEN 1 ELSE 0 END) AS late_share FROM flights WHERE Cancelled""")
def _(spark, folder):
    return quality.cancelled_late_share(base.flights(spark, folder))


@query("d5_pair_mismatch", CHECK, f"""
WITH {TIMES_SQL.strip()}
SELECT 'pair_mismatch' AS check, 'DepDelay/DepDelayMinutes' AS column, count_if(round_even(DepDelay, 0) <> round_even(DepDelayMinutes, 0)) AS n_bad, count(*) AS n_total FROM t""")
def _(spark, folder):
    df = with_times(spark, folder)
    return quality.run_checks(df, quality.pair_checks(df.columns))


@query("d6_quality_report", CHECK, """
WITH f AS (SELECT flight_id, FlightDate, Airline, Origin, Dest, CRSDepTime, Cancelled, DepDelay, Distance FROM flights)
SELECT 'bad_code' AS check, 'Origin' AS column, count(*) AS n_bad, count(*) AS n_total FROM f
UNION ALL SELECT 'bad_code', 'Dest', count(*), count(*) FROM f
UNION ALL SELECT 'not_positive', 'Distance', count_if(Distance <= 0), count(*) FROM f
UNION ALL SELECT 'too_early', 'DepDelay', count_if(DepDelay < -60), count(*) FROM f
UNION ALL SELECT 'too_late', 'DepDelay', count_if(DepDelay > 1440), count(*) FROM f
UNION ALL SELECT 'not_a_time', 'CRSDepTime', count_if(CRSDepTime < 0 OR CRSDepTime > 2359), count(*) FROM f
UNION ALL SELECT 'cancelled_and_late', 'DepDelay', count_if(Cancelled AND DepDelay > 0), count(*) FROM f
UNION ALL SELECT 'duplicate_row', '*', 0, count(*) FROM f
UNION ALL SELECT 'duplicate_key', 'FlightDate+Airline+Origin+Dest+CRSDepTime', count(*) - count(DISTINCT (FlightDate, Airline, Origin, Dest, CRSDepTime)), count(*) FROM f""")
def _(spark, folder):
    df = base.flights(spark, folder).select(
        "flight_id", "FlightDate", "Airline", "Origin", "Dest", "CRSDepTime", "Cancelled", "DepDelay", "Distance"
    )
    return quality.quality_report(df)
