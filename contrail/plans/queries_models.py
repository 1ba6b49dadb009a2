"""Queries over metrics, models, streams and whole jobs (M*, R*, JOB*)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.operators import association, clean, metrics, models, sampling, search, weather
from contrail.plans import base, jobs
from contrail.plans.registry import query
from contrail.session import materialize, shared_dir
from contrail.streaming import ingest


def scratch(spark, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


PRED = "CASE WHEN prob_cancel >= 0.5 THEN 2 WHEN prob_delay >= 0.5 THEN 1 ELSE 0 END"


def predicted(spark, folder):
    return metrics.cascade_predict(base.scored(spark, folder))


@query("m6_cascade_predict", "flight_id:i prediction:i", f"SELECT flight_id, {PRED} AS prediction FROM scored")
def _(spark, folder):
    return predicted(spark, folder)


@query("m7_decode", "flight_id:i Prediction:s",
       f"SELECT flight_id, CASE {PRED} WHEN 0 THEN 'on_time' WHEN 1 THEN 'delayed' ELSE 'cancelled' END AS Prediction FROM scored")
def _(spark, folder):
    return metrics.decode(predicted(spark, folder))


@query("m8_prediction_counts", "Prediction:s n:i",
       f"SELECT CASE {PRED} WHEN 0 THEN 'on_time' WHEN 1 THEN 'delayed' ELSE 'cancelled' END AS Prediction, count(*) AS n FROM scored GROUP BY 1")
def _(spark, folder):
    return metrics.prediction_counts(metrics.decode(predicted(spark, folder)))


def sweep_sql(tas, tbs, rows: str = "scored") -> str:
    a = ", ".join(str(t) for t in tas)
    b = ", ".join(str(t) for t in tbs)
    return f"""
WITH g AS (SELECT unnest([{a}]) / 100 AS ta), h AS (SELECT unnest([{b}]) / 100 AS tb),
     p AS (SELECT ta, tb, target, CASE WHEN prob_cancel >= ta THEN 2 WHEN prob_delay >= tb THEN 1 ELSE 0 END AS pred FROM {rows}, g, h),
     c AS (SELECT ta, tb, k, count_if(target = k AND pred = k) AS hit, count_if(target = k) AS sup, count_if(pred = k) AS got
           FROM p, (SELECT unnest([0, 1, 2]) AS k) GROUP BY ta, tb, k),
     m AS (SELECT *, CASE WHEN sup + got = 0 THEN NULL ELSE 2 * hit / (sup + got) END AS f1, CASE WHEN sup = 0 THEN 0 ELSE hit / sup END AS r, CASE WHEN got = 0 THEN 0 ELSE hit / got END AS pr FROM c)
SELECT ta AS thresh_a, tb AS thresh_b, round(avg(f1), 4) AS macro_f1, round(max(r) FILTER (k = 0), 3) AS ontime_recall, round(max(r) FILTER (k = 1), 3) AS delayed_recall,
       round(max(r) FILTER (k = 2), 3) AS cancelled_recall, round(max(pr) FILTER (k = 2), 3) AS cancelled_precision FROM m GROUP BY ta, tb"""


SWEEP = "thresh_a:f thresh_b:f macro_f1:f ontime_recall:f delayed_recall:f cancelled_recall:f cancelled_precision:f"


@query("m9_threshold_sweep", SWEEP, sweep_sql(*K.TUNED_GRID))
def _(spark, folder):
    return metrics.threshold_sweep(base.scored(spark, folder))


@query("m9_threshold_sweep_resampling_grid", SWEEP, sweep_sql(*K.RESAMPLE_GRID))
def _(spark, folder):
    return metrics.threshold_sweep(base.scored(spark, folder), *K.RESAMPLE_GRID)


@query("m9_delay_sweep", SWEEP, sweep_sql([50], K.DELAY_ONLY_GRID))
def _(spark, folder):
    return metrics.delay_sweep(base.scored(spark, folder))


@query("m10_best_pair", SWEEP, sweep_sql(*K.TUNED_GRID) + " ORDER BY macro_f1 DESC, thresh_a, thresh_b LIMIT 1")
def _(spark, folder):
    return metrics.best_pair(metrics.threshold_sweep(base.scored(spark, folder)))


def scored_in(split: str) -> str:
    return f"(SELECT scored.* FROM scored JOIN splits ON scored.flight_id = splits.flight_id WHERE split = '{split}') AS r"


@query("m10_best_vs_default", "model:s thresh_a:f thresh_b:f macro_f1:f", f"""
WITH s AS ({sweep_sql(*K.TUNED_GRID, scored_in('val'))} ORDER BY macro_f1 DESC, thresh_a, thresh_b LIMIT 1),
     t AS (SELECT 'tuned' AS model, thresh_a, thresh_b FROM s UNION ALL SELECT 'default', 0.5, 0.5),
     p AS (SELECT model, thresh_a, thresh_b, target, CASE WHEN prob_cancel >= thresh_a THEN 2 WHEN prob_delay >= thresh_b THEN 1 ELSE 0 END AS pred FROM {scored_in('test')}, t),
     c AS (SELECT model, thresh_a, thresh_b, k, count_if(target = k AND pred = k) AS hit, count_if(target = k) AS sup, count_if(pred = k) AS got
           FROM p, (SELECT unnest([0, 1, 2]) AS k) GROUP BY ALL)
SELECT model, thresh_a, thresh_b, round(avg(2 * hit / (sup + got)) FILTER (sup + got > 0), 4) AS macro_f1 FROM c GROUP BY model, thresh_a, thresh_b""")
def _(spark, folder):
    df = base.scored(spark, folder).join(base.splits(spark, folder).select("flight_id", "split"), "flight_id")
    return metrics.best_vs_default(df.where("split = 'val'"), df.where("split = 'test'"))


@query("m11_confusion", "label:i prediction:i n:i share:f", f"""
WITH c AS (SELECT target AS a, {PRED} AS b, count(*) AS n FROM scored GROUP BY 1, 2),
     g AS (SELECT a.k AS label, b.k AS prediction FROM (SELECT unnest([0, 1, 2]) AS k) AS a, (SELECT unnest([0, 1, 2]) AS k) AS b),
     j AS (SELECT label, prediction, coalesce(n, 0) AS n FROM g LEFT JOIN c ON a = label AND b = prediction)
SELECT label, prediction, n, n / sum(n) OVER (PARTITION BY label) AS share FROM j""")
def _(spark, folder):
    return metrics.confusion(predicted(spark, folder))


CLASSES_SQL = f"""
p AS (SELECT target AS y, {PRED} AS p FROM scored),
c AS (SELECT k, count_if(y = k AND p = k) AS hit, count_if(y = k) AS sup, count_if(p = k) AS got FROM p, (SELECT unnest([0, 1, 2]) AS k) GROUP BY k),
m AS (SELECT k, sup, got, hit / greatest(got, 1) AS precision, hit / greatest(sup, 1) AS recall, 2 * hit / greatest(sup + got, 1) AS f1 FROM c)"""


@query("m12_class_report", "name:s precision:f recall:f f1:f support:i", f"""
WITH {CLASSES_SQL.strip()}
SELECT CAST(k AS VARCHAR) AS name, precision, recall, f1, sup AS support FROM m
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT sum(recall * sup) / sum(sup) AS a, sum(sup) AS n FROM m)
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(sup) FROM m
UNION ALL SELECT 'weighted avg', sum(precision * sup) / sum(sup), sum(recall * sup) / sum(sup), sum(f1 * sup) / sum(sup), sum(sup) FROM m""")
def _(spark, folder):
    return metrics.class_report(predicted(spark, folder))


@query("m13_summary_metrics", "accuracy:f balanced_accuracy:f gap:f macro_f1:f macro_recall:f macro_precision:f weighted_f1:f n:i", f"""
WITH {CLASSES_SQL.strip()}
SELECT sum(recall * sup) / sum(sup) AS accuracy, avg(recall) AS balanced_accuracy, sum(recall * sup) / sum(sup) - avg(recall) AS gap, avg(f1) AS macro_f1,
       avg(recall) AS macro_recall, avg(precision) AS macro_precision, sum(f1 * sup) / sum(sup) AS weighted_f1, sum(sup) AS n FROM m""")
def _(spark, folder):
    return metrics.summary_metrics(predicted(spark, folder))


def score_sql(score: str, label: int) -> str:
    return f"""
t AS (SELECT {score} AS s, count(*) AS n, count_if(target = {label}) AS pos FROM scored GROUP BY 1),
u AS (SELECT s, n, pos, sum(n) OVER (ORDER BY s DESC) AS taken, sum(pos) OVER (ORDER BY s DESC) AS hits, sum(pos) OVER () AS p, sum(n) OVER () AS total FROM t)"""


@query("m14_average_precision", "cancel:f delay:f", f"""
WITH {score_sql('prob_cancel', 2).strip()}, x AS (SELECT sum(pos / p * hits / taken) AS v FROM u)
SELECT x.v AS cancel, y.v AS delay FROM x, (WITH {score_sql('prob_delay', 1).strip()} SELECT sum(pos / p * hits / taken) AS v FROM u) AS y""")
def _(spark, folder):
    df = base.scored(spark, folder)
    delay = metrics.average_precision(df, "prob_delay", "is_delayed").scalar()
    return metrics.average_precision(df, "prob_cancel", "is_cancelled").select(
        F.col("average_precision").alias("cancel")
    ).withColumn("delay", delay)


@query("m15_roc_auc", "roc_auc:f", """
WITH r AS (SELECT target = 2 AS y, rank() OVER (ORDER BY prob_cancel) + (count(*) OVER (PARTITION BY prob_cancel) - 1) / 2 AS r FROM scored),
     c AS (SELECT count_if(y) AS p, count_if(NOT y) AS q, sum(r) FILTER (y) AS s FROM r)
SELECT (s - p * (p + 1) / 2) / (p * q) AS roc_auc FROM c""")
def _(spark, folder):
    return metrics.roc_auc(base.scored(spark, folder), "prob_cancel", "is_cancelled")


@query("m15_best_f1_threshold", "best_threshold:f best_f1:f", f"""
WITH {score_sql('prob_cancel', 2).strip()}
SELECT s AS best_threshold, 2 * hits / (taken + p) AS best_f1 FROM u ORDER BY best_f1 DESC, s DESC LIMIT 1""")
def _(spark, folder):
    return metrics.best_f1_threshold(base.scored(spark, folder), "prob_cancel", "is_cancelled")


@query("m15_f1_at_half", "f1:f", """
SELECT 2 * count_if(target = 1 AND prob_delay >= 0.5) / (count_if(target = 1) + count_if(prob_delay >= 0.5)) AS f1 FROM scored""")
def _(spark, folder):
    return metrics.f1_at(base.scored(spark, folder), "prob_delay", "is_delayed")


@query("m17_rank_trials", "thresh_a:f thresh_b:f macro_f1:f cancelled_recall:f",
       f"SELECT thresh_a, thresh_b, macro_f1, cancelled_recall FROM ({sweep_sql(*K.RESAMPLE_GRID)}) WHERE macro_f1 > 0.35")
def _(spark, folder):
    sweep = metrics.threshold_sweep(base.scored(spark, folder), *K.RESAMPLE_GRID)
    return metrics.rank_trials(sweep, "cancelled_recall", floor=("macro_f1", 0.35))


@query("m17_compare_runs", "step:i thresh_a:f thresh_b:f test_macro_f1:f place:i gain:f", f"""
WITH r AS (SELECT thresh_a, thresh_b, macro_f1 AS test_macro_f1, row_number() OVER (ORDER BY thresh_a, thresh_b) AS step FROM ({sweep_sql(*K.TUNED_GRID)}))
SELECT step, thresh_a, thresh_b, test_macro_f1, rank() OVER (ORDER BY test_macro_f1 DESC) AS place,
       test_macro_f1 - max(test_macro_f1) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gain FROM r""")
def _(spark, folder):
    """The macro F1 of one run for each threshold pair of the tuning grid, in the grid's order."""
    sweep = metrics.threshold_sweep(base.scored(spark, folder), *K.TUNED_GRID).select("thresh_a", "thresh_b", F.col("macro_f1").alias("test_macro_f1"))
    return metrics.compare_runs(sweep.withColumn("step", F.row_number().over(Window.orderBy("thresh_a", "thresh_b"))))


# --- models ---------------------------------------------------------------------------------------

NUMBERS = ["dep_hour", "Distance", "tmpf", "vsby", "sknt", "p01i", "relh", "gust"]
SMALL = {"maxIter": 4, "maxDepth": 3}


def learnable(spark, folder):
    """Training table: merged flights with splits, written out once because every model reads it many times."""
    df = materialize(clean.temporal_split(base.merged(spark, folder), base.YEARS), "merged")
    df = clean.fill_stat(df, NUMBERS, "median", F.col("split") == "train")
    return materialize(
        df.select("flight_id", "split", "target", "is_cancelled", "is_delayed", "Airline", "Origin", *NUMBERS), "learnable"
    )


def evaluate(pred):
    """Counts that say a model gave every test row one of the classes."""
    return pred.agg(
        F.count("*").alias("n"), F.sum(F.col("prediction").isin(0, 1, 2).cast("int")).alias("valid"),
    )


TEST_ROWS = "SELECT count(*) AS n, count(*) AS valid FROM splits WHERE split = 'test'"


MEASURES = ["Distance", "tmpf", "vsby", "p01i", "gust"]
_FILLED = ", ".join(f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM t WHERE split = 'train')) AS {c}" for c in MEASURES)
_SCALED = ", ".join(f"(i.{c} - (SELECT avg({c}) FROM i WHERE split = 'train')) / (SELECT stddev_samp({c}) FROM i WHERE split = 'train') AS {c}_std" for c in MEASURES)


@query("m1_preprocess", "flight_id:i airline:s origin:s slots:i " + " ".join(f"{c}_std:f" for c in MEASURES), f"""
WITH t AS (SELECT m.*, CASE WHEN yr = 2000 THEN 'val' WHEN yr = 2001 THEN 'test' ELSE 'train' END AS split FROM merged m WHERE yr <> 1997),
     i AS (SELECT flight_id, split, Airline, Origin, {_FILLED} FROM t),
     k AS (SELECT count(DISTINCT Airline) + count(DISTINCT Origin) + {len(MEASURES)} AS slots FROM t WHERE split = 'train')
SELECT flight_id, Airline AS airline, CASE WHEN Origin IN (SELECT Origin FROM t WHERE split = 'train') THEN Origin END AS origin, slots, {_SCALED}
FROM i CROSS JOIN k WHERE split = 'test'""")
def _(spark, folder):
    """A pipeline fitted on training rows with nulls, saved, loaded and applied to test rows; read back from its vectors."""
    df = clean.temporal_split(base.merged(spark, folder), base.YEARS).select("flight_id", "split", "Airline", "Origin", *[F.col(c).cast("double").alias(c) for c in MEASURES])
    df = materialize(df, "merged")
    path = scratch(spark, "preprocess")
    models.preprocess(["Airline", "Origin"], MEASURES, centre=True, impute="median").fit(df.where("split = 'train'")).write().save(path)
    out = models.PipelineModel.load(path).transform(df.where("split = 'test'"))
    names = models.vector_names(out)
    v = models.vector_to_array("features")

    def hot(prefix):
        """The category whose slot is 1; null if none is."""
        slots = [(i, n) for i, n in enumerate(names) if n.startswith(prefix)]
        return F.coalesce(*[F.when(v[i] == 1, n[len(prefix):]) for i, n in slots])

    first = len(names) - len(MEASURES)
    return out.select(
        "flight_id", hot("Airline__v_").alias("airline"), hot("Origin__v_").alias("origin"), F.size(v).alias("slots"),
        *[v[first + i].alias(f"{c}_std") for i, c in enumerate(MEASURES)])


@query("m2_logistic_regression", "n:i valid:i", TEST_ROWS)
def _(spark, folder):
    df = sampling.class_weights(learnable(spark, folder), "target")
    pre = models.preprocess(["Airline", "Origin"], NUMBERS)
    model = models.fit_lr(df.where("split = 'train'"), pre, weight="weight", max_iter=20)
    return evaluate(model.transform(df.where("split = 'test'")))


@query("m3_random_forest", "n:i valid:i", TEST_ROWS)
def _(spark, folder):
    df = sampling.class_weights(learnable(spark, folder), "target")
    pre = models.preprocess(["Airline"], NUMBERS)
    model = models.fit_rf(df.where("split = 'train'"), pre, weight="weight", numTrees=8, maxDepth=5)
    return evaluate(model.transform(df.where("split = 'test'")))


@query("m4_multiclass_boosting", "n:i valid:i", TEST_ROWS)
def _(spark, folder):
    df = models.assemble(learnable(spark, folder), NUMBERS)
    model = models.fit_multiclass_gbt(df.where("split = 'train'"), **SMALL)
    return evaluate(model.transform(df.where("split = 'test'")))


def small_cascade(df):
    return models.fit_cascade(
        df.where("split = 'train'"), NUMBERS, "flight_id", smote=0.2, settings_a=SMALL, settings_b=SMALL
    )


@query("m5_fit_cascade", "n:i valid:i", TEST_ROWS)
def _(spark, folder):
    df = learnable(spark, folder)
    scored = small_cascade(df).probabilities(df.where("split = 'test'"))
    inside = F.col("prob_cancel").between(0, 1) & F.col("prob_delay").between(0, 1)
    return scored.agg(F.count("*").alias("n"), F.sum(inside.cast("int")).alias("valid"))


@query("m16_param_search", "trial:i val_macro_f1:f val_pr_auc:f val_roc_auc:f cancel_recall:f objective:f")
def _(spark, folder):
    df = learnable(spark, folder)
    train, val = df.where("split = 'train'"), df.where("split = 'val'")
    fills = models.fill_values(train, NUMBERS)
    rows_a = models.assemble(train, NUMBERS).select("features", "is_cancelled")
    rows_b = models.assemble(models.delay_frame(train), NUMBERS).select("features", "is_delayed", "weight")
    model_b = models.boosted("is_delayed", "weight", **SMALL).fit(rows_b)
    trials = models.draw_settings(
        {"maxDepth": [2, 3], "stepSize": [0.1, 0.3], "maxIter": [2, 3], "pos_weight": [5, 10]}, 2,
        first={"maxDepth": 3, "stepSize": 0.1, "maxIter": 3, "pos_weight": 10},
    )
    run = models.cancel_trial(rows_a, val, NUMBERS, fills, model_b)
    return models.param_search(spark, trials, run, "val_macro_f1")[0]


@query("m16_delay_search", "trial:i val_rows:i flown:i delayed:i rounds_kept:i prauc_agrees:i f1_agrees:i", """
SELECT i AS trial, v.*, 1 AS rounds_kept, 1 AS prauc_agrees, 1 AS f1_agrees FROM generate_series(1, 4) t(i),
  (SELECT count(*) AS val_rows, count(*) FILTER (WHERE is_cancelled = 0) AS flown, sum(is_delayed) AS delayed FROM splits WHERE split = 'val') v""")
def _(spark, folder):
    """Adaptive search of the delay model; its metrics computed again by SQL from each trial's stored predictions."""
    kept = []
    space = {"maxIter": search.Whole(2, 8, step=2), "maxDepth": search.Whole(2, 4), "stepSize": search.Real(0.05, 0.5, log=True), "weight_factor": search.Real(0.5, 3.0)}
    _, table = jobs.tune_delay_model(
        learnable(spark, folder), "flight_id", 4, None, space=space, patience=2, features=NUMBERS, startup=2,
        keep=lambda params, scored: kept.append(materialize(scored, "scored")))
    parts = [df.withColumn("trial", F.lit(i + 1)) for i, df in enumerate(kept)]
    again = spark.sql("""
WITH s AS (SELECT * FROM {scored}),
     p AS (SELECT trial, prob_delay, count(*) AS n, sum(is_delayed) AS pos FROM s WHERE is_cancelled = 0 GROUP BY ALL),
     u AS (SELECT *, sum(pos) OVER w AS hits, sum(n) OVER w AS taken, sum(pos) OVER (PARTITION BY trial) AS all_pos FROM p
           WINDOW w AS (PARTITION BY trial ORDER BY prob_delay DESC)),
     a AS (SELECT trial, sum(pos / all_pos * hits / taken) AS prauc FROM u GROUP BY trial),
     g AS (SELECT trial, tb, target, CASE WHEN prob_delay >= tb / 100 THEN 1 ELSE 0 END AS guess FROM s LATERAL VIEW explode(sequence(10, 60, 2)) AS tb),
     c AS (SELECT trial, tb, k, count_if(target = k) AS real, count_if(guess = k) AS said, count_if(target = k AND guess = k) AS both
           FROM g LATERAL VIEW explode(array(0, 1, 2)) AS k GROUP BY ALL),
     m AS (SELECT trial, tb, avg(CASE WHEN real + said > 0 THEN 2 * both / (real + said) END) AS mf1 FROM c GROUP BY ALL),
     b AS (SELECT trial, max(round(mf1, 4)) AS mf1 FROM m GROUP BY trial),
     r AS (SELECT trial, count(*) AS val_rows, count_if(is_cancelled = 0) AS flown, sum(is_delayed) AS delayed FROM s GROUP BY trial)
SELECT r.*, a.prauc AS own_prauc, b.mf1 AS own_mf1 FROM r JOIN a USING (trial) JOIN b USING (trial)""", scored=clean.union_parts(*parts))
    close = lambda a, b: (F.abs(F.col(a) - F.col(b)) < 1e-4).cast("int")
    most = F.get_json_object("params", "$.maxIter").cast("int")
    return table.select("trial", "prauc", "best_mf1", F.col("rounds").between(1, most).cast("int").alias("rounds_kept")).join(again, "trial").select(
        "trial", "val_rows", "flown", "delayed", "rounds_kept", close("prauc", "own_prauc").alias("prauc_agrees"), close("best_mf1", "own_mf1").alias("f1_agrees"))


@query("m18_importances", "feature:s importance:f")
def _(spark, folder):
    df = models.assemble(learnable(spark, folder), NUMBERS)
    model = models.fit_rf(df.where("split = 'train'"), numTrees=8, maxDepth=5)
    return models.importances(spark, model, NUMBERS, 5)


@query("m19_feature_sweep", "num_features:i features_used:s accuracy:f macro_f1:f")
def _(spark, folder):
    df = learnable(spark, folder)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    ranked = [r["column"] for r in association.rank_features(train, NUMBERS, ["Airline"], "target").collect()]
    return models.feature_sweep(train, test, ranked, [3, 5], numTrees=5, maxDepth=4)


@query("m20_bundle", "n:i valid:i", TEST_ROWS)
def _(spark, folder):
    df = learnable(spark, folder)
    cascade = small_cascade(df)
    path = scratch(spark, "bundle")
    models.save_bundle(cascade, path)
    test = df.where("split = 'test'")
    before = cascade.predict(test).select("flight_id", F.col("Prediction").alias("before"))
    both = jobs.score(test, path).join(before, "flight_id")
    return both.agg(F.count("*").alias("n"), F.sum((F.col("Prediction") == F.col("before")).cast("int")).alias("valid"))


@query("m21_pca_2d", "flight_id:i pc1_abs:f pc2_abs:f")
def _(spark, folder):
    out, _share = models.pca_2d(learnable(spark, folder), NUMBERS, ["flight_id"])
    return out.select("flight_id", F.abs("pc1").alias("pc1_abs"), F.abs("pc2").alias("pc2_abs"))


# --- streams --------------------------------------------------------------------------------------


@query("r1_stream_enrich", "flight_id:i weather_source:s tmpf:f p01i:f gust:f",
       "SELECT flight_id, weather_source, tmpf, p01i, gust FROM merged")
def _(spark, folder):
    source, out, state = (scratch(spark, n) for n in ("flights", "enriched", "state"))
    flights = base.labelled(spark, folder)
    flights.repartition(4, "flight_id").write.parquet(source)
    hours = materialize(base.hourly(spark, folder), "hours")
    stream = ingest.stream_table(spark, source, flights.schema, files_per_batch=2)
    enriched = ingest.stream_enrich(stream, hours.drop("region"), weather.region_hourly(hours), day="wx_date")
    ingest.write_available(enriched, out, state).awaitTermination()
    return spark.read.schema(enriched.schema).parquet(out)


FILES = 8
BATCHES: dict[str, list] = {}  # of each run of the stream: (batch, rows, rows too late)


@query("r2_stream_hourly_weather", "airport_code:s w_date:d w_hour:i tmpf:f vsby:f p01i:f gust:f", """
SELECT airport_code, w_date, w_hour, tmpf, vsby, p01i, gust FROM hourly
WHERE CAST(w_date AS TIMESTAMP) + to_hours(w_hour + 1) <= (SELECT max(valid) FROM weather) - INTERVAL 2 HOURS""")
def _(spark, folder):
    """Observations arrive in the order of their time, in several micro-batches; rows of the first day that come last are too late."""
    source, out, state = (scratch(spark, n) for n in ("observations", "hours", "state"))
    obs = base.weather(spark, folder)
    ingest.write_in_order(obs, source, "valid", FILES)
    first = obs.agg(F.min("valid")).scalar()
    ingest.write_in_order(obs.where(F.col("valid") < first + F.expr("INTERVAL 1 DAY")).withColumn("tmpf", F.lit(999.0)), source, "valid", 1)
    stream = ingest.stream_table(spark, source, obs.schema, files_per_batch=2)
    hours = ingest.stream_hourly_weather(stream, "2 hours")
    run = ingest.write_available(hours, out, state)
    run.awaitTermination()
    BATCHES[out] = [(p["batchId"], p["numInputRows"], sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"])) for p in map(dict, run.recentProgress)]
    return spark.read.schema(hours.schema).parquet(out)


# --- jobs -----------------------------------------------------------------------------------------

FINAL = ("flight_id:i weather_source:s tmpf:f vsby:f sknt:f p01i:f relh:f gust:f airport_operations:f carrier_delay:f weather_delay:f "
         "nas_delay:f security_delay:f late_aircraft_delay:f airport_lat:f airport_lon:f airport_elevation:f airport_type:s "
         "num_runways:i avg_runway_length_ft:f max_runway_length_ft:f")


def final(spark, folder, store=materialize, skew=True):
    flights = base.flights(spark, folder).withColumnRenamed("wx_date", "f_date")
    return jobs.build_dataset(
        flights, base.weather(spark, folder), base.opsnet(spark, folder), base.causes(spark, folder),
        base.airports(spark, folder), base.runways(spark, folder),
        years_out=base.YEARS_OUT, cause_years=base.CAUSE_YEARS, store=store, skew=skew,
    )


@query("job1_build_dataset", FINAL, "SELECT * FROM final")
def _(spark, folder):
    return final(spark, folder)


def modeling_sql(scope: str) -> str:
    inside = "split = 'train'" if scope == "train" else "TRUE"
    causes = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]

    def rates(keys: str, m: int, prefix: str) -> str:
        return (f"SELECT {keys}, (sum(is_cancelled) + {m} * any_value(g.c)) / (count(*) + {m}) AS {prefix}_cancel_rate, "
                f"(sum(is_delayed) + {m} * any_value(g.d)) / (count(*) + {m}) AS {prefix}_delay_rate FROM s CROSS JOIN g WHERE split = 'train' GROUP BY {keys}")

    both = [f"coalesce({p}_{k}_rate, g.{k[0]}) AS {p}_{k}_rate" for p in ("airline", "airport", "month_avg", "season_avg") for k in ("cancel", "delay")]
    return f"""
WITH s AS (SELECT *, quarter(FlightDate) AS q, CASE WHEN yr = 2000 THEN 'val' WHEN yr = 2001 THEN 'test' ELSE 'train' END AS split FROM final),
     g AS (SELECT avg(is_cancelled) AS c, avg(is_delayed) AS d FROM s WHERE split = 'train'),
     md AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in ("tmpf", "relh", "num_runways", "max_runway_length_ft", "airport_elevation"))} FROM s WHERE split = 'train'),
     ea AS (SELECT Airline, row_number() OVER (ORDER BY Airline) - 1 AS Airline_enc FROM (SELECT DISTINCT Airline FROM s)),
     eo AS (SELECT Origin, row_number() OVER (ORDER BY Origin) - 1 AS Origin_enc FROM (SELECT DISTINCT Origin FROM s)),
     er AS (SELECT region, row_number() OVER (ORDER BY region) - 1 AS region_enc FROM (SELECT DISTINCT region FROM s)),
     ra AS ({rates("Airline", 10000, "airline")}), ro AS ({rates("Origin", 5000, "airport")}),
     rm AS ({rates("Origin, mon", 2000, "month_avg")}), rs AS ({rates("Origin, q", 2000, "season_avg")}),
     dy AS (SELECT split, Origin, FlightDate, count(*) AS n, sum(is_cancelled) AS k, avg(is_cancelled) AS c, avg(is_delayed) AS d FROM s GROUP BY 1, 2, 3),
     dv AS (SELECT quantile_cont(n, 0.5) AS n FROM dy WHERE split = 'train'),
     hf AS (SELECT Origin, FlightDate, dep_hour, count(*) AS n FROM s WHERE {inside} GROUP BY 1, 2, 3),
     lc AS (SELECT Origin, yr * 12 + mon + 1 AS ym, {", ".join(f"min({c}) AS {c}" for c in causes)} FROM s WHERE {inside} GROUP BY 1, 2)
SELECT s.flight_id, s.FlightDate, s.split, target, is_cancelled, is_delayed, is_on_time, s.dep_hour, Distance,
       coalesce(s.tmpf, md.tmpf) AS tmpf, coalesce(vsby, 10) AS vsby, coalesce(sknt, 0) AS sknt, coalesce(p01i, 0) AS p01i, coalesce(s.relh, md.relh) AS relh, coalesce(gust, 0) AS gust,
       sin(2 * pi() * s.mon / 12) AS month_sin, cos(2 * pi() * s.mon / 12) AS month_cos, sin(2 * pi() * isodow(s.FlightDate) / 7) AS dow_sin, cos(2 * pi() * isodow(s.FlightDate) / 7) AS dow_cos,
       CASE WHEN s.dep_hour IN (5, 6, 7) THEN 1 ELSE 0 END AS is_early_morning, CASE WHEN s.dep_hour >= 18 THEN 1 ELSE 0 END AS is_evening,
       CASE WHEN s.mon IN (6, 7, 8) THEN 1 ELSE 0 END AS is_summer, CASE WHEN s.mon IN (11, 12, 1) THEN 1 ELSE 0 END AS is_holiday_season,
       CASE WHEN coalesce(sknt, 0) > 20 THEN 1 ELSE 0 END AS high_wind, CASE WHEN coalesce(vsby, 10) < 3 THEN 1 ELSE 0 END AS low_visibility,
       CASE WHEN coalesce(p01i, 0) > 0 AND p01i <= 0.1 THEN 1 ELSE 0 END AS precip_light, CASE WHEN coalesce(p01i, 0) > 0.1 AND p01i <= 0.5 THEN 1 ELSE 0 END AS precip_moderate,
       CASE WHEN coalesce(p01i, 0) > 0.5 THEN 1 ELSE 0 END AS precip_heavy,
       (coalesce(sknt, 0) / 30 + coalesce(gust, 0) / 50 + (1 - coalesce(vsby, 10) / 10) + least(coalesce(p01i, 0), 2) / 2) / 4 AS weather_severity,
       CASE weather_source WHEN 'airport_hour_match' THEN 0 WHEN 'region_hour_match' THEN 1 ELSE 2 END AS weather_source_enc,
       Airline_enc, Origin_enc, region_enc, {", ".join(both)},
       coalesce(dy.d, g.d) AS lag1_delay_rate, coalesce(dy.c, g.c) AS lag1_cancel_rate, coalesce(dy.n, dv.n) AS lag1_volume,
       CASE WHEN dy.k > 0 THEN 1 ELSE 0 END AS cancelled_yesterday, coalesce(hf.n, 1) AS hourly_flights,
       coalesce(airport_operations, 0) AS airport_operations, CASE WHEN airport_operations > 0 THEN 1 ELSE 0 END AS has_opsnet,
       coalesce(airport_operations, 0) / greatest(1, coalesce(s.num_runways, md.num_runways)) AS ops_per_runway,
       coalesce(s.num_runways, md.num_runways) AS num_runways, coalesce(s.max_runway_length_ft, md.max_runway_length_ft) AS max_runway_length_ft,
       coalesce(s.airport_elevation, md.airport_elevation) AS airport_elevation,
       {", ".join(f"coalesce(lc.{c}, 0) AS lag1m_{c}" for c in causes)}
FROM s CROSS JOIN g CROSS JOIN md CROSS JOIN dv
JOIN ea ON s.Airline = ea.Airline JOIN eo ON s.Origin = eo.Origin JOIN er ON s.region = er.region
LEFT JOIN ra ON s.Airline = ra.Airline LEFT JOIN ro ON s.Origin = ro.Origin
LEFT JOIN rm ON s.Origin = rm.Origin AND s.mon = rm.mon LEFT JOIN rs ON s.Origin = rs.Origin AND s.q = rs.q
LEFT JOIN dy ON s.split = dy.split AND s.Origin = dy.Origin AND s.FlightDate = dy.FlightDate + 1
LEFT JOIN hf ON s.Origin = hf.Origin AND s.FlightDate = hf.FlightDate AND s.dep_hour = hf.dep_hour
LEFT JOIN lc ON s.Origin = lc.Origin AND s.yr * 12 + s.mon = lc.ym"""


_WHOLE = {"target", "is_cancelled", "is_delayed", "is_on_time", "dep_hour", "Airline_enc", "Origin_enc", "region_enc", "weather_source_enc"}
MODELING = "flight_id:i FlightDate:d split:s " + " ".join(
    f"{c}:{'i' if c in _WHOLE else 'f'}" for c in [*K.META[2:], *K.FEATURES_50]
)


@query("job2_build_features", MODELING, modeling_sql("train"))
def _(spark, folder):
    table = materialize(final(spark, folder), "final")
    return jobs.build_features(table, base.YEARS, keep=["flight_id"])


@query("job2_build_features_all_scope", MODELING, modeling_sql("all"))
def _(spark, folder):
    table = materialize(final(spark, folder), "final")
    return jobs.build_features(table, base.YEARS, scope="all", keep=["flight_id"])


@query("job3_build_rf_features", "flight_id:i target:i dep_hour:i is_holiday:i is_morning_peak:i is_evening_peak:i has_precip:i prev_day_failure_origin:i dow_sin:f distance_origin_norm:f Distance_std:f tmpf_std:f", f"""
WITH h AS ({base.HOLIDAY_SQL}),
     m AS (SELECT * FROM merged WHERE yr <> 1997),
     d AS (SELECT Origin, FlightDate, max(greatest(is_cancelled, is_delayed)) AS f FROM m GROUP BY 1, 2),
     p AS (SELECT Origin, FlightDate, coalesce(lag(f) OVER (PARTITION BY Origin ORDER BY FlightDate), 0) AS prev FROM d)
SELECT flight_id, target, dep_hour, is_holiday,
       CASE WHEN dep_hour BETWEEN 6 AND 9 THEN 1 ELSE 0 END AS is_morning_peak, CASE WHEN dep_hour BETWEEN 17 AND 23 THEN 1 ELSE 0 END AS is_evening_peak,
       CASE WHEN coalesce(p01i, 0) > 0 THEN 1 ELSE 0 END AS has_precip, prev AS prev_day_failure_origin, sin(2 * pi() * (isodow(m.FlightDate) - 1) / 7) AS dow_sin,
       Distance - avg(Distance) OVER (PARTITION BY m.Origin) AS distance_origin_norm, (Distance - avg(Distance) OVER ()) / stddev_pop(Distance) OVER () AS Distance_std,
       (tmpf - avg(tmpf) OVER ()) / stddev_pop(tmpf) OVER () AS tmpf_std
FROM m JOIN p ON m.Origin = p.Origin AND m.FlightDate = p.FlightDate JOIN h ON m.FlightDate = h.FlightDate""")
def _(spark, folder):
    from contrail.operators.features import holiday_dates

    days = holiday_dates(spark, 1995, 2001)
    merged = materialize(base.merged(spark, folder), "merged")
    return jobs.build_rf_features(merged.drop("is_cancelled", "is_delayed", "is_on_time", "target", "target_name"), days, base.YEARS_OUT)


@query("job4_to_job6_train_tune_score", "Prediction:s n:i")
def _(spark, folder):
    """The whole job: all trials over the published settings, the published delay model, every training row."""
    table = materialize(final(spark, folder), "final")
    modeling = materialize(jobs.build_features(table, base.YEARS, keep=["flight_id"]), "modeling")
    cascade, _table = jobs.train_cascade(modeling, "flight_id")
    path = scratch(spark, "cascade")
    jobs.tune_and_save(cascade, modeling, path)
    return metrics.prediction_counts(jobs.score(modeling.where("split = 'test'"), path))


def _sample_sql() -> str:
    """Sizes of all samples: the minority grown to ``over`` of the majority first, then the majority cut to minority / ``under``."""
    rows = [
        f"('{label}', '{name}', {over or 0}::DOUBLE, {under or 0}::DOUBLE)"
        for label, samples in (("is_cancelled", models.CANCEL_SAMPLES), ("is_delayed", models.DELAY_SAMPLES)) for name, (over, under) in samples.items()
    ]
    return f"""
WITH t AS (SELECT * FROM splits WHERE split = 'train'),
     s AS (SELECT * FROM (VALUES {", ".join(rows)}) v(label, name, over, under)),
     c AS (SELECT 'is_cancelled' AS label, count_if(is_cancelled = 1) AS pos, count_if(is_cancelled = 0) AS neg FROM t
           UNION ALL SELECT 'is_delayed', count_if(is_delayed = 1), count_if(is_delayed = 0) FROM t WHERE is_cancelled = 0),
     g AS (SELECT label, name, under, greatest(pos, floor(neg * over)) AS pos, neg FROM s JOIN c USING (label)),
     m AS (SELECT *, CASE WHEN under > 0 THEN floor(least(pos, neg) / under) ELSE pos + neg END AS room FROM g)
SELECT label, name, CAST(least(pos, neg) + least(greatest(pos, neg), room) AS BIGINT) AS rows,
       CAST(CASE WHEN pos <= neg THEN pos ELSE least(pos, room) END AS BIGINT) AS positives FROM m"""


@query("job8_resampled_sizes", "label:s name:s rows:i positives:i", _sample_sql())
def _(spark, folder):
    numbers, _fills = jobs.training_numbers(learnable(spark, folder), "flight_id", NUMBERS, None, 42)
    parts = jobs.resampled_rows(numbers, "flight_id", NUMBERS)
    return clean.union_parts(*[
        rows.agg(F.count("*").alias("rows"), F.sum(label).alias("positives")).select(F.lit(label).alias("label"), F.lit(name).alias("name"), "rows", "positives")
        for (label, name), rows in parts.items()])


@query("job8_resampling_experiment", "model_a:s model_b:s thresh_a:f thresh_b:f val_rows:i f1_agrees:i prauc_agrees:i", f"""
SELECT a AS model_a, b AS model_b, ta / 100 AS thresh_a, tb / 100 AS thresh_b, (SELECT count(*) FROM splits WHERE split = 'val') AS val_rows, 1 AS f1_agrees, 1 AS prauc_agrees
FROM (SELECT unnest({list(models.CANCEL_SAMPLES)}) AS a), (SELECT unnest({list(models.DELAY_SAMPLES)}) AS b),
     (SELECT unnest({K.RESAMPLE_GRID[0]}) AS ta), (SELECT unnest({K.RESAMPLE_GRID[1]}) AS tb)""")
def _(spark, folder):
    """All pairs of models and thresholds; macro F1 and average precision computed again by SQL from the stored scores."""
    kept = []
    _, sweep, samples = jobs.resampling_experiment(learnable(spark, folder), "flight_id", None, settings=SMALL, features=NUMBERS, keep=kept.append)
    (scored,) = kept
    stack = lambda label, names: F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"{label}__{n}").alias("p")) for n in names])
    long = scored.select("target", "is_cancelled", "is_delayed", stack("is_cancelled", models.CANCEL_SAMPLES).alias("cancels"), stack("is_delayed", models.DELAY_SAMPLES).alias("delays"))
    again = spark.sql("""
WITH g AS (SELECT model_a, model_b, ta, tb, target, CASE WHEN pa >= ta / 100 THEN 2 WHEN pb >= tb / 100 THEN 1 ELSE 0 END AS guess
           FROM (SELECT target, a.name AS model_a, a.p AS pa, b.name AS model_b, b.p AS pb
                 FROM {long} LATERAL VIEW explode(cancels) AS a LATERAL VIEW explode(delays) AS b)
           LATERAL VIEW explode(sequence(10, 55, 5)) AS ta LATERAL VIEW explode(sequence(10, 55, 5)) AS tb),
     n AS (SELECT model_a, model_b, ta, tb, count(*) AS val_rows,
             count_if(target = 0) AS s0, count_if(target = 1) AS s1, count_if(target = 2) AS s2, count_if(guess = 0) AS g0, count_if(guess = 1) AS g1, count_if(guess = 2) AS g2,
             count_if(target = 0 AND guess = 0) AS h0, count_if(target = 1 AND guess = 1) AS h1, count_if(target = 2 AND guess = 2) AS h2 FROM g GROUP BY ALL),
     f AS (SELECT *, try_divide(2 * h0, s0 + g0) AS f0, try_divide(2 * h1, s1 + g1) AS f1, try_divide(2 * h2, s2 + g2) AS f2 FROM n)
SELECT model_a, model_b, ta / 100 AS thresh_a, tb / 100 AS thresh_b, val_rows,
       (coalesce(f0, 0) + coalesce(f1, 0) + coalesce(f2, 0)) / (int(f0 IS NOT NULL) + int(f1 IS NOT NULL) + int(f2 IS NOT NULL)) AS own_f1 FROM f""", long=long)
    curves = spark.sql("""
WITH s AS (SELECT 'is_cancelled' AS label, m.name, m.p, is_cancelled AS y FROM {long} LATERAL VIEW explode(cancels) AS m
           UNION ALL SELECT 'is_delayed', m.name, m.p, is_delayed FROM {long} LATERAL VIEW explode(delays) AS m WHERE is_cancelled = 0),
     t AS (SELECT label, name, p, count(*) AS n, sum(y) AS pos FROM s GROUP BY ALL),
     u AS (SELECT *, sum(pos) OVER w AS hits, sum(n) OVER w AS taken, sum(pos) OVER (PARTITION BY label, name) AS all_pos FROM t
           WINDOW w AS (PARTITION BY label, name ORDER BY p DESC))
SELECT label, name, sum(pos / all_pos * hits / taken) AS own FROM u GROUP BY ALL""", long=long)
    right = samples.join(curves, ["label", "name"]).agg(F.sum((F.abs(F.col("pr_auc") - F.col("own")) < 1e-6).cast("int")).alias("agree"))
    agree = (F.lit(len(models.CANCEL_SAMPLES) + len(models.DELAY_SAMPLES)) == right.scalar()).cast("int")
    both = sweep.join(again, ["model_a", "model_b", "thresh_a", "thresh_b"])
    return both.select(
        "model_a", "model_b", "thresh_a", "thresh_b", "val_rows", (F.abs(F.col("macro_f1") - F.col("own_f1")) < 1e-4).cast("int").alias("f1_agrees"), agree.alias("prauc_agrees"))


@query("job7_eda_report", "table:s n:i")
def _(spark, folder):
    flights, merged = base.labelled(spark, folder), base.merged(spark, folder)
    report = jobs.eda_report(flights, merged, base.weather(spark, folder))
    parts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, t in report.items()]
    return clean.union_parts(*parts)




@query("m15_score_summary", "pr_auc:f roc_auc:f best_threshold:f best_f1:f", f"""
WITH {score_sql('prob_delay', 1).strip()},
     b AS (SELECT s, 2 * hits / (taken + p) AS f1 FROM u ORDER BY f1 DESC, s DESC LIMIT 1)
SELECT sum(pos / p * hits / taken) AS pr_auc, sum((n - pos) * (hits - pos / 2)) / any_value(p * (total - p)) AS roc_auc,
       (SELECT s FROM b) AS best_threshold, (SELECT f1 FROM b) AS best_f1 FROM u""")
def _(spark, folder):
    return metrics.score_summary(base.scored(spark, folder), "prob_delay", "is_delayed")


@query("job3_build_linear_features", "flight_id:i target:i Airline:s dep_hour:f DayOfWeek:f month_sin:f dow_cos:f tmpf:f gust:f is_red_eye:f "
       "is_evening:f is_holiday_season:f high_wind:f low_visibility:f precip_light:f precip_moderate:f precip_heavy:f", """
SELECT flight_id, target, Airline, dep_hour, isodow(FlightDate) AS "DayOfWeek", sin(2 * pi() * mon / 12) AS month_sin, cos(2 * pi() * isodow(FlightDate) / 7) AS dow_cos,
       coalesce(tmpf, 0) AS tmpf, coalesce(gust, 0) AS gust, CASE WHEN dep_hour <= 4 THEN 1 ELSE 0 END AS is_red_eye, CASE WHEN dep_hour >= 18 THEN 1 ELSE 0 END AS is_evening,
       CASE WHEN mon IN (11, 12, 1) THEN 1 ELSE 0 END AS is_holiday_season, CASE WHEN sknt > 20 OR gust > 35 THEN 1 ELSE 0 END AS high_wind,
       CASE WHEN vsby < 3 THEN 1 ELSE 0 END AS low_visibility, CASE WHEN p01i >= 0.01 AND p01i < 0.1 THEN 1 ELSE 0 END AS precip_light,
       CASE WHEN p01i >= 0.1 AND p01i < 0.5 THEN 1 ELSE 0 END AS precip_moderate, CASE WHEN p01i >= 0.5 THEN 1 ELSE 0 END AS precip_heavy FROM merged""")
def _(spark, folder):
    return jobs.build_linear_features(base.merged(spark, folder), keep=["flight_id", "target"])


@query("job3_build_boosted_features", "flight_id:i split:s Airline_enc:i origin_cancel_rate:f lag1_cancel_rate:f lag1_volume:f hour_sin:f freezing:i "
       "nas_x_peak:f lag_cancel_x_winter:f lag_delay_x_peak:f precip_x_evening:i", """
WITH s AS (SELECT *, CASE WHEN yr = 2000 THEN 'val' WHEN yr = 2001 THEN 'test' ELSE 'train' END AS split,
             CASE WHEN dep_hour BETWEEN 8 AND 11 THEN 1 ELSE 0 END AS peak, CASE WHEN dep_hour BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS eve,
             CASE WHEN mon IN (12, 1, 2) THEN 1 ELSE 0 END AS winter FROM final),
     g AS (SELECT avg(is_cancelled) AS c, avg(is_delayed) AS d FROM s WHERE split = 'train'),
     a AS (SELECT Airline, row_number() OVER (ORDER BY Airline) - 1 AS i FROM (SELECT DISTINCT Airline FROM s)),
     o AS (SELECT Origin, count(*) AS n, sum(is_cancelled) AS c FROM s WHERE split = 'train' GROUP BY 1),
     d AS (SELECT Origin, FlightDate, count(*) AS n, avg(is_cancelled) AS c, avg(is_delayed) AS d FROM s WHERE split = 'train' GROUP BY 1, 2),
     j AS (SELECT s.*, a.i, (coalesce(o.c, 0) + 5000 * g.c) / (coalesce(o.n, 0) + 5000) AS oc, d.n AS dn, coalesce(d.c, g.c) AS dc, coalesce(d.d, g.d) AS dd
           FROM s CROSS JOIN g JOIN a ON s.Airline = a.Airline LEFT JOIN o ON s.Origin = o.Origin LEFT JOIN d ON s.Origin = d.Origin AND s.FlightDate = d.FlightDate + 1)
SELECT flight_id, split, i AS "Airline_enc", oc AS origin_cancel_rate, dc AS lag1_cancel_rate, coalesce(dn, (SELECT avg(dn) FROM j WHERE split = 'train')) AS lag1_volume,
       sin(2 * pi() * dep_hour / 24) AS hour_sin, CASE WHEN tmpf < 32 THEN 1 ELSE 0 END AS freezing, nas_delay * peak AS nas_x_peak, dc * winter AS lag_cancel_x_winter,
       dd * peak AS lag_delay_x_peak, CASE WHEN coalesce(p01i, 0) > 0 THEN eve ELSE 0 END AS precip_x_evening FROM j""")
def _(spark, folder):
    table = materialize(final(spark, folder), "final")
    return jobs.build_boosted_features(table, base.YEARS, keep=["flight_id"])
