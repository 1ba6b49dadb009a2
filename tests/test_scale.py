"""Operators under hot keys, copies and ties, against brute force."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from contrail import session
from contrail.operators import association, enrich, features, lookups, metrics, models, ordered, profile, sampling
from contrail.plans import base, jobs
from contrail.plans.adapters import view


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key and are copies of each other in everything but their id."""
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(np.arange(n) % 3 == 0, "hot", [f"k{i}" for i in rng.integers(0, 40, n)])
    x = np.where(key == "hot", 5.0, np.round(rng.normal(0, 100, n), 1))
    pdf = pd.DataFrame({"id": np.arange(n), "key": key, "x": x, "y": (rng.random(n) < 0.2).astype(int)})
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


@pytest.fixture
def no_broadcast(spark):
    """Every stored table counts as too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_salted_lookup_equals_plain(spark, skewed, no_broadcast):
    pdf, df = skewed
    right = df.where("key <> 'k3'").groupBy("key").agg(F.avg("x").alias("m"))
    hot = lookups.find_hot(df, "key", share=0.2, salts=8)
    assert hot.values == ("hot",)
    plain = lookups.lookup(df, right, ["key"])
    salted = lookups.lookup(df, right, ["key"], hot)
    assert sorted(map(tuple, plain.select(*df.columns, "m").collect()), key=str) == sorted(
        map(tuple, salted.select(*df.columns, "m").collect()), key=str
    )
    spread = lookups.spread(df, hot).where("key = 'hot'").groupBy("_salt_").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 300


def test_a_small_table_is_broadcast_in_spite_of_hot_keys(spark, skewed):
    _, df = skewed

    def ask():
        raise AssertionError("hot keys were looked for")

    right = session.materialize(df.groupBy("key").agg(F.avg("x").alias("m")), "small")
    wide = df.groupBy("key").agg(F.avg("x").alias("m"))  # the planner's guess of its size comes from df's
    for table in (right, wide):
        plan = plan_of(lookups.lookup(df, table, ["key"], lookups.Skew("key", ask)))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "_salt_" not in plan


def test_only_a_large_table_is_salted_and_hot_keys_are_asked_for_once(spark, skewed, no_broadcast):
    _, df = skewed
    asked = []
    skew = lookups.Skew("key", lambda: (asked.append(1), lookups.find_hot(df, "key", share=0.2))[1])
    right = df.groupBy("key").agg(F.avg("x").alias("m"))
    twice = lookups.lookup(lookups.lookup(df, right, ["key"], skew), right.withColumnRenamed("m", "m2"), ["key"], skew)
    plan = plan_of(twice)
    assert len(asked) == 1 and "_salt_" in plan and "BroadcastHashJoin" not in plan
    assert twice.where("m <=> m2").count() == df.count()


def test_airport_tables_stay_broadcast(spark, folder):
    """The whole dataset job under a hot airport: no sort-merge join of the flights."""
    flights = base.flights(spark, folder).withColumn("Origin", F.when(F.col("flight_id") % 3 == 0, "CHINA").otherwise(F.col("Origin")))
    final = jobs.build_dataset(
        flights, base.weather(spark, folder), base.opsnet(spark, folder), base.causes(spark, folder), base.airports(spark, folder),
        base.runways(spark, folder), base.YEARS_OUT, base.CAUSE_YEARS)
    assert "SortMergeJoin" not in plan_of(final) and "_salt_" not in plan_of(final)


def test_runways_are_dealt_out_and_neither_stored_nor_moved(spark, folder):
    """The view's rows, many times those of its tables, come from many tasks and are summed up before anything moves them."""
    rows = base.runways(spark, folder)
    assert rows.exceptAll(view(spark, folder, "runways")).isEmpty() and view(spark, folder, "runways").exceptAll(rows).isEmpty()
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    plan = enrich.runway_profile(rows, base.airports(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert "part.parquet" in plan and 0 < plan.index("partial_count") < plan.index("p_size")
    assert "hashpartitioning" not in plan[plan.index("partial_count") : plan.index("Join", plan.index("partial_count"))]


def test_flight_history_is_summed_on_the_map_side(spark, folder):
    """One scan and one exchange; what tasks hand over are airport-days, airlines and regions, not flights."""
    df = base.splits(spark, folder).selectExpr("*", "Airline _airline", "Origin _origin", "region _region")
    history = jobs.flight_history(df)
    plan = plan_of(history)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan parquet") == 1 and "partial_count" in plan
    days = df.select("split", "Origin", "FlightDate").distinct().count()
    rows = history.groupBy("_set").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()
    assert {r["_set"]: r["n"] for r in rows} == {s: df.count() for s in ("airline", "region", "day")}
    assert {r["_set"]: r["rows"] for r in rows}["day"] == days
    hours = history.where("_set = 'day'").select(F.sum(F.aggregate("hours", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0]
    assert hours == df.where("dep_hour is not null").count()
    # with many flights a day the rows do not grow
    many = df.crossJoin(spark.range(10)).drop("id")
    assert jobs.flight_history(many).count() == history.count()


def test_only_a_join_on_the_hot_column_alone_is_salted(spark, skewed, no_broadcast):
    _, df = skewed
    hot = lookups.find_hot(df, "key", share=0.2)
    right = df.groupBy("key", "y").agg(F.avg("x").alias("m"))
    plan = lookups.lookup(df, right, ["key", "y"], hot)._jdf.queryExecution().toString()
    assert "_salt_" not in plan
    one = lookups.lookup(df, df.groupBy("key").agg(F.avg("x").alias("m")), ["key"], hot)
    assert "Broadcast" not in one._jdf.queryExecution().executedPlan().toString()


def test_null_labels_are_a_stratum(spark):
    from contrail.operators.sampling import stratified_split

    df = spark.range(400).withColumn("y", F.when(F.col("id") % 4 > 0, F.col("id") % 2))
    got = stratified_split(df, "y", {"a": 0.7, "b": 0.3}, ["id"]).groupBy("y", "part").count().collect()
    assert {(r["y"], r["part"]): r["count"] for r in got}[None, "a"] == 70


def test_quantiles_match_numpy(spark, skewed):
    pdf, df = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column"], r["p"]): r["q"] for r in ordered.exact_quantiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        for p in probs:
            assert got[c, p] == pytest.approx(np.quantile(pdf[c], p), abs=1e-9)
    by = {(r["key"], r["p"]): r["q"] for r in ordered.exact_quantiles(df, ["x"], [0.3], by=["key"]).collect()}
    for k, g in pdf.groupby("key"):
        assert by[k, 0.3] == pytest.approx(np.quantile(g["x"], 0.3), abs=1e-9)


def test_number_blocks_keep_order(spark):
    v = sorted([0.0, -0.0, 1e-300, -1e-300, 5e-324, 1.0, 1.0000001, -1.0, 1e308, -1e308, 3.0, 2.9999999, 255.0, 256.0])
    rows = spark.createDataFrame([(x,) for x in v], "v double").withColumn("b", ordered.number_block("v")).collect()
    blocks = [r.b for r in sorted(rows, key=lambda r: r.v)]
    assert blocks == sorted(blocks)


def test_crowded_values_spread_over_blocks(spark, monkeypatch):
    """Epoch seconds and texts with one long prefix: over a hundred blocks, results exact."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "128")
    stored = []
    real = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, label: stored.append(real(df, label)) or stored[-1])
    ids = spark.range(2000).select(F.lit(1).alias("n"), (F.col("id") + 1_700_000_000).cast("double").alias("t"), F.concat(F.lit("x" * 40), F.format_string("%05d", "id")).alias("s"))
    for c in ("t", "s"):
        got = [r["cum_n"] for r in ordered.running_totals(ids.select(c, "n"), c, ["n"]).orderBy(c).collect()]
        assert got == list(range(1, 2001)) and stored[-1].select("_block").distinct().count() > 100
    spark.conf.set("spark.sql.shuffle.partitions", before)
    blocks = ids.select(ordered.number_block("t", F.lit(1_700_000_000.0), F.lit(1_700_001_999.0)).alias("b")).distinct().count()
    assert blocks > 100
    assert {r["q"] for r in ordered.exact_quantiles(ids, ["t"], [0.5]).collect()} == {1_700_000_999.5}


def test_quantiles_and_totals_with_infinities(spark):
    inf, big = float("inf"), 1.7e308
    v = [-inf, -inf, -big, -1.0, 0.0, 5e-324, 2.0, 2.0, big, inf, inf]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v double")
    got = {r["p"]: r["q"] for r in ordered.exact_quantiles(df, ["v"], [0.0, 0.2, 0.4, 0.5, 0.8, 1.0]).collect()}
    assert got == {0.0: -inf, 0.2: -big, 0.4: 0.0, 0.5: 5e-324, 0.8: big, 1.0: inf}
    runs = df.dropna().groupBy("v").agg(F.count("*").alias("n"))
    totals = {r["v"]: r["cum_n"] for r in ordered.running_totals(runs, "v", ["n"]).collect()}
    assert totals == {-inf: 2, -big: 3, -1.0: 4, 0.0: 5, 5e-324: 6, 2.0: 8, big: 9, inf: 11}


def test_cuts_of_groups_do_not_move_the_rows(spark, skewed):
    _, df = skewed
    cut = ordered.cut_by_hash(df, [lambda n: n / 2], ["id"], ["key"])
    plan = plan_of(cut)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    counts = {(r["key"], r["part"]): r["count"] for r in cut.groupBy("key", "part").count().collect()}
    assert all(counts.get((k, 0), 0) == n // 2 for k, n in ((r["key"], r["count"]) for r in df.groupBy("key").count().collect()))


def test_running_totals_match_pandas(spark, skewed):
    pdf, df = skewed
    counts = df.groupBy("x").agg(F.count("*").alias("n"))
    got = {r.x: (r.cum_n, r.all_n) for r in ordered.running_totals(counts, "x", ["n"]).collect()}
    want = pdf.groupby("x").size().sort_index().cumsum()
    assert got == {x: (c, len(pdf)) for x, c in want.items()}


def test_cuts_are_exact_and_repeatable(spark, skewed):
    pdf, df = skewed
    kept = sampling.cap_per_group(df, "key", 25, ["id"])
    sizes = pdf.groupby("key").size().clip(upper=25).to_dict()
    assert {r["key"]: r["count"] for r in kept.groupBy("key").count().collect()} == sizes
    first = {r.id for r in kept.collect()}
    again = {r.id for r in sampling.cap_per_group(df.repartition(11), "key", 25, ["id"]).collect()}
    assert first == again
    assert {r.id for r in sampling.cap_per_group(df, "key", 25, ["id"], seed=1).collect()} != first
    assert sampling.sample_n(df, 10_000, ["id"]).count() == len(pdf)
    assert sampling.sample_n(df, 0, ["id"]).count() == 0


def test_cut_inside_one_hash_block(spark, monkeypatch):
    monkeypatch.setattr(ordered, "HASH_BLOCKS_BITS", 2)  # four blocks: every cut falls inside a crowded one
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    parts = ordered.cut_by_hash(df, [lambda t: t * 0.3, lambda t: t * 0.31, lambda t: t * 0.9], ["id"], ["g"])
    got = {(r.g, r.part): r["count"] for r in parts.groupBy("g", "part").count().collect()}
    assert got == {(g, p): n for g in (0, 1) for p, n in ((0, 150), (1, 5), (2, 295), (3, 50))}
    assert parts.select("id").distinct().count() == 1000


def brute_neighbours(x: np.ndarray, k: int):
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(gap, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), gap.shape), gap), axis=1)[:, :k]
    return order, np.take_along_axis(gap, order, 1)


def test_neighbours_match_brute_force(spark, monkeypatch):
    """Clusters, a third of the points in one place, far outliers; chunks so small that every path is taken."""
    monkeypatch.setattr(sampling, "CHUNK", 20)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1000, (6, 4))
    x = centres[rng.integers(0, 6, 300)] + rng.normal(0, 1, (300, 4))
    x[:100] = x[0]
    x[290:] *= 50
    points = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, x array<double>")
    got = sampling.nearest_neighbours(points, 5).collect()
    order, gap = brute_neighbours(x, 5)
    assert len(got) == 1500
    for r in got:
        assert r.distance == pytest.approx(gap[r.id, r["rank"] - 1], rel=1e-9, abs=1e-9)
        assert r.near_id == order[r.id, r["rank"] - 1]
    some = sampling.nearest_neighbours(points, 3, points.where("id % 7 = 0").select("id"))
    assert some.select("id").distinct().count() == 43


def test_synthetic_rows_lie_between_neighbours(spark, skewed):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n) * 10, "y": (np.arange(n) % 20 == 0).astype(int)})
    df = spark.createDataFrame(pdf)
    out = sampling.smote(df, ["a", "b"], "y", "id", 0.2).toPandas()
    made = out[out["synthetic"] == 1]
    assert (out["y"] == 1).sum() == int(0.2 * (pdf["y"] == 0).sum())
    for r in made.itertuples():
        p, q = pdf.loc[r.base, ["a", "b"]].to_numpy(float), pdf.loc[r.near, ["a", "b"]].to_numpy(float)
        assert 0 <= r.u < 1 and r.base != r.near and pdf.loc[r.near, "y"] == 1
        assert np.allclose([r.a, r.b], p + r.u * (q - p))
    few = spark.createDataFrame(pdf[pdf["id"].isin([0, 20, 40]) | (pdf["y"] == 0)])
    with pytest.raises(ValueError):
        sampling.smote(few, ["a", "b"], "y", "id", 0.1, k=5)
    assert sampling.smote(few, ["a", "b"], "y", "id", 0.1, k=2).where("y = 1").count() == 38


def test_spearman_with_heavy_ties(spark, skewed):
    pdf, df = skewed
    (r,) = association.spearman(df, ["x"], ["y"]).collect()
    assert r.rho == pytest.approx(pdf["x"].rank().corr(pdf["y"].rank()), abs=1e-9)


def test_degenerate_statistics_are_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, "a", 0), (1.0, 2.0, "a", 0)], "x double, z double, c string, y int")
    assert association.spearman(df, ["x"], ["z"]).first().rho is None
    assert association.anova_f(df, ["x"], "y").first().f is None
    assert association.cramers_v(df, ["c"], "y").first().v is None


def test_pacf_solves_yule_walker(spark, folder):
    df = base.flights(spark, folder).groupBy("FlightDate").agg(F.avg("DepDelay").alias("v"))
    r = [x["acf"] for x in profile.acf(df, "v", "FlightDate", 10).orderBy("lag").collect()]
    got = [x["pacf"] for x in profile.pacf(df, "v", "FlightDate", 10).orderBy("lag").collect()]
    for k in range(1, 11):
        m = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(m, r[1 : k + 1])[-1], abs=1e-9)


def test_pca_matches_numpy(spark, skewed):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(k=7.0, id=np.arange(200)))
    out, share = models.pca_2d(df, ["a", "b", "c", "k"], ["id"])
    unit = (x - x.min(0)) / (x.max(0) - x.min(0))
    u, s, _ = np.linalg.svd(unit - unit.mean(0), full_matrices=False)
    want = np.abs(u[:, :2] * s[:2])
    got = out.toPandas().sort_values("id")[["pc1", "pc2"]].abs().to_numpy()
    assert np.allclose(got, want, atol=1e-8)
    assert share == pytest.approx((s**2 / (s**2).sum())[:2])


def test_held_out_rows_do_not_touch_train_statistics(spark, folder):
    df = base.splits(spark, folder)
    changed = df.withColumns({
        "is_cancelled": F.when(F.col("split") == "train", F.col("is_cancelled")).otherwise(1),
        "is_delayed": F.when(F.col("split") == "train", F.col("is_delayed")).otherwise(0),
    })
    labels = {"c": "is_cancelled", "d": "is_delayed"}
    for d in (df, changed):
        table = features.encoding_table(d, ["Origin"], labels, 5000)
        rows = sorted(map(tuple, table.collect()))
        first = rows if d is df else first
        assert rows == first


def test_empty_scope_gives_the_global_rate(spark, folder):
    df = base.splits(spark, folder).withColumn("k", F.concat("Origin", "split"))
    out = features.target_encode(df, ["k"], {"rate": "is_delayed"}, 100)
    overall = df.where("split = 'train'").agg(F.avg("is_delayed")).first()[0]
    assert out.where("split = 'val'").select("rate").distinct().collect() == [(overall,)]


def test_enrichment_keeps_every_flight(spark, folder):
    merged = base.merged(spark, folder)
    assert merged.count() == base.flights(spark, folder).count()
    assert merged.select("flight_id").distinct().count() == merged.count()


def test_modeling_table_does_not_depend_on_row_order_or_skew_handling(spark, folder):
    from contrail.plans.queries_models import final
    from contrail.session import materialize

    table = materialize(final(spark, folder), "final")
    a = jobs.build_features(table, base.YEARS, keep=["flight_id"])
    spark.conf.set("spark.sql.shuffle.partitions", "200")  # many partitions: every origin counts as hot
    try:
        b = jobs.build_features(table.repartition(5).orderBy(F.desc("flight_id")), base.YEARS, keep=["flight_id"])
        rows_b = b.orderBy("flight_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for x, y in zip(a.orderBy("flight_id").collect(), rows_b, strict=True):
        for c in a.columns:
            assert x[c] == (pytest.approx(y[c], abs=1e-9) if isinstance(x[c], float) else y[c])


def test_sweep_equals_one_prediction_per_pair(spark, folder):
    df = base.scored(spark, folder)
    sweep = {(r.thresh_a, r.thresh_b): r.macro_f1 for r in metrics.threshold_sweep(df, [20, 50], [30, 60]).collect()}
    for (ta, tb), f1 in sweep.items():
        one = metrics.summary_metrics(metrics.cascade_predict(df, ta, tb)).first()
        assert f1 == pytest.approx(round(one.macro_f1, 4), abs=1e-4)


def test_a_cap_on_fitted_rows_does_not_change_the_fills(spark):
    rows = [(i, float(i) if i % 3 else None, float(i % 7), int(i % 5 == 0), int(i % 5 in (1, 2))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, is_cancelled int, is_delayed int")
    settings = {"maxIter": 1, "maxDepth": 2}
    fit = lambda cap: models.fit_cascade(df, ["a", "b"], "id", None, 10, cap, settings_a=settings, settings_b=settings)
    assert fit(60).fills == fit(None).fills


def test_stream_runs_in_batches_and_drops_late_rows(spark, folder):
    from contrail.plans import queries_models
    from contrail.plans.catalog import QUERIES

    obs = base.weather(spark, folder)
    got = QUERIES["r2_stream_hourly_weather"].run(spark, folder)
    batches = list(queries_models.BATCHES.values())[-1]
    late = obs.where(F.col("valid") < obs.agg(F.min("valid")).scalar() + F.expr("INTERVAL 1 DAY")).count()
    assert sum(rows > 0 for _, rows, _ in batches) >= 4 and sum(rows for _, rows, _ in batches) == obs.count() + late
    assert sum(dropped for _, _, dropped in batches) > 0 and got.where("tmpf > 900").count() == 0


def test_stored_tables_go_with_their_job(spark, folder, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    root = session.shared_dir(spark).removeprefix("file:")
    left = lambda: sorted(os.listdir(root))
    inputs = [base.flights, base.weather, base.opsnet, base.causes, base.airports, base.runways]
    tables = [load(spark, folder) for load in inputs]
    start = left()
    with session.stored_tables(spark):
        final = jobs.build_dataset(*tables, base.YEARS_OUT, base.CAUSE_YEARS)
        assert left() != start
        modeling = session.stored_result(spark, lambda: jobs.build_features(session.materialize(final, "final"), base.YEARS, keep=["flight_id"]), "modeling")
        assert modeling.count() > 0
    with pytest.raises(ZeroDivisionError), session.stored_tables(spark):
        session.materialize(spark.range(3), "lost")
        raise ZeroDivisionError
    assert left() == start
    spark.sparkContext.setCheckpointDir(before)


def test_ranges_of_many_columns_are_one_table(spark):
    """The ranges are planned once, not as a scalar query for each column and use."""
    names = [f"c{i}" for i in range(12)]
    df = spark.range(50).select(*[(F.col("id") * (i + 1)).alias(n) for i, n in enumerate(names)])
    found = ordered.quantile_row(df, names)
    assert "scalar-subquery" not in found._jdf.queryExecution().analyzed().toString()
    assert list(found.first()) == [24.5 * (i + 1) for i in range(12)]


def test_synthetic_rows_broadcast_no_table_of_minority_rows(spark):
    """The joins on the rows' ids are merged, though these tables are small."""
    df = spark.range(400).selectExpr("id", "id % 17 * 1.5 AS a", "id % 23 * 1.0 AS b", "CAST(id % 5 = 0 AS INT) AS y")
    grown = sampling.smote(df, ["a", "b"], "y", "id", 0.9)
    assert grown.where("synthetic = 1").count() == int(320 * 0.9) - 80
    plan = grown._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and ("[id" in line or "[near_id" in line)]


def test_distances_are_taken_in_slices():
    """A batch of any length makes matrices of ``SLICE`` rows at most, every row once."""
    pdf = pd.DataFrame({"id": range(2 * sampling.SLICE + 3)})
    parts = list(sampling._slices(iter([pdf, pdf.iloc[:0]])))
    assert [len(p) for p in parts] == [sampling.SLICE, sampling.SLICE, 3] and pd.concat(parts).equals(pdf)
