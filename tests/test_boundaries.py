"""Hand-written rows at the edges of each rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.functions import casts, flags, values
from contrail.operators import clean, enrich, features, lookups, metrics, profile, quality, weather
from contrail.sources import traffic_report
from contrail.streaming import ingest

D = dt.date


def one(df, c="v"):
    return [r[c] for r in df.collect()]


def test_lenient_casts(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "t string")
    assert one(df.select(casts.to_num("t").alias("v"))) == [1.0, None, None, 2.5]
    days = spark.createDataFrame([("01/31/2020",), ("13/45/2020",), (None,)], "t string")
    assert one(days.select(casts.to_date("t", "MM/dd/yyyy").alias("v"))) == [D(2020, 1, 31), None, None]


def test_hhmm_hour(spark):
    df = spark.createDataFrame([("0",), ("59",), ("100",), ("2359",), ("2400",), (None,), ("abc",)], "t string")
    assert one(df.select(casts.hhmm_hour("t").alias("v"))) == [0, 0, 1, 23, 23, None, None]
    assert one(df.select(casts.hhmm_hour("t", clip=False).alias("v")))[4] == 24


def test_labels(spark):
    rows = [(d, c) for c in (True, False, None) for d in (14.0, 15.0, None)]
    df = clean.label_flights(spark.createDataFrame(rows, "DepDelay double, Cancelled boolean"))
    assert one(df, "target") == [2, 2, 2, 0, 1, 0, 0, 1, 0]
    assert all(r.is_cancelled + r.is_delayed + r.is_on_time == 1 for r in df.collect())


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (3.0,), (3.1,), (None,), (float("nan"),)], "x double")
    out = one(df.select(values.bin_right_closed("x", [0, 1, 3], ["a", "b"]).alias("v")))
    assert out == [None, "a", "b", "b", None, None, None]
    closed = one(df.select(values.bin_right_closed("x", [0, 1, 3], ["a", "b"], include_lowest=True).alias("v")))
    assert closed[0] == "a"
    with pytest.raises(ValueError):
        values.bin_right_closed("x", [0, 1], ["a", "b"])


def test_city_names(spark):
    rows = ["DALLAS/FORT WORTH, tx", "O'HARE", "A, b, c", None, "st. louis, MO"]
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    out = one(df.select(values.canon_city("c").alias("v")))
    assert out == ["Dallas/Fort Worth, TX", "O'Hare", "A", None, "St. Louis, MO"]


def test_holidays(spark):
    days = {r.holiday for r in features.holiday_dates(spark, 2018, 2022).collect()}
    assert D(2020, 7, 3) in days and D(2020, 7, 4) in days  # Saturday: also observed on Friday
    assert D(2021, 12, 31) in days and D(2022, 1, 1) in days
    assert D(2021, 6, 18) in days and D(2021, 6, 19) in days and D(2020, 6, 19) not in days
    assert D(2022, 6, 20) in days  # Sunday: observed on Monday
    assert D(2019, 5, 27) in days and D(2018, 11, 22) in days and D(2021, 1, 18) in days and D(2022, 9, 5) in days
    assert D(2020, 11, 27) not in days


def test_guards(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        clean.require_columns(df, ["a", "b"])
    assert clean.optional_columns(df, {"a": 9, "b": 2}).first() == (1, 2)
    assert clean.drop_leakage(spark.createDataFrame([(1, 2)], "DepDelay int, Origin int")).columns == ["Origin"]


def test_scope_filters(spark):
    df = spark.createDataFrame([(D(2020, 5, 1),), (D(2021, 1, 1),), (D(2019, 12, 31),), (None,)], "FlightDate date")
    assert clean.exclude_years(df).count() == 3
    assert clean.drop_null(clean.exclude_years(df), ["FlightDate"]).count() == 2


def test_hourly_rollup_nulls(spark):
    t = dt.datetime(2021, 1, 1, 5, 10)
    rows = [("A", t, 1.0, None, 3.0), ("A", t, 3.0, None, None), ("A", None, 9.0, 1.0, 1.0), (None, t, 1.0, 1.0, 1.0)]
    obs = spark.createDataFrame(rows, "airport_code string, valid timestamp, tmpf double, p01i double, gust double")
    (r,) = weather.hourly_weather(obs).collect()
    assert (r.w_hour, r.tmpf, r.p01i, r.gust) == (5, 2.0, None, 3.0)
    assert weather.hourly_weather(obs, zero_if_empty=True).first().p01i == 0.0


def test_region_rollup_counts_stations_once(spark):
    t = dt.datetime(2021, 1, 1, 5)
    rows = [("ATL", t, 10.0)] * 3 + [("MIA", t, 30.0), ("XXX", t, 99.0)]
    obs = spark.createDataFrame(rows, "airport_code string, valid timestamp, tmpf double")
    hourly = weather.station_regions(weather.hourly_weather(obs))
    (r,) = weather.region_hourly(hourly).collect()
    assert (r.region, r.tmpf) == ("South", 20.0)


def test_fallback_is_per_measure(spark):
    day = D(2021, 1, 1)
    flights = spark.createDataFrame([("A", "R", day, 5), ("B", "R", day, 5), ("C", None, day, 5)],
                                    "Origin string, region string, f_date date, dep_hour int")
    hourly = spark.createDataFrame([("A", day, 5, 50.0, None)], "airport_code string, w_date date, w_hour int, tmpf double, gust double")
    region = spark.createDataFrame([("R", day, 5, 10.0, 7.0)], "region string, w_date date, w_hour int, tmpf double, gust double")
    out = {r.Origin: r for r in weather.enrich_with_fallback(flights, hourly, region).collect()}
    assert (out["A"].tmpf, out["A"].gust, out["A"].weather_source) == (50.0, 7.0, "airport_hour_match")
    assert (out["B"].tmpf, out["B"].weather_source) == (10.0, "region_hour_match")
    assert (out["C"].tmpf, out["C"].weather_source) == (None, "still_missing")


def test_prior_day_is_not_previous_row(spark):
    rows = [("A", D(2018, 1, d), c, 0, "train") for d, c in ((1, 1), (2, 0), (5, 0))]
    rows += [("A", D(2021, 1, 1), 0, 0, "val")]
    df = spark.createDataFrame(rows, "Origin string, FlightDate date, is_cancelled int, is_delayed int, split string")
    lag = {r.FlightDate: r for r in features.prior_day_features(df).collect()}
    assert lag[D(2018, 1, 2)].lag1_cancel_rate == 1.0 and lag[D(2018, 1, 2)].cancelled_yesterday == 1.0
    assert lag[D(2018, 1, 5)].lag1_cancel_rate == pytest.approx(1 / 3)  # gap: training average
    assert lag[D(2021, 1, 1)].lag1_volume == 1.0
    prev = {r.FlightDate: r.prev_day_failure_origin for r in features.prev_day_failure(df).collect()}
    assert prev == {D(2018, 1, 1): 0, D(2018, 1, 2): 1, D(2018, 1, 5): 0, D(2021, 1, 1): 0}


def test_prior_month_rolls_over(spark):
    df = spark.createDataFrame([(2019, 12, 5), (2020, 3, 6)], "year int, month int, v int")
    assert {tuple(r) for r in lookups.prior_month(df).collect()} == {(2020, 1, 5), (2020, 4, 6)}


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 9), ("a", 8)], "k string, y int")
    assert {(r.x, r.y) for r in lookups.lookup(left, right, ["k"]).collect()} == {(1, None), (2, 8)}


def test_weather_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "tmpf double, sknt double, vsby double, p01i double, gust double")
    r = flags.weather_flags(df).withColumn("s", flags.weather_severity()).first()
    assert (r.high_wind, r.low_visibility, r.has_precip, r.freezing, r.s) == (0, 0, 0, 0, 0.0)


def test_safe_ratio(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 4.0), (10.0, None)], "a double, b double")
    assert one(df.select(values.safe_ratio("a", "b").alias("v"))) == [10.0, 2.5, 0.0, 0.0]


def test_runways(spark):
    airports = spark.createDataFrame([(1, " KA ", "A"), (2, "KB", None)], "id int, ident string, iata_code string")
    rows = [("KA", "100", 0), ("KA", "300", None), ("KA", "500", 1), ("KA", None, 0), ("KB", "900", 0)]
    out = enrich.runway_profile(spark.createDataFrame(rows, "airport_ident string, length_ft string, closed int"), airports)
    assert [tuple(r) for r in out.collect()] == [("A", 2, 200.0, 300.0)]


def test_traffic_report(spark, tmp_path):
    html = (
        "<table>\n<tr><th rowspan=1>x</th><th>x</th><th colspan=\"2\">Ops</th></tr>\n"
        "<tr><th>Date</th><th>Facility</th><th>Carrier</th><th>Total Operations</th></tr>\n"
        "<tr><td>01/02/2019</td><td> ATL&nbsp;</td><td>1</td><td>1,234</td></tr>\n"
        "<tr><td>Sub-Total for ATL</td><td></td><td>1</td><td>1</td></tr>\n"
        "<tr><td>13/45/2020</td><td>ATL</td><td>1</td><td>1</td></tr>\n"
        "<tr><td>01/03/2019</td><td>ATL</td><td>1</td><td></td></tr>\n"
        "<tr><td>Total</td><td></td><td>2</td><td>9</td></tr>\n</table>\n"
    )
    path = tmp_path / "report.xls"
    path.write_text(html)
    out = traffic_report.read_traffic_report(spark, str(path)).orderBy("date").collect()
    assert [tuple(r) for r in out] == [(D(2019, 1, 2), "ATL", 1234.0), (D(2019, 1, 3), "ATL", None)]


def test_two_reports_with_their_own_headers(spark, tmp_path):
    (tmp_path / "a.xls").write_text(
        "<table><tr><th>x</th><th>x</th><th>Ops</th></tr><tr><th>Date</th><th>Facility</th><th>Total Operations</th></tr>"
        "<tr><td>01/02/2019</td><td>ATL</td><td>5</td><td>one too many</td></tr>"
        "<tr><td>01/03/2019</td><td>ATL</td></tr></table>")
    (tmp_path / "b.xls").write_text(
        "<table><tr><th>x</th><th colspan=2>Ops</th><th>x</th></tr>"
        "<tr><th>Facility</th><th>Carrier</th><th>Total Operations</th><th>Date</th></tr>"
        "<tr><td>BOS</td><td colspan='2'>7</td><td>01/02/2019</td></tr>"
        "<tr><td>ATL</td><td>1</td><td>6</td><td>01/02/2019</td></tr></table>")
    out = traffic_report.read_traffic_report(spark, str(tmp_path)).orderBy("date", "airport").collect()
    assert [tuple(r) for r in out] == [(D(2019, 1, 2), "ATL", 6.0), (D(2019, 1, 2), "BOS", 7.0), (D(2019, 1, 3), "ATL", None)]


def test_scores_with_ties_and_single_class(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.5, 1), (0.5, 0), (0.1, 0)], "s double, y int")
    # thresholds 0.9: P 1, R 1/2; 0.5: P 2/4, R 1
    assert metrics.average_precision(df, "s", "y").first()[0] == pytest.approx(0.5 * 1 + 0.5 * 0.5)
    assert metrics.roc_auc(df, "s", "y").first()[0] == pytest.approx((3 + 1 + 0.5 * 2) / 6)
    best = metrics.best_f1_threshold(df, "s", "y").first()
    assert (best.best_threshold, best.best_f1) == (0.9, pytest.approx(2 / 3))
    none = df.withColumn("y", F.lit(0))
    assert metrics.average_precision(none, "s", "y").first()[0] == 0.0
    assert metrics.roc_auc(none, "s", "y").first()[0] is None


def test_report_with_absent_classes(spark):
    # class 1 is never predicted, class 2 is predicted but never true
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (0, 2)], "target int, prediction int")
    rows = {r.name: r for r in metrics.class_report(df).collect()}
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1, rows["1"].support) == (0, 0, 0, 1)
    assert (rows["2"].precision, rows["2"].support) == (0, 0)
    assert rows["accuracy"].f1 == 0.5
    assert rows["macro avg"].f1 == pytest.approx((2 * 2 / (3 + 3)) / 3)
    assert metrics.summary_metrics(df).first().balanced_accuracy == pytest.approx((2 / 3 + 0) / 2)


def test_confusion_fills_cells(spark):
    df = spark.createDataFrame([(0, 0), (2, 0)], "target int, prediction int")
    cells = {(r.label, r.prediction): (r.n, r.share) for r in metrics.confusion(df).collect()}
    assert len(cells) == 9 and cells[2, 0] == (1, 1.0) and cells[1, 1] == (0, 0.0)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.4, 0.5), (0.4, 0.4)], "prob_cancel double, prob_delay double")
    assert one(metrics.decode(metrics.cascade_predict(df)), "Prediction") == ["cancelled", "delayed", "on_time"]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.5, 0.0), (1.5, 2.0), (2.5, 3.0), (1.0, None)], "a double, b double")
    (r,) = quality.run_checks(df, quality.pair_checks(df.columns, [("a", "b")])).collect()
    assert (r.n_bad, r.n_total) == (1, 4)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,), (10.1,)], "x double")
    assert one(profile.histogram(df, "x", 5, 0, 10).orderBy("bin"), "n") == [2, 1, 0, 0, 1]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(one(profile.histogram(same, "x", 4), "n")) == 2


def test_stream_drops_rows_behind_the_watermark(spark, tmp_path):
    schema = "airport_code string, valid timestamp, tmpf double"

    def put(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = ingest.stream_table(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        hours = ingest.stream_hourly_weather(stream, "2 hours")
        ingest.write_available(hours, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()

    t = dt.datetime
    put(1, [("A", t(2021, 1, 1, 0, 10), 10.0), ("A", t(2021, 1, 1, 3, 0), 1.0)])
    run()
    put(2, [("A", t(2021, 1, 1, 0, 20), 99.0), ("A", t(2021, 1, 1, 1, 30), 20.0), ("A", t(2021, 1, 1, 9, 0), 1.0)])
    run()
    out = {r.w_hour: r.tmpf for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {0: 10.0, 1: 20.0, 3: 1.0}
