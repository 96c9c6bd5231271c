"""Fits on series whose answer is known, and the tables built around them."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.metrics import error_metrics
from wardline.operators import forecasting as fc

CFG = Settings(as_of=date(2023, 12, 31))
WEEKDAYS = np.array([0.9, 1.0, 1.05, 1.1, 1.2, 1.0, 0.75])


def daily(days, zip_code="60601", seed=0):
    rnd = np.random.default_rng(seed)
    d = pd.date_range("2021-01-01", periods=days)
    y = (200 + 0.1 * np.arange(days)) * WEEKDAYS[d.dayofweek] * (1 + 0.2 * np.sin(2 * np.pi * d.dayofyear / 365.25))
    return pd.DataFrame({"pickup_zip": zip_code, "trip_date": d.date, "trip_count": np.round(y + rnd.normal(0, 3, days)).astype(int)})


@pytest.fixture(scope="module")
def traffic(spark):
    pdf = pd.concat([daily(1000), daily(364, "short"), daily(365, "enough")])
    series = fc.traffic_series(spark.createDataFrame(pdf), CFG)
    return series, fc.components(series, fc.TRAFFIC).cache()


def test_traffic_forecast_follows_the_pattern(traffic):
    series, fitted = traffic
    out = fc.traffic_forecast(series, fitted, CFG).filter("zip_code = '60601'").orderBy("forecast_date").toPandas()
    assert len(out) == 90 and out["forecast_date"].iloc[0] == date(2021, 1, 1) + timedelta(days=1000)
    n = 1000 + np.arange(90)
    d = pd.date_range("2021-01-01", periods=1090)[1000:]
    want = (200 + 0.1 * n) * WEEKDAYS[d.dayofweek] * (1 + 0.2 * np.sin(2 * np.pi * d.dayofyear / 365.25))
    assert np.mean(np.abs(out["yhat"] / want - 1)) < 0.05
    assert (out["yhat_lower"] <= out["yhat"]).all() and (out["yhat"] <= out["yhat_upper"]).all()
    assert out["training_days"].iloc[0] == 800 and (out["yhat_lower"] >= 0).all()


def test_short_areas_are_reported_not_modelled(traffic):
    series, fitted = traffic
    assert {r["area"] for r in fitted.select("area").distinct().collect()} == {"60601", "enough"}
    assert [(r["area"], r["points"]) for r in fc.skipped(series, fc.TRAFFIC).collect()] == [("short", 364)]


def test_traffic_metrics(traffic):
    series, fitted = traffic
    rows = {r["zip_code"]: r for r in fc.model_metrics(series, fitted, fc.TRAFFIC, CFG, "n").collect()}
    r = rows["60601"]
    assert r["model_name"] == "traffic_forecast_zip_60601" and r["training_records"] == 1000
    assert r["mape"] < 8 and r["r_squared"] > 0.7 and r["seasonality_mode"] == "multiplicative"
    assert str(r["train_start_date"]) == "2021-01-01"


def test_one_busy_area_stays_a_short_series(spark):
    """A million trips of one ZIP reach the model as one row per day."""
    rows = spark.range(1_000_000).select(
        F.lit("60601").alias("pickup_zip"), F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("trip_date"), F.lit(1).alias("trip_count")
    )
    series = fc.traffic_series(rows, CFG)
    assert series.count() == 400 and series.agg(F.sum("y")).first()[0] == 1_000_000


def weekly(spark, weeks=80, level=1.0):
    start = date(2020, 5, 3)
    rows = [
        (z, start + timedelta(days=7 * i), level + k * 0.2 + 0.3 * float(np.sin(2 * np.pi * i / 52.18)), 10 + i, 100.0 + i, 50, 500 + i, 400)
        for k, z in enumerate(("60601", "60602")) for i in range(weeks)
    ]
    return spark.createDataFrame(
        rows, "zip_code string, week_start date, adjusted_risk_score double, cases_weekly long, case_rate_weekly double, "
        "tests_weekly long, total_trips_from_zip long, total_trips_to_zip long",
    )


def test_simple_risk_model(spark):
    series = fc.covid_series(weekly(spark), date(2020, 3, 1), date(2024, 5, 12))
    out = fc.covid_forecast(series, fc.components(series, fc.COVID_SIMPLE), CFG, fc.COVID_SIMPLE, fc.SCALE_3).orderBy("zip_code", "forecast_date").collect()
    assert len(out) == 24
    first = out[0]
    # The next Monday at least a week after the last Sunday.
    assert first["forecast_date"] == date(2021, 11, 15) and first["forecast_date"].weekday() == 0
    assert first["predicted_cases_weekly"] == int(np.mean([10 + i for i in range(76, 80)]))
    assert first["predicted_mobility_index"] == np.mean([900 + i for i in range(76, 80)])
    assert first["predicted_positivity_rate"] is None and first["training_weeks"] == 64
    assert all(0 <= r["predicted_risk_score"] <= 3 and r["risk_score_lower"] >= 0 and r["risk_score_upper"] <= 3 for r in out)


def test_regressor_model_scales_cases(spark):
    series = fc.covid_series(weekly(spark), date(2020, 3, 1), date(2024, 5, 12), regressors=True)
    assert abs(series.filter("area = '60601'").agg(F.avg("mobility")).first()[0]) < 1e-9
    out = fc.covid_forecast(series, fc.components(series, fc.COVID_REGRESSORS), CFG, fc.COVID_REGRESSORS, fc.SCALE_100_TREND).collect()
    r = out[0]
    assert len(out) == 24 and r["predicted_positivity_rate"] is not None and r["predicted_case_rate"] == 179.0
    assert r["predicted_risk_category"] == "Low" and r["alert_level"] == "NONE"


def test_retrospective_model_is_bounded(spark):
    series = fc.covid_series(weekly(spark, 56, level=2.5), date(2020, 5, 1), date(2021, 5, 31))
    out = fc.covid_forecast(series, fc.components(series, fc.COVID_RETROSPECTIVE), CFG, fc.COVID_RETROSPECTIVE).orderBy("forecast_date").collect()
    assert len(out) == 2 * 156 and out[0]["forecast_date"] == date(2021, 6, 7) and out[-1]["forecast_date"] == date(2024, 5, 27)
    assert all(0 <= r["predicted_risk_score"] <= 3 for r in out)


def test_bands_and_alerts(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 0.8, 1.5, 2.0)], "s double")
    got = [tuple(r) for r in df.select(fc.risk_category(F.col("s"), fc.SCALE_3), fc.alert_level(F.col("s"), fc.SCALE_3)).collect()]
    assert got == [("Low", "NONE"), ("Medium", "NONE"), ("Medium", "CAUTION"), ("High", "WARNING"), ("High", "CRITICAL")]
    t = spark.createDataFrame([(35.0, 6.0), (35.0, 5.0), (35.0, None)], "s double, t double")
    assert [r[0] for r in t.select(fc.alert_level(F.col("s"), fc.SCALE_100_TREND, F.col("t"))).collect()] == ["CAUTION", "NONE", "NONE"]


def test_messages(spark):
    m = lambda level, cases=None: fc.alert_message(F.lit(level), F.lit("60601"), F.lit("High"), None if cases is None else F.lit(cases))
    row = spark.range(1).select(m("WARNING"), m("NONE"), m("CRITICAL", 12.4), m("CAUTION", 1.0)).first()
    assert row[0] == "WARNING: ZIP 60601 shows High COVID risk. Exercise caution."
    assert row[1] == "ZIP 60601 has High COVID risk. Continue standard safety measures."
    assert "(12 cases/week predicted)" in row[2] and "increasing COVID activity" in row[3]


@pytest.mark.parametrize("mode", ["plain", "positive", "floored"])
def test_error_metrics(spark, mode):
    rng = np.random.default_rng(1)
    a, p = rng.uniform(0.2, 5, 300), rng.uniform(0, 5, 300)
    row = spark.createDataFrame(pd.DataFrame({"a": a, "p": p})).agg(*[c.alias(n) for n, c in error_metrics("a", "p", mode).items()]).first()
    below = np.maximum(a, 1) if mode == "floored" else a
    assert row["mae"] == pytest.approx(np.mean(np.abs(a - p)))
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean((a - p) ** 2)))
    assert row["mape"] == pytest.approx(np.mean(np.abs(a - p) / below) * 100)
    assert row["r_squared"] == pytest.approx(1 - np.sum((a - p) ** 2) / np.sum((a - a.mean()) ** 2))


def test_error_metrics_at_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "a double, p double")
    get = lambda mode: df.agg(error_metrics("a", "p", mode)["mape"]).first()[0]
    assert get("plain") == float("inf") and get("positive") == 50.0 and get("floored") == 75.0


def test_neighborhood_intensity(spark):
    f = spark.createDataFrame([("n", float(v)) for v in (0, 25, 50, 75, 100)] + [("flat", 5.0)], "neighborhood string, yhat double")
    got = [(r["neighborhood"], r["traffic_intensity"]) for r in fc.neighborhood_forecast(f).orderBy("neighborhood", "yhat").collect()]
    assert got == [("flat", "Very Low"), ("n", "Very Low"), ("n", "Low"), ("n", "Medium"), ("n", "High"), ("n", "Very High")]
