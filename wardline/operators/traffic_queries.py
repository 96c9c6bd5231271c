"""Reports over the traffic forecast table, one row per (ZIP, forecast date)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import half_up, monday_week, month_of, uncut, uncut_mean

# The ZIPs the downtown and airport reports are about.
DOWNTOWN_ZIPS = ("60601", "60611", "60616")
PATTERN_ZIP = "60601"
AIRPORT_ZIPS = ("60666", "60018")


def _ahead(forecasts: DataFrame, cfg: Settings, days: int) -> DataFrame:
    return forecasts.filter(F.col("forecast_date").between(cfg.as_of, cfg.as_of + timedelta(days=days)))


def _whole(c: str, name: str) -> Column:
    return half_up(F.col(c), 0).alias(name)


def _sum(c: str, name: str) -> Column:
    return half_up(F.sum(uncut(F.col(c))), 0).alias(name)


def _mean(c: str, name: str, digits: int = 0) -> Column:
    return half_up(uncut_mean(F.col(c)), digits).alias(name)


_RANGE = [("yhat", "predicted_trips"), ("yhat_lower", "lower_bound"), ("yhat_upper", "upper_bound")]


def next_week(forecasts: DataFrame, cfg: Settings) -> DataFrame:
    return _ahead(forecasts, cfg, 7).select(
        "zip_code", "forecast_date", *[_whole(c, n) for c, n in _RANGE], _whole("trend", "trend_component")
    )


def weekly(forecasts: DataFrame, cfg: Settings, weeks: int = 12) -> DataFrame:
    """Sums per ZIP and Monday week."""
    return (
        _ahead(forecasts, cfg, 7 * weeks)
        .groupBy("zip_code", monday_week(F.col("forecast_date")).alias("week_start"))
        .agg(
            _sum("yhat", "weekly_predicted_trips"),
            _sum("yhat_lower", "weekly_lower_bound"),
            _sum("yhat_upper", "weekly_upper_bound"),
            _mean("trend", "avg_weekly_trend"),
        )
    )


def monthly(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("zip_code", month_of(F.col("forecast_date")).alias("forecast_month")).agg(
        _sum("yhat", "monthly_predicted_trips"),
        _mean("yhat", "avg_daily_trips"),
        _sum("yhat_lower", "monthly_lower_bound"),
        _sum("yhat_upper", "monthly_upper_bound"),
    )


def top_zips(forecasts: DataFrame, cfg: Settings, limit: int = 10) -> DataFrame:
    return (
        _ahead(forecasts, cfg, 30)
        .groupBy("zip_code")
        .agg(
            _sum("yhat", "total_predicted_trips_30d"),
            _mean("yhat", "avg_daily_trips"),
            _mean("trend", "trend_direction"),
        )
        .orderBy(F.desc("total_predicted_trips_30d"), "zip_code")
        .limit(limit)
    )


def versus_actual(daily: DataFrame, forecasts: DataFrame, cfg: Settings, days: int = 30) -> DataFrame:
    """Forecast error of recent days. Days without a forecast are not reported."""
    actual = (
        daily.filter(F.col("trip_date") >= F.lit(cfg.as_of - timedelta(days=days)))
        .groupBy(F.col("pickup_zip").alias("zip_code"), "trip_date")
        .agg(F.sum("trip_count").alias("actual_trips"))
    )
    predicted = forecasts.filter(F.col("yhat").isNotNull()).select(
        "zip_code", F.col("forecast_date").alias("trip_date"), F.col("yhat").alias("predicted_trips")
    )
    gap = F.col("predicted_trips") - F.col("actual_trips")
    return actual.join(predicted, ["zip_code", "trip_date"]).select(
        "zip_code",
        "trip_date",
        "actual_trips",
        "predicted_trips",
        half_up(gap, 0).alias("forecast_error"),
        half_up(F.try_divide(F.abs(gap), F.col("actual_trips")) * 100, 1).alias("mape_pct"),
    )


def components(forecasts: DataFrame, cfg: Settings, zips: tuple[str, ...] = DOWNTOWN_ZIPS) -> DataFrame:
    return (
        _ahead(forecasts, cfg, 7)
        .filter(F.col("zip_code").isin(*zips))
        .select(
            "zip_code",
            "forecast_date",
            _whole("yhat", "total_predicted"),
            _whole("trend", "trend_component"),
            _whole("yearly", "yearly_seasonality"),
            _whole("weekly", "weekly_seasonality"),
            "model_version",
        )
    )


def model_rollup(metrics: DataFrame, prefix: str = "traffic_forecast") -> DataFrame:
    return (
        metrics.filter(F.col("model_name").startswith(prefix))
        .groupBy("model_name", "model_version", "trained_date")
        .agg(
            F.count(F.lit(1)).alias("zip_codes_modeled"),
            half_up(F.avg("mae"), 1).alias("avg_mae"),
            half_up(F.avg("mape"), 1).alias("avg_mape_pct"),
            half_up(F.avg("r_squared"), 3).alias("avg_r2"),
            half_up(F.avg("training_records"), 0).alias("avg_training_days"),
        )
    )


def uncertainty(forecasts: DataFrame, cfg: Settings, limit: int = 20) -> DataFrame:
    width = F.col("yhat_upper") - F.col("yhat_lower")
    return (
        _ahead(forecasts, cfg, 30)
        .groupBy("zip_code")
        .agg(
            _mean("yhat", "avg_prediction"),
            half_up(uncut_mean(width), 0).alias("avg_uncertainty_range"),
            half_up(F.avg(F.try_divide(width, F.col("yhat")) * 100), 1).alias("uncertainty_pct"),
        )
        .filter(F.col("avg_prediction") > 0)
        .orderBy(F.desc("uncertainty_pct"), "zip_code")
        .limit(limit)
    )


def day_of_week(forecasts: DataFrame, cfg: Settings, zip_code: str = PATTERN_ZIP) -> DataFrame:
    day = F.col("forecast_date")
    return (
        _ahead(forecasts, cfg, 28)
        .filter(F.col("zip_code") == zip_code)
        .groupBy("zip_code", F.dayofweek(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"))
        .agg(_mean("yhat", "avg_predicted_trips"), F.count(F.lit(1)).alias("forecast_days"))
    )


def month_over_month(forecasts: DataFrame) -> DataFrame:
    """Growth over the calendar month before. A month whose predecessor is missing is not reported."""
    months = forecasts.groupBy("zip_code", month_of(F.col("forecast_date")).alias("forecast_month")).agg(
        F.sum(uncut(F.col("yhat"))).cast("double").alias("trips")
    )
    before = months.select(
        "zip_code",
        F.add_months("forecast_month", 1).alias("forecast_month"),
        F.col("trips").alias("before"),
    )
    now, prev = F.col("trips"), F.col("before")
    return (
        months.join(before, ["zip_code", "forecast_month"])
        .filter(prev.isNotNull())
        .select(
            "zip_code",
            "forecast_month",
            half_up(now, 0).alias("current_month_trips"),
            half_up(prev, 0).alias("previous_month_trips"),
            half_up(F.try_divide(now - prev, prev) * 100, 1).alias("mom_growth_pct"),
        )
    )


def airport_forecast(forecasts: DataFrame, cfg: Settings, zips: tuple[str, ...] = AIRPORT_ZIPS) -> DataFrame:
    return (
        _ahead(forecasts, cfg, 30)
        .filter(F.col("zip_code").isin(*zips))
        .select("zip_code", "forecast_date", *[_whole(c, n) for c, n in _RANGE])
    )


def model_averages(metrics: DataFrame, cfg: Settings, prefix: str = "traffic_forecast") -> DataFrame:
    """Averages over the models trained on ``as_of``."""
    return metrics.filter(
        (F.col("trained_date") == F.lit(cfg.as_of)) & F.col("model_name").startswith(prefix)
    ).agg(
        half_up(F.avg("mae"), 6).alias("avg_mae"),
        half_up(F.avg("mape"), 6).alias("avg_mape"),
        half_up(F.avg("r_squared"), 6).alias("avg_r2"),
        F.count(F.lit(1)).alias("models_trained"),
    )


def coverage(forecasts: DataFrame) -> DataFrame:
    return forecasts.agg(
        F.max("model_trained_date").alias("last_trained"),
        F.max("forecast_date").alias("last_forecast_date"),
        F.count_distinct("zip_code").alias("zip_codes_covered"),
    )
