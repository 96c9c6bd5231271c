"""Reports over the weekly COVID risk forecasts, one row per (ZIP, forecast week)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import first_match, half_up, ratio, tally, uncut_mean
from wardline.operators.series import previous_value, top_per_group

# Alert levels from most to least severe, mobility bands, city messages.
# Alert levels by severity; any other level has 1.
SEVERITY = {"CRITICAL": 4, "WARNING": 3, "CAUTION": 2}
MOBILITY_BANDS = [(10000, "Very High Mobility"), (5000, "High Mobility"), (1000, "Medium Mobility")]
MOBILITY_BELOW = "Low Mobility"
CITY_CRITICAL = "CITY ALERT: Critical risk areas identified"
CITY_WARNING = "CITY CAUTION: Multiple warning zones"
CITY_CAUTION = "CITY NOTICE: Elevated risk in some areas"
CITY_NORMAL = "CITY NORMAL: Low risk across Chicago"

# Output columns in their order.
_EXPORT = (
    "zip_code",
    "forecast_date",
    "predicted_risk_score",
    "predicted_risk_category",
    "predicted_case_rate",
    "predicted_positivity_rate",
    "risk_score_lower",
    "risk_score_upper",
    "predicted_mobility_index",
    "predicted_cases_weekly",
    "predicted_tests_weekly",
    "alert_level",
    "alert_message",
    "model_trained_date",
    "training_weeks",
    "model_version",
)


def _severity(level) -> F.Column:
    return first_match([(level == a, i) for a, i in SEVERITY.items()], 1)


def _on_next_date(forecasts: DataFrame, cfg: Settings) -> DataFrame:
    """Rows of the first forecast date on or after ``as_of``."""
    ahead = forecasts.filter(F.col("forecast_date") >= F.lit(cfg.as_of))
    # A global aggregate: one row.
    first = ahead.agg(F.min("forecast_date").alias("_next"))
    return ahead.join(F.broadcast(first), F.col("forecast_date") == F.col("_next")).drop("_next")


def next_month(forecasts: DataFrame, cfg: Settings, weeks: int = 4) -> DataFrame:
    until = cfg.as_of + timedelta(days=7 * weeks)
    return forecasts.filter(F.col("forecast_date").between(cfg.as_of, until)).select(
        "zip_code",
        "forecast_date",
        "predicted_risk_score",
        "predicted_risk_category",
        "alert_level",
        "alert_message",
        "risk_score_lower",
        "risk_score_upper",
        "predicted_cases_weekly",
        "predicted_mobility_index",
    )


def next_alerts(forecasts: DataFrame, cfg: Settings) -> DataFrame:
    return (
        _on_next_date(forecasts, cfg)
        .filter(F.col("predicted_risk_category").isin("Medium", "High"))
        .select(
            "zip_code",
            "forecast_date",
            "predicted_risk_score",
            "predicted_risk_category",
            "alert_level",
            "alert_message",
            "predicted_cases_weekly",
            _severity(F.col("alert_level")).alias("alert_priority"),
        )
    )


def risk_trend(forecasts: DataFrame) -> DataFrame:
    """Risk beside that of the forecast before it, per ZIP."""
    now, before = F.col("predicted_risk_score"), F.col("prev_week_risk")
    return previous_value(
        forecasts.select(
            "zip_code",
            "forecast_date",
            "predicted_risk_score",
            "predicted_risk_category",
            "risk_score_lower",
            "risk_score_upper",
        ),
        ["zip_code"],
        "forecast_date",
        "predicted_risk_score",
        "prev_week_risk",
    ).withColumn("weekly_change", now - before)


def alert_distribution(forecasts: DataFrame, top: int = 5) -> DataFrame:
    """ZIPs per date and alert level, with the riskiest few listed. Equal risks list the smaller ZIP first."""
    keys = ["forecast_date", "alert_level"]
    totals = forecasts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("zip_count"),
        half_up(uncut_mean(F.col("predicted_risk_score")), 2).alias("avg_risk_score"),
        half_up(F.avg("predicted_cases_weekly"), 0).alias("avg_cases_per_zip"),
    )
    first = top_per_group(
        forecasts.select(*keys, "zip_code", "predicted_risk_score"),
        keys,
        [F.desc("predicted_risk_score"), F.asc("zip_code")],
        top,
    )
    # At most ``top`` entries per group.
    listed = first.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("_rank", "zip_code"))), lambda s: s["zip_code"]), ", "
        ).alias("top_5_zips")
    )
    return totals.join(listed, keys)


def history_and_forecast(hotspots: DataFrame, forecasts: DataFrame, cfg: Settings, weeks: int = 12) -> DataFrame:
    since = cfg.as_of - timedelta(days=7 * weeks)
    shape = lambda df, day, risk, kind: df.select(
        "zip_code",
        F.col(day).alias("date"),
        F.col(risk).alias("actual_risk"),
        F.lit(kind).alias("data_type"),
    )
    past = hotspots.filter(F.col("week_start") >= F.lit(since))
    ahead = forecasts.filter(F.col("forecast_date") >= F.lit(cfg.as_of))
    return shape(past, "week_start", "adjusted_risk_score", "Historical").unionByName(
        shape(ahead, "forecast_date", "predicted_risk_score", "Forecast")
    )


def top_risk_zips(forecasts: DataFrame, limit: int = 10) -> DataFrame:
    """ZIPs by mean risk, with the categories and alert levels they reach.

    Both lists hold distinct labels of a fixed set.
    """
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (
        forecasts.groupBy("zip_code")
        .agg(
            half_up(uncut_mean(F.col("predicted_risk_score")), 2).alias("avg_12week_risk"),
            half_up(F.max("predicted_risk_score"), 2).alias("peak_risk"),
            tally(F.col("alert_level").isin("WARNING", "CRITICAL")).alias("high_alert_weeks"),
            half_up(F.avg("predicted_cases_weekly"), 0).alias("avg_weekly_cases"),
            labels("predicted_risk_category").alias("risk_categories"),
            labels("alert_level").alias("alert_levels"),
        )
        .orderBy(F.desc("avg_12week_risk"), F.desc("peak_risk"), "zip_code")
        .limit(limit)
    )


def model_metrics(metrics: DataFrame, prefix: str = "covid_risk_forecast") -> DataFrame:
    return metrics.filter(F.col("model_name").startswith(prefix)).select(
        "zip_code",
        "model_version",
        "trained_date",
        F.col("training_records").alias("training_weeks"),
        half_up(F.col("mae"), 2).alias("mae_risk_points"),
        half_up(F.col("mape"), 1).alias("mape_percent"),
        half_up(F.col("r_squared"), 3).alias("r2_score"),
        "train_start_date",
        "train_end_date",
        "notes",
    )


def uncertainty(forecasts: DataFrame) -> DataFrame:
    width = F.col("risk_score_upper") - F.col("risk_score_lower")
    return forecasts.filter(F.col("predicted_risk_score") > 0).select(
        "zip_code",
        "forecast_date",
        "predicted_risk_score",
        "risk_score_lower",
        "risk_score_upper",
        width.alias("uncertainty_width"),
        ratio(width, F.col("predicted_risk_score")).alias("relative_uncertainty"),
        "predicted_risk_category",
        "alert_level",
    )


def mobility_bands(forecasts: DataFrame) -> DataFrame:
    index = F.col("predicted_mobility_index")
    return forecasts.select(
        "zip_code",
        "forecast_date",
        "predicted_risk_score",
        "predicted_mobility_index",
        "predicted_cases_weekly",
        first_match([(index > low, label) for low, label in MOBILITY_BANDS], MOBILITY_BELOW).alias(
            "mobility_category"
        ),
        "predicted_risk_category",
    )


def long_date(day) -> F.Column:
    """Weekday, month, day padded to two places with a space, year."""
    return F.concat(
        F.date_format(day, "EEEE, MMMM "),
        F.lpad(F.dayofmonth(day).cast("string"), 2, " "),
        F.date_format(day, ", yyyy"),
    )


def weekly_briefing(forecasts: DataFrame) -> DataFrame:
    level = F.col("alert_level")
    named = {"critical": "CRITICAL", "warning": "WARNING", "caution": "CAUTION", "safe": "NONE"}
    summary = forecasts.groupBy("forecast_date").agg(
        F.count(F.lit(1)).alias("total_zips"),
        *[tally(level == v).alias(f"{k}_zips") for k, v in named.items()],
        half_up(uncut_mean(F.col("predicted_risk_score")), 2).alias("city_avg_risk"),
        F.sum("predicted_cases_weekly").alias("total_predicted_cases"),
    )
    return summary.withColumn("week_of", long_date(F.col("forecast_date"))).withColumn(
        "city_status",
        first_match(
            [
                (F.col("critical_zips") > 0, CITY_CRITICAL),
                (F.col("warning_zips") > 5, CITY_WARNING),
                (F.col("caution_zips") > 10, CITY_CAUTION),
            ],
            CITY_NORMAL,
        ),
    )


def risk_with_geometry(forecasts: DataFrame, zips: DataFrame, cfg: Settings) -> DataFrame:
    shapes = zips.select(F.col("zip").cast("string").alias("zip_code"), F.col("rings").alias("geometry"))
    return (
        _on_next_date(forecasts, cfg)
        .join(shapes, "zip_code", "left")
        .select(
            "zip_code",
            "forecast_date",
            "predicted_risk_score",
            "predicted_risk_category",
            "alert_level",
            "predicted_cases_weekly",
            "geometry",
        )
    )


def export(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(*_EXPORT)


def high_risk_ahead(forecasts: DataFrame, cfg: Settings) -> DataFrame:
    return forecasts.filter(
        (F.col("predicted_risk_category") == "High") & (F.col("forecast_date") >= F.lit(cfg.as_of))
    ).select("zip_code", "forecast_date", "predicted_risk_category", "alert_level", "alert_message")


def last_alert_map(forecasts: DataFrame, zips: DataFrame) -> DataFrame:
    """Alerts of the last forecast date for the ZIPs that have a polygon."""
    last = forecasts.agg(F.max("forecast_date").alias("_last"))
    shapes = zips.select(F.col("zip").cast("string").alias("zip_code"), F.col("rings").alias("geometry"))
    return (
        forecasts.join(F.broadcast(last), F.col("forecast_date") == F.col("_last"))
        .join(shapes, "zip_code")
        .select("zip_code", "geometry", "predicted_risk_category", "alert_level", "alert_message")
    )
