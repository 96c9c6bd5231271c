"""Per-area forecasts: Spark prepares, splits and scores; one small fit runs per area.

A series is aggregated to one row per (area, date) before it is grouped, so a
group is as long as the calendar, however many trips an area has. The fitted
function sees one series and returns components per date; clipping, bands, alerts
and error metrics are column expressions over all areas at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import first_match
from wardline.functions.metrics import error_metrics
from wardline.operators.series import top_per_group

# Half width of an 80 % normal interval.
Z80 = 1.2815515655446004


@dataclass(frozen=True)
class ModelSpec:
    """What to fit and how far ahead.

    ``growth`` is linear, or logistic between ``floor`` and ``cap``. The penalty of
    a coefficient is the inverse square of its prior scale. ``suffix`` ends a model's name behind the area.
    ``changepoints`` are spread over the first four fifths of a series; a shorter one has as many as it can.
    """

    name: str
    version: str
    min_points: int
    horizon: int
    step_days: int = 1
    multiplicative: bool = False
    weekly: bool = False
    growth: str = "linear"
    floor: float = 0.0
    cap: float = 0.0
    changepoint_scale: float = 0.05
    seasonality_scale: float = 10.0
    # Stated in the metrics, as published; no holiday terms are fitted.
    holidays_scale: float = 10.0
    regressor_scales: dict[str, float] = field(default_factory=dict)
    refit_on_all: bool = True
    start: date | None = None
    train_share: float = 0.8
    mape_mode: str = "positive"
    suffix: str = ""
    changepoints: int = 25

    @property
    def seasonality_mode(self) -> str:
        return "multiplicative" if self.multiplicative else "additive"


# The four published models.
TRAFFIC = ModelSpec(
    "traffic_forecast_zip", "ridge-v1", 365, 90, multiplicative=True, weekly=True, mape_mode="plain"
)
COVID_SIMPLE = ModelSpec("covid_risk_forecast_zip", "ridge-simple-v1", 52, 12, 7, refit_on_all=False)
COVID_REGRESSORS = ModelSpec(
    "covid_risk_forecast_zip",
    "ridge-regressors-v1",
    52,
    12,
    7,
    changepoint_scale=0.1,
    seasonality_scale=5.0,
    regressor_scales={"mobility": 10.0, "case_rate": 15.0},
    refit_on_all=False,
    mape_mode="floored",
)
COVID_RETROSPECTIVE = ModelSpec(
    "covid_risk_forecast_zip",
    "ridge-logistic-v2",
    40,
    156,
    7,
    growth="logistic",
    cap=3.0,
    changepoint_scale=0.01,
    seasonality_scale=3.0,
    refit_on_all=False,
    start=date(2021, 6, 7),
    suffix="_retrospective",
)

COMPONENTS = (
    "area string, ds date, part string, y double, yhat double, yhat_lower double, yhat_upper double, "
    "trend double, yearly double, weekly double"
)


def _design(days: np.ndarray, origin: float, span: float, knots: np.ndarray, spec: ModelSpec, extra: np.ndarray):
    """Columns of trend, yearly, weekly and regressor terms, and the slices they occupy."""
    t = (days - origin) / span
    trend = [np.ones_like(t), t, *[np.maximum(t - k, 0.0) for k in knots]]
    wave = lambda period, n: [f(2 * np.pi * k * days / period) for k in range(1, n + 1) for f in (np.sin, np.cos)]
    yearly = wave(365.25, 10)
    weekly = wave(7.0, 3) if spec.weekly else []
    cols = np.column_stack([*trend, *yearly, *weekly, *extra.T])
    a, b = len(trend), len(trend) + len(yearly)
    c = b + len(weekly)
    return cols, slice(0, a), slice(a, b), slice(b, c), slice(c, cols.shape[1])


def _curve(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def _bounded_fit(x: np.ndarray, target: np.ndarray, penalty: np.ndarray, solve, steps: int = 30) -> np.ndarray:
    """Coefficients whose logistic curve is nearest to the target, by damped Gauss-Newton steps.

    The values themselves are fitted, limits included; none is moved to make its log-odds finite.
    """
    cost = lambda b: np.sum((target - _curve(x @ b)) ** 2) + penalty @ b**2
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        at = _curve(x @ beta)
        slope = x * (at * (1 - at))[:, None]
        step = solve(slope, target - at + slope @ beta) - beta
        while np.abs(step).max() > 1e-9 and cost(beta + step) >= cost(beta):
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-7:
            break
    return beta


def fit_series(train: pd.DataFrame, future: pd.DataFrame, spec: ModelSpec) -> pd.DataFrame:
    """Penalised least squares of trend bends, seasons and regressors; predicts ``future``."""
    days = lambda s: pd.to_datetime(s).to_numpy().astype("datetime64[D]").astype("float64")
    names = list(spec.regressor_scales)
    regs = lambda df: df[names].to_numpy("float64") if names else np.zeros((len(df), 0))
    d, df_ = days(train["ds"]), days(future["ds"])
    y = train["y"].to_numpy("float64")
    bounded = spec.growth == "logistic"
    low, scale = (spec.floor, spec.cap - spec.floor) if bounded else (0.0, float(np.abs(y).max()) or 1.0)
    target = (y - low) / scale
    origin, span = d.min(), max(d.max() - d.min(), 1.0)
    knots = np.linspace(0, 0.8, min(spec.changepoints, max(0, int(0.8 * len(d)) - 1)) + 2)[1:-1]
    x, tr, ye, we, re = _design(d, origin, span, knots, spec, regs(train))
    xf = _design(df_, origin, span, knots, spec, regs(future))[0]

    penalty = np.full(x.shape[1], 1e-6)
    penalty[tr][2:] = spec.changepoint_scale**-2
    penalty[ye] = penalty[we] = spec.seasonality_scale**-2
    penalty[re] = [s**-2 for s in spec.regressor_scales.values()]
    noise = 0.05**2

    def solve(m: np.ndarray, goal: np.ndarray = target) -> np.ndarray:
        return np.linalg.solve(m.T @ m + noise * np.diag(penalty), m.T @ goal)

    beta = _bounded_fit(x, target, noise * penalty, solve) if bounded else solve(x)
    if spec.multiplicative:
        # Seasons act on the trend: refit with season columns scaled by the trend.
        for _ in range(3):
            level = x[:, tr] @ beta[tr]
            m = x.copy()
            m[:, ye.start : we.stop] *= level[:, None]
            beta = solve(m)
    trend_f, trend_d = xf[:, tr] @ beta[tr], x[:, tr] @ beta[tr]
    yearly, weekly = xf[:, ye] @ beta[ye], xf[:, we] @ beta[we]
    season_d = x[:, ye] @ beta[ye] + x[:, we] @ beta[we]
    other_d, other = x[:, re] @ beta[re], xf[:, re] @ beta[re]
    if spec.multiplicative:
        fitted, raw = trend_d * (1 + season_d) + other_d, trend_f * (1 + yearly + weekly) + other
    else:
        fitted, raw = trend_d + season_d + other_d, trend_f + yearly + weekly + other
    shown = _curve if bounded else (lambda v: v)
    spread = np.sqrt(np.mean((target - shown(fitted)) ** 2)) * Z80
    ahead = np.maximum(df_ - d.max(), 0.0) / span
    drift = np.abs(beta[tr][2:]).mean() * ahead * Z80 if len(knots) else 0 * ahead
    # A bounded curve and its interval stay between the limits.
    limit = (lambda v: np.clip(v, 0.0, 1.0)) if bounded else (lambda v: v)
    back = lambda v, more=0.0: low + scale * limit(shown(v) + more)
    season_unit = 1.0 if spec.multiplicative or bounded else scale
    return pd.DataFrame(
        {
            "ds": future["ds"].to_numpy(),
            "yhat": back(raw),
            "yhat_lower": back(raw - drift, -spread),
            "yhat_upper": back(raw + drift, spread),
            "trend": back(trend_f),
            "yearly": yearly * season_unit,
            "weekly": weekly * season_unit,
        }
    )


def _future_dates(last: pd.Timestamp, spec: ModelSpec) -> pd.DatetimeIndex:
    if spec.step_days == 1:
        return pd.date_range(last + pd.Timedelta(days=1), periods=spec.horizon, freq="D")
    start = pd.Timestamp(spec.start) if spec.start else last + pd.Timedelta(days=7)
    return pd.date_range(start + pd.Timedelta(days=-start.dayofweek % 7), periods=spec.horizon, freq="7D")


def _one_area(spec: ModelSpec):
    names = list(spec.regressor_scales)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds", ignore_index=True)
        cut = int(len(pdf) * spec.train_share)
        train, test = pdf.iloc[:cut], pdf.iloc[cut:]
        held = fit_series(train, test, spec)
        held["part"], held["y"] = "holdout", test["y"].to_numpy("float64")
        ahead = pd.DataFrame({"ds": _future_dates(pd.Timestamp(pdf["ds"].iloc[-1]), spec).date})
        for n in names:
            ahead[n] = float(pdf[n].iloc[-4:].mean())
        out = fit_series(pdf if spec.refit_on_all else train, ahead, spec)
        out["part"], out["y"] = "forecast", np.nan
        both = pd.concat([held, out], ignore_index=True)
        both["area"] = pdf["area"].iloc[0]
        both["ds"] = pd.to_datetime(both["ds"]).dt.date
        return both[[c.split()[0] for c in COMPONENTS.split(", ")]]

    return run


def components(series: DataFrame, spec: ModelSpec) -> DataFrame:
    """Holdout and future predictions of every area with enough points.

    ``series`` has ``area, ds, y`` and the regressor columns. Rows of the same area
    and date are averaged before they are grouped, so a group is never longer than
    the calendar; too short ones are dropped before any row goes to Python.
    """
    values = ["y", *spec.regressor_scales]
    points = series.groupBy("area", "ds").agg(*[F.avg(v).alias(v) for v in values])
    enough = points.groupBy("area").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= spec.min_points)
    wanted = points.join(enough.select("area"), "area", "left_semi")
    # The series are small and the fits are not: a fixed number of partitions keeps
    # adaptive execution from gathering all areas in one task.
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(tasks, "area").groupBy("area").applyInPandas(_one_area(spec), COMPONENTS)


def skipped(series: DataFrame, spec: ModelSpec) -> DataFrame:
    """Areas with too few points to model. Rows of the same date are one point."""
    return (
        series.groupBy("area")
        .agg(F.count_distinct("ds").alias("points"))
        .filter(F.col("points") < spec.min_points)
        .withColumn("needed", F.lit(spec.min_points))
    )


def span_of(series: DataFrame) -> DataFrame:
    return series.groupBy("area").agg(
        F.min("ds").alias("train_start_date"),
        F.max("ds").alias("train_end_date"),
        F.count_distinct("ds").alias("n"),
    )


def _trained(spec: ModelSpec) -> Column:
    """Number of points in the training part."""
    return F.floor(F.col("n") * spec.train_share).cast("long")


def model_metrics(
    series: DataFrame, fitted: DataFrame, spec: ModelSpec, cfg: Settings, notes: str = "", area: str = "zip_code"
) -> DataFrame:
    """Holdout errors of each area's model; ``area`` is the column that names it, ``zip_code`` or ``neighborhood``.

    ``created_at`` is the day of the run, as no operator reads the clock.
    """
    scored = fitted.filter("part = 'holdout'").groupBy("area").agg(
        *[c.alias(n) for n, c in error_metrics("y", "yhat", spec.mape_mode).items()]
    )
    records = F.col("n") if spec.refit_on_all else _trained(spec)
    return scored.join(span_of(series), "area").select(
        F.concat(F.lit(spec.name + "_"), "area", F.lit(spec.suffix)).alias("model_name"),
        F.lit(spec.version).alias("model_version"),
        F.lit(cfg.as_of).alias("trained_date"),
        "train_start_date",
        "train_end_date",
        records.alias("training_records"),
        "mae",
        "rmse",
        "mape",
        "r_squared",
        F.lit(spec.changepoint_scale).alias("changepoint_prior_scale"),
        F.lit(spec.seasonality_scale).alias("seasonality_prior_scale"),
        F.lit(spec.holidays_scale).alias("holidays_prior_scale"),
        F.lit(spec.seasonality_mode).alias("seasonality_mode"),
        F.col("area").alias("zip_code") if area == "zip_code" else F.lit(None).cast("string").alias("zip_code"),
        F.col("area").alias("neighborhood") if area == "neighborhood" else F.lit(None).cast("string").alias("neighborhood"),
        F.lit(notes).alias("notes"),
        F.lit(cfg.as_of).cast("timestamp").alias("created_at"),
    )


# ---------------------------------------------------------------- traffic


def traffic_series(daily: DataFrame, cfg: Settings, area: str = "pickup_zip") -> DataFrame:
    return (
        daily.filter(
            F.col(area).isNotNull() & F.col("trip_date").between(F.lit(cfg.min_date), F.lit(cfg.as_of))
        )
        .groupBy(F.col(area).alias("area"), F.col("trip_date").alias("ds"))
        .agg(F.sum("trip_count").cast("double").alias("y"))
    )


def traffic_forecast(
    series: DataFrame, fitted: DataFrame, cfg: Settings, spec: ModelSpec = TRAFFIC, area: str = "zip_code"
) -> DataFrame:
    floor0 = lambda c: F.greatest(F.lit(0.0), F.col(c)).alias(c)
    return (
        fitted.filter("part = 'forecast'")
        .join(span_of(series), "area")
        .select(
            F.col("area").alias(area),
            F.col("ds").alias("forecast_date"),
            F.lit("daily").alias("forecast_type"),
            floor0("yhat"),
            floor0("yhat_lower"),
            "yhat_upper",
            "trend",
            "yearly",
            "weekly",
            F.lit(cfg.as_of).alias("model_trained_date"),
            _trained(spec).alias("training_days"),
            F.lit(spec.version).alias("model_version"),
        )
    )


# Intensity labels of the neighborhood table; the advisory wording is ours.
INTENSITY = ["Very Low", "Low", "Medium", "High", "Very High"]
ADVISORY = {
    "Very Low": "Good time for lane closures",
    "Low": "Suitable for most construction work",
    "Medium": "Schedule work outside rush hours",
    "High": "Limit work to nights and weekends",
    "Very High": "Avoid construction",
}


def neighborhood_forecast(forecast: DataFrame) -> DataFrame:
    """Traffic forecast per neighborhood with intensity by fifth of its own range, and an advisory."""
    own = forecast.groupBy("neighborhood").agg(F.min("yhat").alias("_lo"), F.max("yhat").alias("_hi"))
    position = F.coalesce(F.try_divide(F.col("yhat") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    fifth = F.least(F.floor(position * 5).cast("int"), F.lit(4))
    label = F.element_at(F.array(*map(F.lit, INTENSITY)), fifth + 1)
    advice = F.create_map(*[F.lit(x) for kv in ADVISORY.items() for x in kv])
    return (
        forecast.join(own, "neighborhood")
        .withColumn("traffic_intensity", label)
        .withColumn("construction_advisory", advice[F.col("traffic_intensity")])
        .drop("_lo", "_hi")
    )


# ---------------------------------------------------------------- COVID risk


@dataclass(frozen=True)
class RiskScale:
    """Upper end of the score, band limits (medium, high) and alert limits."""

    top: float
    medium: float
    high: float
    caution: float
    warning: float
    critical: float
    caution_trend: float | None = None


# The 0..3 scale of the risk table, and the 0..100 scale of the two earlier models.
SCALE_3 = RiskScale(3.0, 0.5, 1.5, 0.8, 1.5, 2.0)
SCALE_100 = RiskScale(100.0, 20.0, 50.0, 30.0, 50.0, 70.0)
SCALE_100_TREND = RiskScale(100.0, 20.0, 50.0, 30.0, 50.0, 70.0, 5.0)


def risk_category(score: Column, scale: RiskScale) -> Column:
    return first_match([(score < scale.medium, "Low"), (score < scale.high, "Medium")], "High")


def alert_level(score: Column, scale: RiskScale, trend: Column | None = None) -> Column:
    caution = score >= scale.caution
    if scale.caution_trend is not None and trend is not None:
        caution = caution & (trend > scale.caution_trend)
    return first_match(
        [(score >= scale.critical, "CRITICAL"), (score >= scale.warning, "WARNING"), (caution, "CAUTION")], "NONE"
    )


# Alert texts, with the ZIP and the category filled in.
MESSAGES = {
    "CRITICAL": ("CRITICAL: ZIP %s has %s COVID risk. Avoid non-essential travel."),
    "WARNING": ("WARNING: ZIP %s shows %s COVID risk. Exercise caution."),
    "CAUTION": ("CAUTION: ZIP %s has %s COVID risk. Monitor situation."),
    "NONE": ("ZIP %s has %s COVID risk. Continue standard safety measures."),
}
MESSAGES_WITH_CASES = {
    "CRITICAL": "CRITICAL: ZIP %s has %s COVID risk (%.0f cases/week predicted). Avoid non-essential travel.",
    "WARNING": "WARNING: ZIP %s shows %s COVID risk. Exercise caution and follow safety protocols.",
    "CAUTION": "CAUTION: ZIP %s has increasing COVID activity. Monitor situation closely.",
    "NONE": "ZIP %s has %s COVID risk. Continue standard safety measures.",
}


def alert_message(level: Column, area: Column, category: Column, cases: Column | None = None) -> Column:
    texts = MESSAGES if cases is None else MESSAGES_WITH_CASES

    def fill(text: str) -> Column:
        args = [area, category, cases][: text.count("%")]
        return F.format_string(text, *args)

    return first_match([(level == k, fill(v)) for k, v in texts.items() if k != "NONE"], fill(texts["NONE"]))


def covid_series(hotspots: DataFrame, start: date, end: date, regressors: bool = False) -> DataFrame:
    """Weekly risk per ZIP with the columns the forecasts carry along.

    Without regressors, weeks without a score are left out; with them, missing
    numbers count as 0 and mobility is standardised per ZIP.
    """
    base = hotspots.filter(F.col("week_start").between(start, end)).select(
        F.col("zip_code").alias("area"),
        F.col("week_start").alias("ds"),
        F.col("adjusted_risk_score").alias("y"),
        F.col("cases_weekly").cast("double").alias("cases"),
        F.col("case_rate_weekly").alias("case_rate"),
        F.try_divide(F.col("cases_weekly") * 100.0, F.col("tests_weekly")).alias("positivity"),
        (F.col("total_trips_from_zip") + F.col("total_trips_to_zip")).cast("double").alias("mobility_index"),
    )
    if not regressors:
        return base.filter(F.col("y").isNotNull())
    per_area = base.groupBy("area").agg(
        F.avg("mobility_index").alias("_mean"), F.stddev_samp("mobility_index").alias("_sd")
    )
    z = F.when(F.col("_sd") > 0, (F.col("mobility_index") - F.col("_mean")) / F.col("_sd")).otherwise(0.0)
    return base.join(per_area, "area").withColumn("mobility", z).drop("_mean", "_sd").fillna(0.0)


def recent_state(series: DataFrame, weeks: int = 4) -> DataFrame:
    """Means over each ZIP's last weeks, its last values, and the mean step of its score.

    Kept to ``weeks`` rows per ZIP by a rank limit that is applied before the shuffle.
    """
    last = top_per_group(series, ["area"], [F.desc("ds")], weeks)
    mean = lambda c: F.avg(c).alias(f"mean_{c}")
    newest, oldest = F.max_by("y", "ds"), F.min_by("y", "ds")
    return last.groupBy("area").agg(
        *[mean(c) for c in ("cases", "case_rate", "positivity", "mobility_index", "y")],
        F.max_by("case_rate", "ds").alias("last_case_rate"),
        F.max_by("mobility_index", "ds").alias("last_mobility_index"),
        F.try_divide(newest - oldest, F.count(F.lit(1)) - 1).alias("recent_step"),
    )


def covid_forecast(
    series: DataFrame, fitted: DataFrame, cfg: Settings, spec: ModelSpec, scale: RiskScale = SCALE_3
) -> DataFrame:
    """Risk forecasts with band, alert level and message.

    A model with regressors scales recent cases and positivity by predicted over
    recent risk; the others repeat the recent means.
    """
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(scale.top), c))
    with_regressors = bool(spec.regressor_scales)
    base = (
        fitted.filter("part = 'forecast'")
        .join(recent_state(series), "area")
        .join(span_of(series), "area")
        .withColumn("score", clip(F.col("yhat")))
    )
    if with_regressors:
        factor = F.coalesce(F.try_divide(F.col("score"), F.col("mean_y")), F.lit(0.0))
        cases = F.greatest(F.lit(0.0), F.col("mean_cases") * factor)
        positivity = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("mean_positivity") * factor))
        rate, mobility = F.col("last_case_rate"), F.col("last_mobility_index")
    else:
        cases, positivity = F.col("mean_cases"), F.lit(None).cast("double")
        rate, mobility = F.col("mean_case_rate"), F.col("mean_mobility_index")
    level = alert_level(F.col("score"), scale, F.col("recent_step"))
    return (
        base.withColumns(
            {"cases_": cases, "category": risk_category(F.col("score"), scale), "level": level}
        ).select(
            F.col("area").alias("zip_code"),
            F.col("ds").alias("forecast_date"),
            F.col("score").alias("predicted_risk_score"),
            F.col("category").alias("predicted_risk_category"),
            rate.alias("predicted_case_rate"),
            positivity.alias("predicted_positivity_rate"),
            F.greatest(F.lit(0.0), F.col("yhat_lower")).alias("risk_score_lower"),
            F.least(F.lit(scale.top), F.col("yhat_upper")).alias("risk_score_upper"),
            mobility.alias("predicted_mobility_index"),
            F.col("cases_").cast("long").alias("predicted_cases_weekly"),
            F.lit(None).cast("long").alias("predicted_tests_weekly"),
            F.col("level").alias("alert_level"),
            alert_message(
                F.col("level"), F.col("area"), F.col("category"), F.col("cases_") if with_regressors else None
            ).alias("alert_message"),
            F.lit(cfg.as_of).alias("model_trained_date"),
            _trained(spec).alias("training_weeks"),
            F.lit(spec.version).alias("model_version"),
        )
    )
