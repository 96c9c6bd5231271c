"""Gold tables: trip aggregates, routes, permit values, weekly risk, loan targets, baseline forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import (
    dated,
    exact_mean,
    exact_sum,
    half_up,
    hundredths,
    mean_2dp,
    min_max,
    sunday_week,
    tally,
    uncut,
)
from wardline.operators.quantiles import group_median
from wardline.session import computed_once

NEW_CONSTRUCTION = "NEW CONSTRUCTION"
UNKNOWN = "Unknown"


def _routed(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("pickup_zip").isNotNull() & F.col("dropoff_zip").isNotNull())


def trips_by_zip(trips: DataFrame, grain: str, require_zips: bool = True) -> DataFrame:
    """Trip counts and mean miles and fare per pair of ZIPs, by ``hour`` or by ``day``."""
    times = ["trip_date", "trip_hour"] if grain == "hour" else ["trip_date"]
    source = _routed(trips) if require_zips else trips
    return source.groupBy("pickup_zip", "dropoff_zip", *times).agg(
        F.count(F.lit(1)).alias("trip_count"),
        mean_2dp(F.col("trip_miles")).alias("avg_miles"),
        mean_2dp(F.col("fare")).alias("avg_fare"),
    )


def trips_by_neighborhood(trips: DataFrame) -> DataFrame:
    """Trips per pickup neighborhood and day, which the neighborhood forecast starts from."""
    return (
        trips.filter(F.col("pickup_neighborhood").isNotNull())
        .groupBy(F.col("pickup_neighborhood").alias("neighborhood"), "trip_date")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )


def route_pairs(trips: DataFrame, limit: int = 10) -> DataFrame:
    """Routes of rank ``limit`` or better by trip count, ties kept.

    Ranks come from the count of routes per distinct trip count. Only the highest
    ``limit`` distinct counts can reach the rank, so that is all that is ordered.
    """
    routes = computed_once(
        _routed(trips)
        .groupBy("pickup_zip", "dropoff_zip")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            mean_2dp(F.col("fare")).alias("avg_fare"),
            mean_2dp(F.col("trip_miles")).alias("avg_miles"),
            exact_sum(F.col("fare")).alias("total_revenue"),
        )
    )
    levels = (
        routes.groupBy("trip_count")
        .agg(F.count(F.lit(1)).alias("_routes"))
        .orderBy(F.desc("trip_count"))
        .limit(limit)
    )
    above = Window.orderBy(F.desc("trip_count")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = levels.select(
        "trip_count",
        (F.coalesce(F.sum("_routes").over(above), F.lit(0)) + 1).alias("rank"),
    ).filter(F.col("rank") <= limit)
    # ``ranks`` has at most ``limit`` rows.
    return routes.join(F.broadcast(ranks), "trip_count").select(
        "pickup_zip", "dropoff_zip", "trip_count", "avg_fare", "avg_miles", "total_revenue", "rank"
    )


def permits_roi(permits: DataFrame) -> DataFrame:
    cost = F.col("reported_cost")
    return (
        permits.filter(F.col("zip_code").isNotNull() & (cost > 0))
        .groupBy("zip_code")
        .agg(
            F.count(F.lit(1)).alias("total_permits"),
            exact_sum(cost).alias("total_permit_value"),
            mean_2dp(cost).alias("avg_permit_value"),
        )
    )


# ---------------------------------------------------------------- weekly risk


def weekly_mobility(trips: DataFrame, week: Column | None = None, pooled_above: int = 0) -> DataFrame:
    """Trips from, to and pooled to each ZIP by week.

    A trip counts once for each of its ends in one aggregation. With the default
    ``pooled_above`` every trip of at least one rider group counts as pooled.
    """
    week = sunday_week(F.col("trip_date")) if week is None else week
    ends = F.array(
        F.struct(F.col("pickup_zip").alias("zip_code"), F.lit(1).alias("out")),
        F.struct(F.col("dropoff_zip").alias("zip_code"), F.lit(0).alias("out")),
    )
    return (
        _routed(trips)
        .select(week.alias("week_start"), "trips_pooled", F.inline(ends))
        .groupBy("week_start", "zip_code")
        .agg(
            tally(F.col("out") == 1).alias("total_trips_from_zip"),
            tally(F.col("out") == 0).alias("total_trips_to_zip"),
            tally((F.col("out") == 0) & (F.col("trips_pooled") > pooled_above)).alias(
                "total_pooled_trips_to_zip"
            ),
        )
    )


_MOBILITY = ["total_trips_from_zip", "total_trips_to_zip", "total_pooled_trips_to_zip"]


def covid_mobility(history: DataFrame, mobility: DataFrame) -> DataFrame:
    joined = history.join(mobility, ["zip_code", "week_start"], "left")
    return joined.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in _MOBILITY})


def covid_hotspots(history: DataFrame, trips: DataFrame, ccvi: DataFrame, cfg: Settings) -> DataFrame:
    """Weekly COVID rows with mobility, epidemiological and vulnerability-adjusted risk."""
    w = cfg.weights
    base = covid_mobility(history, weekly_mobility(trips))
    measures = [*_MOBILITY, "case_rate_weekly", "tests_weekly"]
    bounds = base.agg(
        *[F.min(m).alias(f"lo_{m}") for m in measures], *[F.max(m).alias(f"hi_{m}") for m in measures]
    )
    scores = ccvi.filter(F.col("geography_type") == "ZIP").select(
        F.col("geography_id").alias("zip_code"),
        ((F.col("ccvi_score") - w.ccvi_min) / (w.ccvi_max - w.ccvi_min)).alias("_ccvi"),
    )
    n = {m: min_max(F.col(m), F.col(f"lo_{m}"), F.col(f"hi_{m}")) for m in measures}
    mobility = (
        w.trips_from * n["total_trips_from_zip"]
        + w.trips_to * n["total_trips_to_zip"]
        + w.pooled_to * n["total_pooled_trips_to_zip"]
    )
    epi = w.cases * n["case_rate_weekly"] + w.tests * n["tests_weekly"]
    factor = 1 + w.ccvi_weight * F.coalesce(F.col("_ccvi"), F.lit(0.0))
    # ``bounds`` is a global aggregate: one row.
    return (
        base.crossJoin(F.broadcast(bounds))
        .join(scores, "zip_code", "left")
        .select(
            "zip_code",
            "week_start",
            "case_rate_weekly",
            "cases_weekly",
            "deaths_weekly",
            "tests_weekly",
            "risk_category",
            *_MOBILITY,
            "population",
            half_up(mobility, 2).alias("mobility_risk_rate"),
            half_up(epi, 2).alias("epi_risk"),
            half_up(factor, 3).alias("ccvi_adjustment"),
            half_up((mobility + epi) * factor, 2).alias("adjusted_risk_score"),
        )
    )


# ---------------------------------------------------------------- loan targets


def latest_population(history: DataFrame) -> DataFrame:
    """Population of each ZIP's latest week, even when that is NULL."""
    return history.groupBy("zip_code").agg(F.max_by("population", "week_start").alias("population"))


def zip_income(community_zip: DataFrame, health: DataFrame) -> DataFrame:
    """Per-capita income of a ZIP, weighted by the share of the ZIP in each community area."""
    joined = community_zip.join(
        health.select(F.col("community_area").alias("community_area_number"), "per_capita_income"),
        "community_area_number",
    ).filter(F.col("per_capita_income").isNotNull())
    share = hundredths(F.col("pct_of_zip"))
    weighted = F.sum(hundredths(F.col("per_capita_income")) * share) / 100.0
    return joined.groupBy("zip_code").agg(
        half_up(F.try_divide(weighted, F.sum(share)), 0).alias("per_capita_income")
    )


def permit_costs(permits: DataFrame) -> DataFrame:
    """Permit measures per ZIP, taken over distinct costs.

    The counts are the largest number of permits that share one cost, and the
    median is over distinct costs; both follow the published table.
    """
    new = F.upper("permit_type").contains(NEW_CONSTRUCTION) | F.upper("work_type").contains(NEW_CONSTRUCTION)
    per_cost = computed_once(
        permits.filter(F.col("zip_code").isNotNull() & (F.col("reported_cost") > 0))
        .groupBy("zip_code", "reported_cost")
        .agg(F.count(F.lit(1)).alias("n"), tally(new).alias("n_new"))
    )
    counts = per_cost.groupBy("zip_code").agg(
        F.max("n").alias("total_permits_construction"),
        F.max("n_new").alias("total_permits_new_construction"),
    )
    medians = group_median(per_cost, ["zip_code"], "reported_cost", "median_permit_value")
    return counts.join(medians, "zip_code")


_LOAN_MEASURES = [
    "per_capita_income",
    "total_permits_new_construction",
    "total_permits_construction",
    "median_permit_value",
]


def loan_frame(history: DataFrame, community_zip: DataFrame, health: DataFrame, permits: DataFrame) -> DataFrame:
    """One row per ZIP known to any source, with its measures and the bounds of each measure."""
    income, costs = zip_income(community_zip, health), permit_costs(permits)
    # One row per ZIP from stored and small inputs: cheaper to read twice than to store.
    merged = income.join(costs, "zip_code", "full").join(latest_population(history), "zip_code", "full")
    # A ZIP without a measure has NULL there, which takes no part in the bounds.
    edge = lambda m: [F.min(m).alias(f"lo_{m}"), F.max(m).alias(f"hi_{m}")]
    bounds = merged.agg(*[e for m in _LOAN_MEASURES for e in edge(m)])
    # ``bounds`` is a global aggregate: one row.
    return merged.crossJoin(F.broadcast(bounds))


def _filled(measure: str) -> Column:
    return F.coalesce(F.col(measure), F.lit(0))


def loan_targets(
    history: DataFrame,
    community_zip: DataFrame,
    health: DataFrame,
    permits: DataFrame,
    cfg: Settings,
    version: int = 1,
) -> DataFrame:
    """Loan eligibility per ZIP.

    Version 1 weighs each index before it is rounded and takes eligibility from
    income alone, where unknown income counts as 0. Version 2 rounds plain 0..1
    indices first, combines three of them and asks two of them to reach 0.3.
    """
    frame = loan_frame(history, community_zip, health, permits)
    build = _loan_v1 if version == 1 else _loan_v2
    return build(frame, cfg)


def _loan_v1(frame: DataFrame, cfg: Settings) -> DataFrame:
    income, new, total, value = _LOAN_MEASURES

    def shortfall(m: str) -> Column:
        lo, hi = F.col(f"lo_{m}"), F.col(f"hi_{m}")
        return F.when(hi == lo, F.lit(0.0)).otherwise(
            F.try_divide(hi - F.coalesce(F.col(m), hi), hi - lo)
        )

    lo, hi = F.col(f"lo_{value}"), F.col(f"hi_{value}")
    parts = {
        "inverted_income_index": 0.5 * shortfall(income),
        "inverted_new_construction_index": 0.4 * shortfall(new),
        "inverted_permits_index": 0.1 * shortfall(total),
        "permit_value_index": 0.03 * min_max(F.coalesce(F.col(value), lo), lo, hi),
    }
    score = (
        parts["inverted_income_index"]
        + parts["inverted_new_construction_index"]
        + parts["inverted_permits_index"]
        - parts["permit_value_index"]
    )
    return frame.select(
        "zip_code",
        _filled("population").alias("population"),
        _filled(income).alias(income),
        _filled(new).alias(new),
        _filled(total).alias(total),
        half_up(_filled(value), 2).alias(value),
        *[half_up(c, 2).alias(name) for name, c in parts.items()],
        half_up(score, 2).alias("eligibility_index"),
        (_filled(income) < cfg.income_limit).alias("is_loan_eligible"),
    )


def _loan_v2(frame: DataFrame, cfg: Settings) -> DataFrame:
    income, new, total, value = _LOAN_MEASURES

    def position(m: str) -> Column:
        lo, hi = F.col(f"lo_{m}"), F.col(f"hi_{m}")
        return F.try_divide(_filled(m) - lo, F.nullif(hi - lo, F.lit(0)))

    indexed = frame.filter(F.col("zip_code") != UNKNOWN).select(
        "zip_code",
        _filled("population").alias("population"),
        *[_filled(m).alias(m) for m in _LOAN_MEASURES],
        half_up(1 - position(income), 2).alias("inverted_income_index"),
        half_up(1 - position(new), 2).alias("inverted_new_construction_index"),
        half_up(1 - position(total), 2).alias("inverted_permits_index"),
        half_up(position(value), 2).alias("permit_value_index"),
    )
    a, b, c = (F.col(f"inverted_{n}_index") for n in ("income", "new_construction", "permits"))
    return indexed.withColumn("eligibility_index", half_up(a * 0.4 + b * 0.4 + c * 0.2, 2)).withColumn(
        "is_loan_eligible", (a >= 0.3) & (b >= 0.3)
    )


# ---------------------------------------------------------------- baseline forecast


def default_jitter(zip_code: Column, day: Column) -> Column:
    """A reproducible whole number from -20 to 20 per (ZIP, day).

    Stands in for the sign and remainder of a warehouse fingerprint, which no
    other engine reproduces. Any column with the same range can be passed instead.
    """
    digits = F.coalesce(zip_code.try_cast("long"), F.lit(0))
    return F.pmod(digits * 31 + F.datediff(day, F.lit("2000-01-01").cast("date")) * 17, F.lit(41)) - 20


def baseline_forecast(
    trips: DataFrame,
    horizon: int = 30,
    look_back: int = 30,
    min_days: int = 7,
    jitter=default_jitter,
) -> DataFrame:
    """Recent daily mean per pickup ZIP, carried forward with a small variation.

    The latest date is taken from the daily counts, so the trips are scanned once.
    """
    daily = computed_once(trips.groupBy("pickup_zip", "trip_date").agg(F.count(F.lit(1)).alias("n")))
    last = daily.agg(F.max("trip_date").alias("last_date"))
    # ``last`` is a global aggregate: one row.
    recent = (
        daily.filter(F.col("pickup_zip").isNotNull())
        .crossJoin(F.broadcast(last))
        .filter(F.col("trip_date") >= F.date_sub("last_date", look_back))
        .groupBy(F.col("pickup_zip").alias("zip_code"), "last_date")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("days"))
        .filter(F.col("days") >= min_days)
    )
    dated_rows = recent.select(
        "zip_code",
        (F.col("total") / F.col("days")).alias("mean"),
        F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon))).alias(
            "forecast_date"
        ),
    )
    # The remainder of the fingerprint by 21 is signed, and 10 is taken off it.
    swing = 1 + (jitter(F.col("zip_code"), F.col("forecast_date")) - 10) / 100.0
    scaled = lambda k: half_up(F.col("mean") * k * swing, 2)
    return dated_rows.select(
        "zip_code",
        "forecast_date",
        scaled(1.0).alias("predicted_trip_count"),
        scaled(0.8).alias("lower_bound"),
        scaled(1.2).alias("upper_bound"),
        F.lit("prophet_sample").alias("model_name"),
    )


# ---------------------------------------------------------------- other aggregates


def daily_trip_metrics(raw: DataFrame, start, end) -> DataFrame:
    """Daily trips, revenue and payment mix, and the area most trips start and end in.

    One scan counts rows per (day, taxi) and per (day, area); the second step sees
    only those counts. Equally frequent areas go to the smaller number.
    """
    days = raw.filter(dated(F.col("trip_start_timestamp"), start, end)).withColumn(
        "date", F.to_date("trip_start_timestamp")
    )
    # Each trip stands once for itself and once for each end.
    part = lambda kind, area, taxi: F.struct(
        F.lit(kind).alias("part"), area.alias("area"), taxi.alias("taxi")
    )
    none = F.lit(None).cast("string")
    parts = F.array(
        part("trip", none, F.col("taxi_id")),
        *[part(end_, F.col(f"{end_}_community_area"), none) for end_ in ("pickup", "dropoff")],
    )
    is_trip = F.col("part") == "trip"
    pays = {"cash_trips": "Cash", "credit_trips": "Credit Card", "mobile_trips": "Mobile"}
    amounts = {"total": hundredths(F.col("trip_total")), "miles": uncut(F.col("trip_miles")), "fare": hundredths(F.col("fare"))}
    per_taxi_or_area = (
        days.select(
            "date", "payment_type", *[c.alias(n) for n, c in amounts.items()], F.inline(parts)
        )
        .groupBy("date", "part", "area", "taxi")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.when(is_trip, F.col(a))).alias(a) for a in amounts],
            *[F.count(F.when(is_trip, F.col(a))).alias(f"n_{a}") for a in amounts],
            *[tally(is_trip & (F.col("payment_type") == v)).alias(k) for k, v in pays.items()],
        )
    )
    whole = F.struct(
        "n", (-F.coalesce(F.col("area").try_cast("long"), F.lit(10**6))).alias("smaller_first")
    )
    top = lambda end_: F.max_by("area", F.when(F.col("part") == end_, whole)).alias(f"top_{end_}_area")
    mean = lambda a: F.try_divide(F.sum(a).cast("double"), F.sum(f"n_{a}"))
    return per_taxi_or_area.groupBy("date").agg(
        F.sum(F.when(is_trip, F.col("n"))).alias("total_trips"),
        (F.sum("total") / 100.0).alias("total_revenue"),
        mean("miles").alias("avg_trip_miles"),
        (mean("fare") / 100.0).alias("avg_fare"),
        F.count("taxi").alias("unique_taxis"),
        *[F.sum(k).alias(k) for k in pays],
        top("pickup"),
        top("dropoff"),
    )


def permits_monthly_summary(clean: DataFrame, area: str = "community_area") -> DataFrame:
    return (
        clean.filter(F.col("data_quality_flag") == "valid")
        .groupBy(F.col("issue_year").alias("year"), F.col("issue_month").alias("month"), area)
        .agg(
            F.count(F.lit(1)).alias("permit_count"),
            exact_sum(F.col("total_fee")).alias("total_fees"),
            exact_mean(F.col("total_fee")).alias("avg_fee"),
            F.count_distinct("permit_type").alias("unique_permit_types"),
        )
    )
