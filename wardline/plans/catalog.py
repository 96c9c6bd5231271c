"""Named queries over a data folder. Each entry takes a lake and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.columns import half_up
from wardline.functions.metrics import error_metrics
from wardline.operators import (
    bronze,
    clean,
    covid_queries,
    economic_views,
    enrich,
    forecasting,
    gold,
    incremental,
    lineage,
    mobility_views,
    quality,
    reports,
    spatial,
    traffic_queries,
    vulnerability_views,
)
from wardline.plans import stored
from wardline.plans.lake import FORECASTS, HISTORY, PERMITS, TRIPS, Lake
from wardline.session import computed_once
from wardline.sources import boundaries, landing

CELL = TRIPS.cell_degrees
YEARS = (2001, 2000, 1999, 1998, 1997, 1996)
REPLACED = (date(2024, 1, 10), date(2024, 1, 20))
NOW = datetime(2024, 2, 1)


def _daily_checks(lake: Lake, days_ago: int) -> DataFrame:
    """The checks of one check date, over the day before it."""
    return quality.check_table(
        lake.raw_permits,
        quality.permit_checks(PERMITS.bounds, PERMITS.max_fee),
        "raw_building_permits",
        PERMITS.as_of - timedelta(days=days_ago),
        "issue_date",
    )


def _square_metres(df: DataFrame) -> DataFrame:
    """Areas to whole square metres: the last digits depend on the order of summation."""
    return df.withColumn("intersection_area", half_up(F.col("intersection_area"), 0))


def _degrees(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: half_up(F.col(c), 6) for c in cols})


def _box_of(df: DataFrame) -> DataFrame:
    """Geometry as its four limits, to compare with plain numbers."""
    points = F.flatten(F.flatten("geometry"))
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    limits = {"west": F.array_min(x), "south": F.array_min(y), "east": F.array_max(x), "north": F.array_max(y)}
    return df.withColumns({n: half_up(c, 6) for n, c in limits.items()}).drop("geometry")


def _upserted(lake: Lake) -> DataFrame:
    """Bronze permits up to 30 days ago, then the increment of the last 30 days with changed fees."""
    first_new = PERMITS.as_of - timedelta(days=PERMITS.increment_days)
    target = lake.bronze_permits.filter(F.col("issue_date") < F.lit(first_new))
    source = incremental.increment(lake.bronze_permits, target, "issue_date", PERMITS)
    repeated = target.filter(F.col("processing_time") == 7).withColumns(
        {"issue_date": F.lit(PERMITS.as_of), "total_fee": F.lit(1.0)}
    )
    return incremental.upsert(target, source.unionByName(repeated), ["id"])


def _replaced(lake: Lake) -> DataFrame:
    """Silver trips with the taxi trips of some days rebuilt and the rideshare trips kept."""
    fresh = lake.silver_trips.filter(F.col("source_dataset") == "taxi").withColumn("fare", F.col("fare") + 1.0)
    return incremental.replace_days(
        lake.silver_trips, fresh, "trip_date", *REPLACED, keep=F.col("source_dataset") == "tnp"
    ).select("trip_id", "trip_date", "source_dataset", "pickup_zip", half_up(F.col("fare"), 2).alias("fare"))


def _insert_ignore(lake: Lake) -> DataFrame:
    """Rideshare rows whose trip a table of older trips does not hold yet."""
    rows = lake.raw("tnp").select("trip_id", "trip_start_timestamp", "trip_seconds")
    old = rows.filter(F.col("trip_start_timestamp") < F.lit(date(2024, 1, 15)))
    return landing.new_rows(old, rows.unionByName(rows), ("trip_id",))


def _metrics(mode: str) -> Callable[[Lake], DataFrame]:
    def run(lake: Lake) -> DataFrame:
        cols = error_metrics("actual", "predicted", mode)
        return lake.derived("predictions").groupBy("zip_code").agg(*[half_up(c, 6).alias(n) for n, c in cols.items()])

    return run


def _traffic_model(lake: Lake, part: str) -> DataFrame:
    daily = lake.derived("daily_history").withColumnRenamed("zip_code", "pickup_zip")
    ys = computed_once(forecasting.traffic_series(daily, HISTORY))
    fitted = forecasting.components(ys, forecasting.TRAFFIC)
    if part == "metrics":
        return forecasting.model_metrics(ys, fitted, forecasting.TRAFFIC, HISTORY, "90-day forecast")
    return forecasting.traffic_forecast(ys, fitted, HISTORY)


def _model_facts(df: DataFrame, area: str, trained: str, low: str, score: str, high: str, top: float, *more: str) -> DataFrame:
    """What a fitted forecast has to hold whatever its numbers are: areas, dates, training counts, limits in order."""
    return df.select(
        area, "forecast_date", "model_trained_date", trained, "model_version",
        *(half_up(F.col(c), 6).alias(c) for c in more),
        (F.col(low) <= F.col(high)).alias("in_order"),
        F.col(score).between(0.0, top).alias("in_bounds"),
    )


def _traffic_facts(lake: Lake) -> DataFrame:
    return _model_facts(_traffic_model(lake, "forecast"), "zip_code", "training_days", "yhat_lower", "yhat", "yhat_upper", float("inf"))


def _risk_facts(spec: forecasting.ModelSpec, scale: forecasting.RiskScale, *more: str) -> Callable[[Lake], DataFrame]:
    limits = ("risk_score_lower", "predicted_risk_score", "risk_score_upper")
    return lambda lake: _model_facts(_risk_model(spec, scale)(lake), "zip_code", "training_weeks", *limits, scale.top, *more)


def _neighborhood_model(lake: Lake) -> DataFrame:
    """Daily trips per neighborhood (five ZIPs each) through the traffic model."""
    daily = lake.derived("daily_history").withColumn(
        "neighborhood", F.concat(F.lit("SIDE "), (F.col("zip_code").cast("int") % 5).cast("string"))
    )
    ys = computed_once(forecasting.traffic_series(daily, HISTORY, "neighborhood"))
    fitted = forecasting.components(ys, forecasting.TRAFFIC)
    return forecasting.neighborhood_forecast(
        forecasting.traffic_forecast(ys, fitted, HISTORY, area="neighborhood")
    )


def _risk_model(spec: forecasting.ModelSpec, scale: forecasting.RiskScale) -> Callable[[Lake], DataFrame]:
    def run(lake: Lake) -> DataFrame:
        weekly = lake.derived("weekly_history")
        ys = computed_once(
            forecasting.covid_series(weekly, HISTORY.min_date, HISTORY.as_of, bool(spec.regressor_scales))
        )
        return forecasting.covid_forecast(ys, forecasting.components(ys, spec), HISTORY, spec, scale)

    return run


ENTRIES: dict[str, Callable[[Lake], DataFrame]] = {
    # loads and checks of loads
    "landing_rows_on_date": lambda l: landing.rows_on(l.raw_trips, "trip_start_timestamp", date(2024, 1, 7)),
    "landing_insert_ignore": _insert_ignore,
    "landing_load_profile": lambda l: landing.load_profile(l.raw_trips, "trip_start_timestamp"),
    "boundary_attributes": lambda l: _degrees(
        spatial.boundary_attributes(l.zips).drop("rings"), "area_sq_km", "centroid_lat", "centroid_lon"
    ),
    "boundary_validation": lambda l: boundaries.validate_rings(l.areas, "community"),
    "boundary_name_comparison": lambda l: boundaries.compare_names(
        l.areas,
        l.derived("raw_health").select("community_area_name").union(l.derived("hood_boxes").select("pri_neigh")),
        "community",
        "community_area_name",
    ),
    # bronze
    "bronze_taxi_trips": lambda l: l.bronze_taxi,
    "bronze_tnp_trips": lambda l: l.bronze_tnp,
    "bronze_trips_refiltered": lambda l: bronze.refilter_trips(l.bronze_tnp, _narrow()),
    "bronze_covid_cases": lambda l: l.bronze_covid,
    "bronze_building_permits": lambda l: l.bronze_permits,
    "bronze_ccvi": lambda l: l.bronze_ccvi,
    "bronze_public_health": lambda l: l.health,
    # cleaned views
    "permits_quality_flags": lambda l: clean.flagged_permits(l.raw_permits, PERMITS)
    .groupBy("data_quality_flag")
    .agg(F.count(F.lit(1)).alias("permits")),
    "permits_clean": lambda l: l.permits_clean,
    "covid_clean": lambda l: clean.covid(l.raw_covid, TRIPS),
    "taxi_quality_flags": lambda l: l.raw("taxi")
    .select(clean.taxi_flag(TRIPS).alias("data_quality_flag"))
    .groupBy("data_quality_flag")
    .agg(F.count(F.lit(1)).alias("trips")),
    "taxi_clean": lambda l: clean.taxi(l.raw("taxi"), TRIPS),
    "taxi_clean_recent_month": lambda l: clean.recent(clean.taxi(l.raw("taxi"), TRIPS), "trip_date", TRIPS),
    "permits_quality_report": lambda l: quality.permits_report(l.permits_clean, PERMITS),
    "covid_quality_report": lambda l: quality.covid_report(clean.covid(l.raw_covid, TRIPS)),
    "taxi_quality_report": lambda l: quality.taxi_report(
        clean.recent(clean.taxi(l.raw("taxi"), TRIPS), "trip_date", TRIPS)
    ),
    # enrichment
    "silver_trips_enriched": lambda l: l.silver_trips,
    "silver_permits_enriched": lambda l: l.silver_permits,
    "silver_covid_latest": lambda l: l.covid_latest,
    "silver_covid_weekly_historical": lambda l: l.covid_history,
    "silver_ccvi_high_risk": lambda l: l.ccvi,
    "permits_enriched": lambda l: l.permits_verified.select(
        "id",
        "community_area",
        "verified_community_area",
        "community_area_name_verified",
        "community_area_matches",
        "zip_code_verified",
        "neighborhood_name",
        "secondary_neighborhood",
        "ward_number",
        "alderman_name",
        "census_tract",
    ),
    "covid_enriched": lambda l: l.covid_enriched,
    "taxi_trips_with_geography": lambda l: _metres(enrich.trips_with_geography(l.raw("taxi"), l.all_places, TRIPS)),
    "permits_by_community_and_zip": lambda l: enrich.permits_by_place(l.raw_permits, l.permits_verified, PERMITS),
    "permits_match_rate": lambda l: enrich.match_rate(l.permits_verified, PERMITS),
    "top_estimated_cases": lambda l: enrich.top_estimated_cases(l.covid_enriched, TRIPS),
    # polygons
    "crosswalk_community_zip": lambda l: _square_metres(l.community_zip),
    "crosswalk_community_neighborhood": lambda l: _square_metres(
        spatial.community_neighborhood_crosswalk(l.areas, l.hoods, CELL)
    ),
    "crosswalk_zip_neighborhood": lambda l: _square_metres(l.zip_hood),
    "crosswalk_complete": lambda l: _square_metres(spatial.three_way_crosswalk(l.areas, l.zips, l.hoods, CELL)),
    "crosswalk_summary": lambda l: spatial.crosswalk_summary(l.community_zip),
    # maintenance
    "permits_upsert": _upserted,
    "trips_range_replace": _replaced,
    "permits_layer_statistics": lambda l: reports.layer_statistics(
        l.bronze_permits, l.silver_permits, l.permits_roi, l.loans(2)
    ),
    # gold
    "gold_taxi_hourly_by_zip": lambda l: l.hourly,
    "gold_taxi_daily_by_zip": lambda l: l.daily,
    "gold_taxi_daily_by_neighborhood": lambda l: l.daily_by_neighborhood,
    "gold_route_pairs": lambda l: gold.route_pairs(l.silver_trips),
    "gold_permits_roi": lambda l: l.permits_roi,
    "gold_weekly_mobility": lambda l: gold.weekly_mobility(l.silver_trips),
    "gold_covid_hotspots": lambda l: l.hotspots,
    "gold_loan_targets_v1": lambda l: l.loans(1),
    "gold_loan_targets_v2": lambda l: l.loans(2),
    "gold_forecasts": lambda l: gold.baseline_forecast(l.silver_trips),
    "daily_trip_metrics": lambda l: _degrees(
        gold.daily_trip_metrics(l.raw("taxi"), date(2024, 1, 1), date(2024, 1, 31)), "avg_trip_miles"
    ),
    "permits_monthly_summary": lambda l: gold.permits_monthly_summary(l.permits_clean),
    "hourly_profile": lambda l: reports.hourly_or_daily_profile(l.hourly),
    "daily_profile": lambda l: reports.hourly_or_daily_profile(l.daily),
    "routes_profile": lambda l: reports.routes_profile(gold.route_pairs(l.silver_trips)),
    "roi_profile": lambda l: reports.roi_profile(l.permits_roi),
    "hotspots_profile": lambda l: reports.hotspots_profile(l.hotspots),
    "loans_profile": lambda l: reports.loans_profile(l.loans(1)),
    "forecasts_profile": lambda l: reports.forecasts_profile(gold.baseline_forecast(l.silver_trips)),
    # airport and rush hour
    "v_airport_trips": lambda l: l.airport,
    "v_airport_covid_overlay": lambda l: mobility_views.airport_covid_overlay(l.airport, l.hotspots),
    "v_airport_covid_overlay_aligned": lambda l: mobility_views.airport_covid_overlay(
        l.airport, l.hotspots, lambda week: F.date_add(week, 1)
    ),
    "v_airport_hourly_patterns": lambda l: mobility_views.airport_hourly(l.airport, TRIPS),
    "airport_counts": lambda l: mobility_views.airport_counts(l.airport),
    "v_rush_hour_by_zip": lambda l: l.rush_hour,
    "rush_hour_iqr": lambda l: mobility_views.rush_hour_limits(l.rush_hour, FORECASTS),
    "rush_hour_scale": lambda l: mobility_views.rush_hour_scale(l.rush_hour, FORECASTS),
    "rush_hour_by_day_type": lambda l: mobility_views.rush_hour_by_day_type(l.rush_hour, FORECASTS),
    # vulnerability
    "v_ccvi_map": lambda l: _degrees(
        vulnerability_views.ccvi_map(l.ccvi, spatial.centroids(l.areas), spatial.centroids(l.zips)),
        "latitude",
        "longitude",
    ),
    "v_ccvi_trip_activity": lambda l: vulnerability_views.ccvi_trip_activity(l.silver_trips, l.ccvi, l.areas),
    "v_ccvi_double_burden": lambda l: _burden(vulnerability_views.ccvi_double_burden(l.ccvi, l.hotspots)),
    "v_ccvi_trip_trends": lambda l: vulnerability_views.ccvi_trip_trends(l.silver_trips, l.ccvi),
    "v_ccvi_pooled_rides": lambda l: vulnerability_views.ccvi_pooled_rides(l.silver_trips, l.ccvi, l.areas),
    "v_ccvi_dashboard_summary": lambda l: vulnerability_views.ccvi_summary(l.ccvi, l.silver_trips, l.hotspots),
    # economy
    "v_economic_dashboard": lambda l: l.economic,
    "v_permits_timeline": lambda l: l.timeline,
    "v_permits_by_area": lambda l: economic_views.permits_by_area(l.silver_permits, l.loans(1)),
    "v_monthly_permit_summary": lambda l: l.monthly_permits,
    "v_fee_analysis": lambda l: economic_views.fee_analysis(l.timeline, YEARS),
    "economic_kpis": lambda l: economic_views.kpis(l.economic, l.timeline, l.monthly_permits),
    "economic_check_dashboard": lambda l: reports.check_economic_dashboard(l.economic),
    "economic_check_timeline": lambda l: reports.check_permits_timeline(l.timeline),
    "economic_check_area": lambda l: reports.check_permits_by_area(
        economic_views.permits_by_area(l.silver_permits, l.loans(1))
    ),
    "economic_check_monthly": lambda l: reports.check_monthly_summary(l.monthly_permits),
    "economic_check_fees": lambda l: reports.check_fee_analysis(economic_views.fee_analysis(l.timeline, YEARS)),
    "cumulative_permits": lambda l: economic_views.cumulative_permits(l.monthly_permits),
    "uncertainty_percent": lambda l: economic_views.uncertainty_percent(l.traffic),
    # traffic forecast reports
    "traffic_next_week": lambda l: traffic_queries.next_week(l.traffic, FORECASTS),
    "traffic_weekly": lambda l: traffic_queries.weekly(l.traffic, FORECASTS),
    "traffic_monthly": lambda l: traffic_queries.monthly(l.traffic),
    "traffic_top_zips": lambda l: traffic_queries.top_zips(l.traffic, FORECASTS),
    "traffic_versus_actual": lambda l: traffic_queries.versus_actual(l.daily, l.traffic, TRIPS),
    "traffic_components": lambda l: traffic_queries.components(l.traffic, FORECASTS),
    "traffic_model_rollup": lambda l: traffic_queries.model_rollup(l.metrics),
    "traffic_uncertainty": lambda l: traffic_queries.uncertainty(l.traffic, FORECASTS),
    "traffic_day_of_week": lambda l: traffic_queries.day_of_week(l.traffic, FORECASTS),
    "traffic_month_over_month": lambda l: traffic_queries.month_over_month(l.traffic),
    "traffic_airport": lambda l: traffic_queries.airport_forecast(l.traffic, FORECASTS),
    "traffic_model_averages": lambda l: traffic_queries.model_averages(l.metrics, FORECASTS),
    "traffic_coverage": lambda l: traffic_queries.coverage(l.traffic),
    # COVID forecast reports
    "covid_next_month": lambda l: covid_queries.next_month(l.risk, FORECASTS),
    "covid_next_alerts": lambda l: covid_queries.next_alerts(l.risk, FORECASTS),
    "covid_risk_trend": lambda l: covid_queries.risk_trend(l.risk),
    "covid_alert_distribution": lambda l: covid_queries.alert_distribution(l.risk),
    "covid_history_and_forecast": lambda l: covid_queries.history_and_forecast(l.hotspots, l.risk, FORECASTS),
    "covid_top_risk_zips": lambda l: covid_queries.top_risk_zips(l.risk),
    "covid_model_metrics": lambda l: covid_queries.model_metrics(l.metrics),
    "covid_uncertainty": lambda l: covid_queries.uncertainty(l.risk),
    "covid_mobility_bands": lambda l: covid_queries.mobility_bands(l.risk),
    "covid_weekly_briefing": lambda l: covid_queries.weekly_briefing(l.risk),
    "covid_risk_with_geometry": lambda l: _box_of(covid_queries.risk_with_geometry(l.risk, l.zips, FORECASTS)),
    "covid_export": lambda l: covid_queries.export(l.risk),
    "covid_high_risk_ahead": lambda l: covid_queries.high_risk_ahead(l.risk, FORECASTS),
    "covid_last_alert_map": lambda l: _box_of(covid_queries.last_alert_map(l.risk, l.zips)),
    # short reports
    "airport_share_by_source": lambda l: reports.airport_share(l.silver_trips),
    "enrichment_rate_by_source": lambda l: reports.enrichment_rate(l.silver_trips),
    "permits_by_neighborhood": lambda l: reports.permits_by_neighborhood(l.silver_permits, 2000),
    "covid_risk_distribution": lambda l: reports.risk_distribution(l.covid_latest),
    "high_risk_by_type": lambda l: reports.high_risk_by_type(l.ccvi),
    "top_hotspots": lambda l: reports.top_hotspots(l.hotspots),
    "loan_eligible_zips": lambda l: reports.eligible_zips(l.loans(1)),
    "loan_top_eligible_zips": lambda l: reports.top_eligible_zips(l.loans(1), TRIPS.income_limit),
    "hours_by_pickup_zip": lambda l: reports.hours_by_zip(l.hourly),
    "cases_by_community_area": lambda l: reports.cases_by_area(l.covid_enriched),
    "areas_of_a_zip": lambda l: reports.areas_of_zip(l.community_zip, "60614"),
    "zips_of_a_neighborhood": lambda l: reports.zips_of_neighborhood(l.zip_hood, "ASIA"),
    "distributed_metric": lambda l: reports.distribute(l.bronze_covid, l.community_zip, "cases_weekly"),
    "trips_from_high_risk_areas": lambda l: reports.trips_from_high_risk(l.silver_trips, l.ccvi),
    "investment_areas": lambda l: reports.investment_areas(l.derived("raw_health"), l.silver_permits),
    # quality and lineage
    "quality_check_table": lambda l: quality.check_table(
        l.raw_permits, quality.permit_checks(PERMITS.bounds, PERMITS.max_fee), "raw_building_permits", PERMITS.as_of
    ),
    "quality_check_previous_day": lambda l: _daily_checks(l, 0),
    "quality_check_report": lambda l: quality.check_report(
        reduce(DataFrame.unionByName, [_daily_checks(l, n) for n in (0, 3, 7, 8, 30)]), PERMITS
    ),
    "quality_load_gates": lambda l: quality.gates(l.raw_permits, PERMITS),
    "quality_expectations": lambda l: quality.expectations(l.raw("taxi"), quality.TAXI_EXPECTATIONS),
    "lineage_freshness": lambda l: lineage.freshness(l.files, NOW),
    "lineage_success_rate": lambda l: lineage.success_rate(l.files, TRIPS),
    "lineage_missing_dates": lambda l: lineage.missing_dates(l.files, "taxi", date(2023, 12, 25), date(2024, 2, 1)),
    "lineage_find_file": lambda l: lineage.find_file(l.files, "taxi/2024-01-15/batch_001.json"),
    # models
    "forecast_metrics_plain": _metrics("plain"),
    "forecast_metrics_positive": _metrics("positive"),
    "forecast_metrics_floored": _metrics("floored"),
    "traffic_model_forecast": lambda l: _traffic_model(l, "forecast"),
    "traffic_model_metrics": lambda l: _traffic_model(l, "metrics"),
    "traffic_model_skipped": lambda l: forecasting.skipped(
        forecasting.traffic_series(l.daily, TRIPS), forecasting.TRAFFIC
    ),
    "traffic_model_neighborhoods": _neighborhood_model,
    "covid_model_simple": _risk_model(forecasting.COVID_SIMPLE, forecasting.SCALE_100),
    "covid_model_regressors": _risk_model(forecasting.COVID_REGRESSORS, forecasting.SCALE_100_TREND),
    "covid_model_retrospective": _risk_model(forecasting.COVID_RETROSPECTIVE, forecasting.SCALE_3),
    "traffic_model_facts": _traffic_facts,
    "covid_model_simple_facts": _risk_facts(
        forecasting.COVID_SIMPLE, forecasting.SCALE_100, "predicted_case_rate", "predicted_mobility_index"
    ),
    "covid_model_regressors_facts": _risk_facts(forecasting.COVID_REGRESSORS, forecasting.SCALE_100_TREND),
    "covid_model_retrospective_facts": _risk_facts(
        forecasting.COVID_RETROSPECTIVE, forecasting.SCALE_3, "predicted_case_rate", "predicted_mobility_index"
    ),
}


def _narrow():
    return replace(TRIPS, bounds=replace(TRIPS.bounds, lat_max=41.9, lon_min=-87.8))


def _metres(df: DataFrame) -> DataFrame:
    c = "straight_line_distance_meters"
    return df.withColumn(c, half_up(F.col(c), 3))


def _burden(df: DataFrame) -> DataFrame:
    return df.withColumn("double_burden_score", half_up(F.col("double_burden_score"), 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Lake], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: fn(Lake(spark, folder))

    return {name: bind(fn) for name, fn in (ENTRIES | stored.ENTRIES).items()}
