"""Batch jobs: tables are written between layers, so each layer reads stored, pruned input.

A job takes raw tables as DataFrames and a folder to keep its layers in. Nothing
is chained lazily across layers: the enriched trips alone feed about ten readers.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.operators import bronze, clean, enrich, forecasting, gold, incremental, quality, reports, spatial
from wardline.sources import boundaries, tables


def _by_areas() -> tuple[Column, ...]:
    """Trips lie near each other in files by both ends at once."""
    return (tables.interleaved(F.col("pickup_community_area"), F.col("dropoff_community_area")),)


def _by_zips() -> tuple[Column, ...]:
    ends = (F.col(f"{e}_zip").try_cast("long") % 1024 for e in ("pickup", "dropoff"))
    return (tables.interleaved(*ends, bits=10),)


@dataclass(frozen=True)
class Folders:
    """Where each table of a lake is kept."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def run_permits(
    spark: SparkSession,
    raw: DataFrame,
    places: enrich.Geography,
    history: DataFrame,
    community_zip: DataFrame,
    health: DataFrame,
    root: str,
    cfg: Settings,
    loan_version: int = 2,
    gated: bool = False,
) -> DataFrame:
    """Permits from raw to gold: two keyed upserts, then a full rebuild of the gold tables.

    Only the increment is enriched. ``gated`` measures the load gates as the increment is written, and stops before
    any table changes if a critical one fails. Returns the layer statistics.
    """
    at = Folders(root)
    shaped = bronze.building_permits(raw, cfg)
    known = tables.read_or_empty(spark, at.bronze_permits, shaped)
    fresh = incremental.increment(shaped, known, "issue_date", cfg)
    load = lambda rows: incremental.apply_upsert(rows, at.bronze_permits, ["id"], "issue_date")
    if gated:
        quality.load_gated(fresh, cfg, load)
    else:
        load(fresh)
    stored = spark.read.schema(shaped.schema).parquet(at.bronze_permits)
    like = enrich.silver_permits(stored, places, cfg)
    known = tables.read_or_empty(spark, at.silver_permits, like)
    fresh = incremental.increment(stored, known, "issue_date", cfg)
    incremental.apply_upsert(
        enrich.silver_permits(fresh, places, cfg), at.silver_permits, ["id"], "issue_date"
    )
    silver = spark.read.schema(like.schema).parquet(at.silver_permits)
    tables.write(gold.permits_roi(silver), at.permits_roi)
    loans = gold.loan_targets(history, community_zip, health, silver, cfg, loan_version)
    tables.write(loans, at.loan_targets)
    return reports.layer_statistics(
        stored, silver, spark.read.parquet(at.permits_roi), spark.read.parquet(at.loan_targets)
    )


def run_trips(
    spark: SparkSession, raw_taxi: DataFrame, raw_tnp: DataFrame, places: enrich.Geography, root: str, cfg: Settings
) -> None:
    """Full build of the trip tables, partitioned by date."""
    at = Folders(root)
    for kind, raw in (("taxi", raw_taxi), ("tnp", raw_tnp)):
        rows = bronze.trips(raw, cfg, kind).withColumn("trip_date", F.to_date("trip_start_timestamp"))
        tables.write(rows, f"{at.root}/bronze_{kind}", "trip_date", _by_areas())
    taxi, tnp = (spark.read.parquet(f"{at.root}/bronze_{k}").drop("trip_date") for k in ("taxi", "tnp"))
    silver = enrich.silver_trips(taxi, tnp, places, cfg)
    tables.write(silver, at.silver_trips, "trip_date", ("source_dataset", *_by_areas()))
    _build_trip_gold(spark, at)


def _build_trip_gold(spark: SparkSession, at: Folders) -> None:
    stored = spark.read.parquet(at.silver_trips)
    tables.write(gold.trips_by_zip(stored, "hour"), at.hourly, "trip_date", _by_zips())
    tables.write(gold.trips_by_zip(stored, "day"), at.daily, "trip_date", _by_zips())
    tables.write(gold.route_pairs(stored), at.routes)


def replace_trip_range(
    spark: SparkSession,
    raw_taxi: DataFrame,
    places: enrich.Geography,
    root: str,
    start: date,
    end: date,
    cfg: Settings,
    taxi_only_gold: bool = False,
) -> None:
    """Rebuild the taxi trips of some days in all four trip tables.

    The full build's transforms are used, so replacing every day gives the same
    tables as a rebuild. Rideshare trips of those days are carried over in silver.
    ``taxi_only_gold`` aggregates the replaced days over taxi trips alone, with or
    without ZIPs, as the published backfill does.
    """
    at = Folders(root)
    window = replace(cfg, min_date=start, as_of=end)
    taxi = bronze.trips(raw_taxi, window, "taxi")
    by_day = taxi.withColumn("trip_date", F.to_date("trip_start_timestamp"))
    tables.replace_range(spark, by_day, f"{at.root}/bronze_taxi", "trip_date", start, end)

    stored = spark.read.parquet(at.silver_trips)
    days = F.col("trip_date").between(F.lit(start), F.lit(end))
    kept = stored.filter(days & (F.col("source_dataset") == "tnp"))
    fresh_taxi = spark.read.parquet(f"{at.root}/bronze_taxi").filter(days).drop("trip_date")
    rebuilt = enrich.silver_trips(fresh_taxi, fresh_taxi.limit(0), places, window)
    tables.replace_range(
        spark, rebuilt.select(*kept.columns).unionByName(kept), at.silver_trips, "trip_date", start, end
    )

    part = spark.read.parquet(at.silver_trips).filter(days)
    if taxi_only_gold:
        part = part.filter(F.col("source_dataset") == "taxi")
    for grain, path in (("hour", at.hourly), ("day", at.daily)):
        rows = gold.trips_by_zip(part, grain, require_zips=not taxi_only_gold)
        tables.replace_range(spark, rows, path, "trip_date", start, end)


def refilter_trips(spark: SparkSession, root: str, kind: str, cfg: Settings) -> None:
    """Narrow a stored bronze trip table to the coordinate window."""
    path = f"{root}/bronze_{kind}"
    with tables.staged(bronze.refilter_trips(spark.read.parquet(path), cfg)) as ready:
        tables.write(ready, path, "trip_date", _by_areas())


def load_boundaries(spark: SparkSession, sources: dict[str, tuple[str, dict[str, str]]], root: str) -> None:
    """Boundary files to tables, replacing what is there.

    ``sources`` maps a table name to its file and the attributes to keep.
    """
    for name, (path, attributes) in sources.items():
        tables.write(boundaries.read(spark, path, attributes), f"{root}/{name}")


def build_crosswalks(areas: DataFrame, zips: DataFrame, hoods: DataFrame, root: str, cfg: Settings) -> None:
    at, size = Folders(root), cfg.cell_degrees
    tables.write(spatial.community_zip_crosswalk(areas, zips, size), at.crosswalk_community_zip)
    tables.write(spatial.community_neighborhood_crosswalk(areas, hoods, size), at.crosswalk_community_neighborhood)
    tables.write(spatial.zip_neighborhood_crosswalk(zips, hoods, size), at.crosswalk_zip_neighborhood)
    tables.write(spatial.three_way_crosswalk(areas, zips, hoods, size), at.crosswalk_complete)


def run_health(
    spark: SparkSession, raw_covid: DataFrame, raw_ccvi: DataFrame, raw_health: DataFrame, root: str, cfg: Settings
) -> None:
    """Weekly health tables, vulnerability and income, and the weekly risk over the stored trips."""
    at = Folders(root)
    tables.write(bronze.covid_cases(raw_covid, cfg), at.bronze_covid, "week_start", ("zip_code",))
    tables.write(bronze.ccvi(raw_ccvi), at.bronze_ccvi)
    tables.write(bronze.public_health(raw_health), at.public_health)
    weekly = spark.read.parquet(at.bronze_covid)
    tables.write(enrich.covid_latest(weekly, cfg), at.covid_latest)
    tables.write(enrich.covid_history(weekly, cfg), at.covid_history, "week_start", ("zip_code", "risk_category"))
    tables.write(enrich.ccvi_high_risk(spark.read.parquet(at.bronze_ccvi)), at.ccvi_high_risk)
    if tables.exists(spark, at.silver_trips):
        hotspots = gold.covid_hotspots(
            spark.read.parquet(at.covid_history),
            spark.read.parquet(at.silver_trips),
            spark.read.parquet(at.ccvi_high_risk),
            cfg,
        )
        tables.write(hotspots, at.covid_hotspots, "week_start", ("zip_code", "risk_category"))


def materialise_clean_views(
    raw_permits: DataFrame, raw_covid: DataFrame, raw_taxi: DataFrame, root: str, cfg: Settings
) -> None:
    """Stored copies of the cleaned views.

    Permits and health weeks are created when missing; the recent taxi month is replaced.
    """
    at = Folders(root)
    tables.write(
        clean.permits(raw_permits, cfg),
        at.permits_clean_materialized,
        "issue_date_only",
        ("community_area", "permit_type_category"),
        mode="ignore",
    )
    tables.write(
        clean.covid(raw_covid, cfg), at.covid_clean_materialized, "week_start_date", ("zip_code",), mode="ignore"
    )
    month = clean.recent(clean.taxi(raw_taxi, cfg), "trip_date", cfg)
    tables.write(month, at.taxi_clean_recent_month, "trip_date", ("pickup_community_area", "time_category"))


def run_traffic_forecast(spark: SparkSession, daily: DataFrame, root: str, cfg: Settings) -> None:
    """Traffic forecasts and their metrics.

    The metrics table is shared by all models and keeps their history: a run replaces only the rows of
    the same model, version and date.
    """
    at, spec = Folders(root), forecasting.TRAFFIC
    with tables.staged(forecasting.traffic_series(daily, cfg)) as series:
        with tables.staged(forecasting.components(series, spec)) as fitted:
            tables.write(forecasting.traffic_forecast(series, fitted, cfg), at.traffic_forecasts, "forecast_date")
            metrics = forecasting.model_metrics(series, fitted, spec, cfg, f"{spec.horizon}-day forecast")
            _replace_metrics(spark, metrics, at.forecast_metrics, spec, cfg.as_of)


def run_neighborhood_forecast(spark: SparkSession, trips: DataFrame, root: str, cfg: Settings) -> None:
    """Daily trips per neighborhood from silver trips, and their forecasts with construction advice."""
    at, spec = Folders(root), forecasting.TRAFFIC
    with tables.staged(gold.trips_by_neighborhood(trips)) as daily:
        tables.write(daily, at.gold_taxi_daily_by_neighborhood, "trip_date", ("neighborhood",))
        with tables.staged(forecasting.traffic_series(daily, cfg, "neighborhood")) as series:
            with tables.staged(forecasting.components(series, spec)) as fitted:
                forecasts = forecasting.traffic_forecast(series, fitted, cfg, area="neighborhood")
                tables.write(
                    forecasting.neighborhood_forecast(forecasts), at.traffic_forecasts_by_neighborhood, "forecast_date"
                )


def run_covid_forecast(
    spark: SparkSession,
    hotspots: DataFrame,
    root: str,
    cfg: Settings,
    start: date,
    end: date,
    spec: forecasting.ModelSpec = forecasting.COVID_RETROSPECTIVE,
    scale: forecasting.RiskScale = forecasting.SCALE_3,
) -> None:
    """COVID risk forecasts of one model; forecasts are replaced, metrics kept per model, version and date."""
    at = Folders(root)
    with tables.staged(forecasting.covid_series(hotspots, start, end, bool(spec.regressor_scales))) as series:
        with tables.staged(forecasting.components(series, spec)) as fitted:
            forecasts = forecasting.covid_forecast(series, fitted, cfg, spec, scale)
            tables.write(forecasts, at.covid_forecasts, "forecast_date")
            metrics = forecasting.model_metrics(series, fitted, spec, cfg)
            _replace_metrics(spark, metrics, at.forecast_metrics, spec, cfg.as_of)


def _replace_metrics(spark: SparkSession, metrics: DataFrame, path: str, spec: forecasting.ModelSpec, trained: date) -> None:
    ours = (
        (F.col("model_name") == F.concat(F.lit(spec.name + "_"), F.col("zip_code"), F.lit(spec.suffix)))
        & (F.col("model_version") == spec.version)
        & (F.col("trained_date") == F.lit(trained))
    )
    others = tables.read_or_empty(spark, path, metrics).filter(~ours)
    with tables.staged(others.unionByName(metrics)) as ready:
        tables.write(ready, path)
