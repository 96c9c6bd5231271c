"""Bronze, silver and gold tables over one folder, built lazily and once per lake."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.operators import bronze, clean, economic_views, enrich, gold, mobility_views, spatial
from wardline.sources import boundaries, derived

TRIPS = Settings(as_of=date(2024, 2, 1))
FORECASTS = replace(TRIPS, as_of=date(2024, 1, 10))
PERMITS = Settings(
    as_of=date(2001, 5, 1), min_date=date(1996, 1, 1), permit_valid_from=date(1995, 6, 1)
)
HISTORY = Settings(as_of=date(2001, 12, 31), min_date=date(1995, 1, 1))


class Lake:
    """Every table is a lazy DataFrame; nothing is computed before a query needs it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def derived(self, name: str) -> DataFrame:
        return derived.derive(self.spark, self.folder, name)

    # boundaries

    @cached_property
    def zips(self) -> DataFrame:
        return boundaries.from_boxes(self.derived("zip_boxes"))

    @cached_property
    def areas(self) -> DataFrame:
        return boundaries.from_boxes(self.derived("area_boxes"))

    @cached_property
    def hoods(self) -> DataFrame:
        return boundaries.from_boxes(self.derived("hood_boxes"))

    @cached_property
    def places(self) -> enrich.Geography:
        return enrich.Geography.prepare(TRIPS, self.zips, self.hoods)

    @cached_property
    def all_places(self) -> enrich.Geography:
        return enrich.Geography.prepare(TRIPS, self.zips, self.hoods, self.areas)

    @cached_property
    def community_zip(self) -> DataFrame:
        return spatial.community_zip_crosswalk(self.areas, self.zips, TRIPS.cell_degrees)

    @cached_property
    def zip_hood(self) -> DataFrame:
        return spatial.zip_neighborhood_crosswalk(self.zips, self.hoods, TRIPS.cell_degrees)

    # trips

    @cached_property
    def raw_trips(self) -> DataFrame:
        return self.derived("raw_trips")

    def raw(self, kind: str) -> DataFrame:
        return self.raw_trips.filter(F.col("source_dataset") == kind).drop("source_dataset")

    @cached_property
    def bronze_taxi(self) -> DataFrame:
        return bronze.trips(self.raw("taxi"), TRIPS, "taxi")

    @cached_property
    def bronze_tnp(self) -> DataFrame:
        return bronze.trips(self.raw("tnp"), TRIPS, "tnp")

    @cached_property
    def silver_trips(self) -> DataFrame:
        return enrich.silver_trips(self.bronze_taxi, self.bronze_tnp, self.places, TRIPS)

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.trips_by_zip(self.silver_trips, "hour")

    @cached_property
    def daily(self) -> DataFrame:
        return gold.trips_by_zip(self.silver_trips, "day")

    @cached_property
    def daily_by_neighborhood(self) -> DataFrame:
        return gold.trips_by_neighborhood(self.silver_trips)

    @cached_property
    def airport(self) -> DataFrame:
        return mobility_views.airport_trips(self.silver_trips)

    @cached_property
    def rush_hour(self) -> DataFrame:
        return mobility_views.rush_hour_base(self.hourly)

    # permits

    @cached_property
    def raw_permits(self) -> DataFrame:
        return self.derived("raw_permits")

    @cached_property
    def bronze_permits(self) -> DataFrame:
        return bronze.building_permits(self.raw_permits, PERMITS)

    @cached_property
    def permits_clean(self) -> DataFrame:
        return clean.permits(self.raw_permits, PERMITS)

    @cached_property
    def silver_permits(self) -> DataFrame:
        return enrich.silver_permits(self.bronze_permits, self.places, PERMITS)

    @cached_property
    def permits_verified(self) -> DataFrame:
        wards, tracts = (boundaries.from_boxes(self.derived(n)) for n in ("ward_boxes", "tract_boxes"))
        more = enrich.wards_and_tracts(wards, tracts, PERMITS)
        return enrich.permits_verified(self.raw_permits, self.all_places, PERMITS, more)

    @cached_property
    def permits_roi(self) -> DataFrame:
        return gold.permits_roi(self.silver_permits)

    # health

    @cached_property
    def raw_covid(self) -> DataFrame:
        return self.derived("raw_covid")

    @cached_property
    def bronze_covid(self) -> DataFrame:
        return bronze.covid_cases(self.raw_covid, TRIPS)

    @cached_property
    def covid_history(self) -> DataFrame:
        return enrich.covid_history(self.bronze_covid, TRIPS)

    @cached_property
    def covid_latest(self) -> DataFrame:
        return enrich.covid_latest(self.bronze_covid, TRIPS)

    @cached_property
    def covid_enriched(self) -> DataFrame:
        return enrich.covid_apportioned(self.raw_covid, self.community_zip, self.zip_hood)

    @cached_property
    def bronze_ccvi(self) -> DataFrame:
        return bronze.ccvi(self.derived("raw_ccvi"))

    @cached_property
    def ccvi(self) -> DataFrame:
        return enrich.ccvi_high_risk(self.bronze_ccvi)

    @cached_property
    def health(self) -> DataFrame:
        return bronze.public_health(self.derived("raw_health"))

    @cached_property
    def hotspots(self) -> DataFrame:
        return gold.covid_hotspots(self.covid_history, self.silver_trips, self.ccvi, TRIPS)

    def loans(self, version: int) -> DataFrame:
        return gold.loan_targets(
            self.covid_history, self.community_zip, self.health, self.silver_permits, TRIPS, version
        )

    # economic views

    @cached_property
    def timeline(self) -> DataFrame:
        return economic_views.permits_timeline(self.silver_permits, PERMITS)

    @cached_property
    def monthly_permits(self) -> DataFrame:
        return economic_views.monthly_permit_summary(self.timeline)

    @cached_property
    def economic(self) -> DataFrame:
        return economic_views.economic_dashboard(self.loans(1))

    # forecasts

    @cached_property
    def traffic(self) -> DataFrame:
        return self.derived("traffic_forecasts")

    @cached_property
    def risk(self) -> DataFrame:
        return self.derived("covid_forecasts")

    @cached_property
    def metrics(self) -> DataFrame:
        return self.derived("forecast_metrics")

    @cached_property
    def files(self) -> DataFrame:
        return self.derived("file_manifest")
