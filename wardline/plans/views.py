"""The dashboard views as named lazy queries, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardline.config import Settings
from wardline.operators import economic_views, mobility_views, spatial, vulnerability_views
from wardline.sources.tables import create_view


def dashboard_views(
    *,
    trips: DataFrame,
    hourly: DataFrame,
    hotspots: DataFrame,
    ccvi: DataFrame,
    permits: DataFrame,
    loans: DataFrame,
    areas: DataFrame,
    zips: DataFrame,
    cfg: Settings,
) -> dict[str, DataFrame]:
    """All views over the given silver, gold and boundary tables, by name."""
    airport = mobility_views.airport_trips(trips)
    timeline = economic_views.permits_timeline(permits, cfg)
    v = vulnerability_views
    return {
        "v_airport_trips": airport,
        "v_airport_covid_overlay": mobility_views.airport_covid_overlay(airport, hotspots),
        "v_airport_hourly_patterns": mobility_views.airport_hourly(airport, cfg),
        "v_rush_hour_by_zip": mobility_views.rush_hour_base(hourly),
        "v_ccvi_map": v.ccvi_map(ccvi, spatial.centroids(areas), spatial.centroids(zips)),
        "v_ccvi_trip_activity": v.ccvi_trip_activity(trips, ccvi, areas),
        "v_ccvi_double_burden": v.ccvi_double_burden(ccvi, hotspots),
        "v_ccvi_trip_trends": v.ccvi_trip_trends(trips, ccvi),
        "v_ccvi_pooled_rides": v.ccvi_pooled_rides(trips, ccvi, areas),
        "v_ccvi_dashboard_summary": v.ccvi_summary(ccvi, trips, hotspots),
        "v_economic_dashboard": economic_views.economic_dashboard(loans),
        "v_permits_timeline": timeline,
        "v_permits_by_area": economic_views.permits_by_area(permits, loans),
        "v_monthly_permit_summary": economic_views.monthly_permit_summary(timeline),
        "v_fee_analysis": economic_views.fee_analysis(timeline),
    }


def register(views: dict[str, DataFrame]) -> list[str]:
    """Make the views available to SQL of their session."""
    for name, df in views.items():
        create_view(df, name)
    return sorted(views)
