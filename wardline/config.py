"""Every date, limit and threshold an operator needs, passed in explicitly.

No operator reads the wall clock: ``as_of`` plays the part of today, so a run
over an old snapshot gives the same rows tomorrow.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Bounds:
    """Inclusive coordinate window a record has to fall in."""

    lat_min: float = 41.6
    lat_max: float = 42.1
    lon_min: float = -87.95
    lon_max: float = -87.5


@dataclass(frozen=True)
class TripLimits:
    max_miles: float = 500.0
    max_seconds: int = 100_000
    max_fare: float = 1000.0
    clean_min_seconds: int = 60
    clean_max_seconds: int = 36_000


@dataclass(frozen=True)
class HotspotWeights:
    """Weights of the weekly mobility and epidemiological risk scores."""

    trips_from: float = 0.7
    trips_to: float = 1.0
    pooled_to: float = 1.5
    cases: float = 0.7
    tests: float = 0.3
    ccvi_min: float = 4.0
    ccvi_max: float = 63.7
    ccvi_weight: float = 0.5


@dataclass(frozen=True)
class Settings:
    as_of: date
    min_date: date = date(2020, 1, 1)
    covid_min_date: date = date(2020, 3, 1)
    permit_valid_from: date = date(2000, 1, 1)
    bounds: Bounds = field(default_factory=Bounds)
    trips: TripLimits = field(default_factory=TripLimits)
    weights: HotspotWeights = field(default_factory=HotspotWeights)
    max_fee: float = 10_000_000.0
    community_areas: int = 77
    rate_high: float = 400.0
    rate_medium: float = 200.0
    income_limit: float = 30_000.0
    increment_days: int = 30
    # Side length, in degrees, of the grid cells that points and polygons meet in.
    cell_degrees: float = 0.02
    # A spatial index above this many bytes is joined by shuffle instead.
    broadcast_bytes: int = 64 * 1024 * 1024
