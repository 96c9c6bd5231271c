"""Plain SQL for each catalog query, for an independent engine over the same files.

Polygons are rectangles in the derived data, so containment is four comparisons
here and overlap is one product, where the library joins pieces of polygons in grid cells.
Texts share named sub-queries; ``texts`` puts in front of each query the ones it uses.
"""

from __future__ import annotations

import re

from wardline.sources import derived

AS_OF, FORECAST_DAY = "DATE '2024-02-01'", "DATE '2024-01-10'"
P_MIN, P_AS_OF = "DATE '1996-01-01'", "DATE '2001-05-01'"
BOX = "{lat} BETWEEN 41.6 AND 42.1 AND {lon} BETWEEN -87.95 AND -87.5"
EARTH = 6371009.0


def rnd(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def total(x: str) -> str:
    return f"CAST(sum({cents(x)}) AS DOUBLE) / 100e0"


def mean(x: str) -> str:
    return f"CAST(sum({cents(x)}) AS DOUBLE) / count({x}) / 100e0"


def uncut(x: str) -> str:
    return f"sum(CAST({x} AS DECIMAL(38,12)))"


def uncut_mean(x: str) -> str:
    return f"CAST({uncut(x)} AS DOUBLE) / count({x})"


def mean2(x: str) -> str:
    return f"round(CAST(sum({cents(x)}) AS DOUBLE) / count({x})) / 100e0"


def pct(a: str, b: str, n: int = 2) -> str:
    return rnd(f"(CAST({a} AS DOUBLE) / {b}) * 100e0", n)


def box(lat: str, lon: str) -> str:
    return BOX.format(lat=lat, lon=lon)


def inside(alias: str, lon: str, lat: str) -> str:
    return f"{lon} >= {alias}.x0 AND {lon} < {alias}.x1 AND {lat} >= {alias}.y0 AND {lat} < {alias}.y1"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def num(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def sunday(x: str) -> str:
    return f"{x} - CAST(dayofweek({x}) AS INTEGER)"


def monday(x: str) -> str:
    return f"{x} - CAST((dayofweek({x}) + 6) % 7 AS INTEGER)"


def month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def _checks(check_date: str, rows: str) -> str:
    return f"""
SELECT {check_date} AS check_date, 'raw_building_permits' AS dataset_name, check_name, check_type, expected_value,
  {pct('good', 'nullif(seen, 0)')} AS actual_value, CAST(good AS DOUBLE) / nullif(seen, 0) >= bar AS passed, seen AS row_count,
  seen - good AS failed_row_count
FROM (SELECT 'permit_number_not_null' AS check_name, 'completeness' AS check_type, 100e0 AS expected_value,
    0.95e0 AS bar, count(permit_) AS good, count(*) AS seen FROM {rows}
  UNION ALL SELECT 'coordinates_present', 'completeness', 90e0, 0.8e0,
    count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL), count(*) FROM {rows}
  UNION ALL SELECT 'coordinates_valid_range', 'validity', 95e0, 0.95e0,
    count(*) FILTER (WHERE {box('latitude', 'longitude')}), count(latitude) FROM {rows}
  UNION ALL SELECT 'total_fee_reasonable', 'validity', 98e0, 0.95e0,
    count(*) FILTER (WHERE total_fee BETWEEN 0 AND 1e7), count(total_fee) FROM {rows}
  UNION ALL SELECT 'permit_number_unique', 'uniqueness', 100e0, 1e0, count(DISTINCT permit_), count(*) FROM {rows})"""


def _checks_before(days_ago: int) -> str:
    day = f"{P_AS_OF} - {days_ago}"
    return _checks(f"CAST({day} AS DATE)", f"(SELECT * FROM raw_permits WHERE CAST(issue_date AS DATE) = CAST({day} - 1 AS DATE)) AS d")


def _bronze_trips(kind: str) -> str:
    share = (
        "CAST(NULL AS BOOLEAN) AS shared_trip_authorized, CAST(0 AS BIGINT) AS trips_pooled"
        if kind == "taxi"
        else "shared_trip_authorized, trips_pooled"
    )
    area = lambda e: f"try_cast(nullif({e}_community_area, '') AS BIGINT) AS {e}_community_area"
    spot = lambda c: f"round({c}, 6) AS {c}"
    spots = [f"{e}_centroid_{a}" for e in ("pickup", "dropoff") for a in ("latitude", "longitude")]
    return f"""
SELECT trip_id, trip_start_timestamp, trip_end_timestamp, trip_seconds, round(trip_miles, 2) AS trip_miles,
  {area('pickup')}, {area('dropoff')}, round(fare, 2) AS fare, {share}, {', '.join(map(spot, spots))}
FROM raw_trips
WHERE source_dataset = '{kind}' AND CAST(trip_start_timestamp AS DATE) BETWEEN DATE '2020-01-01' AND {AS_OF}
  AND {box('pickup_centroid_latitude', 'pickup_centroid_longitude')}
  AND {box('dropoff_centroid_latitude', 'dropoff_centroid_longitude')}
  AND trip_miles BETWEEN 0 AND 500 AND trip_seconds BETWEEN 1 AND 100000 AND fare BETWEEN 0 AND 1000"""


def _grouped_trips(grain: str) -> str:
    keys = "pickup_zip, dropoff_zip, trip_date" + (", trip_hour" if grain == "hour" else "")
    return f"""
SELECT {keys}, count(*) AS trip_count, {mean2('trip_miles')} AS avg_miles, {mean2('fare')} AS avg_fare
FROM silver_trips WHERE pickup_zip IS NOT NULL AND dropoff_zip IS NOT NULL GROUP BY {keys}"""


def _band(rate: str) -> str:
    return f"CASE WHEN {rate} >= 400 THEN 'High' WHEN {rate} >= 200 THEN 'Medium' ELSE 'Low' END"


def _overlap(a: str, b: str) -> str:
    strip = lambda t: (
        f"{EARTH * EARTH!r} * radians({t[1]} - {t[0]}) * (sin(radians({t[3]})) - sin(radians({t[2]})))"
    )
    cut = lambda c, f: f"{f}({a}.{c}, {b}.{c})"
    return strip((cut("x0", "greatest"), cut("x1", "least"), cut("y0", "greatest"), cut("y1", "least")))


def _area(t: str) -> str:
    return (
        f"{EARTH * EARTH!r} * radians({t}.x1 - {t}.x0) * (sin(radians({t}.y1)) - sin(radians({t}.y0)))"
    )


def _meets(a: str, b: str) -> str:
    # Rectangles that only share a border, up to float noise, do not overlap.
    return (
        f"least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0) > 1e-6 "
        f"AND least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0) > 1e-6"
    )


_QUARTERS = (
    "quantile_disc(total_trips, 0.25) AS q1, quantile_disc(total_trips, 0.5) AS q2, "
    "quantile_disc(total_trips, 0.75) AS q3"
)

# Named sub-queries. A text may use any other by name.
PARTS: dict[str, str] = {
    **{n: derived.plain_sql(n) for n in derived.TEXTS},
    "bronze_taxi": _bronze_trips("taxi"),
    "bronze_tnp": _bronze_trips("tnp"),
    "both_trips": """
SELECT * REPLACE (FALSE AS shared_trip_authorized, CAST(1 AS BIGINT) AS trips_pooled), 'taxi' AS source_dataset
FROM bronze_taxi UNION ALL SELECT *, 'tnp' FROM bronze_tnp""",
    "silver_trips": f"""
SELECT t.*, CAST(trip_start_timestamp AS DATE) AS trip_date, {num('hour(trip_start_timestamp)')} AS trip_hour,
  CAST(a.zip AS VARCHAR) AS pickup_zip, CAST(b.zip AS VARCHAR) AS dropoff_zip,
  c.pri_neigh AS pickup_neighborhood, d.pri_neigh AS dropoff_neighborhood,
  coalesce(a.zip IN (60666, 60018), FALSE) OR coalesce(b.zip IN (60666, 60018), FALSE) AS is_airport_trip
FROM both_trips t
LEFT JOIN zip_boxes a ON {inside('a', 'pickup_centroid_longitude', 'pickup_centroid_latitude')}
LEFT JOIN zip_boxes b ON {inside('b', 'dropoff_centroid_longitude', 'dropoff_centroid_latitude')}
LEFT JOIN hood_boxes c ON {inside('c', 'pickup_centroid_longitude', 'pickup_centroid_latitude')}
LEFT JOIN hood_boxes d ON {inside('d', 'dropoff_centroid_longitude', 'dropoff_centroid_latitude')}""",
    "hourly": _grouped_trips("hour"),
    "daily": _grouped_trips("day"),
    "routes": f"""
SELECT * FROM (SELECT *, rank() OVER (ORDER BY trip_count DESC) AS rank FROM (
  SELECT pickup_zip, dropoff_zip, count(*) AS trip_count, {mean2('fare')} AS avg_fare,
    {mean2('trip_miles')} AS avg_miles, {total('fare')} AS total_revenue
  FROM silver_trips WHERE pickup_zip IS NOT NULL AND dropoff_zip IS NOT NULL GROUP BY ALL)) WHERE rank <= 10""",
    "bronze_permits": f"""
SELECT id, permit_, permit_status, permit_type, application_start_date, issue_date, processing_time, street_number,
  street_direction, street_name, work_type, work_description, permit_condition, round(total_fee, 2) AS total_fee,
  round(reported_cost, 2) AS reported_cost, pin_list, community_area, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude
FROM raw_permits WHERE issue_date BETWEEN {P_MIN} AND {P_AS_OF} AND {box('latitude', 'longitude')}""",
    "silver_permits": f"""
SELECT id, permit_, permit_status, permit_type, application_start_date, issue_date, processing_time, work_type,
  total_fee, reported_cost, community_area, latitude, longitude, CAST(z.zip AS VARCHAR) AS zip_code,
  h.pri_neigh AS neighborhood, {num('year(issue_date)')} AS permit_year, {num('month(issue_date)')} AS permit_month
FROM bronze_permits p
LEFT JOIN zip_boxes z ON {inside('z', 'longitude', 'latitude')}
LEFT JOIN hood_boxes h ON {inside('h', 'longitude', 'latitude')}""",
    "flagged_permits": f"""
SELECT *, CASE WHEN permit_ IS NULL THEN 'missing_permit_number' WHEN issue_date IS NULL THEN 'missing_issue_date'
  WHEN issue_date > {P_AS_OF} THEN 'future_issue_date' WHEN issue_date < DATE '1995-06-01' THEN 'invalid_issue_date'
  WHEN least(latitude, longitude) IS NULL OR latitude IS NULL OR longitude IS NULL THEN 'missing_coordinates'
  WHEN NOT (latitude BETWEEN 41.6 AND 42.1) THEN 'invalid_latitude'
  WHEN NOT (longitude BETWEEN -87.95 AND -87.5) THEN 'invalid_longitude'
  WHEN total_fee < 0 THEN 'negative_fee' WHEN total_fee > 1e7 THEN 'extreme_high_fee'
  WHEN NOT (community_area BETWEEN 1 AND 77) THEN 'invalid_community_area' ELSE 'valid' END AS data_quality_flag
FROM raw_permits""",
    "permits_clean": f"""
SELECT permit_, id, row_id, issue_date, issue_date AS issue_date_only, {num('year(issue_date)')} AS issue_year,
  {num('month(issue_date)')} AS issue_month, {num('quarter(issue_date)')} AS issue_quarter,
  {num('dayofweek(issue_date) + 1')} AS issue_day_of_week, strftime(issue_date, '%B') AS issue_month_name,
  application_start_date, {num('issue_date - application_start_date')} AS processing_days, permit_type,
  CASE WHEN permit_type ILIKE '%new construction%' THEN 'New Construction'
    WHEN regexp_matches(lower(permit_type), 'renovation|alteration') THEN 'Renovation/Alteration'
    WHEN regexp_matches(lower(permit_type), 'wrecking|demol') THEN 'Demolition'
    WHEN permit_type ILIKE '%sign%' THEN 'Sign' WHEN permit_type ILIKE '%electrical%' THEN 'Electrical'
    WHEN permit_type ILIKE '%plumb%' THEN 'Plumbing' ELSE 'Other' END AS permit_type_category,
  permit_status, work_type, work_description, permit_condition, street_number, street_direction, street_name,
  latitude, longitude, community_area, total_fee,
  CASE WHEN total_fee = 0 THEN 'No Fee' WHEN total_fee > 10000 OR total_fee IS NULL THEN '$10000+'
    WHEN total_fee > 5000 THEN '$5001-10000' WHEN total_fee > 1000 THEN '$1001-5000'
    WHEN total_fee > 500 THEN '$501-1000' WHEN total_fee > 100 THEN '$101-500' ELSE '$1-100' END AS fee_category,
  reported_cost, pin_list, data_quality_flag
FROM flagged_permits
WHERE permit_ IS NOT NULL AND issue_date BETWEEN {P_MIN} AND {P_AS_OF}
  AND (latitude IS NULL OR ({box('latitude', 'longitude')}))
  AND coalesce(total_fee, 0) BETWEEN 0 AND 1e7 AND coalesce(community_area, 1) BETWEEN 1 AND 77""",
    "bronze_covid": f"""
SELECT zip_code, week_number, week_start, week_end, cases_weekly, tests_weekly, deaths_weekly, population,
  round(case_rate_weekly, 2) AS case_rate_weekly, row_id
FROM raw_covid WHERE week_start BETWEEN DATE '2020-01-01' AND {AS_OF}""",
    "covid_clean": f"""
SELECT row_id, zip_code, week_start, week_end, week_start AS week_start_date, week_end AS week_end_date,
  {num('year(week_start)')} AS year, {num('month(week_start)')} AS month, week_number,
  {num("strftime(week_start, '%U')")} AS week_number_in_year, cases_weekly, deaths_weekly, tests_weekly,
  case_rate_weekly, {rnd('cases_weekly * 1e5 / population', 2)} AS cases_per_100k,
  {rnd('deaths_weekly * 1e5 / population', 2)} AS deaths_per_100k,
  {rnd('tests_weekly * 1e5 / population', 2)} AS tests_per_100k, percent_tested_positive_weekly,
  CASE WHEN tests_weekly > 0 AND cases_weekly IS NOT NULL THEN {pct('cases_weekly', 'tests_weekly')}
    ELSE percent_tested_positive_weekly END AS test_positivity_rate_calculated,
  CASE WHEN cases_weekly > 0 THEN {pct('deaths_weekly', 'cases_weekly')} END AS case_fatality_rate_pct,
  population, 'valid' AS data_quality_flag, 'not_suppressed' AS privacy_flag
FROM raw_covid WHERE week_start BETWEEN DATE '2020-03-01' AND {AS_OF} AND cases_weekly >= 0""",
    "history": f"""
SELECT zip_code, week_start, week_end, week_number, cases_weekly, case_rate_weekly, tests_weekly, deaths_weekly,
  population, {_band('case_rate_weekly')} AS risk_category, {num('year(week_start)')} AS year,
  {num('month(week_start)')} AS month,
  CASE WHEN tests_weekly > 0 THEN {pct('cases_weekly', 'tests_weekly')} END AS test_positivity_pct,
  CASE WHEN cases_weekly > 0 THEN {pct('deaths_weekly', 'cases_weekly')} END AS case_fatality_pct
FROM bronze_covid""",
    "latest": f"""
SELECT zip_code, week_end AS latest_week_end, cases_weekly, case_rate_weekly, tests_weekly, deaths_weekly,
  population, {_band('case_rate_weekly')} AS risk_category
FROM bronze_covid b WHERE week_end = (SELECT max(week_end) FROM bronze_covid m WHERE m.zip_code = b.zip_code)""",
    "ccvi": """
SELECT geography_type, community_area_or_zip AS geography_id, round(ccvi_score, 3) AS ccvi_score, ccvi_category
FROM raw_ccvi WHERE ccvi_category = 'HIGH'""",
    "risky_areas": "SELECT CAST(geography_id AS BIGINT) AS area, ccvi_score FROM ccvi WHERE geography_type = 'CA'",
    "health": "SELECT community_area, community_area_name, per_capita_income FROM raw_health "
    "WHERE per_capita_income IS NOT NULL AND community_area IS NOT NULL",
    "taxi_flags": f"""
SELECT *, CASE WHEN trip_id IS NULL THEN 'missing_trip_id'
  WHEN trip_end_timestamp <= trip_start_timestamp THEN 'invalid_timestamps'
  WHEN trip_seconds < 60 THEN 'too_short' WHEN trip_seconds > 36000 THEN 'too_long'
  WHEN trip_miles < 0 THEN 'negative_miles' WHEN trip_miles > 500 THEN 'extreme_miles'
  WHEN trip_total < 0 THEN 'negative_fare' WHEN trip_total > 1000 THEN 'extreme_fare'
  WHEN fare < 0 THEN 'negative_base_fare'
  WHEN pickup_centroid_latitude IS NULL OR pickup_centroid_longitude IS NULL THEN 'missing_pickup_coords'
  WHEN pickup_centroid_latitude NOT BETWEEN 41.6 AND 42.1 THEN 'invalid_pickup_lat'
  WHEN pickup_centroid_longitude NOT BETWEEN -87.95 AND -87.5 THEN 'invalid_pickup_lon'
  WHEN dropoff_centroid_latitude NOT BETWEEN 41.6 AND 42.1 THEN 'invalid_dropoff_lat'
  WHEN dropoff_centroid_longitude NOT BETWEEN -87.95 AND -87.5 THEN 'invalid_dropoff_lon'
  ELSE 'valid' END AS data_quality_flag
FROM raw_trips WHERE source_dataset = 'taxi'""",
    "taxi_clean": f"""
SELECT trip_id, taxi_id, trip_start_timestamp, trip_end_timestamp, d AS trip_date, {num('year(d)')} AS trip_year,
  {num('month(d)')} AS trip_month, {num('day(d)')} AS trip_day, {num('h')} AS trip_hour,
  {num('dayofweek(d) + 1')} AS trip_day_of_week, dayname(d) AS trip_day_name,
  CASE WHEN h < 6 THEN 'Late Night (12-5am)' WHEN h < 10 THEN 'Morning Rush (6-9am)'
    WHEN h < 16 THEN 'Midday (10am-3pm)' WHEN h < 20 THEN 'Evening Rush (4-7pm)'
    ELSE 'Evening (8-11pm)' END AS time_category,
  dayofweek(d) IN (0, 6) AS is_weekend, trip_seconds, trip_miles,
  CASE WHEN trip_miles > 0 THEN {rnd('trip_miles * 3600e0 / trip_seconds', 2)} END AS avg_speed_mph,
  CASE WHEN trip_miles > 20 THEN '20+ miles' WHEN trip_miles > 10 THEN '10-20 miles'
    WHEN trip_miles > 5 THEN '5-10 miles' WHEN trip_miles > 3 THEN '3-5 miles' WHEN trip_miles > 1 THEN '1-3 miles'
    ELSE '0-1 miles' END AS distance_category,
  pickup_community_area, dropoff_community_area, pickup_centroid_latitude, pickup_centroid_longitude,
  dropoff_centroid_latitude, dropoff_centroid_longitude, fare, tips, trip_total,
  CASE WHEN trip_miles > 0 THEN {rnd('trip_total / trip_miles', 2)} END AS fare_per_mile,
  CASE WHEN trip_total > 50 THEN '$50+' WHEN trip_total > 30 THEN '$30-50' WHEN trip_total > 20 THEN '$20-30'
    WHEN trip_total > 10 THEN '$10-20' ELSE '$0-10' END AS fare_category,
  payment_type, company, data_quality_flag
FROM (SELECT *, CAST(trip_start_timestamp AS DATE) AS d, hour(trip_start_timestamp) AS h FROM taxi_flags)
WHERE trip_end_timestamp > trip_start_timestamp AND d BETWEEN DATE '2020-01-01' AND {AS_OF}
  AND trip_seconds BETWEEN 60 AND 36000 AND trip_miles BETWEEN 0 AND 500 AND trip_total BETWEEN 0 AND 1000
  AND fare >= 0 AND (pickup_centroid_latitude IS NULL
    OR ({box('pickup_centroid_latitude', 'pickup_centroid_longitude')}))""",
    "community_zip": f"""
SELECT CAST(a.area_numbe AS BIGINT) AS community_area_number, a.community AS community_area_name,
  CAST(z.zip AS VARCHAR) AS zip_code, {rnd(_overlap('a', 'z'), 0)} AS intersection_area,
  {rnd(f"({_overlap('a', 'z')}) / ({_area('a')}) * 100", 2)} AS pct_of_community_area,
  {rnd(f"({_overlap('a', 'z')}) / ({_area('z')}) * 100", 2)} AS pct_of_zip,
  ({_overlap('a', 'z')}) / ({_area('a')}) > 0.5 AS is_primary_zip
FROM area_boxes a JOIN zip_boxes z ON {_meets('a', 'z')}""",
    "zip_hood": f"""
SELECT CAST(z.zip AS VARCHAR) AS zip_code, h.pri_neigh AS neighborhood_name,
  {rnd(_overlap('z', 'h'), 0)} AS intersection_area,
  {rnd(f"({_overlap('z', 'h')}) / ({_area('z')}) * 100", 2)} AS pct_of_zip,
  {rnd(f"({_overlap('z', 'h')}) / ({_area('h')}) * 100", 2)} AS pct_of_neighborhood,
  ({_overlap('z', 'h')}) / ({_area('z')}) > 0.5 AS is_primary_neighborhood
FROM zip_boxes z JOIN hood_boxes h ON {_meets('z', 'h')}""",
    "covid_enriched": f"""
SELECT c.*, a.community_area_number, a.community_area_name, a.pct_of_zip, a.is_primary_zip, h.neighborhood_name,
  h.pct_of_neighborhood,
  CASE WHEN a.pct_of_zip > 0 THEN {rnd('c.cases_weekly * a.pct_of_zip / 100', 0)} END AS estimated_cases_in_community_area,
  CASE WHEN a.pct_of_zip > 0 THEN {rnd('c.deaths_weekly * a.pct_of_zip / 100', 0)} END AS estimated_deaths_in_community_area
FROM raw_covid c LEFT JOIN community_zip a USING (zip_code)
LEFT JOIN (SELECT * FROM zip_hood WHERE is_primary_neighborhood) h USING (zip_code)""",
    "verified": f"""
SELECT p.*, a.area_numbe AS verified_community_area, a.community AS community_area_name_verified,
  coalesce(p.community_area = a.area_numbe, FALSE) AS community_area_matches, CAST(z.zip AS VARCHAR) AS zip_code_verified,
  h.pri_neigh AS neighborhood_name, h.sec_neigh AS secondary_neighborhood, w.ward AS ward_number,
  w.alderman AS alderman_name, t.tractce10 AS census_tract
FROM raw_permits p LEFT JOIN area_boxes a ON {inside('a', 'longitude', 'latitude')}
LEFT JOIN ward_boxes w ON {inside('w', 'longitude', 'latitude')} LEFT JOIN tract_boxes t ON {inside('t', 'longitude', 'latitude')}
LEFT JOIN zip_boxes z ON {inside('z', 'longitude', 'latitude')}
LEFT JOIN hood_boxes h ON {inside('h', 'longitude', 'latitude')} WHERE {box('latitude', 'longitude')}""",
    "mobility": f"""
SELECT week_start, zip_code, CAST(sum(f) AS BIGINT) AS total_trips_from_zip, CAST(sum(t) AS BIGINT) AS total_trips_to_zip,
  CAST(sum(p) AS BIGINT) AS total_pooled_trips_to_zip
FROM (SELECT {sunday('trip_date')} AS week_start, pickup_zip AS zip_code, 1 AS f, 0 AS t, 0 AS p FROM silver_trips
      WHERE pickup_zip IS NOT NULL AND dropoff_zip IS NOT NULL
      UNION ALL SELECT {sunday('trip_date')}, dropoff_zip, 0, 1, CASE WHEN trips_pooled > 0 THEN 1 ELSE 0 END
      FROM silver_trips WHERE pickup_zip IS NOT NULL AND dropoff_zip IS NOT NULL)
GROUP BY week_start, zip_code""",
    "scored": """
SELECT h.*, coalesce(total_trips_from_zip, 0) AS a, coalesce(total_trips_to_zip, 0) AS b,
  coalesce(total_pooled_trips_to_zip, 0) AS c,
  1 + 0.5e0 * coalesce((v.ccvi_score - 4.0e0) / (63.7e0 - 4.0e0), 0) AS factor
FROM history h LEFT JOIN mobility m USING (zip_code, week_start)
LEFT JOIN (SELECT * FROM ccvi WHERE geography_type = 'ZIP') v ON v.geography_id = h.zip_code""",
    "hotspots": f"""
SELECT zip_code, week_start, case_rate_weekly, cases_weekly, deaths_weekly, tests_weekly, risk_category,
  a AS total_trips_from_zip, b AS total_trips_to_zip, c AS total_pooled_trips_to_zip, population,
  {rnd('mob', 2)} AS mobility_risk_rate, {rnd('epi', 2)} AS epi_risk, {rnd('factor', 3)} AS ccvi_adjustment,
  {rnd('(mob + epi) * factor', 2)} AS adjusted_risk_score
FROM (SELECT *, 0.7e0 * na + 1.0e0 * nb + 1.5e0 * nc AS mob, 0.7e0 * nr + 0.3e0 * nt AS epi FROM (SELECT *,
  {', '.join(f"CASE WHEN max({x}) OVER () = min({x}) OVER () THEN 0e0 ELSE CAST({x} - min({x}) OVER () AS DOUBLE) / (max({x}) OVER () - min({x}) OVER ()) END AS {n}" for x, n in [('a', 'na'), ('b', 'nb'), ('c', 'nc'), ('case_rate_weekly', 'nr'), ('tests_weekly', 'nt')])}
  FROM scored))""",
    "incomes": f"""
SELECT zip_code, {rnd(f"CAST(sum({cents('per_capita_income')} * {cents('pct_of_zip')}) AS DOUBLE) / 100e0 / sum({cents('pct_of_zip')})", 0)} AS per_capita_income
FROM community_zip JOIN health ON community_area_number = community_area GROUP BY zip_code""",
    "costs": """
SELECT zip_code, max(n) AS total_permits_construction, max(k) AS total_permits_new_construction,
  quantile_cont(reported_cost, 0.5) AS median_permit_value
FROM (SELECT zip_code, reported_cost, count(*) AS n,
        count(*) FILTER (WHERE permit_type ILIKE '%new construction%' OR work_type ILIKE '%new construction%') AS k
      FROM silver_permits WHERE zip_code IS NOT NULL AND reported_cost > 0 GROUP BY zip_code, reported_cost)
GROUP BY zip_code""",
    "loan_frame": """
SELECT zip_code, arg_max(population, week_start) AS population, any_value(per_capita_income) AS inc,
  any_value(total_permits_new_construction) AS neu, any_value(total_permits_construction) AS tot,
  any_value(median_permit_value) AS med
FROM (SELECT zip_code FROM history UNION SELECT zip_code FROM incomes UNION SELECT zip_code FROM costs)
LEFT JOIN history USING (zip_code) LEFT JOIN incomes USING (zip_code) LEFT JOIN costs USING (zip_code)
GROUP BY zip_code""",
    "loan_bounds": """
SELECT (SELECT min(per_capita_income) FROM incomes) AS i0, (SELECT max(per_capita_income) FROM incomes) AS i1,
  min(total_permits_new_construction) AS n0, max(total_permits_new_construction) AS n1,
  min(total_permits_construction) AS t0, max(total_permits_construction) AS t1,
  min(median_permit_value) AS m0, max(median_permit_value) AS m1 FROM costs""",
    "loans1": f"""
SELECT zip_code, coalesce(population, 0) AS population, coalesce(inc, 0) AS per_capita_income,
  coalesce(neu, 0) AS total_permits_new_construction, coalesce(tot, 0) AS total_permits_construction,
  {rnd('coalesce(med, 0)', 2)} AS median_permit_value, {rnd('wi', 2)} AS inverted_income_index,
  {rnd('wn', 2)} AS inverted_new_construction_index, {rnd('wt', 2)} AS inverted_permits_index,
  {rnd('wm', 2)} AS permit_value_index, {rnd('wi + wn + wt - wm', 2)} AS eligibility_index,
  coalesce(inc, 0) < 30000 AS is_loan_eligible
FROM (SELECT f.*, CASE WHEN i1 = i0 THEN 0e0 ELSE 0.5e0 * ((i1 - coalesce(inc, i1)) / (i1 - i0)) END AS wi,
  CASE WHEN n1 = n0 THEN 0e0 ELSE 0.4e0 * (CAST(n1 - coalesce(neu, n1) AS DOUBLE) / (n1 - n0)) END AS wn,
  CASE WHEN t1 = t0 THEN 0e0 ELSE 0.1e0 * (CAST(t1 - coalesce(tot, t1) AS DOUBLE) / (t1 - t0)) END AS wt,
  CASE WHEN m1 = m0 THEN 0e0 ELSE 0.03e0 * ((coalesce(med, m0) - m0) / (m1 - m0)) END AS wm
  FROM loan_frame f CROSS JOIN loan_bounds)""",
    "loans2": f"""
SELECT *, {rnd('inverted_income_index * 0.4e0 + inverted_new_construction_index * 0.4e0 + inverted_permits_index * 0.2e0', 2)} AS eligibility_index,
  inverted_income_index >= 0.3e0 AND inverted_new_construction_index >= 0.3e0 AS is_loan_eligible
FROM (SELECT zip_code, coalesce(population, 0) AS population, coalesce(inc, 0) AS per_capita_income,
  coalesce(neu, 0) AS total_permits_new_construction, coalesce(tot, 0) AS total_permits_construction,
  coalesce(med, 0) AS median_permit_value,
  {rnd('1 - (coalesce(inc, 0) - i0) / nullif(i1 - i0, 0)', 2)} AS inverted_income_index,
  {rnd('1 - CAST(coalesce(neu, 0) - n0 AS DOUBLE) / nullif(n1 - n0, 0)', 2)} AS inverted_new_construction_index,
  {rnd('1 - CAST(coalesce(tot, 0) - t0 AS DOUBLE) / nullif(t1 - t0, 0)', 2)} AS inverted_permits_index,
  {rnd('(coalesce(med, 0) - m0) / nullif(m1 - m0, 0)', 2)} AS permit_value_index
  FROM loan_frame CROSS JOIN loan_bounds WHERE zip_code <> 'Unknown')""",
    "roi": f"""
SELECT zip_code, count(*) AS total_permits, {total('reported_cost')} AS total_permit_value,
  {mean2('reported_cost')} AS avg_permit_value
FROM silver_permits WHERE zip_code IS NOT NULL AND reported_cost > 0 GROUP BY zip_code""",
    "baseline": f"""
SELECT zip_code, forecast_date, {rnd('avg_n * 1e0 * swing', 2)} AS predicted_trip_count,
  {rnd('avg_n * 0.8e0 * swing', 2)} AS lower_bound, {rnd('avg_n * 1.2e0 * swing', 2)} AS upper_bound,
  'prophet_sample' AS model_name
FROM (SELECT zip_code, avg_n, forecast_date,
    1 + ((CAST(zip_code AS BIGINT) * 31 + (forecast_date - DATE '2000-01-01') * 17) % 41 - 20 - 10) / 100e0 AS swing
  FROM (SELECT pickup_zip AS zip_code, CAST(sum(n) AS DOUBLE) / count(*) AS avg_n, any_value(last_day) AS last_day
        FROM (SELECT pickup_zip, trip_date, count(*) AS n, (SELECT max(trip_date) FROM silver_trips) AS last_day
              FROM silver_trips GROUP BY pickup_zip, trip_date)
        WHERE pickup_zip IS NOT NULL AND trip_date >= last_day - 30 GROUP BY pickup_zip HAVING count(*) >= 7) r
  CROSS JOIN LATERAL (SELECT r.last_day + CAST(k AS INTEGER) AS forecast_date FROM range(1, 31) s(k)))""",
    "airport": f"""
SELECT trip_id, trip_date, trip_hour, trip_start_timestamp, trip_end_timestamp, trip_miles, fare,
  pickup_community_area, pickup_zip, pickup_neighborhood, dropoff_community_area, dropoff_zip, dropoff_neighborhood,
  shared_trip_authorized, trips_pooled,
  CASE WHEN dropoff_community_area = 76 OR dropoff_zip = '60666' THEN 'O''Hare'
    WHEN dropoff_community_area = 56 AND dropoff_zip = '60638' THEN 'Midway' ELSE 'Other' END AS airport_destination,
  TRUE AS is_airport_trip, {monday('trip_date')} AS week_start, {month('trip_date')} AS month_start
FROM silver_trips WHERE coalesce(dropoff_community_area IN (56, 76), FALSE) OR coalesce(dropoff_zip IN ('60638', '60666'), FALSE)""",
    "rush": """
SELECT pickup_zip AS zip_code, trip_date, trip_hour,
  CASE WHEN dayofweek(trip_date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  CAST(sum(trip_count) AS BIGINT) AS trip_count FROM hourly GROUP BY ALL""",
    "windows": """
SELECT * FROM (VALUES (5, '1. 5 AM - 7 AM', 'Early Morning'), (6, '1. 5 AM - 7 AM', 'Early Morning'),
  (7, '2. 7 AM - 9 AM', 'Morning Rush'), (8, '2. 7 AM - 9 AM', 'Morning Rush'),
  (11, '3. 11 AM - 1 PM', 'Midday'), (12, '3. 11 AM - 1 PM', 'Midday'),
  (14, '4. 2 PM - 4 PM', 'Afternoon'), (15, '4. 2 PM - 4 PM', 'Afternoon'),
  (16, '5. 4 PM - 6 PM', 'Evening Rush'), (17, '5. 4 PM - 6 PM', 'Evening Rush'),
  (19, '6. 7 PM - 9 PM', 'Evening'), (20, '6. 7 PM - 9 PM', 'Evening'),
  (22, '7. 10 PM - 12 AM', 'Late Night'), (23, '7. 10 PM - 12 AM', 'Late Night'), (0, '7. 10 PM - 12 AM', 'Late Night'),
  (2, '8. 2 AM - 4 AM', 'Overnight'), (3, '8. 2 AM - 4 AM', 'Overnight')) w(trip_hour, time_window, window_name)""",
    "window_trips": f"""
SELECT zip_code, trip_hour, day_type, time_window, window_name, CAST(sum(trip_count) AS BIGINT) AS total_trips
FROM rush JOIN windows USING (trip_hour) WHERE trip_date >= {FORECAST_DAY} - 30 GROUP BY ALL""",
    "window_stats": f"""
SELECT time_window, window_name, count(*) AS n, min(total_trips) AS lo, max(total_trips) AS hi, {_QUARTERS}
FROM window_trips GROUP BY ALL""",
    "economic": f"""
SELECT *, CASE WHEN eligibility_index >= 0.8 THEN 'High Priority' WHEN eligibility_index >= 0.5 THEN 'Medium Priority'
  WHEN eligibility_index >= 0.3 THEN 'Low Priority' ELSE 'Not Eligible' END AS priority_category,
  {rnd('(inverted_income_index + inverted_new_construction_index) / 2', 3)} AS investment_need_score
FROM loans1 WHERE zip_code <> 'Unknown' AND population > 0""",
    "timeline": f"""
SELECT id AS permit_id, issue_date, permit_year, permit_month, {month('issue_date')} AS month_start,
  CAST(date_trunc('quarter', issue_date) AS DATE) AS quarter_start,
  CAST(permit_year AS VARCHAR) || '-Q' || CAST(quarter(issue_date) AS VARCHAR) AS year_quarter, zip_code,
  community_area, neighborhood, permit_type, permit_status, work_type, total_fee, reported_cost, processing_time,
  CASE WHEN reported_cost > 0 THEN {rnd('total_fee / reported_cost * 100', 2)} END AS fee_pct_of_cost,
  CASE WHEN reported_cost >= 1e6 THEN 'Large ($1M+)' WHEN reported_cost >= 5e5 THEN 'Medium ($500K-$1M)'
    WHEN reported_cost >= 1e5 THEN 'Small ($100K-$500K)' WHEN reported_cost > 0 THEN 'Minimal (<$100K)'
    ELSE 'Unknown' END AS project_size
FROM silver_permits WHERE permit_type = 'PERMIT - NEW CONSTRUCTION' AND issue_date >= {P_MIN}""",
    "monthly": f"""
SELECT month_start, permit_year, permit_month, year_quarter, count(*) AS permit_count,
  count(DISTINCT zip_code) AS active_zips, {total('reported_cost')} AS total_reported_cost,
  {mean('reported_cost')} AS avg_reported_cost, {total('total_fee')} AS total_fees, {mean('total_fee')} AS avg_fee,
  avg(processing_time) AS avg_processing_days, count(*) FILTER (WHERE project_size LIKE 'Large%') AS large_projects,
  count(*) FILTER (WHERE project_size LIKE 'Medium%') AS medium_projects,
  count(*) FILTER (WHERE project_size LIKE 'Small%') AS small_projects,
  count(*) FILTER (WHERE project_size LIKE 'Minimal%') AS minimal_projects
FROM timeline GROUP BY month_start, permit_year, permit_month, year_quarter""",
    "by_area": f"""
SELECT zip_code, coalesce(permit_count, 0) AS permit_count, coalesce(total_cost, 0) AS total_cost,
  coalesce(avg_cost, 0) AS avg_cost, coalesce(total_fees, 0) AS total_fees, coalesce(avg_fee, 0) AS avg_fee,
  coalesce(avg_processing_days, 0) AS avg_processing_days, first_permit_date, last_permit_date,
  coalesce(population, 0) AS population, coalesce(per_capita_income, 0) AS per_capita_income,
  coalesce(eligibility_index, 0) AS eligibility_index, coalesce(is_loan_eligible, FALSE) AS is_loan_eligible,
  coalesce(inverted_income_index, 0) AS inverted_income_index,
  CASE WHEN population > 0 THEN {rnd('CAST(permit_count AS DOUBLE) / population * 1000', 2)} ELSE 0 END AS permits_per_1000_residents,
  CASE WHEN per_capita_income > 0 THEN {rnd('avg_cost / per_capita_income', 2)} ELSE 0 END AS cost_to_income_ratio
FROM (SELECT zip_code, count(*) AS permit_count, {total('reported_cost')} AS total_cost,
    {mean('reported_cost')} AS avg_cost, {total('total_fee')} AS total_fees, {mean('total_fee')} AS avg_fee,
    min(issue_date) AS first_permit_date, max(issue_date) AS last_permit_date, avg(processing_time) AS avg_processing_days
  FROM silver_permits WHERE permit_type = 'PERMIT - NEW CONSTRUCTION' AND zip_code IS NOT NULL GROUP BY zip_code)
FULL JOIN loans1 USING (zip_code)""",
    "fees": f"""
SELECT zip_code, count(*) AS permit_count, {total('total_fee')} AS total_fees_collected, {mean('total_fee')} AS avg_fee,
  min(total_fee) AS min_fee, max(total_fee) AS max_fee, {total('reported_cost')} AS total_project_value,
  {mean('reported_cost')} AS avg_project_value,
  CASE WHEN sum(reported_cost) > 0 THEN {rnd(f"CAST(sum({cents('total_fee')}) AS DOUBLE) / sum({cents('reported_cost')}) * 100", 2)} ELSE 0 END AS effective_fee_rate_pct,
  avg(processing_time) AS avg_processing_days,
  {', '.join(f"count(*) FILTER (WHERE permit_year = {y}) AS permits_{y}" for y in (2001, 2000, 1999, 1998, 1997, 1996))}
FROM timeline WHERE zip_code IS NOT NULL GROUP BY zip_code""",
    "checks": _checks(P_AS_OF, "raw_permits"),
}

_AHEAD = f"forecast_date BETWEEN {FORECAST_DAY} AND {FORECAST_DAY}"
_PLACES = "zip_code, forecast_date"
_NEXT = f"forecast_date = (SELECT min(forecast_date) FROM covid_forecasts WHERE forecast_date >= {FORECAST_DAY})"
_SHAPE = "CASE WHEN z.x0 IS NOT NULL THEN {} END"
_LIMITS = ", ".join(f"{rnd(f'z.{c}', 6)} AS {n}" for c, n in (("x0", "west"), ("y0", "south"), ("x1", "east"), ("y1", "north")))


def _avg0(x: str) -> str:
    return rnd(uncut_mean(x), 0)


def _sum0(x: str) -> str:
    return rnd(uncut(x), 0)


def _w0(x: str) -> str:
    return rnd(x, 0)


def _errors(mape: str) -> str:
    return f"""
SELECT zip_code, {rnd('avg(abs(actual - predicted))', 6)} AS mae,
  {rnd('sqrt(avg((actual - predicted) * (actual - predicted)))', 6)} AS rmse, {rnd(mape, 6)} AS mape,
  {rnd('1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual))', 6)} AS r_squared
FROM predictions GROUP BY zip_code"""


def _profile_trips(source: str) -> str:
    return f"""
SELECT count(*) AS total_records, count(DISTINCT pickup_zip) AS unique_pickup_zips,
  count(DISTINCT dropoff_zip) AS unique_dropoff_zips, count(DISTINCT trip_date) AS unique_dates,
  min(trip_date) AS earliest_date, max(trip_date) AS latest_date, {big('sum(trip_count)')} AS total_trips,
  {rnd(mean('avg_miles'), 2)} AS overall_avg_miles, {rnd(mean('avg_fare'), 2)} AS overall_avg_fare FROM {source}"""


_SILVER_COLUMNS = (
    "trip_id, trip_date, trip_hour, trip_start_timestamp, trip_end_timestamp, trip_seconds, trip_miles, "
    "pickup_community_area, dropoff_community_area, pickup_centroid_latitude, pickup_centroid_longitude, "
    "dropoff_centroid_latitude, dropoff_centroid_longitude, pickup_zip, dropoff_zip, pickup_neighborhood, "
    "dropoff_neighborhood, fare, shared_trip_authorized, trips_pooled, is_airport_trip, source_dataset"
)


def _overlay(shift: int) -> str:
    return f"""
SELECT week_start, airport_destination, airport_trips, avg_fare, avg_miles,
  coalesce(cases, 0) AS total_covid_cases, coalesce(risk, 0) AS avg_risk_score
FROM (SELECT week_start, airport_destination, count(*) AS airport_trips, {mean('fare')} AS avg_fare,
        {mean('trip_miles')} AS avg_miles FROM airport GROUP BY ALL)
LEFT JOIN (SELECT week_start + {shift} AS week_start, {big('sum(cases_weekly)')} AS cases,
        {mean('adjusted_risk_score')} AS risk FROM hotspots GROUP BY ALL) USING (week_start)"""


_EITHER = "(p.area IS NOT NULL OR d.area IS NOT NULL)"
_TOUCH = """silver_trips t LEFT JOIN risky_areas p ON p.area = t.pickup_community_area
LEFT JOIN risky_areas d ON d.area = t.dropoff_community_area"""


def _half(side: str, short: str) -> str:
    return f"""
SELECT area, ccvi_score, count(*) AS trips, count(*) FILTER (WHERE trips_pooled > 1) AS pooled,
  {mean2('fare')} AS fare, {mean2('trip_miles')} AS miles
FROM silver_trips JOIN risky_areas ON area = {side}_community_area GROUP BY area, ccvi_score"""


def _risk_facts(version: str, least: int, dates: str, recent: bool) -> str:
    """Facts of a weekly model: its dates by ZIP (Mondays; the weeks begin on Sundays), training weeks and, where they are plain means, what it carries along."""
    means = f", {rnd('r.rate', 6)} AS predicted_case_rate, {rnd('r.mobility', 6)} AS predicted_mobility_index" if recent else ""
    return f"""
WITH h AS (SELECT * FROM weekly_history WHERE week_start BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'),
s AS (SELECT zip_code, count(DISTINCT week_start) AS n, max(week_start) AS b FROM h GROUP BY 1),
r AS (SELECT zip_code, avg(case_rate_weekly) AS rate, avg(total_trips_from_zip + total_trips_to_zip) AS mobility
  FROM (SELECT *, row_number() OVER (PARTITION BY zip_code ORDER BY week_start DESC) AS k FROM h) WHERE k <= 4 GROUP BY 1)
SELECT zip_code, CAST({dates} AS DATE) AS forecast_date, DATE '2001-12-31' AS model_trained_date,
  CAST(floor(n * 0.8e0) AS BIGINT) AS training_weeks, '{version}' AS model_version{means}, TRUE AS in_order, TRUE AS in_bounds
FROM s JOIN r USING (zip_code) WHERE n >= {least}"""


QUERIES: dict[str, str] = {
    "landing_rows_on_date": "SELECT count(*) AS rows FROM raw_trips WHERE CAST(trip_start_timestamp AS DATE) = DATE '2024-01-07'",
    "landing_insert_ignore": """
SELECT trip_id, trip_start_timestamp, trip_seconds FROM raw_trips
WHERE source_dataset = 'tnp' AND trip_start_timestamp >= DATE '2024-01-15'""",
    "landing_load_profile": """
SELECT CAST(trip_start_timestamp AS DATE) AS day, count(*) AS rows, (SELECT count(*) FROM raw_trips) AS total_rows,
  (SELECT CAST(min(trip_start_timestamp) AS DATE) FROM raw_trips) AS first_day,
  (SELECT CAST(max(trip_start_timestamp) AS DATE) FROM raw_trips) AS last_day FROM raw_trips GROUP BY 1""",
    "boundary_attributes": f"""
SELECT CAST(zip AS VARCHAR) AS zip_code, {rnd('(x1 - x0) * (y1 - y0) * 111 * 111', 6)} AS area_sq_km,
  {rnd('(y0 + y1) / 2', 6)} AS centroid_lat, {rnd('(x0 + x1) / 2', 6)} AS centroid_lon FROM zip_boxes""",
    "boundary_validation": "SELECT community AS name, 'Valid' AS reason, TRUE AS is_valid, 1 AS polygons, 4 AS points FROM area_boxes",
    "boundary_name_comparison": """
SELECT name, CASE WHEN max(l) + max(r) = 2 THEN 'both' WHEN max(l) = 1 THEN 'left only' ELSE 'right only' END AS found_in
FROM (SELECT upper(community) AS name, 1 AS l, 0 AS r FROM area_boxes
  UNION ALL SELECT upper(community_area_name), 0, 1 FROM raw_health
  UNION ALL SELECT upper(pri_neigh), 0, 1 FROM hood_boxes) GROUP BY name""",
    "bronze_taxi_trips": "SELECT * FROM bronze_taxi",
    "bronze_tnp_trips": "SELECT * FROM bronze_tnp",
    "bronze_trips_refiltered": """
SELECT * FROM bronze_tnp WHERE pickup_centroid_latitude BETWEEN 41.6 AND 41.9
  AND dropoff_centroid_latitude BETWEEN 41.6 AND 41.9 AND pickup_centroid_longitude BETWEEN -87.8 AND -87.5
  AND dropoff_centroid_longitude BETWEEN -87.8 AND -87.5""",
    "bronze_covid_cases": "SELECT * FROM bronze_covid",
    "bronze_building_permits": "SELECT * FROM bronze_permits",
    "bronze_ccvi": """
SELECT geography_type, community_area_or_zip, round(ccvi_score, 3) AS ccvi_score, ccvi_category, location FROM raw_ccvi""",
    "bronze_public_health": "SELECT * FROM health",
    "permits_quality_flags": "SELECT data_quality_flag, count(*) AS permits FROM flagged_permits GROUP BY 1",
    "permits_clean": "SELECT * FROM permits_clean",
    "covid_clean": "SELECT * FROM covid_clean",
    "taxi_quality_flags": "SELECT data_quality_flag, count(*) AS trips FROM taxi_flags GROUP BY 1",
    "taxi_clean": "SELECT * FROM taxi_clean",
    "taxi_clean_recent_month": f"""
SELECT * FROM taxi_clean WHERE trip_date >= {AS_OF} - 30""",
    "permits_quality_report": f"""
SELECT 'Total Records' AS metric, CAST(count(*) AS VARCHAR) AS value, CAST(NULL AS DOUBLE) AS percentage FROM permits_clean
UNION ALL SELECT 'Records by Quality Flag', data_quality_flag, {pct('count(*)', '(SELECT count(*) FROM permits_clean)')}
FROM permits_clean GROUP BY data_quality_flag""",
    "covid_quality_report": """
UNPIVOT (SELECT CAST(count(*) AS VARCHAR) AS "Total Records", CAST(count(DISTINCT zip_code) AS VARCHAR) AS "Unique ZIP Codes",
  CAST(count(DISTINCT week_start_date) AS VARCHAR) AS "Unique Weeks",
  CAST(count(*) FILTER (WHERE privacy_flag = 'suppressed_low_count') AS VARCHAR) AS "Records with Privacy Suppression",
  format('{:,}', CAST(sum(cases_weekly) AS BIGINT)) AS "Total Cases (non-suppressed)" FROM covid_clean)
ON COLUMNS(*) INTO NAME metric VALUE value""",
    "taxi_quality_report": f"""
UNPIVOT (SELECT format('{{:,}}', count(*)) AS "Total Records (Last 30 Days)",
  CAST(CAST({uncut_mean('trip_miles')} AS DECIMAL(38,2)) AS VARCHAR) AS "Average Trip Miles",
  '$' || CAST(CAST({mean('trip_total')} AS DECIMAL(38,2)) AS VARCHAR) AS "Average Fare",
  CAST(CAST(100e0 * count(*) FILTER (WHERE data_quality_flag = 'valid') / count(*) AS DECIMAL(38,1)) AS VARCHAR) || '%' AS "Valid Data %"
  FROM taxi_clean WHERE trip_date >= {AS_OF} - 30) ON COLUMNS(*) INTO NAME metric VALUE value""",
    "silver_trips_enriched": f"SELECT {_SILVER_COLUMNS} FROM silver_trips",
    "silver_permits_enriched": "SELECT * FROM silver_permits",
    "silver_covid_latest": "SELECT * FROM latest",
    "silver_covid_weekly_historical": "SELECT * FROM history",
    "silver_ccvi_high_risk": "SELECT * FROM ccvi",
    "permits_enriched": """
SELECT id, community_area, verified_community_area, community_area_name_verified, community_area_matches,
  zip_code_verified, neighborhood_name, secondary_neighborhood, ward_number, alderman_name, census_tract FROM verified""",
    "covid_enriched": "SELECT * FROM covid_enriched",
    "taxi_trips_with_geography": f"""
SELECT trip_id, trip_start_timestamp, trip_end_timestamp, trip_miles, trip_total, a.community AS pickup_community_area,
  b.pri_neigh AS pickup_neighborhood, CAST(c.zip AS VARCHAR) AS pickup_zip_code, d.community AS dropoff_community_area,
  e.pri_neigh AS dropoff_neighborhood, CAST(f.zip AS VARCHAR) AS dropoff_zip_code,
  {rnd(f"2 * {EARTH} * asin(sqrt(pow(sin(radians(dropoff_centroid_latitude - pickup_centroid_latitude) / 2), 2) + cos(radians(pickup_centroid_latitude)) * cos(radians(dropoff_centroid_latitude)) * pow(sin(radians(dropoff_centroid_longitude - pickup_centroid_longitude) / 2), 2)))", 3)} AS straight_line_distance_meters
FROM raw_trips
LEFT JOIN area_boxes a ON {inside('a', 'pickup_centroid_longitude', 'pickup_centroid_latitude')}
LEFT JOIN hood_boxes b ON {inside('b', 'pickup_centroid_longitude', 'pickup_centroid_latitude')}
LEFT JOIN zip_boxes c ON {inside('c', 'pickup_centroid_longitude', 'pickup_centroid_latitude')}
LEFT JOIN area_boxes d ON {inside('d', 'dropoff_centroid_longitude', 'dropoff_centroid_latitude')}
LEFT JOIN hood_boxes e ON {inside('e', 'dropoff_centroid_longitude', 'dropoff_centroid_latitude')}
LEFT JOIN zip_boxes f ON {inside('f', 'dropoff_centroid_longitude', 'dropoff_centroid_latitude')}
WHERE source_dataset = 'taxi' AND {box('pickup_centroid_latitude', 'pickup_centroid_longitude')}""",
    "permits_by_community_and_zip": f"""
SELECT {num('year(p.issue_date)')} AS year, {num('month(p.issue_date)')} AS month, p.community_area, v.zip_code_verified,
  v.neighborhood_name, count(*) AS permit_count, {total('p.total_fee')} AS total_fees, {mean('p.total_fee')} AS avg_fee,
  count(*) FILTER (WHERE p.permit_type = 'PERMIT - NEW CONSTRUCTION') AS new_construction_count,
  count(*) FILTER (WHERE p.permit_type = 'PERMIT - RENOVATION/ALTERATION') AS renovation_count
FROM raw_permits p LEFT JOIN verified v ON p.permit_ = v.permit_ WHERE p.issue_date >= {P_MIN}
GROUP BY 1, 2, 3, 4, 5""",
    "permits_match_rate": f"""
SELECT count(*) AS record_count, {pct('count(*) FILTER (WHERE community_area_matches)', 'count(*)')} AS match_percentage
FROM verified WHERE issue_date >= {P_MIN}""",
    "top_estimated_cases": """
SELECT zip_code, community_area_name, neighborhood_name, sum(estimated_cases_in_community_area) AS total_estimated_cases
FROM covid_enriched WHERE week_start >= DATE '2020-03-01' GROUP BY 1, 2, 3
ORDER BY 4 DESC NULLS LAST, 1, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 10""",
    "crosswalk_community_zip": "SELECT * FROM community_zip",
    "crosswalk_community_neighborhood": f"""
SELECT CAST(a.area_numbe AS BIGINT) AS community_area_number, a.community AS community_area_name,
  h.pri_neigh AS neighborhood_name, {rnd(_overlap('a', 'h'), 0)} AS intersection_area,
  {rnd(f"({_overlap('a', 'h')}) / ({_area('a')}) * 100", 2)} AS pct_of_community_area,
  {rnd(f"({_overlap('a', 'h')}) / ({_area('h')}) * 100", 2)} AS pct_of_neighborhood,
  ({_overlap('a', 'h')}) / ({_area('h')}) > 0.5 AS is_primary_community_area
FROM area_boxes a JOIN hood_boxes h ON {_meets('a', 'h')}""",
    "crosswalk_zip_neighborhood": "SELECT * FROM zip_hood",
    "crosswalk_complete": f"""
WITH both_boxes AS (SELECT a.area_numbe, a.community, z.zip, greatest(a.x0, z.x0) AS x0, least(a.x1, z.x1) AS x1,
  greatest(a.y0, z.y0) AS y0, least(a.y1, z.y1) AS y1, {_area('a')} AS sa, {_area('z')} AS sz
  FROM area_boxes a JOIN zip_boxes z ON {_meets('a', 'z')})
SELECT CAST(area_numbe AS BIGINT) AS community_area_number, community AS community_area_name,
  CAST(zip AS VARCHAR) AS zip_code, h.pri_neigh AS neighborhood_name, {rnd(_overlap('b', 'h'), 0)} AS intersection_area,
  {rnd(f"({_overlap('b', 'h')}) / sa * 100", 2)} AS pct_of_community_area,
  {rnd(f"({_overlap('b', 'h')}) / sz * 100", 2)} AS pct_of_zip,
  {rnd(f"({_overlap('b', 'h')}) / ({_area('h')}) * 100", 2)} AS pct_of_neighborhood
FROM both_boxes b JOIN hood_boxes h ON {_meets('b', 'h')} WHERE {_overlap('b', 'h')} > 1000""",
    "crosswalk_summary": """
SELECT count(*) AS total_relationships, count(DISTINCT community_area_number) AS unique_community_areas,
  (SELECT count(*) FROM (SELECT 1 FROM community_zip GROUP BY community_area_number HAVING count(DISTINCT zip_code) > 1)) AS community_areas_with_multiple_zips,
  count(DISTINCT zip_code) AS unique_zips,
  (SELECT count(*) FROM (SELECT 1 FROM community_zip GROUP BY zip_code HAVING count(DISTINCT community_area_number) > 1)) AS zips_spanning_multiple_areas
FROM community_zip""",
    "permits_upsert": f"""
WITH old AS (SELECT * FROM bronze_permits WHERE issue_date < {P_AS_OF} - 30),
changed AS (SELECT * REPLACE ({P_AS_OF} AS issue_date, 1e0 AS total_fee) FROM old WHERE processing_time = 7),
fresh AS (SELECT * FROM bronze_permits WHERE issue_date >= {P_AS_OF} - 30 UNION ALL SELECT * FROM changed)
SELECT * FROM fresh UNION ALL SELECT * FROM old WHERE id NOT IN (SELECT id FROM fresh)""",
    "trips_range_replace": f"""
SELECT trip_id, trip_date, source_dataset, pickup_zip,
  {rnd("fare + CASE WHEN source_dataset = 'taxi' AND trip_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' THEN 1e0 ELSE 0e0 END", 2)} AS fare
FROM silver_trips""",
    "permits_layer_statistics": f"""
SELECT 'BRONZE' AS layer, * FROM (UNPIVOT (SELECT CAST(count(*) AS VARCHAR) AS total_records,
    CAST(count(DISTINCT id) AS VARCHAR) AS unique_ids, CAST(min(issue_date) AS VARCHAR) AS oldest_permit,
    CAST(max(issue_date) AS VARCHAR) AS newest_permit FROM bronze_permits) ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'SILVER', * FROM (UNPIVOT (SELECT CAST(count(*) AS VARCHAR) AS total_records,
    CAST(count(DISTINCT id) AS VARCHAR) AS unique_ids, CAST(count(DISTINCT zip_code) AS VARCHAR) AS unique_zips,
    CAST(count(*) - count(zip_code) AS VARCHAR) AS missing_zip, CAST(min(issue_date) AS VARCHAR) AS oldest_permit,
    CAST(max(issue_date) AS VARCHAR) AS newest_permit FROM silver_permits) ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'GOLD - Permits ROI', * FROM (UNPIVOT (SELECT CAST(count(*) AS VARCHAR) AS total_zip_codes,
    CAST({big('sum(total_permits)')} AS VARCHAR) AS total_permits,
    CAST(CAST(sum(total_permit_value) AS DECIMAL(38,2)) AS VARCHAR) AS total_value FROM roi) ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'GOLD - Loan Targets', * FROM (UNPIVOT (SELECT CAST(count(*) AS VARCHAR) AS total_zip_codes,
    CAST(count(*) FILTER (WHERE is_loan_eligible) AS VARCHAR) AS eligible_zips,
    CAST(CAST({mean('eligibility_index')} AS DECIMAL(38,2)) AS VARCHAR) AS avg_eligibility FROM loans2) ON COLUMNS(*) INTO NAME metric VALUE value)""",
    "gold_taxi_hourly_by_zip": "SELECT * FROM hourly",
    "gold_taxi_daily_by_zip": "SELECT * FROM daily",
    "gold_route_pairs": "SELECT * FROM routes",
    "gold_permits_roi": "SELECT * FROM roi",
    "gold_weekly_mobility": "SELECT * FROM mobility",
    "gold_covid_hotspots": "SELECT * FROM hotspots",
    "gold_loan_targets_v1": "SELECT * FROM loans1",
    "gold_loan_targets_v2": "SELECT * FROM loans2",
    "gold_forecasts": "SELECT * FROM baseline",
    "daily_trip_metrics": f"""
WITH t AS (SELECT *, CAST(trip_start_timestamp AS DATE) AS d FROM raw_trips WHERE source_dataset = 'taxi'
  AND trip_start_timestamp < DATE '2024-02-01'),
ends AS (SELECT d, 'p' AS e, pickup_community_area AS area FROM t UNION ALL SELECT d, 'd', dropoff_community_area FROM t),
ranked AS (SELECT d, e, area, row_number() OVER (PARTITION BY d, e ORDER BY count(*) DESC,
  coalesce(try_cast(area AS BIGINT), 1000000)) AS r FROM ends GROUP BY d, e, area)
SELECT t.d AS date, count(*) AS total_trips, {total('trip_total')} AS total_revenue, {rnd(uncut_mean('trip_miles'), 6)} AS avg_trip_miles,
  {mean('fare')} AS avg_fare, count(DISTINCT taxi_id) AS unique_taxis,
  count(*) FILTER (WHERE payment_type = 'Cash') AS cash_trips,
  count(*) FILTER (WHERE payment_type = 'Credit Card') AS credit_trips,
  count(*) FILTER (WHERE payment_type = 'Mobile') AS mobile_trips,
  (SELECT area FROM ranked r WHERE r.d = t.d AND e = 'p' AND r = 1) AS top_pickup_area,
  (SELECT area FROM ranked r WHERE r.d = t.d AND e = 'd' AND r = 1) AS top_dropoff_area
FROM t GROUP BY t.d""",
    "permits_monthly_summary": f"""
SELECT issue_year AS year, issue_month AS month, community_area, count(*) AS permit_count, {total('total_fee')} AS total_fees,
  {mean('total_fee')} AS avg_fee, count(DISTINCT permit_type) AS unique_permit_types
FROM permits_clean WHERE data_quality_flag = 'valid' GROUP BY 1, 2, 3""",
    "hourly_profile": _profile_trips("hourly"),
    "daily_profile": _profile_trips("daily"),
    "routes_profile": f"""
SELECT count(*) AS total_routes, {big('sum(trip_count)')} AS total_trips, {rnd(mean('avg_fare'), 2)} AS overall_avg_fare,
  {rnd(mean('avg_miles'), 2)} AS overall_avg_miles, {rnd('sum(total_revenue)', 2)} AS combined_revenue,
  min(rank) AS min_rank, max(rank) AS max_rank FROM routes""",
    "roi_profile": f"""
SELECT count(*) AS total_zip_codes, {big('sum(total_permits)')} AS overall_permits,
  {rnd('sum(total_permit_value)', 2)} AS overall_permit_value, {rnd(mean('avg_permit_value'), 2)} AS avg_of_avg_permit_value,
  min(total_permits) AS min_permits_per_zip, max(total_permits) AS max_permits_per_zip FROM roi""",
    "hotspots_profile": f"""
SELECT count(*) AS total_records, count(DISTINCT zip_code) AS unique_zips, count(DISTINCT week_start) AS unique_weeks,
  min(week_start) AS earliest_week, max(week_start) AS latest_week, {rnd(mean('mobility_risk_rate'), 2)} AS avg_mobility_risk,
  {rnd(mean('epi_risk'), 2)} AS avg_epi_risk, {rnd(mean('adjusted_risk_score'), 2)} AS avg_adjusted_risk,
  count(*) FILTER (WHERE risk_category = 'High') AS high_risk_weeks,
  count(*) FILTER (WHERE risk_category = 'Medium') AS medium_risk_weeks,
  count(*) FILTER (WHERE risk_category = 'Low') AS low_risk_weeks FROM hotspots""",
    "loans_profile": f"""
SELECT count(*) AS total_zip_codes, count(*) AS eligible_zip_codes, {rnd('avg(per_capita_income)', 0)} AS avg_per_capita_income,
  {rnd(mean('eligibility_index'), 2)} AS avg_eligibility_index, min(per_capita_income) AS min_income,
  max(per_capita_income) AS max_income, {rnd('avg(total_permits_new_construction)', 0)} AS avg_new_construction_permits
FROM loans1 WHERE is_loan_eligible""",
    "forecasts_profile": f"""
SELECT model_name, count(*) AS total_forecasts, count(DISTINCT zip_code) AS unique_zips,
  count(DISTINCT forecast_date) AS unique_dates, min(forecast_date) AS earliest_forecast,
  max(forecast_date) AS latest_forecast, {rnd(mean('predicted_trip_count'), 2)} AS avg_predicted_trips
FROM baseline GROUP BY model_name""",
    "v_airport_trips": "SELECT * FROM airport",
    "v_airport_covid_overlay": _overlay(0),
    "v_airport_covid_overlay_aligned": _overlay(1),
    "v_airport_hourly_patterns": f"""
SELECT trip_hour, airport_destination, count(*) AS trip_count, {mean('fare')} AS avg_fare, {mean('trip_miles')} AS avg_miles
FROM airport WHERE trip_date >= {AS_OF} - 90 GROUP BY 1, 2""",
    "airport_counts": """
SELECT airport_destination, count(*) AS total_trips, min(trip_date) AS first_trip, max(trip_date) AS last_trip
FROM airport GROUP BY 1""",
    "v_rush_hour_by_zip": "SELECT * FROM rush",
    "rush_hour_iqr": f"""
SELECT time_window || ' (' || window_name || ')' AS time_window, n AS data_points, lo AS absolute_min, hi AS absolute_max,
  q1 AS "Q1", q2 AS median, q3 AS "Q3", q3 - q1 AS "IQR", greatest(0e0, q1 - 1.5e0 * (q3 - q1)) AS min_limit_calculated,
  greatest(0e0, q1 - 1.5e0 * (q3 - q1)) AS min_limit_final, q3 + 1.5e0 * (q3 - q1) AS max_limit_final,
  {rnd('(q3 + 1.5e0 * (q3 - q1)) / hi * 100', 1)} AS pct_coverage FROM window_stats""",
    "rush_hour_scale": f"""
SELECT '=== RECOMMENDED COLOR SCALE LIMITS ===' AS summary, lo AS recommended_min, hi AS recommended_max,
  (SELECT time_window FROM window_stats ORDER BY window_stats.hi, time_window LIMIT 1) AS quietest_period,
  (SELECT time_window FROM window_stats ORDER BY window_stats.hi DESC, time_window LIMIT 1) AS busiest_period,
  CAST(CAST(lo AS BIGINT) AS VARCHAR) || ' to ' || CAST(CAST(hi AS BIGINT) AS VARCHAR) AS color_scale_range
FROM (SELECT {rnd('min(greatest(0e0, q1 - 1.5e0 * (q3 - q1)))', 0)} AS lo, {rnd('max(q3 + 1.5e0 * (q3 - q1))', 0)} AS hi FROM window_stats)""",
    "rush_hour_by_day_type": f"""
SELECT time_window, day_type, data_points, min_trips, max_trips, avg_trips, q1 AS "Q1", q3 AS "Q3", q3 - q1 AS "IQR"
FROM (SELECT time_window, day_type, count(*) AS data_points, min(total_trips) AS min_trips, max(total_trips) AS max_trips,
  round(avg(total_trips)) AS avg_trips, {_QUARTERS} FROM window_trips GROUP BY 1, 2)""",
    "v_ccvi_map": f"""
SELECT geography_type, geography_id, area_name, ccvi_score, ccvi_category, {rnd('(y0 + y1) / 2', 6)} AS latitude,
  {rnd('(x0 + x1) / 2', 6)} AS longitude,
  CASE WHEN ccvi_score < 50 THEN 'High (Threshold)' WHEN ccvi_score < 55 THEN 'Moderate-High'
    WHEN ccvi_score < 60 THEN 'High' ELSE 'Very High' END AS vulnerability_level,
  CASE WHEN ccvi_score < 50 THEN 1 WHEN ccvi_score < 55 THEN 2 WHEN ccvi_score < 60 THEN 3 ELSE 4 END AS vulnerability_score
FROM ccvi JOIN (SELECT 'CA' AS geography_type, CAST(area_numbe AS VARCHAR) AS geography_id, community AS area_name,
    x0, x1, y0, y1 FROM area_boxes
  UNION ALL SELECT 'ZIP', CAST(zip AS VARCHAR), CAST(zip AS VARCHAR), x0, x1, y0, y1 FROM zip_boxes) USING (geography_type, geography_id)""",
    "v_ccvi_trip_activity": f"""
WITH f AS ({_half('pickup', 'from')}), t AS ({_half('dropoff', 'to')})
SELECT coalesce(f.area, t.area) AS community_area, community AS area_name, coalesce(f.ccvi_score, t.ccvi_score) AS ccvi_score,
  coalesce(f.trips, 0) AS trips_from_area, coalesce(t.trips, 0) AS trips_to_area,
  coalesce(f.trips, 0) + coalesce(t.trips, 0) AS total_trips, coalesce(f.pooled, 0) AS pooled_trips_from,
  coalesce(t.pooled, 0) AS pooled_trips_to, coalesce(f.pooled, 0) + coalesce(t.pooled, 0) AS total_pooled_trips,
  f.fare AS avg_fare_from, t.fare AS avg_fare_to, f.miles AS avg_miles_from, t.miles AS avg_miles_to,
  CAST(coalesce(f.pooled, 0) + coalesce(t.pooled, 0) AS DOUBLE) / (coalesce(f.trips, 0) + coalesce(t.trips, 0)) * 100 AS pooled_pct
FROM f FULL JOIN t ON f.area = t.area LEFT JOIN area_boxes ON area_numbe = coalesce(f.area, t.area)""",
    "v_ccvi_double_burden": f"""
WITH s AS (SELECT zip_code, population, {mean('case_rate_weekly')} AS avg_case_rate, {big('sum(cases_weekly)')} AS total_cases,
    {big('sum(deaths_weekly)')} AS total_deaths, {mean('adjusted_risk_score')} AS avg_risk_score,
    count(*) FILTER (WHERE risk_category = 'High') AS weeks_high_risk, {big('sum(total_trips_from_zip)')} AS total_trips_from,
    {big('sum(total_trips_to_zip)')} AS total_trips_to FROM hotspots GROUP BY zip_code, population)
SELECT zip_code, ccvi_score, avg_case_rate, total_cases, total_deaths, avg_risk_score, weeks_high_risk, total_trips_from,
  total_trips_to, population, {rnd('ccvi_score / 100e0 * (avg_risk_score / 100e0) * 100', 6)} AS double_burden_score,
  CASE WHEN ccvi_score >= 55 AND avg_risk_score >= 50 THEN 'Critical' WHEN ccvi_score >= 50 AND avg_risk_score >= 40 THEN 'Severe'
    WHEN ccvi_score >= 47.9 AND avg_risk_score >= 30 THEN 'High' ELSE 'Elevated' END AS burden_category
FROM s JOIN ccvi ON geography_type = 'ZIP' AND geography_id = zip_code""",
    "v_ccvi_trip_trends": f"""
SELECT {sunday('trip_date')} AS week_start, {month('trip_date')} AS month_start, {num('year(trip_date)')} AS year,
  {num('month(trip_date)')} AS month, count(p.area) AS trips_from_high_ccvi, count(d.area) AS trips_to_high_ccvi,
  count(*) FILTER (WHERE {_EITHER}) AS trips_involving_high_ccvi,
  count(*) FILTER (WHERE {_EITHER} AND trips_pooled > 1) AS pooled_trips_high_ccvi, count(*) AS total_trips,
  CAST(count(*) FILTER (WHERE {_EITHER}) AS DOUBLE) / count(*) * 100 AS pct_trips_high_ccvi
FROM {_TOUCH} GROUP BY 1, 2, 3, 4""",
    "v_ccvi_pooled_rides": f"""
SELECT area AS community_area, community AS area_name, ccvi_score, count(*) AS total_trips,
  count(*) FILTER (WHERE trips_pooled > 1) AS pooled_trips,
  count(*) FILTER (WHERE coalesce(trips_pooled, 1) = 1) AS solo_trips,
  CAST(count(*) FILTER (WHERE trips_pooled > 1) AS DOUBLE) / count(*) * 100 AS pooled_pct,
  count(*) FILTER (WHERE source_dataset = 'taxi') AS taxi_trips, count(*) FILTER (WHERE source_dataset = 'tnp') AS tnp_trips,
  count(*) FILTER (WHERE shared_trip_authorized) AS shared_authorized,
  CAST(count(*) FILTER (WHERE shared_trip_authorized) AS DOUBLE) / count(*) * 100 AS shared_auth_pct,
  {mean2('fare')} AS avg_fare, {mean2('CASE WHEN trips_pooled > 1 THEN fare END')} AS avg_fare_pooled,
  {mean2('CASE WHEN coalesce(trips_pooled, 1) = 1 THEN fare END')} AS avg_fare_solo, {mean2('trip_miles')} AS avg_miles
FROM silver_trips JOIN risky_areas ON area = pickup_community_area OR area = dropoff_community_area
LEFT JOIN area_boxes ON area_numbe = area GROUP BY area, community, ccvi_score""",
    "v_ccvi_dashboard_summary": f"""
SELECT count(*) AS total_high_risk_areas, count(*) FILTER (WHERE geography_type = 'CA') AS high_risk_cas,
  count(*) FILTER (WHERE geography_type = 'ZIP') AS high_risk_zips, min(ccvi_score) AS min_ccvi_score,
  max(ccvi_score) AS max_ccvi_score, {rnd('avg(ccvi_score)', 1)} AS avg_ccvi_score,
  (SELECT count(*) FROM {_TOUCH} WHERE {_EITHER}) AS total_trips_high_ccvi_areas,
  (SELECT count(DISTINCT zip_code) FROM hotspots WHERE zip_code IN (SELECT geography_id FROM ccvi)) AS zips_with_covid_data,
  (SELECT {big('sum(cases_weekly)')} FROM hotspots WHERE zip_code IN (SELECT geography_id FROM ccvi)) AS total_covid_cases,
  (SELECT {big('sum(deaths_weekly)')} FROM hotspots WHERE zip_code IN (SELECT geography_id FROM ccvi)) AS total_covid_deaths
FROM ccvi""",
    "v_economic_dashboard": "SELECT * FROM economic",
    "v_permits_timeline": "SELECT * FROM timeline",
    "v_permits_by_area": "SELECT * FROM by_area",
    "v_monthly_permit_summary": "SELECT * FROM monthly",
    "v_fee_analysis": "SELECT * FROM fees",
    "economic_kpis": f"""
SELECT 'Total ZIPs with data' AS metric, count(DISTINCT zip_code) AS value FROM economic
UNION ALL SELECT 'Loan eligible ZIPs', count(DISTINCT zip_code) FROM economic WHERE is_loan_eligible
UNION ALL SELECT 'Total NEW CONSTRUCTION permits', count(*) FROM timeline
UNION ALL SELECT 'Date range (months)', date_diff('month', min(month_start), max(month_start)) FROM monthly
UNION ALL SELECT 'Average permits per month', {big('round(avg(permit_count))')} FROM monthly""",
    "economic_check_dashboard": f"""
SELECT 'v_economic_dashboard' AS view_name, count(*) AS total_zips, count(DISTINCT priority_category) AS priority_levels,
  count(*) FILTER (WHERE is_loan_eligible) AS eligible_zips, {rnd('avg(per_capita_income)', 0)} AS avg_income,
  {big('sum(total_permits_new_construction)')} AS total_new_construction FROM economic""",
    "economic_check_timeline": f"""
SELECT 'v_permits_timeline' AS view_name, count(*) AS total_permits, min(issue_date) AS first_date, max(issue_date) AS last_date,
  count(DISTINCT zip_code) AS zip_count, count(DISTINCT year_quarter) AS quarters,
  {rnd('sum(reported_cost)', 0)} AS total_reported_cost, {rnd('sum(total_fee)', 0)} AS total_fees FROM timeline""",
    "economic_check_area": f"""
SELECT 'v_permits_by_area' AS view_name, count(*) AS total_zips, {big('sum(permit_count)')} AS total_permits,
  {rnd('avg(per_capita_income)', 0)} AS avg_income, count(*) FILTER (WHERE is_loan_eligible) AS eligible_zips,
  {rnd('sum(total_cost)', 0)} AS total_project_cost, {rnd(mean('permits_per_1000_residents'), 2)} AS avg_permits_per_1k
FROM by_area WHERE permit_count > 0""",
    "economic_check_monthly": f"""
SELECT 'v_monthly_permit_summary' AS view_name, count(*) AS total_months, {big('sum(permit_count)')} AS total_permits,
  min(month_start) AS first_month, max(month_start) AS last_month, {rnd('avg(permit_count)', 1)} AS avg_permits_per_month,
  max(permit_count) AS peak_month_permits FROM monthly""",
    "economic_check_fees": f"""
SELECT 'v_fee_analysis' AS view_name, count(*) AS total_zips, {big('sum(permit_count)')} AS total_permits,
  {rnd('sum(total_fees_collected)', 0)} AS total_fees, {rnd('avg(avg_fee)', 0)} AS overall_avg_fee,
  {rnd(mean('effective_fee_rate_pct'), 2)} AS avg_fee_rate_pct FROM fees""",
    "cumulative_permits": """
SELECT month_start, CAST(sum(permit_count) AS BIGINT) AS permit_count,
  CAST(sum(sum(permit_count)) OVER (ORDER BY month_start) AS BIGINT) AS cumulative_permits FROM monthly GROUP BY month_start""",
    "uncertainty_percent": f"""
SELECT zip_code, {pct(uncut('(yhat_upper - yhat_lower)'), f"CAST({uncut('yhat')} AS DOUBLE)")} AS uncertainty_percent
FROM traffic_forecasts GROUP BY 1""",
    "traffic_next_week": f"""
SELECT zip_code, forecast_date, {_w0('yhat')} AS predicted_trips, {_w0('yhat_lower')} AS lower_bound,
  {_w0('yhat_upper')} AS upper_bound, {_w0('trend')} AS trend_component FROM traffic_forecasts WHERE {_AHEAD} + 7""",
    "traffic_weekly": f"""
SELECT zip_code, {monday('forecast_date')} AS week_start, {_sum0('yhat')} AS weekly_predicted_trips,
  {_sum0('yhat_lower')} AS weekly_lower_bound, {_sum0('yhat_upper')} AS weekly_upper_bound, {_avg0('trend')} AS avg_weekly_trend
FROM traffic_forecasts WHERE {_AHEAD} + 84 GROUP BY 1, 2""",
    "traffic_monthly": f"""
SELECT zip_code, {month('forecast_date')} AS forecast_month, {_sum0('yhat')} AS monthly_predicted_trips,
  {_avg0('yhat')} AS avg_daily_trips, {_sum0('yhat_lower')} AS monthly_lower_bound, {_sum0('yhat_upper')} AS monthly_upper_bound
FROM traffic_forecasts GROUP BY 1, 2""",
    "traffic_top_zips": f"""
SELECT zip_code, {_sum0('yhat')} AS total_predicted_trips_30d, {_avg0('yhat')} AS avg_daily_trips, {_avg0('trend')} AS trend_direction
FROM traffic_forecasts WHERE {_AHEAD} + 30 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "traffic_versus_actual": f"""
SELECT a.zip_code, a.trip_date, actual_trips, yhat AS predicted_trips, {rnd('yhat - actual_trips', 0)} AS forecast_error,
  {rnd('abs(yhat - actual_trips) / actual_trips * 100', 1)} AS mape_pct
FROM (SELECT pickup_zip AS zip_code, trip_date, {big('sum(trip_count)')} AS actual_trips FROM daily
      WHERE trip_date >= {AS_OF} - 30 GROUP BY 1, 2) a
JOIN traffic_forecasts f ON f.zip_code = a.zip_code AND f.forecast_date = a.trip_date""",
    "traffic_components": f"""
SELECT zip_code, forecast_date, {_w0('yhat')} AS total_predicted, {_w0('trend')} AS trend_component,
  {_w0('yearly')} AS yearly_seasonality, {_w0('weekly')} AS weekly_seasonality, model_version
FROM traffic_forecasts WHERE {_AHEAD} + 7 AND zip_code IN ('60601', '60611', '60616')""",
    "traffic_model_rollup": f"""
SELECT model_name, model_version, trained_date, count(*) AS zip_codes_modeled, {rnd('avg(mae)', 1)} AS avg_mae,
  {rnd('avg(mape)', 1)} AS avg_mape_pct, {rnd('avg(r_squared)', 3)} AS avg_r2, {rnd('avg(training_records)', 0)} AS avg_training_days
FROM forecast_metrics WHERE starts_with(model_name, 'traffic_forecast') GROUP BY 1, 2, 3""",
    "traffic_uncertainty": f"""
SELECT zip_code, {_avg0('yhat')} AS avg_prediction,
  {rnd(uncut_mean('(yhat_upper - yhat_lower)'), 0)} AS avg_uncertainty_range,
  {rnd('avg((yhat_upper - yhat_lower) / nullif(yhat, 0) * 100)', 1)} AS uncertainty_pct
FROM traffic_forecasts WHERE {_AHEAD} + 30 GROUP BY 1 HAVING {_avg0('yhat')} > 0 ORDER BY 4 DESC, 1 LIMIT 20""",
    "traffic_day_of_week": f"""
SELECT zip_code, {num('dayofweek(forecast_date) + 1')} AS day_of_week, dayname(forecast_date) AS day_name,
  {_avg0('yhat')} AS avg_predicted_trips, count(*) AS forecast_days
FROM traffic_forecasts WHERE {_AHEAD} + 28 AND zip_code = '60601' GROUP BY 1, 2, 3""",
    "traffic_month_over_month": f"""
WITH m AS (SELECT zip_code, {month('forecast_date')} AS mon, CAST({uncut('yhat')} AS DOUBLE) AS s FROM traffic_forecasts GROUP BY 1, 2),
p AS (SELECT zip_code, mon, s, lag(s) OVER w AS prev, lag(mon) OVER w AS prev_mon FROM m WINDOW w AS (PARTITION BY zip_code ORDER BY mon))
SELECT zip_code, mon AS forecast_month, {rnd('s', 0)} AS current_month_trips, {rnd('prev', 0)} AS previous_month_trips,
  {rnd('(s - prev) / prev * 100', 1)} AS mom_growth_pct
FROM p WHERE date_diff('month', prev_mon, mon) = 1""",
    "traffic_airport": f"""
SELECT zip_code, forecast_date, {_w0('yhat')} AS predicted_trips, {_w0('yhat_lower')} AS lower_bound, {_w0('yhat_upper')} AS upper_bound
FROM traffic_forecasts WHERE {_AHEAD} + 30 AND zip_code IN ('60018', '60666')""",
    "traffic_model_averages": f"""
SELECT {rnd('avg(mae)', 6)} AS avg_mae, {rnd('avg(mape)', 6)} AS avg_mape, {rnd('avg(r_squared)', 6)} AS avg_r2,
  count(*) AS models_trained FROM forecast_metrics
WHERE trained_date = {FORECAST_DAY} AND starts_with(model_name, 'traffic_forecast')""",
    "traffic_coverage": """
SELECT max(model_trained_date) AS last_trained, max(forecast_date) AS last_forecast_date,
  count(DISTINCT zip_code) AS zip_codes_covered FROM traffic_forecasts""",
    "covid_next_month": f"""
SELECT zip_code, forecast_date, predicted_risk_score, predicted_risk_category, alert_level, alert_message,
  risk_score_lower, risk_score_upper, predicted_cases_weekly, predicted_mobility_index
FROM covid_forecasts WHERE {_AHEAD} + 28""",
    "covid_next_alerts": f"""
SELECT zip_code, forecast_date, predicted_risk_score, predicted_risk_category, alert_level, alert_message,
  predicted_cases_weekly, CASE alert_level WHEN 'CRITICAL' THEN 4 WHEN 'WARNING' THEN 3 WHEN 'CAUTION' THEN 2 ELSE 1 END AS alert_priority
FROM covid_forecasts WHERE {_NEXT} AND predicted_risk_category <> 'Low'""",
    "covid_risk_trend": """
SELECT zip_code, forecast_date, predicted_risk_score, predicted_risk_category, risk_score_lower, risk_score_upper,
  lag(predicted_risk_score) OVER w AS prev_week_risk,
  predicted_risk_score - lag(predicted_risk_score) OVER w AS weekly_change
FROM covid_forecasts WINDOW w AS (PARTITION BY zip_code ORDER BY forecast_date)""",
    "covid_alert_distribution": f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY forecast_date, alert_level ORDER BY predicted_risk_score DESC, zip_code) AS k FROM covid_forecasts)
SELECT forecast_date, alert_level, count(*) AS zip_count, {rnd(uncut_mean('predicted_risk_score'), 2)} AS avg_risk_score,
  {rnd('avg(predicted_cases_weekly)', 0)} AS avg_cases_per_zip,
  string_agg(zip_code, ', ' ORDER BY k) FILTER (WHERE k <= 5) AS top_5_zips FROM r GROUP BY 1, 2""",
    "covid_history_and_forecast": f"""
SELECT zip_code, week_start AS date, adjusted_risk_score AS actual_risk, 'Historical' AS data_type FROM hotspots
WHERE week_start >= {FORECAST_DAY} - 84
UNION ALL SELECT zip_code, forecast_date, predicted_risk_score, 'Forecast' FROM covid_forecasts WHERE forecast_date >= {FORECAST_DAY}""",
    "covid_top_risk_zips": f"""
SELECT zip_code, {rnd(uncut_mean('predicted_risk_score'), 2)} AS avg_12week_risk, {rnd('max(predicted_risk_score)', 2)} AS peak_risk,
  count(*) FILTER (WHERE alert_level IN ('CRITICAL', 'WARNING')) AS high_alert_weeks,
  {rnd('avg(predicted_cases_weekly)', 0)} AS avg_weekly_cases,
  string_agg(DISTINCT predicted_risk_category, ',' ORDER BY predicted_risk_category) AS risk_categories,
  string_agg(DISTINCT alert_level, ',' ORDER BY alert_level) AS alert_levels
FROM covid_forecasts GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 10""",
    "covid_model_metrics": f"""
SELECT zip_code, model_version, trained_date, training_records AS training_weeks, {rnd('mae', 2)} AS mae_risk_points,
  {rnd('mape', 1)} AS mape_percent, {rnd('r_squared', 3)} AS r2_score, train_start_date, train_end_date, notes
FROM forecast_metrics WHERE starts_with(model_name, 'covid_risk_forecast')""",
    "covid_uncertainty": """
SELECT zip_code, forecast_date, predicted_risk_score, risk_score_lower, risk_score_upper,
  risk_score_upper - risk_score_lower AS uncertainty_width,
  (risk_score_upper - risk_score_lower) / predicted_risk_score AS relative_uncertainty, predicted_risk_category, alert_level
FROM covid_forecasts WHERE predicted_risk_score > 0""",
    "covid_mobility_bands": """
SELECT zip_code, forecast_date, predicted_risk_score, predicted_mobility_index, predicted_cases_weekly,
  CASE WHEN predicted_mobility_index <= 1000 THEN 'Low Mobility' WHEN predicted_mobility_index <= 5000 THEN 'Medium Mobility'
    WHEN predicted_mobility_index <= 10000 THEN 'High Mobility' ELSE 'Very High Mobility' END AS mobility_category,
  predicted_risk_category FROM covid_forecasts""",
    "covid_weekly_briefing": f"""
SELECT *, CASE WHEN critical_zips > 0 THEN 'CITY ALERT: Critical risk areas identified'
  WHEN warning_zips > 5 THEN 'CITY CAUTION: Multiple warning zones'
  WHEN caution_zips > 10 THEN 'CITY NOTICE: Elevated risk in some areas' ELSE 'CITY NORMAL: Low risk across Chicago' END AS city_status
FROM (SELECT forecast_date, strftime(forecast_date, '%A, %B ') || lpad(CAST(day(forecast_date) AS VARCHAR), 2, ' ')
    || strftime(forecast_date, ', %Y') AS week_of, count(*) AS total_zips,
  count(*) FILTER (WHERE alert_level = 'CRITICAL') AS critical_zips, count(*) FILTER (WHERE alert_level = 'WARNING') AS warning_zips,
  count(*) FILTER (WHERE alert_level = 'CAUTION') AS caution_zips, count(*) FILTER (WHERE alert_level = 'NONE') AS safe_zips,
  {rnd(uncut_mean('predicted_risk_score'), 2)} AS city_avg_risk, {big('sum(predicted_cases_weekly)')} AS total_predicted_cases
  FROM covid_forecasts GROUP BY forecast_date)""",
    "covid_risk_with_geometry": f"""
SELECT zip_code, forecast_date, predicted_risk_score, predicted_risk_category, alert_level, predicted_cases_weekly, {_LIMITS}
FROM covid_forecasts LEFT JOIN zip_boxes z ON zip_code = CAST(z.zip AS VARCHAR) WHERE {_NEXT}""",
    "covid_export": "SELECT * FROM covid_forecasts",
    "covid_high_risk_ahead": f"""
SELECT zip_code, forecast_date, predicted_risk_category, alert_level, alert_message FROM covid_forecasts
WHERE predicted_risk_category = 'High' AND forecast_date >= {FORECAST_DAY}""",
    "covid_last_alert_map": f"""
SELECT zip_code, predicted_risk_category, alert_level, alert_message, {_LIMITS}
FROM covid_forecasts JOIN zip_boxes z ON zip_code = CAST(z.zip AS VARCHAR)
WHERE forecast_date = (SELECT max(forecast_date) FROM covid_forecasts)""",
    "airport_share_by_source": f"""
SELECT source_dataset, count(*) AS total_trips, count(*) FILTER (WHERE is_airport_trip) AS airport_trips,
  {pct('count(*) FILTER (WHERE is_airport_trip)', 'count(*)')} AS airport_pct FROM silver_trips GROUP BY 1""",
    "enrichment_rate_by_source": f"""
SELECT source_dataset, count(*) AS total, count(pickup_zip) AS pickup_zip_enriched, {pct('count(pickup_zip)', 'count(*)')} AS pickup_zip_pct,
  count(dropoff_zip) AS dropoff_zip_enriched, {pct('count(dropoff_zip)', 'count(*)')} AS dropoff_zip_pct FROM silver_trips GROUP BY 1""",
    "permits_by_neighborhood": f"""
SELECT neighborhood, count(*) AS permit_count, {rnd(mean('total_fee'), 2)} AS avg_fee, {rnd('avg(processing_time)', 0)} AS avg_processing_days
FROM silver_permits WHERE permit_year = 2000 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "covid_risk_distribution": f"""
SELECT risk_category, count(*) AS zip_count, {rnd(mean('case_rate_weekly'), 2)} AS avg_case_rate, {big('sum(population)')} AS total_population
FROM latest GROUP BY 1""",
    "high_risk_by_type": f"SELECT geography_type, count(*) AS high_risk_count, {rnd('avg(ccvi_score)', 3)} AS avg_score FROM ccvi GROUP BY 1",
    "top_hotspots": """
SELECT zip_code, week_start, risk_category, adjusted_risk_score, mobility_risk_rate, epi_risk FROM hotspots
WHERE risk_category = 'High' ORDER BY adjusted_risk_score DESC, zip_code, week_start LIMIT 20""",
    "loan_eligible_zips": """
SELECT zip_code, per_capita_income, total_permits_new_construction, eligibility_index, is_loan_eligible FROM loans1 WHERE is_loan_eligible""",
    "loan_top_eligible_zips": """
SELECT zip_code, per_capita_income, total_permits_new_construction, eligibility_index, is_loan_eligible FROM loans1
WHERE is_loan_eligible AND per_capita_income < 30000 ORDER BY eligibility_index DESC, zip_code LIMIT 10""",
    "hours_by_pickup_zip": f"""
SELECT pickup_zip, trip_hour, {big('sum(trip_count)')} AS total_trips, {rnd(mean('avg_fare'), 2)} AS avg_fare FROM hourly GROUP BY 1, 2""",
    "cases_by_community_area": """
SELECT week_start, community_area_name, sum(estimated_cases_in_community_area) AS total_cases FROM covid_enriched
WHERE is_primary_zip GROUP BY 1, 2""",
    "areas_of_a_zip": """
SELECT zip_code, community_area_name, pct_of_zip, pct_of_community_area, is_primary_zip FROM community_zip WHERE zip_code = '60614'""",
    "zips_of_a_neighborhood": """
SELECT neighborhood_name, zip_code, pct_of_neighborhood, is_primary_neighborhood FROM zip_hood WHERE neighborhood_name = 'ASIA'""",
    "distributed_metric": f"""
SELECT community_area_number, community_area_name, CAST(sum(cases_weekly * {cents('pct_of_zip')}) AS DOUBLE) / 10000e0 AS distributed_metric
FROM bronze_covid JOIN community_zip USING (zip_code) GROUP BY 1, 2""",
    "trips_from_high_risk_areas": f"""
SELECT {sunday('trip_date')} AS week, count(*) AS trips_from_high_ccvi, {mean('fare')} AS avg_fare FROM silver_trips
WHERE pickup_community_area IN (SELECT area FROM risky_areas) GROUP BY 1""",
    "investment_areas": f"""
SELECT community_area_name, unemployment, below_poverty_level AS poverty_rate, per_capita_income, count(p.id) AS total_permits,
  {total('p.total_fee')} AS total_fees_charged
FROM raw_health h LEFT JOIN silver_permits p ON p.community_area = h.community_area
GROUP BY 1, 2, 3, 4 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 5""",
    "quality_check_table": "SELECT * FROM checks",
    "gold_taxi_daily_by_neighborhood": """
SELECT pickup_neighborhood AS neighborhood, trip_date, count(*) AS trip_count FROM silver_trips
WHERE pickup_neighborhood IS NOT NULL GROUP BY 1, 2""",
    "quality_check_previous_day": _checks_before(0),
    "quality_check_report": "SELECT *, CASE WHEN passed THEN '✅ PASS' ELSE '❌ FAIL' END AS status FROM ("
    + " UNION ALL ".join(_checks_before(n) for n in (0, 3, 7))
    + ")",
    "quality_load_gates": f"""
SELECT name, severity, threshold, {rnd('v', 6)} AS actual_value, CASE WHEN name = 'non_zero_record_count' THEN v >= threshold ELSE v <= threshold END AS passed
FROM (SELECT 'non_zero_record_count' AS name, 'CRITICAL' AS severity, 1e0 AS threshold, CAST(count(*) AS DOUBLE) AS v FROM raw_permits
  UNION ALL SELECT 'permit_number_not_null', 'CRITICAL', 5e0, (count(*) - count(permit_)) * 100e0 / count(*) FROM raw_permits
  UNION ALL SELECT 'issue_date_not_future', 'WARNING', 10e0, count(*) FILTER (WHERE issue_date > DATE '2002-05-01') * 100e0 / count(*) FROM raw_permits
  UNION ALL SELECT 'coordinates_present', 'INFO', 20e0, count(*) FILTER (WHERE coalesce(latitude, 0) * coalesce(longitude, 0) = 0) * 100e0 / count(*) FROM raw_permits)""",
    "quality_expectations": """
WITH t AS (SELECT * FROM raw_trips WHERE source_dataset = 'taxi')
SELECT expectation, (SELECT count(*) FROM t) AS element_count, bad AS unexpected_count, bad = 0 AS success FROM (
  SELECT 'trip_id_not_null' AS expectation, count(*) FILTER (WHERE trip_id IS NULL) AS bad FROM t
  UNION ALL SELECT 'fare_valid_range', count(*) FILTER (WHERE fare < 0 OR fare > 1000) FROM t
  UNION ALL SELECT 'trip_miles_valid', count(*) FILTER (WHERE trip_miles < 0 OR trip_miles > 500) FROM t
  UNION ALL SELECT 'coordinates_not_null', count(*) - count(pickup_centroid_latitude) FROM t
  UNION ALL SELECT 'payment_type_valid', count(*) FILTER (WHERE payment_type NOT IN ('Cash', 'Credit Card', 'Mobile', 'Prcard', 'Unknown', 'No Charge', 'Dispute')) FROM t
  UNION ALL SELECT 'timestamp_format', count(*) - count(trip_start_timestamp) FROM t
  UNION ALL SELECT 'unique_trip_ids', coalesce((SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM t GROUP BY trip_id HAVING count(*) > 1)), 0)
  UNION ALL SELECT 'row_count_reasonable', CASE WHEN count(*) BETWEEN 100 AND 1000000 THEN 0 ELSE 1 END FROM t)""",
    "lineage_freshness": """
SELECT dataset, max(partition_date) AS latest_data_date,
  CAST(floor(date_diff('second', date_trunc('second', max(created_at)), TIMESTAMP '2024-02-01 00:00:00') / 3600e0) AS BIGINT) AS hours_since_last_load,
  count(*) AS total_files, CAST(sum(row_count) AS BIGINT) AS total_rows FROM file_manifest WHERE loaded_to_bronze GROUP BY 1""",
    "lineage_success_rate": f"""
SELECT dataset, count(*) AS total_files, count(*) FILTER (WHERE validation_status = 'passed') AS passed,
  count(*) FILTER (WHERE validation_status = 'failed') AS failed, {pct("count(*) FILTER (WHERE validation_status = 'passed')", 'count(*)')} AS success_rate_pct
FROM file_manifest WHERE partition_date >= {AS_OF} - 30 GROUP BY 1""",
    "lineage_missing_dates": """
SELECT CAST(d AS DATE) AS missing_date FROM generate_series(DATE '2023-12-25', DATE '2024-02-01', INTERVAL 1 DAY) s(d)
WHERE CAST(d AS DATE) NOT IN (SELECT partition_date FROM file_manifest WHERE dataset = 'taxi' AND loaded_to_bronze)""",
    "lineage_find_file": "SELECT * FROM file_manifest WHERE file_uri = 'taxi/2024-01-15/batch_001.json'",
    "forecast_metrics_plain": _errors("avg(abs(actual - predicted) / abs(actual)) * 100"),
    "forecast_metrics_positive": _errors("avg(CASE WHEN actual > 0 THEN abs(actual - predicted) / actual END) * 100"),
    "forecast_metrics_floored": _errors("avg(abs(actual - predicted) / greatest(actual, 1e0)) * 100"),
    "traffic_model_facts": """
WITH s AS (SELECT zip_code, count(*) AS n, max(trip_date) AS b FROM daily_history
  WHERE trip_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY 1)
SELECT zip_code, CAST(b + unnest(range(1, 91))::INT AS DATE) AS forecast_date, DATE '2001-12-31' AS model_trained_date,
  CAST(floor(n * 0.8e0) AS BIGINT) AS training_days, 'ridge-v1' AS model_version, TRUE AS in_order, TRUE AS in_bounds
FROM s WHERE n >= 365""",
    "covid_model_simple_facts": _risk_facts("ridge-simple-v1", 52, "b + 1 + 7 * unnest(range(1, 13))::INT", True),
    "covid_model_regressors_facts": _risk_facts("ridge-regressors-v1", 52, "b + 1 + 7 * unnest(range(1, 13))::INT", False),
    "covid_model_retrospective_facts": _risk_facts(
        "ridge-logistic-v2", 40, "DATE '2021-06-07' + 7 * unnest(range(0, 156))::INT", True
    ),
    "landing_lines_read": """
SELECT trip_id, trip_start_timestamp, trip_seconds, trips_pooled, trip_miles, fare, trip_total, shared_trip_authorized,
  pickup_community_area, dropoff_community_area, pickup_centroid_latitude, dropoff_centroid_longitude
FROM raw_trips WHERE source_dataset = 'tnp' AND trip_seconds % 97 <> 0""",
    "landing_malformed_lines": """
SELECT 'tnp' AS dataset, 'malformed line' AS reason, count(*) AS records
FROM raw_trips WHERE source_dataset = 'tnp' AND trip_seconds % 97 = 0 HAVING count(*) > 0""",
    "lineage_manifest_of_files": """
WITH d AS (SELECT CAST(trip_start_timestamp AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE trip_seconds % 97 = 0) AS bad
  FROM raw_trips WHERE source_dataset = 'tnp' GROUP BY 1)
SELECT 'tnp' AS dataset, CASE WHEN n > bad THEN day END AS partition_date, n AS row_count,
  CAST(bad > 0 AS BIGINT) AS validation_checks_failed, CASE WHEN bad > 0 THEN 'failed' ELSE 'passed' END AS validation_status,
  CASE WHEN bad > 0 THEN 'quarantined' ELSE 'validated' END AS processing_stage, bad > 0 AS quarantined,
  CASE WHEN bad > 0 THEN 'malformed_line: ' || bad || ' rows' END AS quarantine_reason FROM d""",
    "boundary_geojson_read": """
SELECT CAST(zip AS INTEGER) AS zip, 1 AS polygons, 5 AS points, round(x0, 6) AS west, round(x1, 6) AS east,
  round(y0, 6) AS south, round(y1, 6) AS north FROM zip_boxes""",
    "landing_spaced_headers": """
SELECT geography_type, community_area_or_zip, round(ccvi_score, 6) AS ccvi_score, ccvi_category FROM raw_ccvi""",
    "tables_write_modes": """
SELECT mode, source_dataset, count(*) AS rows FROM raw_trips,
  (VALUES ('replaced', 'tnp'), ('if missing', 'taxi'), ('view', 'taxi'), ('view', 'tnp')) v(mode, kind)
WHERE source_dataset = kind GROUP BY ALL""",
    "tables_quarter_archive": """
WITH d AS (SELECT CAST(trip_start_timestamp AS DATE) + INTERVAL 1 MONTH * CASE
    WHEN CAST(substr(trip_id, 2) AS BIGINT) % 5 = 0 THEN 3 ELSE 0 END AS t FROM raw_trips)
SELECT CASE WHEN t >= DATE '2024-01-01' AND t < DATE '2024-04-01' THEN 'archive' ELSE 'table' END AS place,
  CAST(t AS DATE) AS day, count(*) AS rows FROM d GROUP BY 1, 2""",
    "permits_silver_upsert": "SELECT * FROM silver_permits",
    "permits_gold_refresh": "SELECT * FROM roi",
    "permits_increment_window": f"""
SELECT target, CAST(date_trunc('month', issue_date) AS DATE) AS month, count(*) AS rows
FROM bronze_permits, (VALUES ('empty'), ('filled')) v(target)
WHERE target = 'empty' OR issue_date >= {P_AS_OF} - 30 GROUP BY 1, 2""",
    "forecast_job_sinks": """
WITH d AS (SELECT zip_code, count(*) AS n, min(trip_date) AS a, max(trip_date) AS b FROM daily_history
  WHERE trip_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY 1)
SELECT zip_code, CAST(90 AS BIGINT) AS forecasts, CAST(b + 1 AS DATE) AS first_date, CAST(b + 90 AS DATE) AS last_date,
  'traffic_forecast_zip_' || zip_code AS model_name, n AS training_records, a AS train_start_date, b AS train_end_date,
  DATE '2001-12-31' AS trained_date FROM d WHERE n >= 365""",
    "traffic_model_skipped": """
SELECT pickup_zip AS area, count(DISTINCT trip_date) AS points, 365 AS needed FROM daily
GROUP BY 1 HAVING count(DISTINCT trip_date) < 365""",
}

_NAME = re.compile("|".join(rf"\b{n}\b" for n in sorted(PARTS, key=len, reverse=True)))


def _uses(text: str) -> list[str]:
    return [m for m in dict.fromkeys(_NAME.findall(re.sub(r"'[^']*'", "''", text)))]


def _ordered(text: str, seen: dict[str, None]) -> dict[str, None]:
    for name in _uses(text):
        if name not in seen and PARTS[name].strip() != text.strip():
            _ordered(PARTS[name], seen)
            seen[name] = None
    return seen


def texts() -> dict[str, str]:
    """Complete statements, each with the sub-queries it needs in front."""
    out = {}
    for name, body in QUERIES.items():
        parts = list(_ordered(body, {}))
        head = ",\n".join(f"{p} AS ({PARTS[p].strip()})" for p in parts)
        # A wrapper keeps a body's own WITH or UNPIVOT apart from the shared list.
        out[name] = f"WITH {head}\nSELECT * FROM ({body.strip()})" if head else body.strip()
    return out
