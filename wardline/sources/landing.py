"""Landing files: newline-delimited JSON, one folder per data set and date.

Numbers arrive as text, so every field is read as a string and cast afterwards; a
value that does not parse becomes NULL instead of failing the load. A line that is
no JSON object is no row: it goes to the quarantine with its file, as do rows that
a keyed load cannot take.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from wardline.functions.columns import dated
from wardline.sources import tables


def _fields(text: str, kind: str) -> dict[str, str]:
    return {name: kind for name in text.split()}


_FEES = " ".join(
    f"{group}_fee_{part}" for group in ("building", "zoning", "other") for part in ("paid", "unpaid", "waived", "subtotal")
)
_CONTACTS = " ".join(f"contact_{i}_{p}" for i in range(1, 6) for p in ("type", "name", "city", "state", "zipcode"))
_CENTROIDS = " ".join(f"{e}_centroid_{a}" for e in ("pickup", "dropoff") for a in ("latitude", "longitude"))
_AREAS = "pickup_community_area dropoff_community_area"
_TRACTS = "pickup_census_tract dropoff_census_tract"
_TIMES = "trip_start_timestamp trip_end_timestamp"


@dataclass(frozen=True)
class Dataset:
    """Fields of a landing data set with their target types, its key and its date column."""

    name: str
    key: tuple[str, ...]
    day: str
    types: dict[str, str]

    @property
    def read_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.types])


TAXI = Dataset(
    "taxi",
    ("trip_id",),
    "trip_start_timestamp",
    {
        **_fields("trip_id taxi_id company payment_type " + _TRACTS, "string"),
        **_fields(_TIMES, "timestamp"),
        **_fields("trip_seconds", "long"),
        **_fields("trip_miles fare tips tolls extras trip_total", "double"),
        **_fields(_AREAS, "area"),
        **_fields(_CENTROIDS, "double"),
    },
)
TNP = Dataset(
    "tnp",
    ("trip_id",),
    "trip_start_timestamp",
    {
        **_fields("trip_id " + _TRACTS, "string"),
        **_fields(_TIMES, "timestamp"),
        **_fields("trip_seconds trips_pooled", "long"),
        **_fields("trip_miles fare tip additional_charges trip_total", "double"),
        **_fields("shared_trip_authorized", "boolean"),
        **_fields(_AREAS, "area"),
        **_fields(_CENTROIDS, "double"),
    },
)
PERMITS = Dataset(
    "permits",
    ("id",),
    "issue_date",
    {
        **_fields("id permit_ row_id permit_status permit_milestone permit_type review_type", "string"),
        **_fields("application_start_date issue_date", "date"),
        **_fields("processing_time street_number", "long"),
        **_fields("street_direction street_name work_type work_description permit_condition pin_list", "string"),
        **_fields(_CONTACTS, "string"),
        **_fields(_FEES + " subtotal_paid subtotal_unpaid subtotal_waived total_fee reported_cost", "double"),
        **_fields("community_area census_tract ward", "long"),
        **_fields("xcoordinate ycoordinate latitude longitude", "double"),
    },
)
COVID = Dataset(
    "covid",
    ("zip_code", "week_start"),
    "week_start",
    {
        **_fields("zip_code row_id", "string"),
        **_fields("week_start week_end", "date"),
        **_fields(
            "week_number cases_weekly cases_cumulative tests_weekly tests_cumulative deaths_weekly "
            "deaths_cumulative population",
            "long",
        ),
        **_fields(
            "case_rate_weekly case_rate_cumulative test_rate_weekly test_rate_cumulative "
            "percent_tested_positive_weekly percent_tested_positive_cumulative death_rate_weekly "
            "death_rate_cumulative",
            "double",
        ),
    },
)
TNP_PERMITS = Dataset(
    "tnp_permits",
    ("id",),
    "issue_date",
    {
        **_fields("id permit_number permit_type permit_status license_number vehicle_make vehicle_model address", "string"),
        **_fields("issue_date expiration_date", "date"),
        **_fields("vehicle_year", "long"),
        **_fields("latitude longitude", "double"),
    },
)
DATASETS = {d.name: d for d in (TAXI, TNP, PERMITS, COVID, TNP_PERMITS)}

# Column names of the two published tables whose headers hold spaces.
CCVI_HEADERS = {
    "Geography Type": "geography_type",
    "Community Area or ZIP Code": "community_area_or_zip",
    "CCVI Score": "ccvi_score",
    "CCVI Category": "ccvi_category",
    "Location": "location",
}
HEALTH_HEADERS = {
    "Community Area": "community_area",
    "Community Area Name": "community_area_name",
    "Per Capita Income": "per_capita_income",
    "Unemployment": "unemployment",
    "Below Poverty Level": "below_poverty_level",
}


def area_text(text: Column) -> Column:
    """Community area as text: whole floats lose their decimals, 0 and blanks become ''."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"\.0+$", "")
    return F.when(trimmed == "0", F.lit("")).otherwise(trimmed)


def _cast(name: str, kind: str, zero_is_null: bool) -> Column:
    c = F.col(name)
    if kind == "area":
        return area_text(c)
    if kind == "string":
        return c
    if kind == "long":
        # "12.0" is a whole number too.
        value = c.try_cast("double").try_cast("long")
    elif kind == "date":
        value = F.substring(c, 1, 10).try_cast("date")
    else:
        value = c.try_cast(kind)
    keeps_zero = kind not in ("long", "double") or name.endswith(("latitude", "longitude"))
    return value if keeps_zero or not zero_is_null else F.nullif(value, F.lit(0).cast(kind))


def typed(raw: DataFrame, dataset: Dataset, zero_is_null: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text fields to their types; ``keep`` names further columns that stay as they are.

    ``zero_is_null`` reproduces the published extractors, whose writer leaves out
    zero numbers: a true 0 then arrives as NULL, except in coordinates. A missing
    coordinate becomes 0 there and fails the bounds filter later on.
    """
    cols = []
    for name, kind in dataset.types.items():
        value = _cast(name, kind, zero_is_null)
        if zero_is_null and name.endswith(("latitude", "longitude")) and dataset.name != "tnp":
            value = F.coalesce(value, F.lit(0.0))
        cols.append(value.alias(name))
    return raw.select(*cols, *keep)


#: The column of a raw row that holds its line where that is no JSON object.
MALFORMED = "_malformed"
#: What a raw row knows of its file.
FILE = {"file_uri": "file_path", "size_bytes": "file_size", "created_at": "file_modification_time"}
#: Columns of the quarantine: which data set and file, why, and the record as it came.
QUARANTINE = ("dataset", "file_uri", "reason", "record")


def raw(reader: DataFrameReader | DataStreamReader, path: str, dataset: Dataset) -> DataFrame:
    """Landing lines with text fields, their line where it is malformed, and their file. Blank lines are none.

    The schema is declared, so no inference pass runs, and a line is parsed once. A line has to begin with an object;
    what stands behind it is not looked at.
    """
    schema = T.StructType([*dataset.read_schema, T.StructField(MALFORMED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    file = [F.col(f"_metadata.{c}").alias(n) for n, c in FILE.items()]
    lines = reader.text(path).select("value", *file).filter("trim(value) != ''")
    return lines.select(F.inline(F.array(F.from_json("value", schema, options))), *FILE)


def is_malformed() -> Column:
    return F.col(MALFORMED).isNotNull()


def read(spark: SparkSession, path: str, dataset: Dataset, zero_is_null: bool = False) -> DataFrame:
    """A landing folder as typed rows, without malformed lines, which ``malformed`` returns."""
    return typed(raw(spark.read, path, dataset).filter(~is_malformed()), dataset, zero_is_null)


def set_apart(rows: DataFrame, dataset: Dataset, reason: str, record: Column, file_uri: Column) -> DataFrame:
    """Rows in the columns of the quarantine."""
    values = (F.lit(dataset.name), file_uri.cast("string"), F.lit(reason), record)
    return rows.select(*(v.alias(n) for n, v in zip(QUARANTINE, values)))


def malformed(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """The lines of a landing folder that are no JSON objects, for the quarantine."""
    return malformed_of(raw(spark.read, path, dataset), dataset)


def malformed_of(lines: DataFrame, dataset: Dataset) -> DataFrame:
    return set_apart(lines.filter(is_malformed()), dataset, "malformed line", F.col(MALFORMED), F.col("file_uri"))


def without_key(rows: DataFrame, dataset: Dataset, file_uri: Column | None = None) -> DataFrame:
    """Rows that lack a part of their key, which ``new_rows`` cannot load, for the quarantine."""
    lacking = reduce(Column.__or__, (F.col(k).isNull() for k in dataset.key))
    uri = F.lit(None) if file_uri is None else file_uri
    return set_apart(rows.filter(lacking), dataset, "missing key", F.to_json(F.struct(*dataset.types)), uri)


def quarantine_counts(found: DataFrame) -> DataFrame:
    """Records by data set, file and reason."""
    return found.groupBy("dataset", "file_uri", "reason").agg(F.count("*").alias("records"))


def read_csv(spark: SparkSession, path: str, headers: dict[str, str], numbers: tuple[str, ...] = ()) -> DataFrame:
    """A table with spaced headers as renamed columns."""
    raw = spark.read.option("header", True).csv(path)
    renamed = raw.select(*[F.col(f"`{h}`").alias(n) for h, n in headers.items() if h in raw.columns])
    return renamed.withColumns({n: F.col(n).try_cast("double") for n in numbers if n in renamed.columns})


def rows_on(df: DataFrame, day: str, wanted) -> DataFrame:
    """Row count of one date, for the check after a load."""
    return df.filter(dated(F.col(day), wanted, wanted)).agg(F.count(F.lit(1)).alias("rows"))


def new_rows(target: DataFrame, source: DataFrame, key: tuple[str, ...] | list[str]) -> DataFrame:
    """Rows of ``source`` whose key the target does not hold, one per key.

    Which of several equal keys stays is decided by the largest row value, so a
    rerun keeps the same one. Rows without a full key are no part of it, as a key
    constraint would reject them; ``without_key`` returns those.
    """
    key = list(key)
    others = [c for c in source.columns if c not in key]
    keyed = source.dropna(subset=key)
    one = keyed.groupBy(*key).agg(F.max(F.struct(*others)).alias("_row")) if others else keyed.distinct()
    flat = one.select(*key, "_row.*") if others else one
    return flat.join(target.select(*key), key, "left_anti").select(*source.columns)


def load_new(spark: SparkSession, rows: DataFrame, dataset: Dataset, path: str, partition: str) -> None:
    """Append the rows whose key the stored table does not hold yet; few keys are looked up only where files may hold them."""
    with tables.staged(rows) as ready:
        target = tables.probe(tables.read_or_empty(spark, path, ready).select(*dataset.key), ready, list(dataset.key))
        with tables.staged(new_rows(target, ready, dataset.key)) as fresh:
            tables.write(fresh, path, partition, mode="append", keys=dataset.key)


def load_profile(df: DataFrame, day: str) -> DataFrame:
    """Rows, first and last day of a load, and its rows per day, in one table."""
    per_day = df.groupBy(F.to_date(day).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    whole = per_day.agg(
        F.sum("rows").alias("total_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
    return per_day.crossJoin(F.broadcast(whole))
