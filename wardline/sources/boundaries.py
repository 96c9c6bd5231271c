"""Polygon boundaries: GeoJSON reading, validation and name comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions import geometry as G

_POINT = T.ArrayType(T.DoubleType())
_RINGS = T.ArrayType(_POINT)
#: A comma that parts features which stand on lines of their own.
_COMMA = r",\s*$"
_POLYGON, _MULTI = T.ArrayType(_RINGS), T.ArrayType(T.ArrayType(_RINGS))


def layout_of(spark: SparkSession, path: str) -> str:
    """``lines`` if the first line that is not blank is a whole feature, else ``collection``. Reads the head of one file."""
    head = spark.read.text(path).filter("trim(value) != ''").take(1)
    kind = F.get_json_object(F.regexp_replace("value", _COMMA, ""), "$.type")
    found = spark.createDataFrame(head, "value string").select(kind.alias("kind")).first() if head else None
    return "lines" if found and found["kind"] == "Feature" else "collection"


def features(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    """One row per GeoJSON feature: its properties as a map and its geometry text.

    Reads one feature per line, where Spark splits a large file over tasks, as well as feature collections, where
    a file is one row until its features are taken apart; these are then dealt over tasks before anything in them is
    parsed. ``layout`` is ``lines`` or ``collection``; left out, the head of the first file decides for all. Lines may
    end in a comma, and a whole collection on one line is taken apart in either layout. Property names lose a
    leading colon.
    """
    layout = layout or layout_of(spark, path)
    if layout == "lines":
        text = spark.read.text(path).select(F.regexp_replace("value", _COMMA, "").alias("text")).filter("trim(text) != ''")
    else:
        text = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
    whole = F.get_json_object("text", "$.features")
    parsed = F.from_json(whole, T.ArrayType(T.StringType()))
    own = F.filter(F.split("text", "\n"), lambda s: F.length(F.trim(s)) > 0)
    taken = text.select(F.explode(F.when(whole.isNotNull(), parsed).otherwise(own)).alias("feature"))
    if layout != "lines":
        taken = taken.repartition(spark.sparkContext.defaultParallelism)
    return (
        taken.select(
            F.from_json(
                F.get_json_object("feature", "$.properties"), T.MapType(T.StringType(), T.StringType())
            ).alias("raw_properties"),
            # A JSON null reads as a missing value; the words tell the two apart.
            F.col("feature").rlike(r'"geometry"\s*:').alias("has_geometry"),
            F.col("feature").rlike(r'"coordinates"\s*:\s*null').alias("null_coordinates"),
            F.get_json_object("feature", "$.geometry").alias("geometry"),
        )
        .withColumn(
            "properties", F.transform_keys("raw_properties", lambda k, _: F.regexp_replace(k, "^:", ""))
        )
        .drop("raw_properties")
    )


def _coordinates(geometry: Column) -> Column:
    return F.get_json_object(geometry, "$.coordinates")


def parsed_rings(geometry: Column) -> Column:
    """Polygons > rings > points, from polygon or multi-polygon text; NULL for anything else."""
    kind, text = F.get_json_object(geometry, "$.type"), _coordinates(geometry)
    raw = F.when(kind == "Polygon", F.array(F.from_json(text, _POLYGON))).when(
        kind == "MultiPolygon", F.from_json(text, _MULTI)
    )
    to_point = lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))
    return F.transform(raw, lambda poly: F.transform(poly, lambda ring: F.transform(ring, to_point)))


def read(spark: SparkSession, path: str, attributes: dict[str, str]) -> DataFrame:
    """Boundaries with ``rings`` and the named properties.

    ``attributes`` maps property names to column types, such as ``{"zip": "int"}``.
    """
    return features(spark, path).select(
        *[F.col("properties")[a].try_cast(t).alias(a) for a, t in attributes.items()],
        parsed_rings(F.col("geometry")).alias("rings"),
    )


def points_in(rings: Column) -> Column:
    return F.coalesce(
        F.aggregate(F.flatten(rings), F.lit(0), lambda n, ring: n + F.coalesce(F.size(ring), F.lit(0))), F.lit(0)
    )


def validate(found: DataFrame, name: str) -> DataFrame:
    """One row per feature: verdict, geometry type, polygons and points."""
    # The texts of the verdicts are fixed values.
    g = F.col("geometry")
    kind, text = F.get_json_object(g, "$.type"), _coordinates(g)
    rings = F.col("rings")
    known = kind.isin("Polygon", "MultiPolygon")
    first = F.size(F.get(F.get(rings, 0), 0))
    reason = (
        F.when(~F.col("has_geometry"), "Missing geometry field")
        .when(g.isNull(), "Geometry is null")
        .when(kind.isNull(), "Missing geometry type")
        .when(text.isNull() & F.col("null_coordinates"), "Coordinates are null")
        .when(text.isNull(), "Missing coordinates")
        .when(~F.substring(F.ltrim(text), 1, 1).eqNullSafe("["), "Coordinates are not a list")
        .when(F.regexp_replace(text, r"\s", "") == "[]", "Coordinates array is empty")
        .when(known & F.coalesce(first < 0, F.lit(True)), F.concat(F.lit("Malformed "), kind, F.lit(" structure")))
        .when(
            known & (first < 3),
            F.concat(F.lit("First ring has only "), first.cast("string"), F.lit(" points (minimum 3 required)")),
        )
        .otherwise("Valid")
    )
    return (
        found.withColumn("rings", parsed_rings(g))
        .select(
            F.col("properties")[name].alias("name"),
            kind.alias("geometry_type"),
            reason.alias("reason"),
            (reason == "Valid").alias("is_valid"),
            F.coalesce(F.size(rings), F.lit(0)).alias("polygons"),
            points_in(rings).alias("points"),
        )
    )


def validate_rings(boundaries: DataFrame, name: str) -> DataFrame:
    """The same verdict for boundaries that are already in ring form; texts are fixed values."""
    rings = F.col("rings")
    first = F.size(F.get(F.get(rings, 0), 0))
    reason = (
        F.when(rings.isNull(), "Geometry is null")
        .when(F.size(rings) == 0, "Coordinates array is empty")
        .when(F.coalesce(first < 0, F.lit(True)), "Malformed structure")
        .when(first < 3, F.concat(F.lit("First ring has only "), first.cast("string"), F.lit(" points (minimum 3 required)")))
        .otherwise("Valid")
    )
    return boundaries.select(
        F.col(name).cast("string").alias("name"),
        reason.alias("reason"),
        (reason == "Valid").alias("is_valid"),
        F.coalesce(F.size(rings), F.lit(0)).alias("polygons"),
        points_in(rings).alias("points"),
    )


def validation_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("is_valid", "reason").agg(
        F.count(F.lit(1)).alias("features"), F.sum("points").cast("long").alias("points")
    )


def compare_names(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Names of either side, upper-cased, with where each occurs."""
    tidy = lambda df, c, side: (
        df.select(F.upper(F.col(c)).alias("name"))
        .filter((F.col("name") != "") & (F.col("name") != "NULL"))
        .withColumn("side", F.lit(side))
    )
    both = tidy(left, left_name, 1).unionByName(tidy(right, right_name, 2))
    return both.groupBy("name").agg(F.bit_or("side").alias("sides")).select(
        "name",
        F.when(F.col("sides") == 3, "both").when(F.col("sides") == 1, "left only").otherwise("right only").alias("found_in"),
    )


def from_boxes(boxes: DataFrame) -> DataFrame:
    """Rectangles (x0, y0, x1, y1) as boundaries."""
    corners = ("x0", "y0", "x1", "y1")
    return boxes.selectExpr("*", f"{G.box_rings(*corners)} AS rings").drop(*corners)
