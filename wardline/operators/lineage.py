"""File manifest of the landing zone, and the questions asked of it."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import percent, tally
from wardline.sources import landing


# The columns of the manifest table.
MANIFEST = {
    "file_uri": "string",
    "dataset": "string",
    "partition_date": "date",
    "row_count": "bigint",
    "size_bytes": "bigint",
    "sha256_checksum": "string",
    "created_at": "timestamp",
    "extractor_version": "string",
    "api_endpoint": "string",
    "extraction_duration_seconds": "bigint",
    "validation_status": "string",
    "validation_timestamp": "timestamp",
    "validation_checks_passed": "bigint",
    "validation_checks_failed": "bigint",
    "validation_error_message": "string",
    "loaded_to_bronze": "boolean",
    "bronze_table": "string",
    "bronze_partition": "string",
    "bronze_loaded_at": "timestamp",
    "bronze_load_job_id": "string",
    "bronze_rows_loaded": "bigint",
    "processing_stage": "string",
    "quarantined": "boolean",
    "quarantine_reason": "string",
}


def checksums(files: DataFrame) -> DataFrame:
    """SHA-256 of whole files, from a ``binaryFile`` scan: ``file_uri, sha256_checksum``."""
    return files.select(F.col("path").alias("file_uri"), F.sha2("content", 256).alias("sha256_checksum"))


def manifest(
    landed: DataFrame,
    dataset: str,
    day: str,
    broken_row: Column | dict[str, Column],
    now: datetime | None = None,
    extractor_version: str | None = None,
    api_endpoint: str | None = None,
    extraction_seconds: int | None = None,
    checks: DataFrame | None = None,
    loads: DataFrame | None = None,
) -> DataFrame:
    """One row per landed file with its size, verdict, load and stage, in the columns of ``MANIFEST``.

    ``broken_row`` marks bad rows, by the name of the check where there are several; a file that fails a check is
    quarantined, with the failed checks as the reason. ``checks`` holds checksums by ``file_uri``. ``loads`` says
    what reached bronze: ``file_uri, bronze_table, bronze_partition, bronze_loaded_at, bronze_load_job_id,
    bronze_rows_loaded``. ``now`` is the time of validation. Rows either come straight from files or carry the columns of
    ``landing.FILE``.
    """
    broken = broken_row if isinstance(broken_row, dict) else {"row_check": broken_row}
    told_of = [F.col(n) if n in landed.columns else F.col(f"_metadata.{c}").alias(n) for n, c in landing.FILE.items()]
    per_file = landed.select(
        *told_of,
        F.to_date(day).alias("d"),
        *[bad.alias(f"bad_{n}") for n, bad in broken.items()],
    ).groupBy("file_uri", "size_bytes", "created_at")
    counted = per_file.agg(
        F.min("d").alias("partition_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.array(*[F.struct(F.lit(n).alias("name"), tally(F.col(f"bad_{n}")).alias("rows")) for n in broken]).alias("checks"),
    )
    failed = F.filter("checks", lambda c: c["rows"] > 0)
    told = F.array_join(F.transform(failed, lambda c: F.concat(c["name"], F.lit(": "), c["rows"].cast("string"), F.lit(" rows"))), ", ")
    is_bad = F.size(failed) > 0
    out = counted
    for more in (checks, loads):
        if more is not None:
            out = out.join(more, "file_uri", "left")
    have = set(out.columns)
    value = lambda c, kind: (F.col(c) if c in have else F.lit(None)).cast(kind)
    loaded = value("bronze_table", "string").isNotNull() & ~is_bad
    fresh = {
        "dataset": F.lit(dataset),
        "extractor_version": F.lit(extractor_version),
        "api_endpoint": F.lit(api_endpoint),
        "extraction_duration_seconds": F.lit(extraction_seconds),
        "validation_status": F.when(is_bad, "failed").otherwise("passed"),
        "validation_timestamp": F.lit(now),
        "validation_checks_passed": F.size("checks") - F.size(failed),
        "validation_checks_failed": F.size(failed),
        "validation_error_message": F.when(is_bad, told),
        "loaded_to_bronze": loaded,
        "processing_stage": F.when(is_bad, "quarantined").when(loaded, "bronze").otherwise("validated"),
        "quarantined": is_bad,
        "quarantine_reason": F.when(is_bad, told),
    }
    return out.select(*[(fresh[c].cast(t) if c in fresh else value(c, t)).alias(c) for c, t in MANIFEST.items()])


def split_quarantine(landed: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of good files and rows of quarantined files."""
    tagged = landed.withColumn("file_uri", F.col("_metadata.file_path"))
    bad = files.filter("quarantined").select("file_uri")
    return (
        tagged.join(bad, "file_uri", "left_anti"),
        tagged.join(bad, "file_uri", "left_semi"),
    )


def freshness(files: DataFrame, now: datetime) -> DataFrame:
    """Latest date, whole hours since the last load, files and rows per data set.

    ``now`` is a wall time in the zone of the session.
    """
    until = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    gone = F.timestamp_diff("SECOND", F.max("created_at").cast("timestamp_ntz"), until) / 3600
    return (
        files.filter("loaded_to_bronze")
        .groupBy("dataset")
        .agg(
            F.max("partition_date").alias("latest_data_date"),
            F.floor(gone).alias("hours_since_last_load"),
            F.count(F.lit(1)).alias("total_files"),
            F.sum("row_count").alias("total_rows"),
        )
    )


def success_rate(files: DataFrame, cfg: Settings, days: int = 30) -> DataFrame:
    of = lambda s: tally(F.col("validation_status") == s)
    total = F.count(F.lit(1))
    return (
        files.filter(F.col("partition_date") >= F.lit(cfg.as_of - timedelta(days=days)))
        .groupBy("dataset")
        .agg(
            total.alias("total_files"),
            of("passed").alias("passed"),
            of("failed").alias("failed"),
            percent(of("passed"), total).alias("success_rate_pct"),
        )
    )


def missing_dates(files: DataFrame, dataset: str, start: date, end: date) -> DataFrame:
    """Days of the range without a loaded file."""
    loaded = files.filter((F.col("dataset") == dataset) & F.col("loaded_to_bronze")).select(
        F.col("partition_date").alias("missing_date")
    )
    calendar = files.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("missing_date")
    )
    return calendar.join(loaded.distinct(), "missing_date", "left_anti")


def find_file(files: DataFrame, uri: str) -> DataFrame:
    return files.filter(F.col("file_uri") == uri)
