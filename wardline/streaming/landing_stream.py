"""New landing files as a stream: each trigger takes the files not seen yet.

The source remembers its files in the checkpoint, and each batch is merged by key,
so a batch that runs twice after a failure leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline.operators import lineage
from wardline.operators.incremental import apply_upsert
from wardline.sources import tables
from wardline.sources.landing import FILE, MALFORMED, Dataset, is_malformed, malformed_of, raw, typed, without_key
from wardline.sources.landing import load_new as insert_new


def stream(spark: SparkSession, folder: str, dataset: Dataset, files_per_batch: int = 1000) -> DataFrame:
    """Lines of new files: the text fields, the line where it is malformed, and the file."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    return raw(reader, folder, dataset)


def _with_day(batch: DataFrame, dataset: Dataset) -> DataFrame:
    """Rows whose date does not parse are kept, in the folder of rows without a day."""
    return batch.withColumn("load_day", F.to_date(dataset.day))


def _set_apart(lines: DataFrame, dataset: Dataset, quarantine: str, batch: int, keyless: bool) -> None:
    """Bad records of a batch, in a folder of its own: a batch that runs twice overwrites what it wrote."""
    bad = malformed_of(lines, dataset)
    if keyless:
        rows = typed(lines.filter(~is_malformed()), dataset, keep=("file_uri",))
        bad = bad.unionByName(without_key(rows, dataset, F.col("file_uri")))
    bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch}")


def _note_files(lines: DataFrame, dataset: Dataset, table: str, manifest: str, batch: int) -> None:
    """Merges a row for each file of the batch into the manifest, by uri: a batch that runs twice counts once."""
    rows = typed(lines, dataset, keep=(*FILE, MALFORMED))
    per_file = lines.filter(~is_malformed()).groupBy("file_uri").agg(
        F.lit(table).alias("bronze_table"),
        F.max("created_at").alias("bronze_loaded_at"),
        F.lit(f"{dataset.name}-{batch}").alias("bronze_load_job_id"),
        F.count("*").alias("bronze_rows_loaded"),
    )
    broken = {"malformed_line": is_malformed()}
    files = lineage.manifest(rows, dataset.name, dataset.day, broken, loads=per_file)
    apply_upsert(files, manifest, ["file_uri"], "partition_date")


def load_new(
    spark: SparkSession,
    folder: str,
    dataset: Dataset,
    path: str,
    checkpoint: str,
    update: bool = False,
    quarantine: str | None = None,
    manifest: str | None = None,
) -> StreamingQuery:
    """Load all waiting files and stop.

    ``update`` replaces rows that exist already; otherwise they are left alone. Malformed lines, and rows without a key
    unless ``update`` takes them, go to the ``quarantine``, a folder beside the table by default. ``manifest`` names a
    table that keeps a row for each file (``lineage.MANIFEST``).
    """
    aside = quarantine or f"{path}_quarantine"

    def merge(batch: DataFrame, number: int) -> None:
        with tables.staged(batch) as lines:
            _set_apart(lines, dataset, aside, number, keyless=not update)
            rows = _with_day(typed(lines.filter(~is_malformed()), dataset), dataset)
            if update:
                apply_upsert(rows, path, list(dataset.key), "load_day")
            else:
                insert_new(spark, rows, dataset, path, "load_day")
            if manifest:
                _note_files(lines, dataset, path, manifest, number)

    return (
        stream(spark, folder, dataset)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
