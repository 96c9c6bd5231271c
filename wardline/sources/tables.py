"""Partitioned parquet tables: writing, replacing days, archiving and removing days.

Days are partition folders, so replacing or dropping a day never touches another
one. A replacement is written as a copy in the shared folder first: a lost
executor then repeats a task, not the merge, and the target is only touched by a
plain copy of finished rows. A small journal in the table's folder names that copy
and the days to write and to drop, so a driver lost half-way leaves a change that
the next one finishes. One writer at a time changes a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.session import shared_dir

#: The folder name of rows whose partition value is NULL.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


#: The journal of a change that is under way, in the table's own folder.
JOURNAL = "_change.json"
#: Keys that a lookup names one by one, for the filters that files keep.
PROBE_KEYS = 1000


def _writer(df: DataFrame, keys: Iterable[str] = ()) -> DataFrameWriter:
    """A parquet writer whose files can tell for each row group whether it may hold a key."""
    writer = df.write.option("compression", "snappy")
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer


def write(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    sort: tuple[str | Column, ...] = (),
    mode: str = "overwrite",
    keys: Iterable[str] = (),
) -> None:
    """Write a table. ``mode`` is overwrite, append, ignore (create if missing) or error.

    Rows are brought together by day with a rebalance, which adaptive execution
    splits where one busy day would become one task; sorting inside a task keeps
    min/max ranges of the sort columns narrow. ``keys`` are columns for ``probe``.
    """
    out = df
    if partition:
        out = df.hint("rebalance", partition).sortWithinPartitions(partition, *sort)
    writer = _writer(out, keys).mode(mode)
    if partition:
        writer = writer.partitionBy(partition).option("partitionOverwriteMode", "static")
    writer.parquet(path)


def create_view(df: DataFrame, name: str) -> None:
    """A named lazy query."""
    df.createOrReplaceTempView(name)


def interleaved(*columns: Column, bits: int = 8) -> Column:
    """A sort key that keeps rows near each other which are near in every column, for ``write(sort=..)``.

    Columns are whole numbers, or text of one, from 0 to 2^bits - 1 (others count as the nearest, NULL as 0). Their bits
    take turns, so a filter on any one of the columns finds its rows in few row groups, not on the first alone.
    """
    places = [F.greatest(F.lit(0), F.least(F.coalesce(c.try_cast("long"), F.lit(0)), F.lit((1 << bits) - 1))) for c in columns]
    n = len(places)
    parts = [F.shiftleft(F.shiftright(p, b).bitwiseAND(1), b * n + n - 1 - i) for i, p in enumerate(places) for b in range(bits)]
    return reduce(Column.bitwiseOR, parts)


def probe(target: DataFrame, source: DataFrame, keys: list[str], most: int = PROBE_KEYS) -> DataFrame:
    """Rows of ``target`` that may have a key of ``source``.

    Up to ``most`` keys are named one by one, so that row groups whose filters or ranges rule all of them out are not
    read. More keys than that leave the scan as it is. Keys that hold a NULL match nothing.
    """
    few = source.select(*keys).dropna().distinct().limit(most + 1).collect()
    if len(few) > most:
        return target
    for k in keys:
        values = sorted({r[k] for r in few})
        # Lists of up to ten are tested value by value in the files, longer ones by their range only.
        tens = [F.col(k).isin(values[i : i + 10]) for i in range(0, len(values), 10)]
        target = target.filter(reduce(Column.__or__, tens, F.lit(False)))
    return target


def exists(spark: SparkSession, path: str) -> bool:
    """True if the folder holds anything but hidden files."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or an empty one shaped like ``like`` when there is none."""
    if exists(spark, path):
        return spark.read.schema(like.schema).parquet(path)
    return spark.createDataFrame([], like.schema)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """A written copy of ``df`` in the shared folder, there for the length of the block."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def overwrite_days(df: DataFrame, path: str, partition: str, keys: Iterable[str] = ()) -> None:
    """Replace exactly the days that occur in ``df``."""
    (
        _writer(df.hint("rebalance", partition), keys)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def days_in(df: DataFrame, partition: str) -> list[date | None]:
    """Distinct days of a table, as many as the calendar has; None, last, for rows without a day."""
    return in_order(r[0] for r in df.select(partition).distinct().collect())


def in_order(days: Iterable[date | None]) -> list[date | None]:
    """Distinct days in order, None last."""
    return sorted(set(days), key=lambda d: (d is None, d or date.min))


def on_days(partition: str, days: list[date | None]) -> Column:
    """True for rows of the given days, None standing for rows without a day. Prunes folders."""
    dated = F.col(partition).isin([d for d in days if d is not None])
    return dated | F.col(partition).isNull() if None in days else dated


def drop_days(spark: SparkSession, path: str, partition: str, days: list[date | None]) -> None:
    """Remove the folders of the given days; None is the folder of rows without a day."""
    for day in days:
        fs, p = _fs(spark, f"{path}/{partition}={day.isoformat() if day else NO_DAY}")
        if fs.exists(p):
            fs.delete(p, True)


def change_days(
    spark: SparkSession, df: DataFrame, path: str, partition: str, touched: Iterable[date | None], keys: Iterable[str] = ()
) -> tuple[list[date | None], list[date | None]]:
    """Make ``df`` the whole content of the touched days; returns the days written and the days emptied.

    ``df`` may read the table. Whatever stops the driver once the journal is there, ``recover`` finishes the change.
    """
    copy = f"{shared_dir(spark)}/change-{uuid.uuid4().hex}"
    df.write.parquet(copy)
    written = days_in(spark.read.schema(df.schema).parquet(copy), partition)
    emptied = [d for d in in_order(touched) if d not in set(written)]
    text = lambda days: [d and d.isoformat() for d in days]
    note = {"copy": copy, "schema": df.schema.jsonValue(), "partition": partition, "keys": list(keys)}
    _put(spark, f"{path}/{JOURNAL}", json.dumps(note | {"written": text(written), "emptied": text(emptied)}))
    recover(spark, path)
    return written, emptied


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a change that its driver began to apply; True if there was one. Doing it again changes nothing."""
    found = _get(spark, f"{path}/{JOURNAL}")
    if found is None:
        return False
    note = json.loads(found)
    if note["written"]:
        ready = spark.read.schema(T.StructType.fromJson(note["schema"])).parquet(note["copy"])
        overwrite_days(ready, path, note["partition"], note["keys"])
    drop_days(spark, path, note["partition"], [d and date.fromisoformat(d) for d in note["emptied"]])
    for done in (f"{path}/{JOURNAL}", note["copy"]):
        fs, p = _fs(spark, done)
        fs.delete(p, True)
    return True


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there wholly or not at all."""
    fs, p = _fs(spark, path)
    _, half = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(half, p):
        raise RuntimeError(f"{path} is there already; another change is under way")


def _get(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_range(spark: SparkSession, df: DataFrame, path: str, partition: str, start: date, end: date) -> None:
    """Make ``df`` the whole content of the days from ``start`` to ``end``.

    Days of the range that ``df`` has no rows for are removed.
    """
    recover(spark, path)
    inside = F.col(partition).between(F.lit(start), F.lit(end))
    old_days = days_in(spark.read.parquet(path).filter(inside), partition) if exists(spark, path) else []
    change_days(spark, df.filter(inside), path, partition, old_days)


def quarter_range(year: int, quarter: int) -> tuple[date, date]:
    first = date(year, 3 * quarter - 2, 1)
    after = date(year + quarter // 4, 3 * quarter % 12 + 1, 1)
    return first, date.fromordinal(after.toordinal() - 1)


def content(df: DataFrame, partition: str) -> dict[date | None, tuple]:
    """Rows and a digest of all columns for each day, whatever the order of rows and files.

    The digest is the exact sum and the exclusive or of a hash of each row, so repeated rows count.
    """
    names = sorted(c for c in df.columns if c != partition)
    # The hash skips NULLs; which columns are NULL goes in beside the values.
    h = F.xxhash64(*names, F.concat_ws("", *(F.col(c).isNull().cast("string") for c in names)))
    per_day = df.select(partition, h.alias("h")).groupBy(partition)
    rows = per_day.agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("mix"))
    return {r[0]: (r["n"], r["total"], r["mix"]) for r in rows.collect()}


def archive_quarter(
    spark: SparkSession, path: str, partition: str, year: int, quarter: int, archive: str, delete: bool = False
) -> int:
    """Copy a quarter to the archive as snappy parquet, check the copy, then optionally drop it.

    The filter is on the partition column, so only the quarter's folders are read. Returns the number of archived
    rows. Nothing is deleted unless every day of the copy has the rows and the content digest of the table as it is
    then: a row altered, lost or added on either side stops it.
    """
    start, end = quarter_range(year, quarter)
    part = spark.read.parquet(path).filter(F.col(partition).between(F.lit(start), F.lit(end)))
    target = f"{archive}/{year}-Q{quarter}"
    _writer(part).mode("overwrite").parquet(target)
    kept, copied = content(part, partition), content(spark.read.schema(part.schema).parquet(target), partition)
    differ = tables_differ(kept, copied)
    if differ:
        raise RuntimeError(f"the archive differs from the table on {', '.join(differ)}")
    if delete:
        drop_days(spark, path, partition, list(kept))
    return sum(n for n, *_ in copied.values())


def tables_differ(kept: dict[date | None, tuple], copied: dict[date | None, tuple]) -> list[str]:
    """The days whose content is not the same, in order."""
    return [str(d) for d in in_order([*kept, *copied]) if kept.get(d) != copied.get(d)]


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
