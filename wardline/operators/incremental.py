"""Keyed upserts and date-range replacement."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.columns import dated
from wardline.sources import tables


def increment(source: DataFrame, target: DataFrame, day: str, cfg: Settings) -> DataFrame:
    """Rows of the last ``increment_days`` days, or all rows while the target is empty.

    The window is on the record's own date, so a late change of an older record is
    not part of it.
    """
    if target.isEmpty():
        return source
    return source.filter(F.col(day) >= F.lit(cfg.as_of - timedelta(days=cfg.increment_days)))


def _keyed(keys: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))


def latest_per_key(source: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """One row per key: the latest ``version``, then the largest row hash. Rows without a full key stay as they are.

    A maximum over a struct combines before the shuffle, so a key with very many
    versions costs no more than any other.
    """
    others = [c for c in source.columns if c not in keys]
    keyed = source.filter(_keyed(keys))
    if others:
        order = [F.col(version)] if version else []
        choice = F.struct(*order, F.xxhash64(*others))
        one = keyed.groupBy(*keys).agg(F.max_by(F.struct(*others), choice).alias("_row"))
        keyed = one.select(*keys, "_row.*").select(*source.columns)
    else:
        keyed = keyed.distinct()
    return keyed.unionByName(source.filter(~_keyed(keys)))


def keyless(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows without a full key that the target lacks, compared as whole rows.

    NULL equals nothing, so such rows match no key and none replaces another. To let a job run twice, a row goes in only
    as often as the source has it beyond the target's equal rows.
    """
    names = source.columns
    rows = source.filter(~_keyed(keys)).select(*names, F.lit(1).alias("_n"))
    there = target.filter(~_keyed(keys)).select(*names, F.lit(-1).alias("_n"))
    counted = rows.unionByName(there).groupBy(*names).agg(F.sum("_n").cast("int").alias("_n")).filter("_n > 0")
    return counted.withColumn("_n", F.explode(F.sequence(F.lit(1), "_n"))).select(*names)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """Target rows without a match in the source, and all source rows, one per key; for those without one see ``keyless``."""
    source = source.select(*target.columns)
    fresh = latest_per_key(source.filter(_keyed(keys)), keys, version)
    kept = target.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh).unionByName(keyless(target, source, keys))


@dataclass(frozen=True)
class Applied:
    """Days a table change wrote and days it emptied; None stands for rows without a day."""

    written: list[date | None]
    emptied: list[date | None]


def apply_upsert(
    source: DataFrame, path: str, keys: list[str], partition: str, version: str | None = None
) -> Applied:
    """Upsert into a partitioned table, rewriting only the days it touches.

    Touched days are those of the source and those that matched rows are in now,
    because an update can move a row to another day. Rows without a day have a
    folder of their own and are merged like any other day's. A change that an
    earlier driver left half-done is finished first.
    """
    with tables.staged(latest_per_key(source, keys, version)) as fresh:
        return _merge(fresh, path, keys, partition)


def _merge(fresh: DataFrame, path: str, keys: list[str], partition: str) -> Applied:
    spark = fresh.sparkSession
    tables.recover(spark, path)
    if not tables.exists(spark, path):
        tables.overwrite_days(fresh, path, partition, keys)
        return Applied(tables.days_in(fresh, partition), [])
    target = tables.read_or_empty(spark, path, fresh)
    known = fresh.filter(_keyed(keys)).select(*keys)
    # Only the keys are read, and few keys only where files may hold them.
    now = tables.probe(target.select(*keys, partition), known, keys)
    moved = tables.days_in(now.join(known, keys, "left_semi"), partition)
    touched = tables.in_order([*moved, *tables.days_in(fresh, partition)])
    # The list of days goes into the filter as literals: only these folders are read.
    here = target.filter(tables.on_days(partition, touched))
    names = here.columns
    merged = (
        here.join(known, keys, "left_anti")
        .unionByName(fresh.filter(_keyed(keys)).select(*names))
        .unionByName(keyless(here, fresh.select(*names), keys))
    )
    return Applied(*tables.change_days(spark, merged, path, partition, touched, keys))


def replace_days(
    target: DataFrame, fresh: DataFrame, day: str, start: date, end: date, keep=None
) -> DataFrame:
    """Target with the rows of a date range replaced by ``fresh``.

    ``keep`` marks rows of the range that stay, such as another source's rows in a
    shared table.
    """
    outside = ~F.coalesce(dated(F.col(day), start, end), F.lit(False))
    stays = outside if keep is None else outside | keep
    return target.filter(stays).unionByName(fresh.filter(dated(F.col(day), start, end)).select(*target.columns))
