"""Quality reports, check tables, load gates and expectations.

Every report is one aggregation pass over its table; the one-row result is turned
into rows afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardline.config import Bounds, Settings
from wardline.functions.columns import all_of, dated, exact_mean, half_up, percent, ratio, tally, uncut_mean, within
from wardline.sources import tables


def rows() -> Column:
    return F.count(F.lit(1))


def permits_report(clean: DataFrame, cfg: Settings) -> DataFrame:
    """Total and share per quality flag, as (metric, value, percentage) with values as text.

    The shares come from counts per flag, so the table is read once.
    """
    per_flag = clean.groupBy("data_quality_flag").agg(
        rows().alias("everything"), tally(F.col("issue_date") >= F.lit(cfg.min_date)).alias("n")
    )
    # One row per flag of a fixed set, gathered in one row with their totals.
    flag = F.struct(F.col("data_quality_flag").alias("value"), "n")
    whole = per_flag.agg(
        F.sum("everything").alias("t"), F.sum("n").alias("tn"), F.collect_list(F.when(F.col("n") > 0, flag)).alias("flags")
    )
    line = lambda metric, value, percentage: F.struct(
        F.lit(metric).alias("metric"), value.alias("value"), percentage.alias("percentage")
    )
    head = line("Total Records", F.coalesce("tn", F.lit(0)).cast("string"), F.lit(None).cast("double"))
    shares = F.transform("flags", lambda f: line("Records by Quality Flag", f["value"], percent(f["n"], F.col("t"))))
    return whole.select(F.inline(F.concat(F.array(head), shares)))


def _as_rows(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "metric", "value")


def covid_report(clean: DataFrame) -> DataFrame:
    figures = {
        "Total Records": rows().cast("string"),
        "Unique ZIP Codes": F.count_distinct("zip_code").cast("string"),
        "Unique Weeks": F.count_distinct("week_start_date").cast("string"),
        "Records with Privacy Suppression": tally(F.col("privacy_flag") == "suppressed_low_count").cast("string"),
        "Total Cases (non-suppressed)": F.format_number(F.sum("cases_weekly"), 0),
    }
    return _as_rows(clean.agg(*[c.alias(n) for n, c in figures.items()]))


def taxi_report(recent: DataFrame) -> DataFrame:
    two = lambda c: half_up(c, 2).cast("decimal(38,2)").cast("string")
    valid = ratio(tally(F.col("data_quality_flag") == "valid"), rows(), 100.0)
    figures = {
        "Total Records (Last 30 Days)": F.format_number(rows(), 0),
        "Average Trip Miles": two(uncut_mean(F.col("trip_miles"))),
        "Average Fare": F.concat(F.lit("$"), two(exact_mean(F.col("trip_total")))),
        "Valid Data %": F.concat(half_up(valid, 1).cast("decimal(38,1)").cast("string"), F.lit("%")),
    }
    return _as_rows(recent.agg(*[c.alias(n) for n, c in figures.items()]))


# ---------------------------------------------------------------- check table


@dataclass(frozen=True)
class Check:
    """``good`` rows out of the rows ``considered``; passes at ``at_least``."""

    name: str
    kind: str
    expected: float
    good: Column
    at_least: float
    considered: Column | None = None
    unique_key: str | None = None


# Names, kinds, expected percentages and thresholds of the documented checks.
def permit_checks(b: Bounds, max_fee: float) -> list[Check]:
    has = lambda *cs: all_of(F.col(c).isNotNull() for c in cs)
    return [
        Check("permit_number_not_null", "completeness", 100.0, has("permit_"), 0.95),
        Check("coordinates_present", "completeness", 90.0, has("latitude", "longitude"), 0.80),
        Check(
            "coordinates_valid_range",
            "validity",
            95.0,
            within(F.col("latitude"), F.col("longitude"), b),
            0.95,
            has("latitude"),
        ),
        Check("total_fee_reasonable", "validity", 98.0, F.col("total_fee").between(0, max_fee), 0.95, has("total_fee")),
        Check("permit_number_unique", "uniqueness", 100.0, F.lit(True), 1.0, unique_key="permit_"),
    ]


def check_table(
    df: DataFrame, checks: Sequence[Check], dataset: str, check_date: date, day: str | None = None
) -> DataFrame:
    """One row per check with expected and actual percentage, verdict and failed rows.

    With ``day``, only rows of the day before ``check_date`` are checked; without, the whole table.
    Plain checks share one scan. A uniqueness check counts rows per key first, so
    a key that many rows share is combined before the shuffle.
    """
    if day:
        before = check_date - timedelta(days=1)
        df = df.filter(dated(F.col(day), before, before))
    plain = [c for c in checks if c.unique_key is None]
    unique = [c for c in checks if c.unique_key is not None]
    counted = df.agg(
        *[F.struct(good.alias("good"), seen.alias("seen")).alias(n) for n, (good, seen) in check_measures(plain).items()]
    )
    parts = [counted.unpivot([], [c.name for c in plain], "check_name", "v").select("check_name", "v.good", "v.seen")]
    return _check_rows(parts + _unique_checks(df, unique), checks, dataset, check_date)


def check_measures(checks: Sequence[Check]) -> dict[str, tuple[Column, Column]]:
    """Rows that hold and rows that count, for checks that one pass can measure."""
    return {
        c.name: (
            tally(c.good if c.considered is None else c.considered & c.good),
            rows() if c.considered is None else tally(c.considered),
        )
        for c in checks
        if c.unique_key is None
    }


def _unique_checks(df: DataFrame, checks: Sequence[Check]) -> list[DataFrame]:
    return [
        df.groupBy(c.unique_key)
        .agg(rows().alias("n"))
        .agg(
            F.lit(c.name).alias("check_name"),
            F.count(c.unique_key).alias("good"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("seen"),
        )
        for c in checks
        if c.unique_key is not None
    ]


def _check_rows(parts: list[DataFrame], checks: Sequence[Check], dataset: str, check_date: date) -> DataFrame:
    results = reduce(DataFrame.unionByName, parts)
    by_name = lambda value: F.create_map(*[x for c in checks for x in (F.lit(c.name), F.lit(value(c)))])[
        F.col("check_name")
    ]
    share = F.try_divide(F.col("good"), F.col("seen"))
    return results.select(
        F.lit(check_date).alias("check_date"),
        F.lit(dataset).alias("dataset_name"),
        "check_name",
        by_name(lambda c: c.kind).alias("check_type"),
        by_name(lambda c: c.expected).alias("expected_value"),
        half_up(share * 100, 2).alias("actual_value"),
        (share >= by_name(lambda c: c.at_least)).alias("passed"),
        F.col("seen").alias("row_count"),
        (F.col("seen") - F.col("good")).alias("failed_row_count"),
    )


# Verdict labels of the check report.
PASS, FAIL = "✅ PASS", "❌ FAIL"


def check_report(checks: DataFrame, cfg: Settings, days: int = 7) -> DataFrame:
    return checks.filter(F.col("check_date") >= F.lit(cfg.as_of - timedelta(days=days))).withColumn(
        "status", F.when(F.col("passed"), PASS).otherwise(FAIL)
    )


# ---------------------------------------------------------------- load gates


class GateFailed(RuntimeError):
    """A critical gate did not hold; nothing may be loaded."""


def _gate_spec(cfg: Settings, key: str, day: str) -> dict[str, tuple[str, float, Column]]:
    """Severity, threshold and measure of each gate; names and thresholds are fixed values."""
    missing_key = F.col(key).isNull() | (F.col(key) == "")
    far = F.col(day) > F.add_months(F.lit(cfg.as_of), 12)
    no_place = F.coalesce((F.col("latitude") == 0) | (F.col("longitude") == 0), F.lit(True))
    share = lambda bad: F.coalesce(ratio(tally(bad), rows(), 100.0), F.lit(0.0))
    return {
        "non_zero_record_count": ("CRITICAL", 1.0, rows().cast("double")),
        "permit_number_not_null": ("CRITICAL", 5.0, share(missing_key)),
        "issue_date_not_future": ("WARNING", 10.0, share(far)),
        "coordinates_present": ("INFO", 20.0, share(no_place)),
    }


def _gate_rows(long: DataFrame, spec: dict[str, tuple[str, float, Column]]) -> DataFrame:
    pick = lambda i: F.create_map(*[x for n, v in spec.items() for x in (F.lit(n), F.lit(v[i]))])[F.col("name")]
    actual, threshold = F.col("actual_value"), F.col("threshold")
    return (
        long.withColumns({"severity": pick(0), "threshold": pick(1)})
        .withColumn(
            "passed",
            F.when(F.col("name") == "non_zero_record_count", actual >= threshold).otherwise(actual <= threshold),
        )
        .select("name", "severity", "threshold", half_up(actual, 6).alias("actual_value"), "passed")
    )


def gates(df: DataFrame, cfg: Settings, key: str = "permit_", day: str = "issue_date") -> DataFrame:
    """Gates before a load, as (name, severity, threshold, actual_value, passed)."""
    spec = _gate_spec(cfg, key, day)
    long = df.agg(*[v.alias(n) for n, (_, _, v) in spec.items()]).unpivot([], list(spec), "name", "actual_value")
    return _gate_rows(long, spec)


def load_gated(
    df: DataFrame, cfg: Settings, load: Callable[[DataFrame], object], key: str = "permit_", day: str = "issue_date"
) -> DataFrame:
    """Gates measured while the rows are written to a copy: the input is read once. Returns the verdicts.

    ``load`` gets the copy. It is not called when a critical gate fails, which raises.
    """
    spec = _gate_spec(cfg, key, day)
    watch = Observation("gates")
    with tables.staged(df.observe(watch, *[v.alias(n) for n, (_, _, v) in spec.items()])) as copy:
        verdicts = _gate_rows(df.sparkSession.createDataFrame(list(watch.get.items()), "name string, actual_value double"), spec)
        enforce(verdicts)
        load(copy)
    return verdicts


def write_checked(
    df: DataFrame,
    write: Callable[[DataFrame], object],
    stored: Callable[[], DataFrame],
    checks: Sequence[Check],
    dataset: str,
    check_date: date,
) -> DataFrame:
    """``check_table`` of rows as they are written: plain checks are measured by the write, with no scan of their own.

    ``write`` writes the rows it is given in one job; ``stored`` reads them back, where only a uniqueness check reads its
    key.
    """
    watch, measures = Observation("checks"), check_measures(checks)
    write(df.observe(watch, *[c.alias(f"{n}_{k}") for n, both in measures.items() for k, c in zip(("good", "seen"), both)]))
    found = [(n, watch.get[f"{n}_good"], watch.get[f"{n}_seen"]) for n in measures]
    measured = df.sparkSession.createDataFrame(found, "check_name string, good long, seen long")
    return _check_rows([measured, *_unique_checks(stored(), checks)], checks, dataset, check_date)


def enforce(gate_rows: DataFrame) -> None:
    """Raise when a critical gate failed. Reads at most one row per gate."""
    failed = [r["name"] for r in gate_rows.filter("NOT passed AND severity = 'CRITICAL'").collect()]
    if failed:
        raise GateFailed(", ".join(sorted(failed)))


# ---------------------------------------------------------------- expectations


@dataclass(frozen=True)
class Expectation:
    """A rule over one column, or over the row count."""

    name: str
    rule: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    members: tuple[str, ...] = ()
    pattern: str | None = None


# The documented rule set for taxi files.
TAXI_EXPECTATIONS = [
    Expectation("trip_id_not_null", "not_null", "trip_id"),
    Expectation("fare_valid_range", "between", "fare", 0, 1000),
    Expectation("trip_miles_valid", "between", "trip_miles", 0, 500),
    Expectation("coordinates_not_null", "not_null", "pickup_centroid_latitude"),
    Expectation(
        "payment_type_valid",
        "in_set",
        "payment_type",
        members=("Cash", "Credit Card", "Mobile", "Prcard", "Unknown", "No Charge", "Dispute"),
    ),
    Expectation(
        "timestamp_format", "matches", "trip_start_timestamp", pattern=r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}"
    ),
    Expectation("unique_trip_ids", "unique", "trip_id"),
    Expectation("row_count_reasonable", "row_count", low=100, high=1_000_000),
]


def _unexpected(e: Expectation) -> Column:
    c = F.col(e.column)
    return {
        "not_null": lambda: c.isNull(),
        "between": lambda: c.isNotNull() & ~c.between(e.low, e.high),
        "in_set": lambda: c.isNotNull() & ~c.isin(*e.members),
        "matches": lambda: c.isNotNull() & ~c.cast("string").rlike(e.pattern or ""),
    }[e.rule]()


def expectations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: rows seen, rows that break it, verdict.

    Row and row-count rules share one scan. A uniqueness rule counts the rows whose key occurs
    more than once, from counts per key.
    """
    scanned = [e for e in rules if e.rule != "unique"]
    broken = lambda e: (
        F.when(rows().between(e.low, e.high), F.lit(0)).otherwise(F.lit(1)).cast("long")
        if e.rule == "row_count"
        else tally(_unexpected(e))
    )
    one = df.agg(rows().alias("_rows"), *[broken(e).alias(e.name) for e in scanned])
    parts = [
        one.unpivot(["_rows"], [e.name for e in scanned], "expectation", "unexpected_count").select(
            "expectation", "_rows", "unexpected_count", (F.col("unexpected_count") == 0).alias("success")
        )
    ]
    for e in rules:
        if e.rule == "unique":
            keys = df.groupBy(e.column).agg(rows().alias("n"))
            repeated = F.col(e.column).isNotNull() & (F.col("n") > 1)
            parts.append(
                keys.agg(
                    F.lit(e.name).alias("expectation"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("_rows"),
                    F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("unexpected_count"),
                ).withColumn("success", F.col("unexpected_count") == 0)
            )
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("_rows", "element_count")
