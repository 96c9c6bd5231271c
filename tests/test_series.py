"""Split windows and order statistics against the plain forms they replace."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardline.operators import series
from wardline.operators.quantiles import group_median


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    out = []
    for key, n in (("hot", 1500), ("small", 5), ("one", 1)):
        day = date(2015, 1, 1)
        for _ in range(n):
            day += timedelta(days=rnd.choice([1, 2, 3, 400 if key == "small" else 4]))
            out.append((key, day, rnd.choice([None, *range(50)])))
    return spark.createDataFrame(out, "k string, d date, v int").repartition(5)


@pytest.mark.parametrize("interval", ["year", "month"])
def test_previous_value_is_lag(rows, interval):
    w = Window.partitionBy("k").orderBy("d")
    want = {(r["k"], r["d"]): r["p"] for r in rows.withColumn("p", F.lag("v").over(w)).collect()}
    got = {(r["k"], r["d"]): r["p"] for r in series.previous_value(rows, ["k"], "d", "v", "p", interval).collect()}
    assert want == got


def test_top_per_group_limits_before_the_shuffle(rows):
    out = series.top_per_group(rows.fillna(0), ["k"], [F.desc("v"), F.asc("d")], 3)
    assert sorted((r["k"], r["_rank"]) for r in out.collect()) == [("hot", 1), ("hot", 2), ("hot", 3), ("one", 1), ("small", 1), ("small", 2), ("small", 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("spread", [0.005, 0.0, 0.25, 0.5])
def test_median_is_exact(spark, spread):
    rnd = random.Random(11)
    data = [("even", float(i)) for i in range(1000)] + [("skew", rnd.choice([1.0, 2.0, 1e9, rnd.random()])) for _ in range(3001)]
    data += [("single", 4.0), ("two", 1.0), ("two", 2.0), ("null", None), ("null", 3.0)] + [("same", 7.0)] * 500
    df = spark.createDataFrame(data, "k string, v double").repartition(6)
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.expr("percentile(v, 0.5)").alias("m")).collect()}
    got = {r["k"]: r["m"] for r in group_median(df, ["k"], "v", "m", spread).collect()}
    assert got == pytest.approx(want)


def test_running_total(spark):
    df = spark.createDataFrame([(date(2024, m, 1), m) for m in (3, 1, 2)], "m date, n long")
    assert [r["c"] for r in series.running_total(df, "m", "n", "c").orderBy("m").collect()] == [1, 3, 6]
