"""Every catalog query against its SQL in another engine, on the smallest data."""

import re

import __spark_entry__ as entry
import pytest
from oracle_check import compare, connect
from wardline.plans import catalog, oracle

QUERIES, SQL = catalog.queries(), oracle.texts()
#: The smallest tables hold no row for these; any other query without rows is a fault.
EMPTY_WHEN_SMALL = {"top_hotspots", "traffic_airport"}


@pytest.fixture(scope="module")
def engine(small):
    return connect(small)


def test_every_text_has_a_query():
    assert not set(SQL) - set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def no_pairing_without_a_key(df):
    """Nested-loop joins only with a one-row aggregate, and no row-at-a-time Python."""
    text = df._jdf.queryExecution().executedPlan().toString()
    one_row = re.findall(r"BroadcastNestedLoopJoin BuildRight, (?:Cross|Inner)", text)
    assert "CartesianProduct" not in text and text.count("BroadcastNestedLoopJoin") == len(one_row)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_and_rows(spark, engine, small, name):
    df = QUERIES[name](spark, small)
    no_pairing_without_a_key(df)
    if name in SQL:
        assert compare(engine, df, SQL[name]) in (None, "no rows" if name in EMPTY_WHEN_SMALL else None)
    else:
        assert set(df.columns) & {"zip_code", "neighborhood"}


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
