"""A sample of the registered queries against DuckDB; checks.compare runs them all."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 21


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 70


@pytest.mark.parametrize(
    "name",
    ["events_clean", "candles_clean", "slot_aggregate", "next_open", "gold_history", "gold_daily",
     "serve_documents", "hist_interpolated", "describe", "alpha_grid", "archive_scan"],
)
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    assert difference(df, connect(SF), entry.oracle_sql()[name]) is None
