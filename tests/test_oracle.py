"""Every registered key against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck
from tripgate.plans.catalog import ORACLE_SQL, QUERIES

KEYS = sorted(ORACLE_SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    result = compare(spark, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL, con)
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["trip_date", "trip_count", "total_revenue_usd"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["silver_clean", "silver_duplicates", "gold_daily_trip_metrics", "gate_evaluate"])
def test_driver_like_session(spark, con, key):
    """The driver's own session (UTC, ANSI on, default planner settings) gets the same results."""
    s = spark.newSession()
    s.conf.set("spark.sql.session.timeZone", "UTC")
    s.conf.set("spark.sql.ansi.enabled", "true")
    result = compare(s, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL, con)
    assert result["ok"], result
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"  # the caller's session is untouched
