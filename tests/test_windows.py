"""Windows of the landing and lake keys come from the events, in the queries and in their SQL."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck
from tripgate.operators.quality import GATE_CODES
from tripgate.plans import catalog, lake, queries


def test_windows_follow_the_events(spark):
    given = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert lake.event_windows(given) == (("w01", "2024-01-01", "2024-01-16"), ("w02", "2024-01-01", "2024-01-31"))
    spread = given.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 YEARS") + F.expr("make_interval(0, 0, 0, event_id % 90)"))
    first, second = lake.event_windows(spread)
    assert first[1] == second[1] and first[2] < second[2]
    assert lake.event_windows(given.where("to_date(ts) = '2024-01-05'")) == (("w01", "2024-01-05", "2024-01-06"), ("w02", "2024-01-05", "2024-01-06"))
    assert lake.event_days(given.limit(0))[0].year == 1970


@pytest.mark.parametrize("key", ["page_manifest", "extract_pages", "kpi_daily_revenue", "kpi_top_zones", "ops_metrics_sample", "quality_history", "publish_roundtrip"])
def test_keys_equal_their_sql_on_other_days(spark, tmp_path_factory, key):
    """Events of another season: nothing in the queries or their SQL knows the dates of the given tables."""
    folder = tmp_path_factory.getbasetemp() / "winter"
    if not folder.exists():
        folder.mkdir()
        # to days within standard time, as the row hash of the SQL has its offset
        duck(SF_SMALL).sql("SELECT * REPLACE (ts - INTERVAL 40 DAYS AS ts) FROM events WHERE day(ts) < 25").write_parquet(f"{folder}/events.parquet")
    sf = str(folder)
    assert compare(spark, key, catalog.QUERIES[key], catalog.ORACLE_SQL[key], sf, duck(sf))["ok"]


def test_every_violation_occurs(spark):
    seen = {code for r in queries.gate_evaluate(spark, SF_SMALL).collect() for code in r.violations.split(";") if code}
    assert seen == set(GATE_CODES)


def test_every_fault_of_a_page_is_seen(spark):
    flags = queries.bronze_integrity(spark, "/root/testdata/sf0.01").where("batch = 'faulty'").collect()
    kinds = {(r.listed, r.present, r.bytes_ok, r.sha256_ok, r.rows == r.scanned_rows) for r in flags}
    assert kinds == {(True, True, True, True, True), (True, True, True, False, True), (True, False, False, False, False),
                     (True, True, False, False, False), (False, True, False, False, False)}
    assert all(r.manifest_consistent for r in flags)


def test_statements_show_rows_in_order(spark):
    """What the SQL check, which sorts, cannot see."""
    metrics = queries.LAKE_QUERIES["ops_metrics_sample"](spark, "/root/testdata/sf0.01").collect()
    days = [r.trip_date for r in queries.LAKE_QUERIES["kpi_daily_metrics"](spark, "/root/testdata/sf0.01").collect()]
    assert len(days) == 30 and days == sorted(days) and [r.trip_date for r in metrics] == days[:20]
    assert [r["rank"] for r in queries.LAKE_QUERIES["kpi_top_zones"](spark, "/root/testdata/sf0.01").collect()] == list(range(1, 11))
    rejects = [(-r.rows_n, r.batch_id, r.reject_type, r.reject_reason) for r in queries.LAKE_QUERIES["ops_rejects_by_batch"](spark, "/root/testdata/sf0.01").collect()]
    assert rejects == sorted(rejects) and len({r[0] for r in rejects}) < len(rejects)  # ties among them
