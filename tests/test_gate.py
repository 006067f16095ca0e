"""Quality gate scenarios: one row per scenario, judged in a single job."""

from datetime import datetime, timedelta, timezone

import pytest

from tripgate.config import GatePolicy, PipelineConfig
from tripgate.operators import quality

NOW = datetime(2026, 9, 17, 10, 0, tzinfo=timezone.utc)

SCHEMA = ("scenario string, batch_id string, validation_batch_id string, manifest_batch_id string, "
          "raw_rows long, clean_rows long, rejected_rows long, duplicate_valid_rows long, "
          "silver_rows long, daily_count_sum long, metrics_count_sum long, revenue_matches boolean, "
          "gold_daily_rows long, gold_top_zones_rows long, null_zone_ranks long, extracted_at_utc string")

BASE = dict(batch_id="b1", validation_batch_id="b1", manifest_batch_id="b1",
            raw_rows=100, clean_rows=94, rejected_rows=4, duplicate_valid_rows=2,
            silver_rows=94, daily_count_sum=94, metrics_count_sum=94, revenue_matches=True,
            gold_daily_rows=2, gold_top_zones_rows=7, null_zone_ranks=0,
            extracted_at_utc=(NOW - timedelta(minutes=3)).isoformat())

SCENARIOS = {
    "pass": {},
    "reject": dict(rejected_rows=15, clean_rows=83, silver_rows=83, daily_count_sum=83, metrics_count_sum=83),
    "duplicate": dict(duplicate_valid_rows=12, clean_rows=84, silver_rows=84, daily_count_sum=84,
                      metrics_count_sum=84),
    "reconcile": dict(clean_rows=95, revenue_matches=False),
    "stale": dict(extracted_at_utc=(NOW - timedelta(days=3)).isoformat()),
    "future": dict(extracted_at_utc=(NOW + timedelta(hours=2)).isoformat()),
    "batch": dict(validation_batch_id="b2"),
    "batch_missing": dict(manifest_batch_id=None),
    "empty": dict(clean_rows=0, rejected_rows=98, silver_rows=0, daily_count_sum=0, metrics_count_sum=0),
    "bad_ts": dict(extracted_at_utc="oops"),
    "naive_ts": dict(extracted_at_utc="2026-09-17T09:57:00"),
    "zulu": dict(extracted_at_utc="2026-09-17T09:57:00Z"),
    "compact_offset": dict(extracted_at_utc="2026-09-17T09:57:00+0000"),
    "hour_offset": dict(extracted_at_utc="2026-09-17T15:27:00.5+05:30"),
    "minutes_only": dict(extracted_at_utc="2026-09-17T09:57Z"),
    "date_only": dict(extracted_at_utc="2026-09-17"),
    "age_zero": dict(extracted_at_utc=NOW.isoformat()),
    "age_limit": dict(extracted_at_utc=(NOW - timedelta(hours=24)).isoformat()),
    "age_over": dict(extracted_at_utc=(NOW - timedelta(hours=24, seconds=1)).isoformat()),
    "silver_count": dict(silver_rows=93),
    "daily_count": dict(daily_count_sum=93),
    "metrics_count": dict(metrics_count_sum=None),
    "zones_zero": dict(gold_top_zones_rows=0),
    "zones_eleven": dict(gold_top_zones_rows=11),
    "null_rank": dict(null_zone_ranks=1),
    "raw_zero": dict(raw_rows=0, clean_rows=0, rejected_rows=0, duplicate_valid_rows=0, silver_rows=0,
                     daily_count_sum=0, metrics_count_sum=0),
}


@pytest.fixture(scope="module")
def judged(spark):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = []
    for name, over in SCENARIOS.items():
        r = {**BASE, **over, "scenario": name}
        rows.append(tuple(r[c] for c in cols))
    df = spark.createDataFrame(rows, SCHEMA)
    out = quality.evaluate_gate(df, GatePolicy(), NOW)
    return {r.scenario: r for r in out.collect()}


def test_pass(judged):
    r = judged["pass"]
    assert r.status == "PASS" and r.violations == [] and r.reconciliation_delta == 0
    assert r.reject_rate == 0.04 and r.duplicate_rate == 0.02
    assert abs(r.extract_age_hours - 0.05) < 1e-12
    assert r.checked_at_utc == NOW.isoformat()


@pytest.mark.parametrize("scenario,code", [
    ("reject", "reject_rate_exceeded"),
    ("duplicate", "duplicate_rate_exceeded"),
    ("reconcile", "raw_silver_reconciliation"),
    ("reconcile", "revenue_reconciliation"),
    ("stale", "stale_or_future_extraction"),
    ("future", "stale_or_future_extraction"),
    ("batch", "batch_id_mismatch"),
    ("batch_missing", "batch_id_mismatch"),
    ("empty", "empty_clean_dataset"),
    ("bad_ts", "invalid_extraction_timestamp"),
    ("naive_ts", "invalid_extraction_timestamp"),
    ("age_over", "stale_or_future_extraction"),
    ("silver_count", "silver_materialization_mismatch"),
    ("daily_count", "daily_revenue_count_mismatch"),
    ("metrics_count", "daily_metrics_count_mismatch"),
    ("zones_zero", "top_zones_cardinality"),
    ("zones_eleven", "top_zones_cardinality"),
    ("null_rank", "null_zone_rank"),
    ("raw_zero", "reject_rate_exceeded"),
])
def test_failing_scenarios(judged, scenario, code):
    r = judged[scenario]
    assert r.status == "FAIL"
    assert code in r.violations


def test_inclusive_age_limits(judged):
    assert judged["age_zero"].status == "PASS" and judged["age_zero"].extract_age_hours == 0.0
    assert judged["age_limit"].status == "PASS" and judged["age_limit"].extract_age_hours == 24.0
    assert judged["zulu"].status == "PASS"


def test_offset_forms(judged):
    for name in ("compact_offset", "minutes_only"):
        assert judged[name].status == "PASS" and abs(judged[name].extract_age_hours - 0.05) < 1e-12
    assert abs(judged["hour_offset"].extract_age_hours - 179.5 / 3600) < 1e-9  # 09:57:00.5 UTC
    assert judged["date_only"].violations == ["invalid_extraction_timestamp"]


def test_invalid_timestamp_has_no_age(judged):
    assert judged["bad_ts"].extract_age_hours is None
    assert judged["naive_ts"].extract_age_hours is None


def test_raw_zero_rates_are_one(judged):
    r = judged["raw_zero"]
    assert r.reject_rate == 1.0 and r.duplicate_rate == 1.0
    assert r.violations[:3] == ["empty_clean_dataset", "reject_rate_exceeded", "duplicate_rate_exceeded"]


def test_violation_order(judged):
    r = judged["reconcile"]
    assert r.violations == ["raw_silver_reconciliation", "silver_materialization_mismatch",
                            "daily_revenue_count_mismatch", "daily_metrics_count_mismatch",
                            "revenue_reconciliation"]


def test_naive_now_rejected(spark):
    df = spark.createDataFrame([tuple(BASE.values())], ", ".join(SCHEMA.split(", ")[1:]))
    with pytest.raises(ValueError, match="timezone aware"):
        quality.evaluate_gate(df, GatePolicy(), datetime(2026, 9, 17, 10, 0))


def test_quality_batch_row(spark, judged):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple({**BASE, "scenario": "x"}[c] for c in cols)], SCHEMA)
    row = quality.quality_batch(quality.evaluate_gate(df, GatePolicy(), NOW), "2026-09-17T09:58:00+00:00").first()
    assert list(row.asDict()) == list(quality.QUALITY_BATCH_COLUMNS)
    assert row.gate_status == "PASS" and row.violations == "" and row.gold_top_zones_rows == 7


@pytest.mark.parametrize("kwargs,match", [
    (dict(start_date="2023-01-08", end_date="2023-01-01"), "is empty"),
    (dict(page_size=50_001), "page_size"),
    (dict(page_size=0), "page_size"),
    (dict(max_rows=0), "max_rows"),
    (dict(max_reject_rate=1.2, page_size=0), "page_size.*max_reject_rate"),
    (dict(max_duplicate_rate=-0.1), "max_duplicate_rate"),
    (dict(max_extract_age_hours=0), "max_extract_age_hours"),
    (dict(max_trip_miles=0), "above 0"),
])
def test_invalid_configuration(kwargs, match):
    with pytest.raises(ValueError, match=match):
        PipelineConfig(**kwargs)


def test_paths():
    cfg = PipelineConfig(root="file:/lake")
    assert cfg.dataset_prefix == "trips/start=2023-01-01/end=2023-01-08"
    assert cfg.candidate_prefix("b1") == "file:/lake/silver/trips/start=2023-01-01/end=2023-01-08/batch=b1/_gold_candidates"
    assert PipelineConfig.from_env({"PAGE_SIZE": "10", "MAX_ROWS": "5"}).page_size == 10
