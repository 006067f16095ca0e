"""End-to-end pipeline: gated publication, rollback on failure, idempotence, history."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripgate.config import PipelineConfig
from tripgate.plans import kpi, pipeline
from tripgate.plans import publish as pub
from tripgate.sources import documents, schemas
from tripgate.sources.adapters import TRIP_ADAPTER_COLUMNS, read_table

CLOCK = datetime(2024, 2, 1, 6, 0, tzinfo=timezone.utc)


def clock():
    return CLOCK


def cfg(root, start, end, **kw):
    return PipelineConfig(start_date=start, end_date=end, root=root, **kw)


@pytest.fixture(scope="module")
def lake(spark):
    from tripgate.session import scratch_dir

    root = scratch_dir(spark, "pipeline-test")
    events = read_table(spark, SF_SMALL, "events")
    first = pipeline.run_pipeline(spark, cfg(root, "2024-01-01", "2024-01-16"), events, batch_id="w1", clock=clock, columns=TRIP_ADAPTER_COLUMNS)
    second = pipeline.run_pipeline(spark, cfg(root, "2024-01-16", "2024-01-31"), events, batch_id="w2", clock=clock, columns=TRIP_ADAPTER_COLUMNS)
    return {"root": root, "events": events, "w1": first, "w2": second}


def test_runs_publish_and_verify(spark, lake):
    c = cfg(lake["root"], "2024-01-16", "2024-01-31")
    marker = pub.current_publication(spark, c)
    assert marker["batch_id"] == "w2" and marker["quality_gate"] == "PASS"
    report = pub.verify_publication(spark, c)
    assert report == {"status": "PASS", "batch_id": "w2", "window": ["2024-01-16", "2024-01-31"]}
    silver = lake["w2"]["silver"]
    assert silver["raw_rows"] == silver["clean_rows"] + silver["rejected_rows"] + silver["duplicate_valid_rows"]


def test_gold_candidates_are_single_files(spark, lake):
    """K3: one Parquet file a table, in the batch's private area."""
    prefix = lake["w2"]["candidate"]["candidate_prefix"]
    for name in ("daily_revenue", "daily_trip_metrics", "top_pickup_zones"):
        assert len([n for n in documents.children(spark, f"{prefix}/{name}") if n.endswith(".parquet")]) == 1


def test_silver_is_one_folder_for_each_disposition(spark, lake):
    silver = lake["w2"]["silver"]
    folders = [n for n in documents.children(spark, silver["rejected_key"]) if n.startswith("disposition=")]
    assert folders == ["disposition=clean", "disposition=duplicate", "disposition=invalid"]
    assert schemas.read(spark, silver["silver_key"], schemas.SILVER).count() == silver["clean_rows"]
    rejected = pipeline.rejected_records(spark, silver["rejected_key"], "w2")
    assert rejected.count() == silver["rejected_rows"] + silver["duplicate_valid_rows"]
    scan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "disposition" in scan.split("PartitionFilters", 1)[1][:200]


def test_snapshot_semantics(spark, lake):
    c = cfg(lake["root"], "2024-01-16", "2024-01-31")
    days = [r.trip_date for r in pub.read_published(spark, c, "daily_revenue").collect()]
    assert days and min(days).isoformat() >= "2024-01-16"
    total = pub.read_published(spark, c, "daily_revenue").agg(F.sum("trip_count")).first()[0]
    assert total == lake["w2"]["silver"]["clean_rows"]


def test_history_accumulates_and_retry_is_idempotent(spark, lake):
    c = cfg(lake["root"], "2024-01-01", "2024-01-16")
    w1 = lake["w1"]
    pipeline.validate(spark, c, w1["silver"], w1["candidate"], w1["ingest"]["manifest_key"], clock=clock)
    batches = kpi.read_quality(spark, c, "quality_batch").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in batches} == {"w1": 1, "w2": 1}
    rejected = kpi.read_quality(spark, c, "rejected_records")
    n_w1 = rejected.filter("batch_id = 'w1'").count()
    assert n_w1 == w1["silver"]["rejected_rows"] + w1["silver"]["duplicate_valid_rows"]
    reasons = kpi.read_quality(spark, c, "quality_reasons").filter("batch_id = 'w1'")
    assert reasons.agg(F.sum("reject_count")).first()[0] == n_w1


def test_publish_is_idempotent(spark, lake):
    c = cfg(lake["root"], "2024-01-16", "2024-01-31")
    before = pub.current_publication(spark, c)
    again = pub.publish(spark, c, lake["w2"]["candidate"], lake["w2"]["gate"],
                        clock=lambda: datetime(2030, 1, 1, tzinfo=timezone.utc))
    assert again == before


def test_publish_requires_pass(spark, lake):
    c = cfg(lake["root"], "2024-01-16", "2024-01-31")
    cand, gate = lake["w2"]["candidate"], lake["w2"]["gate"]
    with pytest.raises(PermissionError):
        pub.publish(spark, c, cand, {**gate, "status": "FAIL"})
    with pytest.raises(PermissionError):
        pub.publish(spark, c, cand, {**gate, "batch_id": "w1"})
    with pytest.raises(PermissionError):
        pub.publish(spark, c, {**cand, "candidate_prefix": "elsewhere"}, {**gate, "candidate_prefix": "elsewhere"})


def test_failed_gate_keeps_previous_publication(spark, lake):
    c = cfg(lake["root"], "2024-01-08", "2024-01-16", max_reject_rate=0.01)
    with pytest.raises(AssertionError, match="The gate refuses batch .*: reject_rate_exceeded"):
        pipeline.run_pipeline(spark, c, lake["events"], batch_id="bad", clock=clock, columns=TRIP_ADAPTER_COLUMNS)
    assert pub.current_publication(spark, c)["batch_id"] == "w2"
    row = kpi.read_quality(spark, c, "quality_batch").filter("batch_id = 'bad'").first()
    assert row.gate_status == "FAIL" and "reject_rate_exceeded" in row.violations
    report = documents.load_json(spark, c.metadata_batch("bad", "validation.json"))
    assert report["status"] == "FAIL"


def test_failure_during_publish_leaves_previous_live(spark, lake, monkeypatch):
    c = cfg(lake["root"], "2024-01-01", "2024-01-16")
    w1 = lake["w1"]
    real = schemas.read
    calls = {"n": 0}

    def flaky(spark_, path, schema):
        if "_gold_candidates/daily_trip_metrics" in path:
            calls["n"] += 1
            raise OSError("storage went away")
        return real(spark_, path, schema)

    monkeypatch.setattr(pub.schemas, "read", flaky)
    with pytest.raises(OSError):
        pub.publish(spark, c, w1["candidate"], w1["gate"], clock=clock)
    monkeypatch.setattr(pub.schemas, "read", real)
    assert calls["n"] == 1
    assert pub.current_publication(spark, c)["batch_id"] == "w2"
    versions = documents.children(spark, f"{c.published_root()}/daily_revenue")
    assert [v for v in versions if v.startswith("publication=w2-")] and len([v for v in versions if v.startswith("publication=w1-")]) == 1
    assert pub.read_published(spark, c, "daily_revenue").count() > 0


def published(spark, c):
    return {name: documents.children(spark, f"{c.published_root()}/{name}") for name in ("daily_revenue", "top_pickup_zones")}


def test_of_two_publishers_one_learns_of_the_other(spark, lake, monkeypatch):
    """w1 begins, w2's retry (another batch by then) is published before w1 adds its marker."""
    c = cfg(lake["root"], "2024-01-01", "2024-01-16")
    w1, w2 = lake["w1"], lake["w2"]
    before, versions, real, nested = pub.current_publication(spark, c), published(spark, c), schemas.read, []

    def meanwhile(spark_, path, schema):
        if "_gold_candidates/top_pickup_zones" in path and not nested:
            nested.append(documents.append(spark_, c.publication_log(), {**before, "published_at_utc": "meanwhile"}))
        return real(spark_, path, schema)

    monkeypatch.setattr(pub.schemas, "read", meanwhile)
    with pytest.raises(pub.PublicationConflict, match="Batch w2 was published while batch w1"):
        pub.publish(spark, c, w1["candidate"], w1["gate"], clock=clock)
    assert nested and pub.current_publication(spark, c)["published_at_utc"] == "meanwhile"
    assert published(spark, c) == versions
    # the same batch published twice at once: one version, both callers get it
    nested.clear()
    done = []

    def twice(spark_, path, schema):
        if "_gold_candidates/top_pickup_zones" in path and not nested:
            nested.append(1)
            done.append(pub.publish(spark_, c, w1["candidate"], w1["gate"], clock=clock))
        return real(spark_, path, schema)

    monkeypatch.setattr(pub.schemas, "read", twice)
    assert pub.publish(spark, c, w1["candidate"], w1["gate"], clock=clock) == done[0] == pub.current_publication(spark, c)
    assert sum(len(v) for v in published(spark, c).values()) == sum(len(v) for v in versions.values()) + 2
    monkeypatch.setattr(pub.schemas, "read", real)
    pub.publish(spark, cfg(lake["root"], "2024-01-16", "2024-01-31"), w2["candidate"], w2["gate"], clock=clock)
    assert pub.current_publication(spark, c)["batch_id"] == "w2"


def test_kpi_script_and_views(spark, lake):
    c = cfg(lake["root"], "2024-01-16", "2024-01-31")
    frames = kpi.run_script(spark, c)
    assert len(frames) == 3
    assert [r.rank for r in frames[2].collect()] == list(range(1, 11))
    assert kpi.split_script("-- note;\n\nSELECT 1;") == ["SELECT 1"]
    hist = kpi.run(spark, c, "ops_gate_history").collect()
    assert {r.batch_id for r in hist} >= {"w1", "w2"}


def test_command_line(spark, lake, capsys):
    from tripgate.__main__ import main

    assert main(["verify", "--root", lake["root"]]) == 0
    assert "PASS: published batch w2" in capsys.readouterr().out
    assert main(["kpi", "--root", lake["root"], "--rows", "3"]) == 0
    out = capsys.readouterr().out
    assert out.count("SQL> ") == 3 and "top_pickup_zones" in out


def test_gate_requires_matching_candidate(spark, lake):
    c = cfg(lake["root"], "2024-01-01", "2024-01-16")
    w1, w2 = lake["w1"], lake["w2"]
    with pytest.raises(AssertionError, match="does not belong to Silver"):
        pipeline.validate(spark, c, w1["silver"], w2["candidate"], w1["ingest"]["manifest_key"], clock=clock)


def test_publish_rechecks_stored_report(spark, lake):
    c = cfg(lake["root"], "2024-01-01", "2024-01-16")
    w1 = lake["w1"]
    key = w1["gate"]["validation_key"]
    stored = documents.load_json(spark, key)
    try:
        documents.save_json(spark, key, {**stored, "status": "FAIL"})
        with pytest.raises(PermissionError, match="does not pass batch"):
            pub.publish(spark, c, w1["candidate"], w1["gate"], clock=clock)
    finally:
        documents.save_json(spark, key, stored)
    assert pub.current_publication(spark, c)["batch_id"] == "w2"
