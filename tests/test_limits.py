"""Nothing is cut silently: page labels, row caps, empty history."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tripgate import session
from tripgate.config import PipelineConfig
from tripgate.plans import pipeline, publish
from tripgate.session import checkpoint_dir
from tripgate.sources import bronze, documents


def test_page_labels_keep_all_digits(spark):
    pages = spark.createDataFrame([(0,), (9_999,), (10_000,), (100_000,), (100_001,)], "page int")
    got = [r[0] for r in pages.orderBy("page").select(bronze.page_label(F.col("page"))).collect()]
    assert got == ["00000", "09999", "10000", "100000", "100001"]


def test_pages_beyond_five_digits_are_files_of_their_own(spark, scratch):
    rows = spark.createDataFrame([(p, f"id{p}") for p in (9_999, 10_000, 100_000, 100_001)], "page int, trip_id string")
    bronze.write_pages(rows, ["trip_id"], scratch + "/pages", ["trip_id"])
    assert bronze.page_files(spark, scratch + "/pages").count() == 4


def test_no_cap_by_default(spark):
    cfg = PipelineConfig(start_date="2024-01-01", end_date="2024-01-02", page_size=2)
    assert cfg.max_rows is None
    events = spark.range(7).select(F.col("id").alias("event_id"), F.lit("2024-01-01 05:00:00").cast("timestamp_ntz").alias("ts"))
    got = bronze.bounded_extract(events, cfg).collect()
    assert sorted((r._rn, r.page, r.page_row) for r in got) == [(i + 1, i // 2, i % 2) for i in range(7)]


def test_a_retry_without_rejects_clears_the_batch(spark, scratch):
    cfg = PipelineConfig(root=scratch)
    rows = spark.createDataFrame([("b1", "r1", 1), ("b1", "r2", 2)], "batch_id string, reject_reason string, reject_count long")
    publish.append_history(rows, cfg, "quality_reasons", "b1")
    publish.append_history(rows.withColumn("batch_id", F.lit("b2")), cfg, "quality_reasons", "b2")
    publish.append_history(rows.limit(0), cfg, "quality_reasons", "b1")
    assert {r.batch_id for r in publish.read_history(spark, cfg, "quality_reasons").collect()} == {"b2"}
    assert publish.drop_superseded(spark, cfg, "quality_reasons") == 1
    assert publish.drop_superseded(spark, cfg, "quality_reasons") == 0
    assert publish.read_history(spark, cfg, "quality_reasons").count() == 2


def test_a_retry_that_dies_half_way_keeps_the_old_rows(spark, scratch):
    cfg = PipelineConfig(root=scratch)
    schema = "batch_id string, reject_reason string, reject_count long"
    rows = spark.createDataFrame([("b1", f"r{i}", i) for i in range(40)], schema).repartition(8)
    publish.append_history(rows, cfg, "quality_reasons", "b1")
    dies = rows.withColumn("reject_count", F.when(F.col("reject_reason") == "r39", F.raise_error(F.lit("executor gone")).cast("long")).otherwise(F.lit(7)))
    with pytest.raises(Exception, match="executor gone"):
        publish.append_history(dies, cfg, "quality_reasons", "b1")
    read = lambda: sorted(r.reject_count for r in publish.read_history(spark, cfg, "quality_reasons").collect())
    assert read() == list(range(40))
    # written whole, but its commit never happens
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(documents, "append", lambda *_: (_ for _ in ()).throw(OSError("storage went away")))
        with pytest.raises(OSError):
            publish.append_history(rows.limit(3), cfg, "quality_reasons", "b1")
    assert read() == list(range(40))
    publish.append_history(rows.limit(3), cfg, "quality_reasons", "b1")
    assert len(read()) == 3


def test_numbered_log_has_one_writer_for_each_number(spark, scratch):
    log = f"{scratch}/log"
    assert documents.latest(spark, log) == (0, None)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: documents.commit_after(spark, log, 0, {"by": i}), range(16)))
    assert won.count(True) == 1 and documents.latest(spark, log) == (1, {"by": won.index(True)})
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: documents.append(spark, log, {"by": i}), range(16)))
    assert sorted(numbers) == list(range(2, 18))
    assert documents.children(spark, log) == [f"{n:010d}.json" for n in range(1, 18)]


def test_a_capped_batch_needs_leave(spark, scratch):
    cfg = PipelineConfig(root=scratch, max_rows=3)
    prefix = cfg.candidate_prefix("b1")
    documents.save_json(spark, cfg.metadata_batch("b1", "validation.json"), {"status": "PASS", "batch_id": "b1"})
    documents.save_json(spark, cfg.metadata_batch("b1", "manifest.json"), {"batch_id": "b1", "capped": True})
    gate = {"status": "PASS", "batch_id": "b1", "candidate_prefix": prefix, "validation_key": cfg.metadata_batch("b1", "validation.json")}
    with pytest.raises(PermissionError, match="row cap"):
        publish.publish(spark, cfg, {"batch_id": "b1", "candidate_prefix": prefix}, gate)


def test_checkpoint_folder_is_the_session_s(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_source_columns_go_through_in_the_pipeline_zone(spark, scratch):
    """Any trip table is landed as it is, also columns nobody asked for; days are those of the pipeline's zone."""
    utc = spark.newSession()
    utc.conf.set("spark.sql.session.timeZone", "UTC")
    rows = [(k, f"2023-01-0{day} {hour}", "2023-01-01T10:00:00.000", "note, quoted") for k, day, hour in (
        ("early", 1, "03:00:00"), ("mid", 1, "12:00:00"), ("late", 2, "05:30:00"), ("after", 2, "06:00:00"))]
    trips = utc.createDataFrame(rows, "trip_id string, seen string, trip_start_timestamp string, remark string").selectExpr(
        "trip_id", "cast(seen as timestamp) AS seen", "trip_start_timestamp", "'5' AS trip_total", "remark")
    cfg = PipelineConfig(start_date="2023-01-01", end_date="2023-01-02", root=scratch)
    info = pipeline.ingest(utc, cfg, trips, batch_id="b1", ts_col="seen", key_col="trip_id")
    landed = bronze.read_pages(utc, cfg.bronze_prefix("b1"), ["trip_id", "remark"]).collect()
    assert info["rows_downloaded"] == 2
    assert [(r.trip_id, r.seen, r.remark) for r in landed] == [
        ("mid", "2023-01-01T06:00:00.000", "note, quoted"), ("late", "2023-01-01T23:30:00.000", "note, quoted")]


def test_scratch_folders_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", {})
    kept = session.materialize(spark.range(5), "kept")
    folder = kept.inputFiles()[0].rpartition("/")[0]
    assert documents.holds(spark, folder, ".parquet")
    assert session.drop_scratch(spark) == 1 and session.drop_scratch(spark) == 0
    assert not documents.exists(spark, folder)
