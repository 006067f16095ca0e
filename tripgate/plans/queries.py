"""The registered query catalogue: one DataFrame-returning callable per operator key.

Every callable takes ``(spark, sf_dir)``, reads the driver tables (through the trip
adapter over ``events``) and returns typed, aliased columns. Timestamps are returned as
``timestamp_ntz`` wall-clock values of the pipeline zone, so results compare across
engines regardless of the reader's zone.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgate.config import PipelineConfig
from tripgate.functions.parsing import RAW_COLUMNS
from tripgate.operators import gold, quality, silver
from tripgate.plans import history, kpi
from tripgate.plans.lake import LAKE_CLOCK, demo_lake, event_days
from tripgate.plans.pipeline import ingest
from tripgate.plans.publish import read_published, verify_publication
from tripgate.plans.scenarios import with_scenarios
from tripgate.session import footer_session, scratch_dir, zoned_session
from tripgate.sources import bronze, documents, faults
from tripgate.sources.adapters import TRIP_ADAPTER_COLUMNS, raw_trips, read_table

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Cast zone-bound timestamps to wall-clock ``timestamp_ntz`` (in the frame's session zone)."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def _silver(spark: SparkSession, sf_dir: str) -> silver.SilverResult:
    s = zoned_session(spark)
    return silver.refine(raw_trips(s, sf_dir))


# ---- Silver -------------------------------------------------------------------------

def silver_parse(spark, sf_dir):
    s = zoned_session(spark)
    return portable(silver.parse(raw_trips(s, sf_dir)))


def silver_classify(spark, sf_dir):
    return portable(_silver(spark, sf_dir).classified)


def silver_invalid(spark, sf_dir):
    return portable(_silver(spark, sf_dir).invalid)


def silver_clean(spark, sf_dir):
    return portable(_silver(spark, sf_dir).clean)


def silver_duplicates(spark, sf_dir):
    return portable(_silver(spark, sf_dir).duplicate)


def silver_rejections(spark, sf_dir):
    return portable(silver.rejections(_silver(spark, sf_dir).versions, "all"))


def reject_breakdown(spark, sf_dir):
    return silver.breakdown_from_classified(_silver(spark, sf_dir).classified)


def silver_reconciliation(spark, sf_dir):
    s = zoned_session(spark)
    raw = raw_trips(s, sf_dir)
    return silver.reconciliation(raw, silver.refine(raw).versions)


# ---- Gold ---------------------------------------------------------------------------

def gold_daily_revenue(spark, sf_dir):
    return gold.daily_revenue(_silver(spark, sf_dir).clean)


def gold_daily_trip_metrics(spark, sf_dir):
    return gold.daily_trip_metrics(_silver(spark, sf_dir).clean)


def gold_zone_totals(spark, sf_dir):
    return gold.zone_totals(_silver(spark, sf_dir).clean)


def gold_top_pickup_zones(spark, sf_dir):
    return gold.top_zones(_silver(spark, sf_dir).clean)


# ---- Gate and quality history (one batch per event day) -------------------------------

def gate_metrics(spark, sf_dir):
    h = history.batch_history(spark, sf_dir)
    v = h.validation.withColumnRenamed("batch_id", "_vb")
    return h.metrics.join(v, h.metrics["batch_id"] == v["_vb"], "left").select(
        "batch_id", *quality.METRIC_COLUMNS, *quality.VALIDATION_COLUMNS)


def gate_evaluate(spark, sf_dir):
    """Every batch judged, with something wrong on most days: all violation codes occur."""
    h = history.batch_history(spark, sf_dir)
    judged = quality.evaluate_gate(with_scenarios(h.inputs), history.HISTORY_POLICY, history.HISTORY_NOW)
    return judged.select(
        "batch_id", "status", F.array_join("violations", ";").alias("violations"),
        "reject_rate", "duplicate_rate", "reconciliation_delta", "extract_age_hours", "checked_at_utc")


def quality_batch(spark, sf_dir):
    h = history.batch_history(spark, sf_dir)
    return quality.quality_batch(h.gated, F.col("recorded_at_utc"))


def quality_reasons(spark, sf_dir):
    h = history.batch_history(spark, sf_dir)
    return h.reasons.select(F.col("batch_id").cast("string"), "reject_reason", "reject_count")


SILVER_GOLD_QUERIES: dict[str, Query] = {
    "silver_parse": silver_parse,
    "silver_classify": silver_classify,
    "silver_invalid": silver_invalid,
    "silver_clean": silver_clean,
    "silver_duplicates": silver_duplicates,
    "silver_rejections": silver_rejections,
    "reject_breakdown": reject_breakdown,
    "silver_reconciliation": silver_reconciliation,
    "gold_daily_revenue": gold_daily_revenue,
    "gold_daily_trip_metrics": gold_daily_trip_metrics,
    "gold_zone_totals": gold_zone_totals,
    "gold_top_pickup_zones": gold_top_pickup_zones,
    "gate_metrics": gate_metrics,
    "gate_evaluate": gate_evaluate,
    "quality_batch": quality_batch,
    "quality_reasons": quality_reasons,
}


# ---- Bronze: one landing of the whole events range per application and input ----------------

BRONZE_PAGE_SIZE = 1000
EXTRACT_START, EXTRACT_END = "2024-01-03", "2024-01-24"

_LANDINGS: dict = {}
_LANDING_LOCK = threading.RLock()


def bronze_config(events: DataFrame, root: str = "") -> PipelineConfig:
    first, end = event_days(events)
    return PipelineConfig(start_date=first.isoformat(), end_date=end.isoformat(), page_size=BRONZE_PAGE_SIZE, root=root)


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    """``build`` once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    with _LANDING_LOCK:
        if key not in _LANDINGS:
            _LANDINGS[key] = build(spark, sf_dir)
        return _LANDINGS[key]


def bronze_landing(spark: SparkSession, sf_dir: str) -> dict:
    """The ingest step (pages and manifest), run once, and where it landed."""
    return _once(spark, sf_dir, "landing", _land)


def _land(spark: SparkSession, sf_dir: str) -> dict:
    events = read_table(zoned_session(spark), sf_dir, "events")
    cfg = bronze_config(events, scratch_dir(spark, "bronze"))
    info = ingest(spark, cfg, events, batch_id="b0", columns=TRIP_ADAPTER_COLUMNS, source_url="table:events", clock=lambda: LAKE_CLOCK)
    return {**info, "cfg": cfg}


def extract_window(spark, sf_dir):
    spark = zoned_session(spark)
    cfg = PipelineConfig(start_date=EXTRACT_START, end_date=EXTRACT_END)
    return bronze.extract_window(read_table(spark, sf_dir, "events"), cfg)


def extract_pages(spark, sf_dir):
    spark = zoned_session(spark)
    events = read_table(spark, sf_dir, "events")
    paged = bronze.bounded_extract(events, bronze_config(events))
    return paged.select("event_id", "ts", F.col("_rn").alias("rn"), "page", "page_row")


def _pages_root(landing: dict) -> str:
    return landing["cfg"].bronze_prefix(landing["batch_id"])


def page_manifest(spark, sf_dir):
    spark = zoned_session(spark)
    landing = bronze_landing(spark, sf_dir)
    manifest = bronze.read_manifest(spark, landing["manifest_key"])
    pages = bronze.listed_pages(spark, manifest)
    return pages.select(F.regexp_extract("key", r"/page=(\d+)/", 1).alias("page"), "rows", "bytes", "sha256")


def page_validation(spark, sf_dir):
    """The audit over pages good and bad: other headers, wrong widths, quoted line ends, error documents."""
    spark = zoned_session(spark)
    root = _once(spark, sf_dir, "faulty-pages", _faulty_pages)
    return bronze.page_audit(spark, root).select("page", "header_ok", "rows", "malformed_rows", "blank_rows", "bytes", "sha256")


def _faulty_pages(spark, sf_dir) -> str:
    events = read_table(spark, sf_dir, "events")
    root = scratch_dir(spark, "faulty-pages")
    paged = bronze.bounded_extract(events, bronze_config(events))
    faults.write_faulty_pages(paged, [F.expr(c) for c in TRIP_ADAPTER_COLUMNS], root)
    return root


def bronze_csv_scan(spark, sf_dir):
    spark = zoned_session(spark)
    landing = bronze_landing(spark, sf_dir)
    return bronze.read_pages(spark, _pages_root(landing), RAW_COLUMNS)


def bronze_integrity(spark, sf_dir):
    """S3-S5 + S7: each listed page against storage and the scan, where storage has lost, altered, cut and
    stray pages (batch ``faulty``), and where the list doesn't add up besides (batch ``wrong_total``)."""
    spark = zoned_session(spark)
    root, manifests = _once(spark, sf_dir, "faulty-storage", _faulty_storage)
    scanned = (bronze.read_pages(spark, root, RAW_COLUMNS)
               .groupBy(F.col("_metadata.file_path").alias("key"))
               .agg(F.count(F.lit(1)).alias("scanned_rows")))
    checks = None
    for batch, key in manifests.items():
        seen = bronze.verify_pages(spark, bronze.read_manifest(spark, key)).withColumn("batch", F.lit(batch))
        checks = seen if checks is None else checks.unionByName(seen)
    return (checks.join(scanned, "key", "left")
            .select("batch", F.regexp_extract("key", r"/page=(\d+)/", 1).alias("page"), "rows",
                    F.coalesce("scanned_rows", F.lit(0)).alias("scanned_rows"),
                    "listed", "present", "bytes_ok", "sha256_ok", "manifest_consistent"))


def _faulty_storage(spark, sf_dir) -> tuple[str, dict[str, str]]:
    """The landed pages copied with faults, and two manifests that list them as they were landed."""
    landing = bronze_landing(spark, sf_dir)
    root, meta = scratch_dir(spark, "faulty-storage"), scratch_dir(spark, "faulty-storage-lists")
    faults.write_faulty_storage(bronze.whole_pages(spark, _pages_root(landing)), root)
    there = bronze.page_files(spark, root).select(F.col("key").alias("found"), F.col("page").alias("_page"))
    listed = bronze.listed_pages(spark, bronze.read_manifest(spark, landing["manifest_key"])).withColumn("_page", F.regexp_extract("key", r"/page=(\d+)/", 1))
    lost = F.concat(F.lit(f"{root}/page="), F.col("_page"), F.lit("/lost.txt"))
    listed.join(there, "_page", "left").select(
        F.coalesce("found", lost).alias("key"), "rows", "bytes", "sha256").write.parquet(f"{meta}/pages")
    document = {**documents.load_json(spark, landing["manifest_key"]), "pages_root": root, "pages_table": f"{meta}/pages"}
    manifests = {}
    for batch, more in (("faulty", 0), ("wrong_total", 1)):
        manifests[batch] = f"{meta}/{batch}.json"
        documents.save_json(spark, manifests[batch], {**document, "rows_downloaded": document["rows_downloaded"] + more})
    return root, manifests


# ---- Publication, history, KPI and operations over the pipeline-built lake -------------------

def publish_roundtrip(spark, sf_dir):
    spark = zoned_session(spark)
    cfg = demo_lake(spark, sf_dir)
    verify_publication(spark, cfg)
    return read_published(spark, cfg, "daily_revenue")


def dim_date(spark, sf_dir):
    """Over the published daily table, whose first and last day stand in its footers."""
    cfg = demo_lake(spark, sf_dir)
    return gold.dim_date(read_published(footer_session(spark, cfg.time_zone), cfg, "daily_revenue"))


def quality_history(spark, sf_dir):
    spark = zoned_session(spark)
    return kpi.read_quality(spark, demo_lake(spark, sf_dir), "quality_reasons").select(
        "batch_id", "reject_reason", "reject_count")


def _kpi(name: str) -> Query:
    def run(spark, sf_dir):
        return kpi.run(spark, demo_lake(spark, sf_dir), name)

    run.__name__ = name
    return run


BRONZE_QUERIES: dict[str, Query] = {
    "extract_window": extract_window,
    "extract_pages": extract_pages,
    "page_manifest": page_manifest,
    "page_validation": page_validation,
    "bronze_csv_scan": bronze_csv_scan,
    "bronze_integrity": bronze_integrity,
}

LAKE_QUERIES: dict[str, Query] = {
    "publish_roundtrip": publish_roundtrip,
    "dim_date": dim_date,
    "quality_history": quality_history,
    **{name: _kpi(name) for name in ("kpi_daily_revenue", "kpi_daily_metrics", "kpi_top_zones",
                                     "ops_rejects", "ops_rejects_by_batch", "ops_gate_history",
                                     "ops_metrics_sample")},
}
