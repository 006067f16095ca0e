"""Batch history derived from ``events``: every calendar day of events is one extract batch.

This drives the gate and quality-history operators over many batches in one job, the
way a re-judgement of the whole audit history runs. The batch id is the day
(``yyyy-MM-dd``); the manifest side of a batch records its extraction one hour after
the window closed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgate.config import GatePolicy, TripLimits
from tripgate.operators import gold, quality, silver
from tripgate.session import materialize, zoned_session
from tripgate.sources.adapters import TRIP_ADAPTER_COLUMNS, read_table

BY = ("batch_id",)
# Fixed query parameters of the history keys: the judgement instant and freshness bound.
HISTORY_NOW = datetime(2024, 2, 1, 0, 0, tzinfo=timezone.utc)
HISTORY_POLICY = GatePolicy(max_reject_rate=0.10, max_duplicate_rate=0.10, max_extract_age_hours=72)

BATCH_ID_SQL = "date_format(ts, 'yyyy-MM-dd')"
EXTRACTED_AT_SQL = "date_format(date_add(to_date(ts), 1), \"yyyy-MM-dd'T'01:00:00+00:00\")"
RECORDED_AT_SQL = "date_format(date_add(to_date(ts), 1), \"yyyy-MM-dd'T'01:30:00+00:00\")"


@dataclass(frozen=True)
class BatchHistory:
    silver: silver.SilverResult
    gold: dict[str, DataFrame]
    metrics: DataFrame
    validation: DataFrame
    manifest: DataFrame
    inputs: DataFrame
    gated: DataFrame
    reasons: DataFrame


def batched_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return events.selectExpr(f"{BATCH_ID_SQL} AS batch_id", *TRIP_ADAPTER_COLUMNS)


def batch_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch: rows extracted and the extraction instant (ISO with offset)."""
    events = read_table(spark, sf_dir, "events")
    return (
        events.selectExpr(f"{BATCH_ID_SQL} AS batch_id", f"{EXTRACTED_AT_SQL} AS extracted_at_utc",
                          f"{RECORDED_AT_SQL} AS recorded_at_utc")
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("rows_downloaded"),
             F.max("extracted_at_utc").alias("extracted_at_utc"),
             F.max("recorded_at_utc").alias("recorded_at_utc"))
    )


def batch_history(spark: SparkSession, sf_dir: str, limits: TripLimits = TripLimits(),
                  policy: GatePolicy = HISTORY_POLICY, now: datetime = HISTORY_NOW) -> BatchHistory:
    """Silver, Gold, metrics and the gate for every batch in one plan.

    One pass over the batches carries all the work: every row with its disposition, rolled up by
    (batch, disposition, reason) and, for the clean rows, also by (date, zone). The rollup holds at
    most batches x (days x zones + reasons) rows; it is written once to the shared checkpoint
    folder and everything else derives from it.
    """
    s = zoned_session(spark)
    result = silver.refine(batched_raw(s, sf_dir), limits, by=BY)
    kinds = materialize(gold.candidate_rollup(
        result.versions.withColumn("trip_date", F.when(F.col("disposition") == silver.CLEAN, F.col("trip_date")))
        .withColumn("pickup_community_area", F.when(F.col("disposition") == silver.CLEAN, F.col("pickup_community_area"))),
        by=(*BY, "disposition", "reject_reason"), counted=F.lit(1)), "rollup")
    kind = F.col("disposition")
    rollup = kinds.where(kind == silver.CLEAN).drop("disposition", "reject_reason")
    tables = gold.tables_from_rollup(rollup, by=BY)
    of = lambda name: F.coalesce(F.sum(F.when(kind == name, F.col("n"))), F.lit(0))
    metrics = kinds.groupBy(*BY).agg(
        F.sum("n").alias("raw_rows"), of(silver.CLEAN).alias("clean_rows"), of(silver.INVALID).alias("rejected_rows"),
        of(silver.DUPLICATE).alias("duplicate_valid_rows"))
    validation = quality.validation_metrics(
        rollup, tables["daily_revenue"], tables["daily_trip_metrics"], tables["top_pickup_zones"], by=BY,
        silver_rows=F.col("n"), silver_revenue=F.col("revenue"))
    manifest = batch_manifests(s, sf_dir)
    inputs = quality.gate_input(metrics, validation, manifest)
    gated = quality.evaluate_gate(inputs, policy, now)
    reasons = kinds.where(kind != silver.CLEAN).groupBy(*BY, "reject_reason").agg(F.sum("n").alias("reject_count"))
    return BatchHistory(result, tables, metrics, validation, manifest, inputs, gated, reasons)
