"""Explicit schemas of the stored tables (Silver, rejects, Gold, quality history).

Reading with a known schema skips Parquet footer inference (one Spark job per read)
and pins partition columns such as ``batch_id`` to strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripgate.functions.parsing import SILVER_COLUMNS

SILVER_TYPES = {
    "trip_id": T.StringType(), "trip_start_ts": T.TimestampType(), "trip_end_ts": T.TimestampType(),
    "trip_seconds": T.DoubleType(), "trip_miles": T.DoubleType(), "trip_total_usd": T.DecimalType(18, 2),
    "pickup_community_area": T.IntegerType(), "trip_date": T.DateType(), "duration_seconds": T.DoubleType(),
}


def struct(spec) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in spec])


SILVER = struct([(c, SILVER_TYPES[c]) for c in SILVER_COLUMNS])
REJECTED = struct([*[(c, SILVER_TYPES[c]) for c in SILVER_COLUMNS], ("reject_reason", T.StringType()),
                   ("reject_type", T.StringType()), ("batch_id", T.StringType())])
VERSIONS = struct([*[(c, SILVER_TYPES[c]) for c in SILVER_COLUMNS], ("reject_reason", T.StringType()), ("disposition", T.StringType())])
GOLD = {
    "daily_revenue": struct([("trip_date", T.DateType()), ("trip_count", T.LongType()),
                             ("total_revenue_usd", T.DecimalType(20, 2))]),
    "daily_trip_metrics": struct([("trip_date", T.DateType()), ("trip_count", T.LongType()),
                                  ("avg_duration_min", T.DoubleType()), ("avg_trip_miles", T.DoubleType())]),
    "top_pickup_zones": struct([("rank", T.IntegerType()), ("pickup_zone", T.StringType()),
                                ("trip_count", T.LongType()), ("total_revenue_usd", T.DecimalType(20, 2))]),
}
HISTORY = {
    "rejected_records": REJECTED,
    "quality_batch": struct([
        ("recorded_at_utc", T.StringType()), ("checked_at_utc", T.StringType()), ("gate_status", T.StringType()),
        *[(c, T.LongType()) for c in ("raw_rows", "clean_rows", "rejected_rows", "duplicate_valid_rows",
                                       "reconciliation_delta", "gold_daily_rows", "gold_top_zones_rows")],
        ("reject_rate", T.DoubleType()), ("duplicate_rate", T.DoubleType()),
        ("extract_age_hours", T.DoubleType()), ("violations", T.StringType()), ("batch_id", T.StringType())]),
    "quality_reasons": struct([("reject_reason", T.StringType()), ("reject_count", T.LongType()),
                               ("batch_id", T.StringType())]),
}


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
