"""Trip adapter over the driver's ``events`` table.

One expression list, valid in both Spark SQL and DuckDB, turns ``events`` into an
all-string raw trip table: every reject code occurs, duplicates arise naturally (same
user, same hour) and the default gate passes. The modulo terms only choose which
values are made dirty; every events row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the adapter projection shared by the Spark queries and the SQL oracle.
TRIP_ADAPTER_COLUMNS = (
    "CASE WHEN event_id % 197 = 0 THEN '  ' "
    "ELSE concat(cast(user_id AS STRING), '-', substr(cast(ts AS STRING), 1, 13)) END AS trip_id",
    "CASE WHEN event_id % 193 = 0 THEN 'nonsense' "
    "ELSE concat(replace(substr(cast(ts AS STRING), 1, 19), ' ', 'T'), '.000') END AS trip_start_timestamp",
    "CASE WHEN event_type = 'error' THEN NULL "
    "WHEN event_id % 191 = 0 THEN '2023-12-31T00:00:00.000' "
    "ELSE '2024-01-31T12:00:00.000' END AS trip_end_timestamp",
    "CASE WHEN event_id % 181 = 0 THEN '-5' WHEN event_id % 179 = 0 THEN '90000' "
    "WHEN event_id % 173 = 0 THEN NULL ELSE cast((event_id * 7) % 5400 AS STRING) END AS trip_seconds",
    "CASE WHEN event_type = 'view' THEN NULL WHEN event_id % 167 = 0 THEN '-1' "
    "WHEN event_id % 163 = 0 THEN '501' ELSE concat(cast(event_id % 40 AS STRING), '.5') END AS trip_miles",
    "CASE WHEN event_id % 157 = 0 THEN 'abc' WHEN event_id % 151 = 0 THEN '5000.01' "
    "ELSE cast(value AS STRING) END AS trip_total",
    "CASE WHEN event_type = 'click' THEN NULL WHEN event_id % 149 = 0 THEN '78' "
    "ELSE cast(event_id % 77 + 1 AS STRING) END AS pickup_community_area",
)

ADAPTER_SELECT = ",\n  ".join(TRIP_ADAPTER_COLUMNS)
ADAPTER_SQL = f"SELECT {ADAPTER_SELECT}\nFROM events"

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """All-string raw trips (the Bronze schema) from an events DataFrame."""
    return events.selectExpr(*TRIP_ADAPTER_COLUMNS)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, sf_dir, "events"))
