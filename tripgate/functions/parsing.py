"""Silver parsing expressions.

The reference ran on Spark 3.5 with ANSI mode off, where a bad cast yields NULL.
Spark 4 turns ANSI on by default, so every cast here is a ``try_`` form: the result
is NULL for dirty input whatever the caller's ANSI setting is.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw (Bronze) columns the transform requires, and the Silver
# column order (the order feeds the row hash, so it must not change).
RAW_COLUMNS = (
    "trip_id",
    "trip_start_timestamp",
    "trip_end_timestamp",
    "trip_seconds",
    "trip_miles",
    "trip_total",
    "pickup_community_area",
)
SILVER_COLUMNS = (
    "trip_id",
    "trip_start_ts",
    "trip_end_ts",
    "trip_seconds",
    "trip_miles",
    "trip_total_usd",
    "pickup_community_area",
    "trip_date",
    "duration_seconds",
)

# Leading / trailing bytes the legacy string -> int cast skips (whitespace and ISO controls).
_EDGE = r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$"
# A signed integral part, optionally followed by a well-formed fraction that is truncated.
_LEGACY_INT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*)$"


def legacy_int(col: Column) -> Column:
    """String -> int with the legacy (non-ANSI) cast rules: ``'8.7'`` -> 8, ``'.5'`` -> 0,
    ``' 7 '`` -> 7, ``'1e3'`` / ``'x'`` / overflow -> NULL.

    Plain integers take the strict cast, which gives the same value whenever it
    succeeds; only strings it rejects go through the (costlier) pattern path.
    """
    fast = col.try_cast("int")
    s = F.regexp_replace(col, _EDGE, "")
    sign = F.regexp_extract(s, r"^([+-]?)", 1)
    digits = F.regexp_extract(s, r"^[+-]?([0-9]*)", 1)
    integral = F.concat(sign, F.when(digits == "", F.lit("0")).otherwise(digits))
    slow = F.when(s.rlike(_LEGACY_INT), integral.try_cast("int"))
    return F.when(fast.isNotNull(), fast).when(col.isNotNull(), slow)


def parsed_columns() -> list[Column]:
    """The nine typed Silver columns, in order, from the seven raw string columns."""
    return list(_parsed_columns())


def jvm_cached(fn):
    """Cache a Column builder per JVM: expressions are session-independent, so they are
    built once (each builder call is a round trip to the JVM) and reused by every session."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext

        key = (id(SparkContext._jvm), *args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    return wrapper


@jvm_cached
def _parsed_columns() -> tuple[Column, ...]:
    start = F.try_to_timestamp(F.col("trip_start_timestamp"))
    end = F.try_to_timestamp(F.col("trip_end_timestamp"))
    seconds = F.col("trip_seconds").try_cast("double")
    return (
        F.trim(F.col("trip_id")).alias("trip_id"),
        start.alias("trip_start_ts"),
        end.alias("trip_end_ts"),
        seconds.alias("trip_seconds"),
        F.col("trip_miles").try_cast("double").alias("trip_miles"),
        F.col("trip_total").try_cast("decimal(18,2)").alias("trip_total_usd"),
        legacy_int(F.col("pickup_community_area")).alias("pickup_community_area"),
        F.to_date(start).alias("trip_date"),
        # trip_seconds is authoritative (source timestamps are rounded); otherwise the
        # absolute-time difference of the two timestamps in whole seconds.
        F.coalesce(seconds, (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double"))
        .alias("duration_seconds"),
    )
