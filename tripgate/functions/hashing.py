"""Dedup ordering helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgate.functions.parsing import SILVER_COLUMNS, jvm_cached

# Fixed value: the optional fields whose presence makes a version "more complete".
COMPLETENESS_FIELDS = ("trip_end_ts", "trip_miles", "pickup_community_area")


@jvm_cached
def completeness() -> Column:
    """0..3: how many of the optional fields are present."""
    return sum((F.col(c).isNotNull().cast("int") for c in COMPLETENESS_FIELDS), F.lit(0))


@jvm_cached
def row_hash() -> Column:
    """SHA-256 of the row's JSON (NULL fields omitted, timestamps with the session offset).

    Stable across runs for identical content, so it is the last deterministic tie-break
    between versions of one trip.
    """
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in SILVER_COLUMNS])), 256)
