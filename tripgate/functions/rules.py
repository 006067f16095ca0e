"""Ordered row rules.

Each rule is a code and a predicate over the parsed Silver columns; a NULL predicate
means the rule does not fire. All firing codes are joined by ``;`` in rule order, and
an empty reason marks a valid row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgate.config import TripLimits
from tripgate.functions.parsing import jvm_cached

# The reason codes, in evaluation order, plus the dedup reason.
REASON_CODES = (
    "missing_trip_id",
    "invalid_start_timestamp",
    "invalid_trip_total",
    "invalid_duration",
    "negative_trip_miles",
    "end_before_start",
    "implausible_trip_miles",
    "implausible_duration",
    "implausible_trip_total",
    "invalid_pickup_area",
)
DUPLICATE_REASON = "duplicate_trip_id"
PICKUP_AREA_MIN, PICKUP_AREA_MAX = 1, 77


@dataclass(frozen=True)
class Rule:
    code: str
    predicate: Column


def trip_rules(limits: TripLimits = TripLimits()) -> list[Rule]:
    trip_id, start, end = F.col("trip_id"), F.col("trip_start_ts"), F.col("trip_end_ts")
    total, duration = F.col("trip_total_usd"), F.col("duration_seconds")
    miles, area = F.col("trip_miles"), F.col("pickup_community_area")
    # Each predicate references an expensive parsed column once: when Catalyst inlines
    # the parse into a filter, every reference is evaluated again. ``coalesce(p, d)``
    # states the NULL case explicitly (d = what a NULL input means for the rule).
    no, yes = F.lit(False), F.lit(True)
    predicates = [
        F.coalesce(trip_id == "", yes),                        # NULL or empty id
        start.isNull(),
        F.coalesce(total < 0, yes),                            # NULL or negative
        F.coalesce(duration < 0, yes),                         # NULL or negative
        F.coalesce(miles < 0, no),                             # present and negative
        F.coalesce(end < start, no),                           # both present, end first
        # Spark orders NaN above every number: a NaN distance / duration is implausible.
        miles > F.lit(float(limits.max_trip_miles)),
        duration > F.lit(float(limits.max_trip_duration_seconds)),
        total > F.lit(float(limits.max_trip_total_usd)),
        ~F.coalesce(area.between(PICKUP_AREA_MIN, PICKUP_AREA_MAX), yes),  # present, outside
    ]
    return [Rule(code, pred) for code, pred in zip(REASON_CODES, predicates)]


def reject_reason(rules: list[Rule]) -> Column:
    """``;``-joined codes of every firing rule, ``''`` when none fires."""
    return F.concat_ws(";", *[F.when(r.predicate, F.lit(r.code)) for r in rules])


@jvm_cached
def reason_column(limits: TripLimits = TripLimits()) -> Column:
    """The reason expression for ``limits``, built once per process and limits."""
    return reject_reason(trip_rules(limits))
