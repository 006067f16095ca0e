"""Silver: typed parse, ordered row rules, deterministic keyed dedup (P*, R12, W1, U1, A4, A5).

Skew design. A trip id, or one group of exact copies, may hold a large share of all
rows, so the dedup never sends a whole key group through one task. It is a tournament:
the versions of an id that one input split holds meet first, then the firsts of all
splits; every row passes both rounds once, in one plan over one scan, and leaves with
its disposition (``versions``). Where only the winners are wanted (``keep_best``), a
partial WindowGroupLimit shrinks a hot id to one row a task before the only shuffle.

Rows that break a rule take no part: they keep to their own input split, so the many rows
with an empty id never form a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripgate.config import TripLimits
from tripgate.functions.hashing import completeness, row_hash
from tripgate.functions.parsing import RAW_COLUMNS, SILVER_COLUMNS, parsed_columns
from tripgate.functions.rules import DUPLICATE_REASON, reason_column

REJECTION_COLUMNS = (*SILVER_COLUMNS, "reject_reason")


CLEAN, INVALID, DUPLICATE = "clean", "invalid", "duplicate"
DISPOSITIONS = (CLEAN, INVALID, DUPLICATE)


@dataclass(frozen=True)
class SilverResult:
    """The three dispositions of a raw batch; ``classified`` is every row with its reason,
    ``versions`` every row with its reason and disposition from one pass over the batch.

    ``observation`` holds ``raw_rows`` and ``invalid_rows``, counted in the same pass as
    the classification, once an action has run over ``classified``.
    """

    clean: DataFrame
    invalid: DataFrame
    duplicate: DataFrame
    classified: DataFrame
    versions: DataFrame
    observation: Observation | None = None


def require_columns(raw: DataFrame, required=RAW_COLUMNS, what: str = "source") -> None:
    missing = sorted(set(required).difference(raw.columns))
    if missing:
        raise ValueError(f"Missing {what} columns: {missing}")


def parse(raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The nine typed Silver columns; extra source columns are dropped
    (``by`` columns, e.g. a batch id, are carried through)."""
    require_columns(raw)
    return raw.select(*by, *parsed_columns())


def classify(parsed: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Add ``reject_reason`` (``''`` = valid)."""
    return parsed.withColumn("reject_reason", reason_column(limits))


def observe_dispositions(classified: DataFrame) -> tuple[DataFrame, Observation]:
    """Count raw and invalid rows while classifying (no extra pass).

    The observation node is also a plan boundary: without it, Catalyst pushes the
    ``reject_reason`` split filters below the classification and inlines every rule and
    every parse expression into them, so each row is parsed several times over.
    """
    seen = Observation()
    observed = classified.observe(
        seen,
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col("reject_reason") != "").alias("invalid_rows"),
    )
    return observed, seen


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, invalid rows with it)."""
    valid = classified.filter(F.col("reject_reason") == "").drop("reject_reason")
    invalid = classified.filter(F.col("reject_reason") != "")
    return valid, invalid


def _best_first() -> list[Column]:
    """Completeness desc, end desc nulls last, row hash asc: only equal rows tie."""
    return [F.col("_complete").desc(), F.col("trip_end_ts").desc_nulls_last(), F.col("_hash").asc()]


def keep_best(valid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``trip_id``: the most complete, latest-ending, lowest-hash version.

    ``row_number() = 1`` is planned as a partial WindowGroupLimit before the shuffle: a
    hot id reaches the shuffle as at most one row per map task.
    """
    keyed = valid.select("*", completeness().alias("_complete"), row_hash().alias("_hash"))
    of_id = Window.partitionBy(*by, "trip_id").orderBy(*_best_first())
    return keyed.withColumn("_place", F.row_number().over(of_id)).where("_place = 1").select(*by, *SILVER_COLUMNS)


def versions(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """W1 + R12: every classified row with its ``disposition``; losing versions get the reason ``duplicate_trip_id``.

    First round: the versions of an id within one input split (``_split`` salts the key, and
    grows with the input). Second round: each split's first. Rows out of the race (rule breakers,
    losers of the first round) keep the salt, so no task meets more of an id than one
    split holds or one row for each split.
    """
    valid = F.col("reject_reason") == ""
    keyed = classified.select(
        *by, *SILVER_COLUMNS, "reject_reason", F.spark_partition_id().alias("_split"), F.when(valid, F.col("trip_id")).alias("_id"),
        F.when(valid, completeness()).alias("_complete"), F.when(valid, row_hash()).alias("_hash"))
    inside = Window.partitionBy(*by, "_id", "_split").orderBy(*_best_first())
    across = Window.partitionBy(*by, "_id", "_round").orderBy(*_best_first())
    in_race = F.col("_id").isNotNull() & (F.col("_place") == 1)
    ranked = (keyed.withColumn("_place", F.row_number().over(inside))
              .withColumn("_round", F.when(in_race, F.lit(-1)).otherwise(F.col("_split")))
              .withColumn("_final", F.row_number().over(across)))
    disposition = F.when(F.col("_id").isNull(), INVALID).when((F.col("_round") == -1) & (F.col("_final") == 1), CLEAN).otherwise(DUPLICATE)
    judged = ranked.withColumn("disposition", disposition)
    reason = F.when(F.col("disposition") == DUPLICATE, DUPLICATE_REASON).otherwise(F.col("reject_reason"))
    return judged.select(*by, *SILVER_COLUMNS, reason.alias("reject_reason"), "disposition")


def losing_versions(valid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every valid row except the best version of its ``trip_id``, reason ``duplicate_trip_id``."""
    ranked = versions(valid.withColumn("reject_reason", F.lit("")), by)
    return ranked.where(F.col("disposition") == DUPLICATE).select(*by, *REJECTION_COLUMNS)


def dedup(valid: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean, duplicates)."""
    return keep_best(valid, by), losing_versions(valid, by)


def refine(raw: DataFrame, limits: TripLimits = TripLimits(), by: Sequence[str] = ()) -> SilverResult:
    """The whole Silver transform: (clean, invalid, duplicate) plus the classified rows.

    ``by`` names columns (e.g. ``batch_id``) that are carried through and scope the dedup.
    """
    classified, seen = observe_dispositions(classify(parse(raw, by), limits))
    valid, invalid = split(classified)
    clean, duplicate = dedup(valid, by)
    return SilverResult(clean, invalid, duplicate, classified, versions(classified, by), seen)


def refine_pair(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two-result form with default limits: (clean, invalid)."""
    result = refine(raw)
    return result.clean, result.invalid


def rejections(ranked: DataFrame, batch_id: str | None = None) -> DataFrame:
    """The invalid and duplicate rows of ``versions``, typed by disposition, tagged with the batch.

    With ``batch_id=None`` the rows must already carry a ``batch_id`` column.
    """
    batch = F.lit(batch_id) if batch_id is not None else F.col("batch_id")
    return ranked.where(F.col("disposition").isin(INVALID, DUPLICATE)).select(
        *REJECTION_COLUMNS, F.col("disposition").alias("reject_type"), batch.alias("batch_id"))


def reject_breakdown(rejected: DataFrame) -> DataFrame:
    """A5: rows per exact reason string (code combinations are not exploded)."""
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("reject_count"))


def breakdown_from_classified(classified: DataFrame) -> DataFrame:
    """A5 in one aggregate over the classified rows: invalid rows per exact reason, plus
    ``duplicate_trip_id`` = valid rows minus distinct valid ids (what the dedup drops).

    Distinct ids are counted by a two-level aggregate keyed on (reason, id), so the many
    rows sharing an empty id collapse map-side.
    """
    per_reason = classified.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("ids"))
    reason = F.col("reject_reason")
    return per_reason.select(
        F.when(reason == "", F.lit(DUPLICATE_REASON)).otherwise(reason).alias("reject_reason"),
        F.when(reason == "", F.col("n") - F.col("ids")).otherwise(F.col("n")).alias("reject_count"),
    ).filter(F.col("reject_count") > 0)


def reconciliation(raw: DataFrame, ranked: DataFrame) -> DataFrame:
    """A4: one row ``raw, clean, invalid, duplicate, delta, reconciled``.

    The rows of ``versions`` are counted by disposition in one aggregate, together with the raw
    rows, whose scan reads no column; ``reconciled`` requires ``raw = clean + invalid + duplicate``
    and ``clean > 0``.
    """
    kind = F.col("disposition")
    counted = ranked.select(kind).unionByName(raw.select(F.lit("raw").alias("disposition")))
    counts = counted.agg(*[F.count_if(kind == name).alias(f"{name}_rows") for name in ("raw", *DISPOSITIONS)])
    delta = F.col("raw_rows") - F.col("clean_rows") - F.col("invalid_rows") - F.col("duplicate_rows")
    return counts.select(
        "raw_rows", "clean_rows", "invalid_rows", "duplicate_rows",
        delta.alias("reconciliation_delta"),
        ((delta == 0) & (F.col("clean_rows") > 0)).alias("reconciled"),
    )
