"""Gate scenarios by rule: what goes wrong with which day's batch.

Each rule is a text valid in Spark SQL and in DuckDB that alters one input of the gate on one day of
the month, so every violation code occurs among the batches; all other days stay as they are.
``day`` is the day of the month of the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "CAST(substr(batch_id, 9, 2) AS INT)"

#: Input of the gate -> its value under the scenarios.
SCENARIO_RULES = {
    "validation_batch_id": "CASE day WHEN 1 THEN concat(validation_batch_id, '-other') ELSE validation_batch_id END",
    "manifest_batch_id": "CASE day WHEN 2 THEN NULL ELSE manifest_batch_id END",
    "raw_rows": "CASE day WHEN 3 THEN raw_rows + 1 WHEN 16 THEN 0 ELSE raw_rows END",
    "clean_rows": "CASE WHEN day IN (4, 16) THEN 0 ELSE clean_rows END",
    "rejected_rows": "CASE day WHEN 5 THEN rejected_rows + raw_rows WHEN 16 THEN 0 ELSE rejected_rows END",
    "duplicate_valid_rows": "CASE day WHEN 6 THEN duplicate_valid_rows + raw_rows WHEN 16 THEN 0 ELSE duplicate_valid_rows END",
    "extracted_at_utc": "CASE day WHEN 7 THEN 'oops' WHEN 8 THEN NULL WHEN 9 THEN substr(extracted_at_utc, 1, 19) "
                        "WHEN 17 THEN '2024-02-01T02:00:00+00:00' ELSE extracted_at_utc END",
    "silver_rows": "CASE WHEN day = 10 THEN silver_rows + 1 WHEN day IN (4, 16) THEN 0 ELSE silver_rows END",
    "daily_count_sum": "CASE WHEN day = 11 THEN daily_count_sum - 1 WHEN day IN (4, 16) THEN 0 ELSE daily_count_sum END",
    "metrics_count_sum": "CASE WHEN day = 12 THEN NULL WHEN day IN (4, 16) THEN 0 ELSE metrics_count_sum END",
    "revenue_matches": "CASE day WHEN 13 THEN false ELSE revenue_matches END",
    "gold_top_zones_rows": "CASE day WHEN 14 THEN 11 WHEN 18 THEN 0 ELSE gold_top_zones_rows END",
    "null_zone_ranks": "CASE day WHEN 15 THEN 2 WHEN 19 THEN NULL ELSE null_zone_ranks END",
}


def with_scenarios(gate_input: DataFrame) -> DataFrame:
    """The gate's input (one row a batch, ids beginning with the date) as the rules have it."""
    others = [c for c in gate_input.columns if c not in SCENARIO_RULES]
    dated = gate_input.withColumn("day", F.expr(DAY))
    return dated.select(*others, *[F.expr(rule).cast(gate_input.schema[c].dataType).alias(c) for c, rule in SCENARIO_RULES.items()])
