"""SQL over the published Gold and the quality history (K8, Q1-Q7, T4).

Views: the three published Gold tables (resolved through the publication marker) and the
three batch-keyed quality tables. Queries are plain Spark SQL; Catalyst plans them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripgate.config import PipelineConfig
from tripgate.operators.gold import GOLD_TABLES
from tripgate.plans.publish import QUALITY_TABLES, read_history, read_published
from tripgate.session import zoned_session

# The KPIs are the Gold tables in order; their columns are fixed values of ``schemas.GOLD``.
KPI_SQL = {
    "kpi_daily_revenue": "SELECT * FROM daily_revenue ORDER BY trip_date",
    "kpi_daily_metrics": "SELECT * FROM daily_trip_metrics ORDER BY trip_date",
    "kpi_top_zones": "SELECT * FROM top_pickup_zones ORDER BY rank",
}
KPI_SCRIPT = ";\n".join(KPI_SQL.values()) + ";"

# The names of the output columns.
OPS_SQL = {
    "ops_rejects_by_batch": """
        SELECT batch_id, reject_type, reject_reason, count(*) AS rows_n FROM rejected_records
        GROUP BY ALL ORDER BY rows_n DESC, batch_id, reject_type, reject_reason""",
    "ops_rejects": """
        SELECT reject_reason, reject_type, count(*) AS records FROM rejected_records
        GROUP BY ALL ORDER BY records DESC, reject_reason, reject_type""",
    "ops_gate_history": """
        SELECT batch_id, gate_status, reject_rate, duplicate_rate, violations FROM quality_batch
        ORDER BY checked_at_utc DESC, batch_id""",
    # A sample of the metrics: the first 20 days.
    "ops_metrics_sample": "SELECT * FROM daily_trip_metrics ORDER BY trip_date LIMIT 20",
}


def split_script(text: str) -> list[str]:
    """Q7: statements separated by ``;``; blanks and ``--`` comment statements skipped."""
    return [part for part in map(str.strip, text.split(";")) if part and not part.startswith("--")]


def read_quality(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    return read_history(spark, cfg, table)


def register_views(spark: SparkSession, cfg: PipelineConfig) -> SparkSession:
    """K8: temp views for 3 Gold + 3 quality tables in a zone-pinned child session."""
    s = zoned_session(spark, cfg.time_zone)
    for name in GOLD_TABLES:
        read_published(s, cfg, name).createOrReplaceTempView(name)
    for name in QUALITY_TABLES:
        read_quality(s, cfg, name).createOrReplaceTempView(name)
    return s


def run(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    sql = KPI_SQL.get(name) or OPS_SQL[name]
    return register_views(spark, cfg).sql(sql)


def run_script(spark: SparkSession, cfg: PipelineConfig, text: str = KPI_SCRIPT) -> list[DataFrame]:
    s = register_views(spark, cfg)
    return [s.sql(stmt) for stmt in split_script(text)]
