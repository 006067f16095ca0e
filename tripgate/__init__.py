"""tripgate: a Spark-native batch pipeline for trip-style event records.

Bronze (bounded ordered extract -> paged CSV + checksummed manifest)
-> Silver (typed parse, ordered row rules, deterministic keyed dedup)
-> Gold candidates (daily revenue, daily metrics, top pickup zones)
-> quality gate -> gated publication, batch-keyed quality history and SQL views.

Every relational step is a DataFrame / SQL expression planned by Catalyst.
"""

from tripgate.config import PipelineConfig, TripLimits

__all__ = ["PipelineConfig", "TripLimits"]
