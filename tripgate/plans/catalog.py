"""All registered query keys and their SQL oracles."""

from __future__ import annotations

from tripgate.plans.oracle import ORACLE_SQL as _ORACLE
from tripgate.plans.queries import BRONZE_QUERIES, LAKE_QUERIES, SILVER_GOLD_QUERIES

QUERIES = {
    **BRONZE_QUERIES,
    **SILVER_GOLD_QUERIES,
    **LAKE_QUERIES,
}

ORACLE_SQL = {k: v for k, v in _ORACLE.items() if k in QUERIES}
