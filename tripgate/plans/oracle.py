"""Independent DuckDB SQL for every query key (the correctness oracle).

Written from the operator semantics, not from the Spark code: a CTE chain over the
pre-registered driver views. The row hash is rebuilt as the JSON text Spark's
``to_json`` produces (NULL fields skipped, timestamps with the zone offset); every
adapter timestamp lies in Central Standard Time, so the offset is the constant -06:00.
"""

from __future__ import annotations

from tripgate.plans.scenarios import DAY, SCENARIO_RULES
from tripgate.sources import faults
from tripgate.sources.adapters import ADAPTER_SELECT

SILVER_COLS = ("trip_id, trip_start_ts, trip_end_ts, trip_seconds, trip_miles, trip_total_usd, "
               "pickup_community_area, trip_date, duration_seconds")

_AREA_TRIMMED = r"regexp_replace(pickup_community_area, '^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$', '', 'g')"
_AREA_SQL = f"""CASE WHEN regexp_full_match({_AREA_TRIMMED}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]*)')
      THEN TRY_CAST(concat(regexp_extract({_AREA_TRIMMED}, '^([+-]?)', 1),
           CASE WHEN regexp_extract({_AREA_TRIMMED}, '^[+-]?([0-9]*)', 1) = '' THEN '0'
                ELSE regexp_extract({_AREA_TRIMMED}, '^[+-]?([0-9]*)', 1) END) AS INTEGER) END"""


def _json_ts(col: str) -> str:
    return f"""'"{col}":"' || strftime({col}, '%Y-%m-%dT%H:%M:%S.%g') || '-06:00"'"""


_ROW_JSON = " , ".join([
    """'"trip_id":"' || trip_id || '"'""",
    _json_ts("trip_start_ts"),
    _json_ts("trip_end_ts"),
    """'"trip_seconds":' || CAST(trip_seconds AS VARCHAR)""",
    """'"trip_miles":' || CAST(trip_miles AS VARCHAR)""",
    """'"trip_total_usd":' || CAST(trip_total_usd AS VARCHAR)""",
    """'"pickup_community_area":' || CAST(pickup_community_area AS VARCHAR)""",
    """'"trip_date":"' || strftime(trip_date, '%Y-%m-%d') || '"'""",
    """'"duration_seconds":' || CAST(duration_seconds AS VARCHAR)""",
])


DAY_BATCH = "strftime(ts, '%Y-%m-%d')"


def silver_ctes(batch_expr: str | None = None, source: str = "events") -> str:
    """raw -> parsed -> typed -> classified -> hashed -> ranked -> clean / dups.

    ``batch_expr`` (SQL over the source) adds a ``batch_id`` that scopes the dedup;
    ``source`` is what the events are read from.
    """
    batched = batch_expr is not None
    b = "batch_id, " if batched else ""
    part = "batch_id, trip_id" if batched else "trip_id"
    raw_batch = f"{batch_expr} AS batch_id, " if batched else ""
    return f"""
raw AS (SELECT {raw_batch}{ADAPTER_SELECT} FROM {source}),
parsed AS (
  SELECT {b}trim(trip_id, ' ') AS trip_id,
         TRY_CAST(trip_start_timestamp AS TIMESTAMP) AS trip_start_ts,
         TRY_CAST(trip_end_timestamp AS TIMESTAMP) AS trip_end_ts,
         TRY_CAST(trip_seconds AS DOUBLE) AS trip_seconds,
         TRY_CAST(trip_miles AS DOUBLE) AS trip_miles,
         TRY_CAST(trip_total AS DECIMAL(18,2)) AS trip_total_usd,
         {_AREA_SQL} AS pickup_community_area
  FROM raw),
typed AS (
  SELECT {b}trip_id, trip_start_ts, trip_end_ts, trip_seconds, trip_miles, trip_total_usd,
         pickup_community_area, CAST(trip_start_ts AS DATE) AS trip_date,
         coalesce(trip_seconds, floor(epoch(trip_end_ts)) - floor(epoch(trip_start_ts))) AS duration_seconds
  FROM parsed),
classified AS (
  SELECT *, concat_ws(';',
    CASE WHEN trip_id IS NULL OR trip_id = '' THEN 'missing_trip_id' END,
    CASE WHEN trip_start_ts IS NULL THEN 'invalid_start_timestamp' END,
    CASE WHEN trip_total_usd IS NULL OR trip_total_usd < 0 THEN 'invalid_trip_total' END,
    CASE WHEN duration_seconds IS NULL OR duration_seconds < 0 THEN 'invalid_duration' END,
    CASE WHEN trip_miles IS NOT NULL AND trip_miles < 0 THEN 'negative_trip_miles' END,
    CASE WHEN trip_end_ts IS NOT NULL AND trip_start_ts IS NOT NULL AND trip_end_ts < trip_start_ts
         THEN 'end_before_start' END,
    CASE WHEN trip_miles > 500.0 THEN 'implausible_trip_miles' END,
    CASE WHEN duration_seconds > 86400.0 THEN 'implausible_duration' END,
    CASE WHEN CAST(trip_total_usd AS DOUBLE) > 5000.0 THEN 'implausible_trip_total' END,
    CASE WHEN pickup_community_area IS NOT NULL AND NOT (pickup_community_area BETWEEN 1 AND 77)
         THEN 'invalid_pickup_area' END) AS reject_reason
  FROM typed),
invalid AS (SELECT * FROM classified WHERE reject_reason <> ''),
hashed AS (
  SELECT {b}{SILVER_COLS},
         (CASE WHEN trip_end_ts IS NULL THEN 0 ELSE 1 END + CASE WHEN trip_miles IS NULL THEN 0 ELSE 1 END
          + CASE WHEN pickup_community_area IS NULL THEN 0 ELSE 1 END) AS completeness,
         sha256('{{' || concat_ws(',', {_ROW_JSON}) || '}}') AS row_hash
  FROM classified WHERE reject_reason = ''),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {part}
             ORDER BY completeness DESC, trip_end_ts DESC NULLS LAST, row_hash ASC) AS rn
  FROM hashed),
clean AS (SELECT {b}{SILVER_COLS} FROM ranked WHERE rn = 1),
dups AS (SELECT {b}{SILVER_COLS}, 'duplicate_trip_id' AS reject_reason FROM ranked WHERE rn > 1)"""


def gold_ctes(batched: bool = False) -> str:
    """daily (both daily tables), zones, top_zones over ``clean``."""
    b = "batch_id, " if batched else ""
    rank_part = "PARTITION BY batch_id " if batched else ""
    return f""",
daily AS (
  SELECT {b}trip_date, count(trip_id) AS trip_count,
         CAST(sum(trip_total_usd) AS DECIMAL(20,2)) AS total_revenue_usd,
         round(avg(duration_seconds) / 60, 2) AS avg_duration_min,
         round(avg(trip_miles), 2) AS avg_trip_miles
  FROM clean GROUP BY {b}trip_date),
zones AS (
  SELECT {b}coalesce(CAST(pickup_community_area AS VARCHAR), 'Unknown') AS pickup_zone,
         count(trip_id) AS trip_count, CAST(sum(trip_total_usd) AS DECIMAL(20,2)) AS total_revenue_usd
  FROM clean GROUP BY ALL),
top_zones AS (
  SELECT * FROM (
    SELECT {b}CAST(row_number() OVER ({rank_part}ORDER BY trip_count DESC, pickup_zone ASC) AS INTEGER) AS rank,
           pickup_zone, trip_count, total_revenue_usd
    FROM zones) WHERE rank <= 10)"""


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).lstrip()


def history_ctes(batch_expr: str, source: str, extracted_sql: str, recorded_sql: str,
                 now_ts: str, checked_at: str, max_age_hours: float, rules: dict[str, str] | None = None) -> str:
    """Per-batch metrics, validation, manifest and the gate, as in the relational gate; ``rules`` alter its inputs."""
    altered = ", ".join(f"{rule} AS {c}" for c, rule in (rules or {}).items())
    scenario = f"""SELECT * REPLACE ({altered}) FROM (SELECT *, {DAY} AS day FROM joined)""" if altered else "SELECT * FROM joined"
    return _with(silver_ctes(batch_expr, source), gold_ctes(True), f""",
m_raw AS (SELECT batch_id, count(*) AS raw_rows,
                 count(*) FILTER (WHERE reject_reason <> '') AS rejected_rows
          FROM classified GROUP BY batch_id),
m_dedup AS (SELECT batch_id, count(*) FILTER (WHERE rn = 1) AS clean_rows,
                   count(*) FILTER (WHERE rn > 1) AS duplicate_valid_rows
            FROM ranked GROUP BY batch_id),
metrics AS (SELECT m_raw.batch_id, raw_rows, coalesce(clean_rows, 0) AS clean_rows, rejected_rows,
                   coalesce(duplicate_valid_rows, 0) AS duplicate_valid_rows
            FROM m_raw LEFT JOIN m_dedup USING (batch_id)),
v_silver AS (SELECT batch_id, count(*) AS silver_rows, sum(trip_total_usd) AS silver_revenue
             FROM clean GROUP BY batch_id),
v_daily AS (SELECT batch_id, CAST(sum(trip_count) AS BIGINT) AS daily_count_sum,
                   CAST(sum(trip_count) AS BIGINT) AS metrics_count_sum,
                   sum(total_revenue_usd) AS gold_revenue, count(*) AS gold_daily_rows
            FROM daily GROUP BY batch_id),
v_zones AS (SELECT batch_id, count(*) AS gold_top_zones_rows,
                   count(*) FILTER (WHERE rank IS NULL) AS null_zone_ranks
            FROM top_zones GROUP BY batch_id),
validation AS (
  SELECT batch_id, silver_rows, daily_count_sum, metrics_count_sum,
         silver_revenue IS NOT DISTINCT FROM gold_revenue AS revenue_matches,
         gold_daily_rows, gold_top_zones_rows, null_zone_ranks
  FROM v_silver FULL JOIN v_daily USING (batch_id) FULL JOIN v_zones USING (batch_id)),
manifest AS (
  SELECT {batch_expr} AS batch_id, max({extracted_sql}) AS extracted_at_utc,
         max({recorded_sql}) AS recorded_at_utc
  FROM {source} GROUP BY 1),
joined AS (
  SELECT m.*, v.batch_id AS validation_batch_id, v.silver_rows, v.daily_count_sum, v.metrics_count_sum,
         v.revenue_matches, v.gold_daily_rows, v.gold_top_zones_rows, v.null_zone_ranks,
         f.batch_id AS manifest_batch_id, f.extracted_at_utc, f.recorded_at_utc
  FROM metrics m LEFT JOIN validation v ON m.batch_id = v.batch_id
       LEFT JOIN manifest f ON m.batch_id = f.batch_id),
rated AS (
  SELECT *, raw_rows - clean_rows - rejected_rows - duplicate_valid_rows AS reconciliation_delta,
         CASE WHEN raw_rows <> 0 THEN rejected_rows / raw_rows ELSE 1.0 END AS reject_rate,
         CASE WHEN raw_rows <> 0 THEN duplicate_valid_rows / raw_rows ELSE 1.0 END AS duplicate_rate,
         CASE WHEN regexp_matches(extracted_at_utc, 'T.*[+]00:00$') THEN
           (epoch(TIMESTAMP '{now_ts}')
            - epoch(TRY_CAST(replace(substr(extracted_at_utc, 1, 19), 'T', ' ') AS TIMESTAMP))) / 3600.0 END AS extract_age_hours
  FROM ({scenario})),
gate AS (
  SELECT *, concat_ws(';',
    CASE WHEN batch_id IS NULL OR validation_batch_id IS NULL OR manifest_batch_id IS NULL
           OR batch_id <> validation_batch_id OR validation_batch_id <> manifest_batch_id
         THEN 'batch_id_mismatch' END,
    CASE WHEN reconciliation_delta <> 0 THEN 'raw_silver_reconciliation' END,
    CASE WHEN clean_rows <= 0 THEN 'empty_clean_dataset' END,
    CASE WHEN reject_rate > 0.10 THEN 'reject_rate_exceeded' END,
    CASE WHEN duplicate_rate > 0.10 THEN 'duplicate_rate_exceeded' END,
    CASE WHEN extract_age_hours < 0 OR extract_age_hours > {max_age_hours} THEN 'stale_or_future_extraction' END,
    CASE WHEN extract_age_hours IS NULL THEN 'invalid_extraction_timestamp' END,
    CASE WHEN coalesce(silver_rows, -1) <> clean_rows THEN 'silver_materialization_mismatch' END,
    CASE WHEN coalesce(daily_count_sum, -1) <> clean_rows THEN 'daily_revenue_count_mismatch' END,
    CASE WHEN coalesce(metrics_count_sum, -1) <> clean_rows THEN 'daily_metrics_count_mismatch' END,
    CASE WHEN NOT coalesce(revenue_matches, false) THEN 'revenue_reconciliation' END,
    CASE WHEN coalesce(gold_top_zones_rows, 0) NOT BETWEEN 1 AND 10 THEN 'top_zones_cardinality' END,
    CASE WHEN coalesce(null_zone_ranks, 1) <> 0 THEN 'null_zone_rank' END) AS violations,
    '{checked_at}' AS checked_at_utc
  FROM rated)""")


_SILVER = _with(silver_ctes())
_GOLD = _with(silver_ctes(), gold_ctes())
_BY_DAY = dict(
    extracted_sql="strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y-%m-%dT01:00:00+00:00')",
    recorded_sql="strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y-%m-%dT01:30:00+00:00')",
    now_ts="2024-02-01 00:00:00", checked_at="2024-02-01T00:00:00+00:00", max_age_hours=72)
_HIST = history_ctes(DAY_BATCH, "events", **_BY_DAY)
_SCENARIOS = history_ctes(DAY_BATCH, "events", **_BY_DAY, rules=SCENARIO_RULES)


def _q(prefix: str, body: str) -> str:
    return f"{prefix}\n{body.strip()}"


ORACLE_SQL: dict[str, str] = {
    "silver_parse": _q(_SILVER, f"SELECT {SILVER_COLS} FROM typed"),
    "silver_classify": _q(_SILVER, f"SELECT {SILVER_COLS}, reject_reason FROM classified"),
    "silver_invalid": _q(_SILVER, f"SELECT {SILVER_COLS}, reject_reason FROM invalid"),
    "silver_clean": _q(_SILVER, f"SELECT {SILVER_COLS} FROM clean"),
    "silver_duplicates": _q(_SILVER, f"SELECT {SILVER_COLS}, reject_reason FROM dups"),
    "silver_rejections": _q(_SILVER, f"""
SELECT {SILVER_COLS}, reject_reason, 'invalid' AS reject_type, 'all' AS batch_id FROM invalid
UNION ALL
SELECT {SILVER_COLS}, reject_reason, 'duplicate' AS reject_type, 'all' AS batch_id FROM dups"""),
    "reject_breakdown": _q(_SILVER, """
SELECT reject_reason, count(*) AS reject_count
FROM (SELECT reject_reason FROM invalid UNION ALL SELECT reject_reason FROM dups)
GROUP BY reject_reason"""),
    "silver_reconciliation": _q(_SILVER, """
SELECT raw_rows, clean_rows, invalid_rows, duplicate_rows,
       raw_rows - clean_rows - invalid_rows - duplicate_rows AS reconciliation_delta,
       (raw_rows - clean_rows - invalid_rows - duplicate_rows = 0 AND clean_rows > 0) AS reconciled
FROM (SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM clean) AS clean_rows,
             (SELECT count(*) FROM invalid) AS invalid_rows, (SELECT count(*) FROM dups) AS duplicate_rows)"""),
    "gold_daily_revenue": _q(_GOLD, "SELECT trip_date, trip_count, total_revenue_usd FROM daily"),
    "gold_daily_trip_metrics": _q(_GOLD, "SELECT trip_date, trip_count, avg_duration_min, avg_trip_miles FROM daily"),
    "gold_zone_totals": _q(_GOLD, "SELECT pickup_zone, trip_count, total_revenue_usd FROM zones"),
    "gold_top_pickup_zones": _q(_GOLD, "SELECT rank, pickup_zone, trip_count, total_revenue_usd FROM top_zones"),
    "dim_date": _q(_GOLD, """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS iso_day_of_week, CAST(weekofyear(d) AS INTEGER) AS iso_week,
       strftime(d, '%Y-%m') AS year_month
FROM (SELECT unnest(generate_series(min(trip_date)::TIMESTAMP, max(trip_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d
      FROM daily)"""),
    "gate_metrics": _q(_HIST, """
SELECT m.batch_id, m.raw_rows, m.clean_rows, m.rejected_rows, m.duplicate_valid_rows,
       coalesce(v.silver_rows, 0) AS silver_rows, v.daily_count_sum, v.metrics_count_sum, v.revenue_matches,
       coalesce(v.gold_daily_rows, 0) AS gold_daily_rows, coalesce(v.gold_top_zones_rows, 0) AS gold_top_zones_rows,
       coalesce(v.null_zone_ranks, 0) AS null_zone_ranks
FROM metrics m LEFT JOIN validation v ON m.batch_id = v.batch_id"""),
    "gate_evaluate": _q(_SCENARIOS, """
SELECT batch_id, CASE WHEN violations = '' THEN 'PASS' ELSE 'FAIL' END AS status, violations,
       reject_rate, duplicate_rate, reconciliation_delta, extract_age_hours, checked_at_utc
FROM gate"""),
    "quality_batch": _q(_HIST, """
SELECT batch_id, recorded_at_utc, checked_at_utc, CASE WHEN violations = '' THEN 'PASS' ELSE 'FAIL' END AS gate_status,
       raw_rows, clean_rows, rejected_rows, duplicate_valid_rows, reconciliation_delta,
       coalesce(gold_daily_rows, 0) AS gold_daily_rows, coalesce(gold_top_zones_rows, 0) AS gold_top_zones_rows,
       reject_rate, duplicate_rate, extract_age_hours, violations
FROM gate"""),
    "quality_reasons": _q(_HIST, """
SELECT batch_id, reject_reason, count(*) AS reject_count
FROM (SELECT batch_id, reject_reason FROM invalid UNION ALL SELECT batch_id, reject_reason FROM dups)
GROUP BY batch_id, reject_reason"""),
}


# ---- Bronze: the whole events range landed as pages of 1,000 rows --------------------------

_RAW_NAMES = ("trip_id", "trip_start_timestamp", "trip_end_timestamp", "trip_seconds", "trip_miles",
              "trip_total", "pickup_community_area")
_CSV_LINE = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in _RAW_NAMES) + ")"
_CSV_HEADER = ",".join(_RAW_NAMES)


def bronze_ctes(page_size: int) -> str:
    """Pages over all events, in order, with their bodies as text."""
    return f"""WITH
num AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events),
paged AS (SELECT *, CAST((rn - 1) // {page_size} AS INTEGER) AS page,
                 CAST((rn - 1) % {page_size} AS INTEGER) AS page_row FROM num),
adapted AS (SELECT rn, page, page_row, {ADAPTER_SELECT} FROM paged),
lines AS (
  SELECT rn, page, page_row, {_CSV_LINE} AS line, coalesce(trip_id, '') AS id, substr({_CSV_LINE}, length(coalesce(trip_id, '')) + 1) AS rest,
         coalesce({", ".join(_RAW_NAMES)}) IS NULL AS blank
  FROM adapted),
pages AS (
  SELECT page, count(*) AS rows, '{_CSV_HEADER}' || chr(10) || string_agg(line, chr(10) ORDER BY rn) || chr(10) AS body,
         length(arg_max(line, rn)) + 1 AS last_line
  FROM lines GROUP BY page)"""


def lake_windows(batches) -> str:
    """(batch, start, end): the first half of the events' days, and all of them."""
    first, second = batches
    return f"""
days AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) + 1 AS hi FROM events),
windows AS (
  SELECT '{first}' AS batch, lo AS start_day, lo + CAST((hi - lo + 1) // 2 AS INTEGER) AS end_day FROM days
  UNION ALL SELECT '{second}', lo, hi FROM days),
windowed AS (SELECT batch, events.* FROM events JOIN windows ON ts >= start_day AND ts < end_day),"""


def _bronze_sql() -> dict[str, str]:
    from tripgate.plans.queries import BRONZE_PAGE_SIZE, EXTRACT_END, EXTRACT_START

    ctes = bronze_ctes(BRONZE_PAGE_SIZE)
    return {
        "extract_window": f"SELECT * FROM events WHERE ts >= TIMESTAMP '{EXTRACT_START} 00:00:00' AND ts < TIMESTAMP '{EXTRACT_END} 00:00:00'",
        "extract_pages": _q(ctes, "SELECT event_id, ts, rn, page, page_row FROM paged"),
        "page_manifest": _q(ctes, "SELECT printf('%05d', page) AS page, rows, strlen(body) AS bytes, sha256(body) AS sha256 FROM pages"),
        "page_validation": _q(ctes, f""",
altered AS (
  SELECT page, rn, {faults.LINE_RULE} AS line, ({faults.MALFORMED}) AS malformed,
         ({faults.BLANK_MADE}) OR (blank AND NOT ({faults.MALFORMED}) AND NOT ({faults.BLANK_GONE})) AS empty
  FROM lines WHERE {faults.HAS_RECORDS}),
bodies AS (
  SELECT page, count(*) AS rows, count(*) FILTER (WHERE malformed) AS malformed_rows, count(*) FILTER (WHERE empty) AS blank_rows,
         string_agg(line, chr(10) ORDER BY rn) || chr(10) AS body
  FROM altered GROUP BY page),
whole AS (
  SELECT page, coalesce(b.rows, 0) AS rows, coalesce(malformed_rows, 0) AS malformed_rows, coalesce(blank_rows, 0) AS blank_rows,
         {faults.HEADER_RULE} || chr(10) || coalesce(b.body, '') AS body
  FROM pages LEFT JOIN bodies b USING (page))
SELECT printf('%05d', page) AS page, {faults.HEADER_GOOD} AS header_ok, rows, malformed_rows, blank_rows,
       strlen(body) AS bytes, sha256(body) AS sha256
FROM whole"""),
        "bronze_csv_scan": _q(ctes, f"SELECT {', '.join(_RAW_NAMES)} FROM adapted"),
        "bronze_integrity": _q(ctes, f""",
stored AS (
  SELECT page, rows, body, CASE WHEN NOT ({faults.MISSING}) THEN {faults.BODY_RULE} END AS found FROM pages),
checked AS (
  SELECT page, rows, true AS listed, found IS NOT NULL AS present, coalesce(strlen(found) = strlen(body), false) AS bytes_ok,
         coalesce(sha256(found) = sha256(body), false) AS sha256_ok,
         coalesce(length(found) - length(replace(found, chr(10), '')) - 1, 0) AS scanned_rows
  FROM stored
  UNION ALL
  SELECT page + {faults.STRAY_OFFSET}, NULL, false, true, false, false, 1 FROM pages WHERE {faults.STRAY})
SELECT batch, printf('%05d', page) AS page, rows, CAST(scanned_rows AS BIGINT) AS scanned_rows, listed, present, bytes_ok, sha256_ok, batch = 'faulty' AS manifest_consistent
FROM checked, (VALUES ('faulty'), ('wrong_total')) AS t(batch)"""),
    }


def _lake_sql() -> dict[str, str]:
    from tripgate.plans.lake import LAKE_BATCHES, LAKE_CLOCK

    clock_iso = LAKE_CLOCK.isoformat()
    windows = lake_windows(LAKE_BATCHES)
    gold_last = _GOLD  # the last batch holds all events
    hist = "WITH " + windows.lstrip() + history_ctes(
        "batch", "windowed", extracted_sql=f"'{clock_iso}'", recorded_sql=f"'{clock_iso}'",
        now_ts=LAKE_CLOCK.strftime("%Y-%m-%d %H:%M:%S"), checked_at=clock_iso, max_age_hours=24).removeprefix("WITH ")
    rejects = "(SELECT batch_id, reject_reason, 'invalid' AS reject_type FROM invalid UNION ALL " \
              "SELECT batch_id, reject_reason, 'duplicate' AS reject_type FROM dups)"
    return {
        "publish_roundtrip": _q(gold_last, "SELECT trip_date, trip_count, total_revenue_usd FROM daily"),
        "kpi_daily_revenue": _q(gold_last, "SELECT trip_date, trip_count, total_revenue_usd FROM daily"),
        "kpi_daily_metrics": _q(gold_last, "SELECT trip_date, trip_count, avg_duration_min, avg_trip_miles FROM daily"),
        "kpi_top_zones": _q(gold_last, "SELECT rank, pickup_zone, trip_count, total_revenue_usd FROM top_zones"),
        "ops_metrics_sample": _q(gold_last, """
SELECT trip_date, trip_count, avg_duration_min, avg_trip_miles FROM daily ORDER BY trip_date LIMIT 20"""),
        "quality_history": _q(hist, f"""
SELECT batch_id, reject_reason, count(*) AS reject_count FROM {rejects} GROUP BY batch_id, reject_reason"""),
        "ops_rejects_by_batch": _q(hist, f"""
SELECT batch_id, reject_type, reject_reason, count(*) AS rows_n FROM {rejects}
GROUP BY batch_id, reject_type, reject_reason"""),
        "ops_rejects": _q(hist, f"""
SELECT reject_reason, reject_type, count(*) AS records FROM {rejects} GROUP BY reject_reason, reject_type"""),
        "ops_gate_history": _q(hist, """
SELECT batch_id, CASE WHEN violations = '' THEN 'PASS' ELSE 'FAIL' END AS gate_status,
       reject_rate, duplicate_rate, violations
FROM gate"""),
    }


ORACLE_SQL.update(_bronze_sql())
ORACLE_SQL.update(_lake_sql())
