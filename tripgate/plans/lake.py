"""A lake built by the real pipeline over ``events``: a batch of the first half of its days, one of all, then two retries.

The publication, history, KPI and operations keys read this lake. Batch ids and the
clock are fixed so results are reproducible: the batches are judged at the instant they
were extracted (age 0 h). The published state is that of the second batch, which holds every event. After both runs, the gate step of the first batch is retried
(its history rows are rewritten, not doubled) and the live batch is published again (a
no-op). The lake is built once per Spark application and input folder.
"""

from __future__ import annotations

import threading
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgate.config import PipelineConfig
from tripgate.plans import pipeline
from tripgate.plans.publish import publish
from tripgate.session import scratch_dir, zoned_session
from tripgate.sources.adapters import TRIP_ADAPTER_COLUMNS, read_table

# Batch ids of the two runs, in order: the first half of the events' days, then all of them.
LAKE_BATCHES = ("w01", "w02")
LAKE_CLOCK = datetime(2024, 2, 1, 6, 0, tzinfo=timezone.utc)

_LAKES: dict[tuple[str, str], PipelineConfig] = {}
_LOCK = threading.Lock()


def _clock() -> datetime:
    return LAKE_CLOCK


def window_config(root: str, start: str, end: str) -> PipelineConfig:
    return PipelineConfig(start_date=start, end_date=end, root=root)


def event_days(events: DataFrame, ts_col: str = "ts") -> tuple[date, date]:
    """The first day of the events and the day after the last; a day long past if there are none."""
    first, last = events.agg(F.to_date(F.min(ts_col)), F.to_date(F.max(ts_col))).first()
    if first is None:
        first = last = date(1970, 1, 1)
    return first, last + timedelta(days=1)


def event_windows(events: DataFrame) -> tuple[tuple[str, str, str], ...]:
    """(batch, start, end): the first half of the events' days (the larger one), then all their days."""
    first, end = event_days(events)
    middle = first + timedelta(days=((end - first).days + 1) // 2)
    return tuple((batch, first.isoformat(), until.isoformat()) for batch, until in zip(LAKE_BATCHES, (middle, end), strict=True))


def demo_lake(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    """Build (once) and return the config of the last published window."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key in _LAKES:
            return _LAKES[key]
        root = scratch_dir(spark, "lake")
        events = read_table(zoned_session(spark), sf_dir, "events")
        runs, cfg = {}, None
        windows = event_windows(events)
        for batch, start, end in windows:
            cfg = window_config(root, start, end)
            runs[batch] = (cfg, pipeline.run_pipeline(spark, cfg, events, batch_id=batch, clock=_clock,
                                                     columns=TRIP_ADAPTER_COLUMNS, source_url="table:events"))
        first_cfg, first = runs[windows[0][0]]
        pipeline.validate(spark, first_cfg, first["silver"], first["candidate"],
                          first["ingest"]["manifest_key"], clock=_clock)
        last_cfg, last = runs[windows[-1][0]]
        publish(spark, last_cfg, last["candidate"], last["gate"], clock=_clock)
        _LAKES[key] = last_cfg
        return last_cfg
