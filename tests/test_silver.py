"""Silver parse / rules / dedup semantics, including the edges the reference never tested."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripgate.config import TripLimits
from tripgate.functions.parsing import RAW_COLUMNS, legacy_int
from tripgate.operators import silver

ROW = ("id", "2023-01-01T10:00:00.000", "2023-01-01T10:15:00.000", "600", "2", "12.00", "8")


RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def sample(spark):
    """Eight trips: four clean ones, a poorer copy of the first, three that break a rule."""
    morning, night = "2023-03-05T07:30:00.000", "2023-03-05T22:10:00.000"
    monday = ("2023-03-06T09:00:00.000", "2023-03-06T09:15:00.000")
    return frame(spark, [
        ("p10", morning, "2023-03-05T07:50:00.000", "1200", "4.5", "21.50", "32"),
        ("p10", morning, None, "1200", "4.5", "21.50", "32"),
        ("p11", night, "2023-03-05T22:14:00.000", "240", "0.9", "6.25", None),
        ("p12", *monday, "900", "11", "38.00", "76"),
        ("p13", *monday, "900", "3", "14.00", "32"),
        ("p14", *monday, "-30", "3", "14.00", "32"),
        ("", *monday, "900", "3", "14.00", "32"),
        ("p15", "last monday", monday[1], "900", "3", "14.00", "32"),
    ])


def reasons_of(spark, rows, limits=TripLimits()):
    r = silver.refine(frame(spark, rows), limits)
    return [x["reject_reason"] for x in r.classified.collect()]


def test_every_row_lands_once(spark):
    parts = silver.refine(sample(spark))
    assert sorted(r.trip_id for r in parts.clean.collect()) == ["p10", "p11", "p12", "p13"]
    assert sorted(r.reject_reason for r in parts.invalid.collect()) == ["invalid_duration", "invalid_start_timestamp", "missing_trip_id"]
    loser = parts.duplicate.collect()
    assert [(r.trip_id, r.trip_end_ts, r.reject_reason) for r in loser] == [("p10", None, "duplicate_trip_id")]


def test_two_result_form(spark):
    clean, invalid = silver.refine_pair(sample(spark))
    assert (clean.count(), invalid.count()) == (4, 3)


def test_all_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="trip_miles.*trip_total"):
        silver.refine(frame(spark, [ROW]).drop("trip_total", "trip_miles"))


def test_extra_columns_dropped(spark):
    df = spark.createDataFrame([ROW + ("extra",)], RAW_SCHEMA + ", other string")
    assert "other" not in silver.refine(df).clean.columns


@pytest.mark.parametrize("text,expected", [
    ("8", 8), ("8.7", 8), (" 7 ", 7), ("\t7\n", 7), ("-3.", -3), (".5", 0), ("+4", 4), ("0", 0),
    ("1e3", None), ("x", None), ("", None), ("+", None), ("99999999999", None), ("7 8", None), (None, None),
])
def test_legacy_int_cast(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(legacy_int(F.col("s")).alias("v")).first().v == expected


def test_decimal_half_up_and_overflow(spark):
    base = list(ROW)
    rows = []
    for i, total in enumerate(["1.005", "2.675", "1e30", "abc", "-0.01", "5000.00", "5000.01"]):
        r = list(base)
        r[0], r[5] = f"t{i}", total
        rows.append(tuple(r))
    out = {r.trip_id: r for r in silver.refine(frame(spark, rows)).classified.collect()}
    assert out["t0"].trip_total_usd == Decimal("1.01")
    assert out["t1"].trip_total_usd == Decimal("2.68")
    assert out["t2"].trip_total_usd is None and out["t2"].reject_reason == "invalid_trip_total"
    assert out["t3"].reject_reason == "invalid_trip_total"
    assert out["t4"].reject_reason == "invalid_trip_total"
    assert out["t5"].reject_reason == ""  # the limit is strict
    assert out["t6"].reject_reason == "implausible_trip_total"


def test_nan_and_infinity(spark):
    rows = []
    for i, (miles, secs) in enumerate([("NaN", "600"), ("Infinity", "600"), ("1", "NaN"), ("-Infinity", "600")]):
        r = list(ROW)
        r[0], r[4], r[3] = f"n{i}", miles, secs
        rows.append(tuple(r))
    out = {r.trip_id: r.reject_reason for r in silver.refine(frame(spark, rows)).classified.collect()}
    assert out["n0"] == "implausible_trip_miles"  # NaN sorts above every number
    assert out["n1"] == "implausible_trip_miles"
    assert out["n2"] == "implausible_duration"
    assert out["n3"] == "negative_trip_miles"


def test_area_rules(spark):
    rows = []
    for i, area in enumerate(["78", "0", "x", "77", "1", "8.7", None]):
        r = list(ROW)
        r[0], r[6] = f"a{i}", area
        rows.append(tuple(r))
    out = {r.trip_id: (r.pickup_community_area, r.reject_reason)
           for r in silver.refine(frame(spark, rows)).classified.collect()}
    assert out["a0"] == (78, "invalid_pickup_area")
    assert out["a1"] == (0, "invalid_pickup_area")
    assert out["a2"] == (None, "")  # unparsable areas are allowed (Unknown zone)
    assert out["a3"][1] == "" and out["a4"][1] == ""
    assert out["a5"] == (8, "")
    assert out["a6"] == (None, "")


def test_multi_code_order_and_end_before_start(spark):
    rows = [
        ("  ", "nonsense", None, "-5", "-1", "abc", "0"),
        ("e1", "2023-01-01T10:00:00.000", "2023-01-01T09:00:00.000", "600", "1", "5", "8"),
        ("e2", "2023-01-01T10:00:00.000", None, None, "1", "5", "8"),
    ]
    out = {r.trip_id: r.reject_reason for r in silver.refine(frame(spark, rows)).classified.collect()}
    assert out[""] == ("missing_trip_id;invalid_start_timestamp;invalid_trip_total;invalid_duration;"
                       "negative_trip_miles;invalid_pickup_area")
    assert out["e1"] == "end_before_start"  # even with positive trip_seconds
    assert out["e2"] == "invalid_duration"  # NULL end and NULL seconds


def test_trim_spaces_only(spark):
    rows = [("\tid\t",) + ROW[1:], ("  id  ",) + ROW[1:]]
    ids = sorted(r.trip_id for r in silver.parse(frame(spark, rows)).collect())
    assert ids == ["\tid\t", "id"]


def test_duration_from_timestamps_across_dst(spark):
    # 2023-11-05: 01:00-02:00 CDT repeats; 00:30 -> 02:30 wall clock is 3 h of absolute time.
    rows = [("d1", "2023-11-05T00:30:00.000", "2023-11-05T02:30:00.000", None, "1", "5", "8"),
            # 2023-03-12: 02:30 does not exist and resolves to 03:30 CDT.
            ("d2", "2023-03-12T01:30:00.000", "2023-03-12T02:30:00.000", None, "1", "5", "8")]
    out = {r.trip_id: r.duration_seconds for r in silver.parse(frame(spark, rows)).collect()}
    assert out["d1"] == 10800.0
    assert out["d2"] == 3600.0


def test_dedup_prefers_complete_then_latest_end_then_hash(spark):
    base = ("k", "2023-01-01T10:00:00.000")
    rows = [
        base + ("2023-01-01T10:10:00.000", "600", None, "5", "8"),   # completeness 2
        base + ("2023-01-01T10:05:00.000", "600", "1", "5", "8"),    # completeness 3, earlier end
        base + ("2023-01-01T10:20:00.000", "600", "1", "5", "8"),    # completeness 3, latest end: wins
        ("h", "2023-01-01T10:00:00.000", "2023-01-01T10:20:00.000", "600", "1", "5", "8"),
        ("h", "2023-01-01T10:00:00.000", "2023-01-01T10:20:00.000", "601", "1", "5", "8"),
    ]
    result = silver.refine(frame(spark, rows))
    clean = {r.trip_id: r for r in result.clean.withColumn(
        "end_local", F.col("trip_end_ts").cast("timestamp_ntz")).collect()}
    assert clean["k"].end_local == datetime(2023, 1, 1, 10, 20)
    # Equal completeness and end: the lower SHA-256 of the row JSON wins.
    hashes = (silver.split(result.classified)[0]
              .filter("trip_id = 'h'")
              .select("trip_seconds", F.sha2(F.to_json(F.struct(*[F.col(c) for c in result.clean.columns])), 256)
                      .alias("h")).collect())
    expected = min(hashes, key=lambda r: r.h).trip_seconds
    assert clean["h"].trip_seconds == expected
    assert result.duplicate.count() == 3


def test_exact_copies_keep_exactly_one(spark):
    rows = [ROW] * 7
    result = silver.refine(frame(spark, rows))
    assert result.clean.count() == 1
    assert result.duplicate.count() == 6


def test_reconciliation_row(spark):
    raw = sample(spark)
    row = silver.reconciliation(raw, silver.refine(raw).versions).first()
    assert (row.raw_rows, row.clean_rows, row.invalid_rows, row.duplicate_rows) == (8, 4, 3, 1)
    assert row.reconciliation_delta == 0 and row.reconciled


def test_rejections_union(spark):
    r = silver.refine(sample(spark))
    rej = silver.rejections(r.versions, "b1")
    rows = rej.collect()
    assert len(rows) == 4
    assert {x.reject_type for x in rows} == {"invalid", "duplicate"}
    assert {x.batch_id for x in rows} == {"b1"}
    counts = {x.reject_reason: x.reject_count for x in silver.reject_breakdown(rej).collect()}
    assert counts["duplicate_trip_id"] == 1 and sum(counts.values()) == 4


def test_ansi_independent(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.ansi.enabled", "true")
    df = s.createDataFrame([("x", "nonsense", "bad", "bad", "bad", "bad", "bad")], RAW_SCHEMA)
    row = silver.refine(df).classified.first()
    assert row.trip_start_ts is None and row.trip_seconds is None and row.trip_total_usd is None
