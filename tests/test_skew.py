"""Skew: a third of all rows on one trip id, or as exact copies of one row."""

from pyspark.sql import functions as F

from tripgate.functions.parsing import RAW_COLUMNS
from tripgate.operators import silver


def skewed(spark, n=3000):
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
        .alias("trip_id"),
        F.lit("2023-01-01T10:00:00.000").alias("trip_start_timestamp"),
        # Hot rows differ by end time, except every 5th hot row which is one exact copy.
        F.when((F.col("id") % 3 == 0) & (F.col("id") % 5 == 0), F.lit("2023-01-01T10:30:00.000"))
        .otherwise(F.format_string("2023-01-01T10:%02d:00.000", (F.col("id") % 29).cast("int")))
        .alias("trip_end_timestamp"),
        F.lit("600").alias("trip_seconds"),
        F.lit("1").alias("trip_miles"),
        F.lit("5.00").alias("trip_total"),
        F.lit("8").alias("pickup_community_area"),
    )
    return base.select(*RAW_COLUMNS)


def test_hot_key_and_copies_dedup_exactly(spark):
    raw = skewed(spark).repartition(16)
    result = silver.refine(raw)
    assert result.clean.count() == 2000 + 1  # every non-hot id, plus one hot version
    assert result.duplicate.count() == 999
    hot = result.clean.filter("trip_id = 'HOT'").withColumn("end", F.col("trip_end_ts").cast("timestamp_ntz"))
    assert hot.first().end.minute == 30  # the latest end wins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_winners_are_limited_before_the_shuffle(spark):
    from tripgate.session import zoned_session

    # The partial WindowGroupLimit sits below the shuffle on trip_id (map-side top-1).
    below_exchange = plan(silver.refine(skewed(zoned_session(spark))).clean).split("Exchange hashpartitioning(trip_id", 1)[1]
    assert "WindowGroupLimit" in below_exchange


def test_dispositions_come_from_one_scan_without_joins(spark, scratch):
    from tripgate.session import zoned_session

    s = zoned_session(spark)
    skewed(s).write.parquet(f"{scratch}/raw")
    result = silver.refine(s.read.parquet(f"{scratch}/raw"))
    for df in (result.versions, result.duplicate, silver.rejections(result.versions, "b")):
        text = plan(df)
        assert text.count("FileScan") == 1 and "Join" not in text and "Union" not in text
        assert text.count("Exchange hashpartitioning(") == 2


def test_a_third_of_three_million_rows_on_one_id(spark):
    n, splits = 3_000_000, 32
    raw = skewed(spark, n).repartition(splits)
    ranked = silver.refine(raw).versions
    # rows by task of the last shuffle: a plan over the same partitions, no further shuffle
    by_task = ranked.groupBy(F.spark_partition_id().alias("task"), "disposition").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("trip_id") == "HOT").alias("hot")).collect()
    total = {k: sum(r.n for r in by_task if r.disposition == k) for k in silver.DISPOSITIONS}
    assert total == {"clean": n * 2 // 3 + 1, "invalid": 0, "duplicate": n // 3 - 1}
    tasks = {r.task for r in by_task}
    hot = [sum(r.hot for r in by_task if r.task == t) for t in tasks]
    # the hot id's rows are dealt out in parts of one split each
    assert max(hot) <= 3 * (n // 3) // len(tasks) + n // 3 // splits
    assert sum(hot) == n // 3
