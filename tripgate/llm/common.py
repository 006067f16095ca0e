"""Helpers shared by the corpus operators."""

from __future__ import annotations

import io
import math
import os
import tempfile
import zipfile

from pyspark import StorageLevel  # noqa: F401  (re-exported for operators that persist)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tripgate
from tripgate.session import materialize  # noqa: F401  (general helper, used by most operators)

#: Words of the contracts: runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: A side of a join is sent whole to every executor only below this many bytes (rows x bytes a row).
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), lambda w: w != "")


def small(df: DataFrame, rows: int, bytes_a_row: int) -> DataFrame:
    """``df`` marked for broadcast when its counted rows fit the bound; else left to a shuffle join."""
    return F.broadcast(df) if rows * bytes_a_row <= BROADCAST_BYTES else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked so that neither it nor what it is joined with is sent through the driver.

    Spark estimates the rows of generators and Python functions from the bytes of the files below them, so
    a few kilobytes of compressed counts can stand for millions of rows.
    """
    return df.hint("merge")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python finds it."""
    sc = spark.sparkContext
    if getattr(sc, "_tripgate_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tripgate.__file__))
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tripgate", os.path.relpath(path, root)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tripgate-ship-")), "tripgate_executors.zip")
    with open(path, "wb") as out:  # the driver's own file; Spark serves it to the executors
        out.write(blob.getvalue())
    sc.addPyFile(path)
    sc._tripgate_shipped = True


def prefix_sums(df: DataFrame, group: str, bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` in each ``group``, in the order (bucket, order).

    Sums per (group, bucket) come first, so no task holds a whole group: a group of
    n rows in about sqrt(n) buckets needs tasks of about sqrt(n) rows only.
    """
    totals = df.groupBy(group, bucket).agg(F.sum(value).alias("_bucket_sum"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, bucket, F.coalesce(F.sum("_bucket_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(shuffled(offsets), [group, bucket])  # by the keys of the window, so ``df`` isn't moved again
        .withColumn(out, (F.col("_inside") + F.col("_offset")).cast("long"))
        .drop("_inside", "_offset")
    )


def root_buckets(rows: int) -> int:
    """About sqrt(rows), at least 1."""
    return max(1, math.isqrt(max(rows, 1)))
