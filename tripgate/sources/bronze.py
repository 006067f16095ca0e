"""Bronze: bounded ordered extract, pages, CSV page sink, page audit and manifest.

The reference pulled ``$where / $order / $limit / $offset`` pages from an HTTP API and
audited every page on the driver. Here the same contract is a Spark plan over a table:

* S9  window filter pushed to the Parquet scan, order ``(ts, key)``, cap ``max_rows``;
* T3  global row numbers without a single-partition window: ranges from a stored sketch of
      the keys, as many as the rows and bytes need, counted before the rows are moved;
* K1  one CSV file per page, header included, in a fresh batch directory, cut from the sorted
      ranges; only the pages on a border between ranges move again;
* S10 / S11 page audit in one read: bytes, SHA-256, header, logical rows and malformed
      records of each page by column expressions (``csv_pages``);
* S3-S5, S7 manifest read back as JSON and reconciled against the files and the scan.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from datetime import date, datetime, time
from itertools import accumulate
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgate.config import PipelineConfig
from tripgate.session import materialize
from tripgate.sources import csv_pages
from tripgate.sources.documents import holds

# The columns a page header must contain.
HEADER_REQUIRED = ("trip_id", "trip_start_timestamp", "trip_total")

MANIFEST_SCHEMA = T.StructType([
    T.StructField("source_url", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("start_date_inclusive", T.StringType()),
    T.StructField("end_date_exclusive", T.StringType()),
    T.StructField("order_by", T.StringType()),
    T.StructField("page_size", T.LongType()),
    T.StructField("max_rows", T.LongType()),
    T.StructField("rows_downloaded", T.LongType()),
    T.StructField("capped", T.BooleanType()),
    T.StructField("extracted_at_utc", T.StringType()),
    T.StructField("pages_root", T.StringType()),
    T.StructField("pages_table", T.StringType()),
    T.StructField("page_count", T.LongType()),
])


# ---- S9 / T3: bounded ordered extract --------------------------------------------------

def _bound(source: DataFrame, ts_col: str, day: str, time_zone: str) -> Column:
    """Midnight of ``day`` as a literal of the source column's own type, so the filter reaches the scan.

    For instants it is midnight in ``time_zone``, whatever the zone of the session.
    """
    dtype = source.schema[ts_col].dataType
    if isinstance(dtype, T.TimestampType):
        return F.lit(datetime.combine(date.fromisoformat(day), time(), ZoneInfo(time_zone)))
    return F.lit(f"{day} 00:00:00").cast(dtype)


def text_columns(source: DataFrame, time_zone: str) -> list[Column]:
    """Every source column as text; timestamps as ISO wall-clock time, instants in ``time_zone``."""
    def shown(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            value = F.convert_timezone(F.current_timezone(), F.lit(time_zone), value.cast("timestamp_ntz"))
        elif not isinstance(field.dataType, T.TimestampNTZType):
            return value.cast("string").alias(field.name)
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(field.name)

    return [shown(field) for field in source.schema]


def extract_window(source: DataFrame, cfg: PipelineConfig, ts_col: str = "ts") -> DataFrame:
    """Rows with ``start <= ts < end`` (end exclusive)."""
    ts = F.col(ts_col)
    first, end = (_bound(source, ts_col, day, cfg.time_zone) for day in (cfg.start_date, cfg.end_date))
    return source.filter((ts >= first) & (ts < end))


#: What one task sorts and writes at most, about: bytes of text, and pages, since a file of its own for each is
#: slow however small it is. And how many keys of the sketch stand for a range.
RANGE_BYTES = 32 << 20
RANGE_PAGES = 100
SKETCH_POINTS = 32
_MEASURED_ROWS = 1_000
_HASHES = 1 << 30
# Borders travel as JSON; instants with their offset, all timestamps to the microsecond.
_JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Names that the extract adds to the source's own.
EXTRACT_COLUMNS = ("_rn", "page", "page_row", "_on_border")


@dataclass(frozen=True)
class Ranges:
    """Consecutive ranges of the order keys: the borders between them (JSON) and the rows of each."""

    borders: str
    key_type: str
    sizes: tuple[int, ...]

    @property
    def rows(self) -> int:
        return sum(self.sizes)

    def of(self, key: Column) -> Column:
        return _range_of(self.borders, self.key_type, key)


def _range_of(borders: str, key_type: str, key: Column) -> Column:
    """How many borders are at or below ``key``: a binary search in one folded literal, equal keys in one range."""
    n = len(json.loads(borders))
    if not n:
        return F.lit(0)
    known = F.from_json(F.lit(borders), f"array<{key_type}>", _JSON_TIMES)
    # steps of falling powers of two, one comparison each; past the last border ``get`` is null, and no step is taken
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])

    def search(sought: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step - 1) <= sought, at + step).otherwise(at))

    return F.transform(F.array(key), search)[0]


def _text_bytes(df: DataFrame) -> Column:
    """Bytes of a row as text."""
    return sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))


def sketch_ranges(df: DataFrame, order_cols: list[str], partitions: int | None = None, range_rows: int | None = None) -> Ranges:
    """Ranges of about ``RANGE_BYTES``, and of ``range_rows`` if that is less (or a given number of them), with exact sizes.

    Their number follows from the rows and their bytes. The borders come from a sketch that is
    written once: the keys whose hash is in the lowest part, about ``SKETCH_POINTS`` for each
    range, so any pass over the data finds the same borders. Then one pass over the order keys
    counts each range. The borders and sizes, one of each a range, pass through the driver.
    """
    keys = df.select(*order_cols)
    rows = keys.count()
    ranges = partitions
    if ranges is None:
        row_bytes = df.limit(_MEASURED_ROWS).agg(F.avg(_text_bytes(df))).first()[0] or 0
        ranges = max(1, math.ceil(rows * row_bytes / RANGE_BYTES), math.ceil(rows / range_rows) if range_rows else 1)
    key_type = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order_cols]).simpleString()
    borders = "[]"
    if ranges > 1 and rows:
        part = min(_HASHES, math.ceil(_HASHES * ranges * SKETCH_POINTS / rows))
        sketch = materialize(keys.where(F.pmod(F.xxhash64(*order_cols), F.lit(_HASHES)) < part), "key-sketch")
        points = sketch.count()
        at = F.row_number().over(Window.orderBy(*order_cols))  # SKETCH_POINTS rows a range, not the data
        nth = lambda i: F.floor(i * ranges / F.lit(max(points, 1)))
        chosen = sketch.withColumn("_at", at.cast("long")).where((nth(F.col("_at")) > nth(F.col("_at") - 1)) & (F.col("_at") < points))
        borders = chosen.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*order_cols))), {**_JSON_TIMES, "ignoreNullFields": "false"})).first()[0]
    place = _range_of(borders, key_type, F.struct(*order_cols))
    sizes = {r["_range"]: r["n"] for r in keys.groupBy(place.alias("_range")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return Ranges(borders, key_type, tuple(sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)))


def number_rows(df: DataFrame, order_cols: list[str], partitions: int | None = None, last: int | None = None,
                range_rows: int | None = None) -> DataFrame:
    """Add ``_rn`` (1-based) in ``order_cols`` order, the keys being unique; and ``_before``, ``_size`` of the row's range.

    Rows go to the partition of their range by its number, the only shuffle, and are sorted there.
    A row's number is the rows before its range, known beforehand, and its place inside it.
    With ``last``, ranges that begin after that row aren't shuffled at all.
    """
    known = sketch_ranges(df, order_cols, partitions, range_rows)
    before = list(accumulate(known.sizes, initial=0))
    kept = [i for i in range(len(known.sizes)) if last is None or before[i] < last] or [0]
    placed = df.withColumn("_range", known.of(F.struct(*order_cols)))
    if len(kept) < len(known.sizes):
        placed = placed.where(F.col("_range") <= kept[-1])
    ordered = placed.repartitionById(len(kept), F.col("_range")).sortWithinPartitions(*order_cols)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    starts = df.sparkSession.createDataFrame([(i, before[i], known.sizes[i]) for i in kept], "_range int, _before long, _size long")
    numbered = (ordered.withColumn("_place", place).join(F.broadcast(starts), "_range")  # one row a range
                .select(*df.columns, (F.col("_before") + F.col("_place") + 1).alias("_rn"), "_before", "_size"))
    return numbered if last is None else numbered.where(F.col("_rn") <= last)


def bounded_extract(source: DataFrame, cfg: PipelineConfig, ts_col: str = "ts",
                    key_col: str = "event_id", partitions: int | None = None) -> DataFrame:
    """S9 + T3: the window's rows in ``(ts, key)`` order (the first ``max_rows`` if there is a cap), numbered
    and paged: ``_rn`` (1-based), ``page`` (0-based int), ``page_row`` (0-based) and ``_on_border``, true for
    the rows of a page that two or more ranges share.

    The cap never funnels through one task (as ``orderBy().limit(k)`` does, merging k rows
    from every partition in a single reducer): ranges past it are left out before the shuffle.
    """
    clash = sorted(set(source.columns) & {*EXTRACT_COLUMNS, "_range", "_place", "_before", "_size"})
    if clash:
        raise ValueError(f"The extract needs these names for itself: {clash}")
    window = extract_window(source, cfg, ts_col)
    ps = int(cfg.page_size)
    numbered = number_rows(window, [ts_col, key_col], partitions, cfg.max_rows, ps * RANGE_PAGES)
    page = F.expr(f"(_rn - 1) DIV {ps}")
    begins, ends = page * ps, (page + 1) * ps
    # a page that begins before its range, or would end after it (as the last one does unless it is full)
    shared = (begins < F.col("_before")) | (ends > F.col("_before") + F.col("_size"))
    return numbered.select(*source.columns, "_rn", page.cast("int").alias("page"),
                           F.expr(f"CAST((_rn - 1) % {ps} AS INT)").alias("page_row"), shared.alias("_on_border"))


def page_label(page: Column) -> Column:
    """Five digits at least; longer numbers keep all of theirs."""
    return F.format_string("%05d", page)


# ---- K1: page sink -------------------------------------------------------------------------

CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
    "encoding": "UTF-8",
}


def write_pages(paged: DataFrame, columns: list[str | Column], prefix: str,
                order_cols: list[str]) -> None:
    """One CSV file per page under ``prefix/page=NNNNN/`` with the rows in extract order.

    Pages are cut from the sorted ranges where they lie; only the pages on a border between
    ranges move, to meet there by page. Both parts read the same shuffle (``ReusedExchange``),
    and one local sort by (page, order) gives the order that the partitioned writer needs.
    Rows that don't say whether they are on a border all move by page.
    """
    if "_on_border" not in paged.columns:
        paged = paged.withColumn("_on_border", F.lit(True))
    labelled = paged.withColumn("page", page_label(F.col("page")))
    inside = labelled.where(~F.col("_on_border"))
    stitched = labelled.where(F.col("_on_border")).repartition(F.col("page"))
    (
        inside.unionAll(stitched)
        .sortWithinPartitions("page", *order_cols)
        .select("page", *columns)
        .write.mode("errorifexists")
        .options(**CSV_WRITE_OPTIONS)
        .partitionBy("page")
        .csv(prefix)
    )


#: Files of a batch folder that count as pages; Spark itself leaves out names that begin with ``_`` or ``.``.
PAGE_SUFFIXES = (".csv", ".txt")


def _page_reader(reader, paths):
    """A batch folder is read as one root (one listing, no glob); explicit lists as given."""
    if isinstance(paths, str):
        return reader.option("recursiveFileLookup", "true"), paths.rstrip("/")
    return reader, paths


def whole_pages(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``key, page, bytes, content`` of every file of a batch folder, or of an explicit list of files."""
    reader, paths = _page_reader(spark.read.format("binaryFile"), paths)
    return reader.load(paths).select(
        F.col("path").alias("key"), F.regexp_extract("path", r"/page=(\d+)/", 1).alias("page"), F.col("length").alias("bytes"), "content")


def page_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S5 observation in one read of each file: ``key, page, bytes, sha256``."""
    return whole_pages(spark, paths).select("key", "page", "bytes", F.sha2(F.col("content"), 256).alias("sha256"))


# ---- S10: page validation --------------------------------------------------------------------

def header_ok(header: Column) -> Column:
    return F.coalesce(F.forall(F.array(*[F.lit(c) for c in HEADER_REQUIRED]), lambda c: F.array_contains(header, c)), F.lit(False))


def page_audit(spark: SparkSession, prefix: str) -> DataFrame:
    """``key, page, bytes, sha256, header_ok, rows, malformed_rows, blank_rows`` per page, from one read of it.

    Every page is held against its own header: records (quoted line ends stay inside one) of
    another width are malformed. A page that isn't UTF-8 has no header and no rows.
    """
    if not holds(spark, prefix, PAGE_SUFFIXES):
        raise ValueError(f"No CSV pages under {prefix}")
    text = csv_pages.text_of(F.col("content"))
    read = whole_pages(spark, prefix).select(
        "key", "page", "bytes", F.sha2(F.col("content"), 256).alias("sha256"),
        header_ok(csv_pages.header_fields(text)).alias("header_ok"), csv_pages.record_counts(text).alias("seen"))
    return read.select("key", "page", "bytes", "sha256", "header_ok",
                       *[F.coalesce(F.col(f"seen.{c}"), F.lit(0)).alias(c) for c in ("rows", "malformed_rows", "blank_rows")])


# ---- S11: manifest ---------------------------------------------------------------------------

PAGE_ENTRY_COLUMNS = ("key", "rows", "bytes", "sha256")


def manifest_from_audit(audit: DataFrame, cfg: PipelineConfig, batch_id: str, source_url: str, order_by: str,
                        extracted_at_utc: str, pages_root: str, pages_table: str) -> dict:
    """The manifest of an audited batch; ``ValueError`` names the first page of each fault.

    The audit is written once, to ``pages_table``, which is the page list of the batch at
    every size; the judgement is one aggregate over it and the document refers to it.
    """
    audit.write.mode("overwrite").parquet(pages_table)
    pages = audit.sparkSession.read.schema(audit.schema).parquet(pages_table)
    faults = {
        "header": ~F.col("header_ok"),
        "record width": F.col("malformed_rows") > 0,
        "page size": F.col("rows") > cfg.page_size,
    }
    seen = pages.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("rows"), F.lit(0)).alias("records"),
        *[F.min(F.when(fault, F.col("key"))).alias(name) for name, fault in faults.items()]).first()
    found = [f"{name} ({seen[name]})" for name in faults if seen[name]]
    if found:
        raise ValueError("Bronze pages with a bad " + ", ".join(found))
    records = int(seen["records"])
    return {
        "source_url": source_url, "batch_id": batch_id,
        "start_date_inclusive": cfg.start_date, "end_date_exclusive": cfg.end_date,
        "order_by": order_by, "page_size": cfg.page_size, "max_rows": cfg.max_rows,
        "rows_downloaded": records, "capped": records == cfg.max_rows, "extracted_at_utc": extracted_at_utc,
        "pages_root": pages_root, "pages_table": pages_table, "page_count": int(seen["n"]),
    }


def read_manifest(spark: SparkSession, key: str) -> DataFrame:
    """The manifest as a one-row DataFrame; its pages are those of ``listed_pages``."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(key)


def listed_pages(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``key, rows, bytes, sha256`` of every page that the manifest lists."""
    return spark.read.parquet(manifest.first()["pages_table"]).select(*PAGE_ENTRY_COLUMNS)


def verify_pages(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """S4 + S5: the pages listed and the files in the batch folder, held against each other.

    Output ``key, rows, listed, present, bytes_ok, sha256_ok, manifest_consistent``: a page
    missing on storage has ``present = false``, a file that no list names ``listed = false``.
    Where all is true the folder holds the listed pages and nothing else, so it can be read whole.
    """
    listed = listed_pages(spark, manifest)
    declared = manifest.select("rows_downloaded", "pages_root").first()
    listed_rows = listed.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    observed = page_files(spark, declared["pages_root"]).select(
        "key", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha256"))
    return (
        listed.join(observed, "key", "full")
        .select("key", "rows",
                F.col("bytes").isNotNull().alias("listed"),
                F.col("_bytes").isNotNull().alias("present"),
                F.coalesce(F.col("_bytes") == F.col("bytes"), F.lit(False)).alias("bytes_ok"),
                F.coalesce(F.col("_sha256") == F.col("sha256"), F.lit(False)).alias("sha256_ok"),
                F.lit(bool(declared["rows_downloaded"] == listed_rows)).alias("manifest_consistent"))
    )


def read_pages(spark: SparkSession, keys: list[str] | str, required) -> DataFrame:
    """S1 + S2: the pages of a batch folder or a list of files, all columns as strings, strict parsing.

    ``enforceSchema=false`` makes every page's header be checked against the first one.
    """
    reader = (spark.read.option("header", "true").option("multiLine", "true").option("mode", "FAILFAST")
              .option("enforceSchema", "false"))
    reader, keys = _page_reader(reader, keys)
    raw = reader.csv(keys)
    missing = sorted(set(required).difference(raw.columns))
    if missing:
        raise ValueError(f"Missing columns in Bronze: {missing}")
    return raw
