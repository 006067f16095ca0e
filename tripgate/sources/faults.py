"""Faulty landings for the audit and the integrity check, made by rules that SQL can repeat.

``LINE_RULES`` and ``PAGE_RULES`` are texts valid in Spark SQL and in DuckDB: the queries write
their pages with them, the oracle derives bodies, counts and flags from the same texts over
the same rows. The rules look at page and row numbers only, so every row of the input takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgate.sources.bronze import page_label

# The header of a page and a header that lacks a required column.
HEADER = "trip_id,trip_start_timestamp,trip_end_timestamp,trip_seconds,trip_miles,trip_total,pickup_community_area"
BYTE_ORDER_MARK = "\ufeff"
FOREIGN_HEADER = "trip,trip_start_timestamp,trip_end_timestamp,trip_seconds,trip_miles,trip_total,pickup_community_area"

#: What becomes of a page's header line: its kind is ``page % 10``.
HEADER_RULE = f"""CASE page % 10
  WHEN 3 THEN '{FOREIGN_HEADER}'
  WHEN 4 THEN '{{"error":"rate limit"}}'
  WHEN 6 THEN concat('{BYTE_ORDER_MARK}"', replace('{HEADER}', ',', '","'), '"', chr(13))
  WHEN 8 THEN 'note,{HEADER}'
  ELSE '{HEADER}' END"""

#: What becomes of a record, given as ``line`` (``id`` is its first field, ``rest`` what follows, comma included).
LINE_RULE = """CASE
  WHEN page % 10 = 1 AND page_row % 50 = 7 THEN 'a,b'
  WHEN page % 10 = 2 AND page_row % 40 = 3 THEN concat(line, ',more')
  WHEN page % 10 = 5 AND page_row % 30 = 1 THEN concat('"', id, chr(10), ',""', chr(13), '"', rest)
  WHEN page % 10 = 6 THEN concat(line, chr(13))
  WHEN page % 10 = 7 AND page_row % 100 = 9 THEN ''
  WHEN page % 10 = 7 AND page_row % 100 = 10 THEN ',,,,,,'
  WHEN page % 10 = 8 AND page_row % 60 = 5 THEN line
  WHEN page % 10 = 8 THEN concat('seen,', line)
  WHEN page % 10 = 9 AND page_row % 20 = 2 THEN concat('5" x', id, rest)
  ELSE line END"""

#: A page of kind 4 is an error document: it has no records.
HAS_RECORDS = "page % 10 <> 4"
HEADER_GOOD = "page % 10 NOT IN (3, 4)"
MALFORMED = """(page % 10 = 1 AND page_row % 50 = 7) OR (page % 10 = 2 AND page_row % 40 = 3)
  OR (page % 10 = 7 AND page_row % 100 = 9) OR (page % 10 = 8 AND page_row % 60 = 5)"""
#: Of the records that came blank already, those that a rule has made something else of.
BLANK_GONE = "(page % 10 = 8) OR (page % 10 = 9 AND page_row % 20 = 2) OR (page % 10 = 5 AND page_row % 30 = 1)"
BLANK_MADE = "page % 10 = 7 AND page_row % 100 = 10"

#: What storage holds of a landed page (``body``; ``last_line`` is the length of its last record): its kind is ``page % 6``.
#: Kind 1 has one byte changed, the first of its first record; kind 3 lacks its last record.
BODY_RULE = f"""CASE page % 6
  WHEN 1 THEN concat(substr(body, 1, {len(HEADER) + 1}), '#', substr(body, {len(HEADER) + 3}))
  WHEN 3 THEN substr(body, 1, length(body) - last_line)
  ELSE body END"""
MISSING = "page % 6 = 2"
#: Pages beside which lies a file that no list names.
STRAY = "page % 6 = 4"
STRAY_BODY = f"concat('{HEADER}', chr(10), 'stray,,,,,,', chr(10))"
STRAY_OFFSET = 100_000


def write_faulty_pages(paged: DataFrame, columns: list, prefix: str) -> None:
    """Pages whose header and records follow ``HEADER_RULE`` and ``LINE_RULE``, a text file each, rows in order."""
    fields = paged.select("page", "page_row", *columns)
    names = fields.columns[2:]
    text = [F.coalesce(F.col(c), F.lit("")) for c in names]
    lines = fields.select("page", "page_row", text[0].alias("id"), F.concat(*[x for t in text[1:] for x in (F.lit(","), t)]).alias("rest")).withColumn(
        "line", F.concat("id", "rest"))
    records = lines.where(HAS_RECORDS).select("page", "page_row", F.expr(LINE_RULE).alias("value"))
    headers = lines.where("page_row = 0").select("page", F.lit(-1).alias("page_row"), F.expr(HEADER_RULE).alias("value"))
    (headers.unionByName(records).withColumn("page", page_label(F.col("page")))
     .repartition("page").sortWithinPartitions("page", "page_row").select("page", "value")
     .write.mode("errorifexists").partitionBy("page").text(prefix))


def write_faulty_storage(pages: DataFrame, prefix: str) -> None:
    """Copies of landed pages (``page``, ``content``) as ``BODY_RULE`` has them, without the missing ones, with the strays."""
    whole = pages.select(F.col("page").cast("int").alias("page"), F.decode("content", "UTF-8").alias("body"))
    last_line = F.length("body") - F.length(F.regexp_extract("body", r"(?s)\A(.*\n)[^\n]*\n\z", 1))
    kept = whole.where(f"NOT ({MISSING})").withColumn("last_line", last_line).select("page", F.expr(BODY_RULE).alias("value"))
    strays = whole.where(STRAY).select((F.col("page") + STRAY_OFFSET).alias("page"), F.expr(STRAY_BODY).alias("value"))
    # the writer ends every text with a line end, which the pages have already
    (kept.unionByName(strays).select(page_label(F.col("page")).alias("page"), F.regexp_replace("value", r"\n\z", "").alias("value"))
     .write.mode("errorifexists").partitionBy("page").text(prefix))
