"""Bronze: bounded ordered extract, paging, page sink, page audit and manifest integrity."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tripgate.config import PipelineConfig
from tripgate.functions.parsing import RAW_COLUMNS
from tripgate.plans.pipeline import build_silver, check_bronze, ingest
from tripgate.session import zoned_session
from tripgate.sources import bronze, csv_pages, documents

PAGE_COLUMNS = ("trip_id", "trip_start_timestamp", "trip_total", "trip_seconds")


def source(spark, n, day="2023-01-01"):
    """n trips, one per minute, with the columns the pipeline pages carry."""
    rows = [(i, f"{day} 00:{i:02d}:00", f"t{i:03d}") for i in range(n)]
    df = spark.createDataFrame(rows, "event_id long, ts_s string, trip_id string")
    return df.select("event_id", F.to_timestamp_ntz("ts_s").alias("ts"), "trip_id")


TRIP_COLUMNS = (
    "trip_id",
    "replace(cast(ts AS STRING), ' ', 'T') AS trip_start_timestamp",
    "CAST(NULL AS STRING) AS trip_end_timestamp",
    "'300' AS trip_seconds",
    "'1.5' AS trip_miles",
    "'12.00' AS trip_total",
    "'8' AS pickup_community_area",
)


def cfg_for(root, **kw):
    return PipelineConfig(start_date="2023-01-01", end_date="2023-01-02", root=root, **kw)


def test_window_is_half_open_and_pushed_down(spark):
    df = source(spark, 3)
    edge = spark.createDataFrame([(99, "2023-01-02 00:00:00", "x")], "event_id long, ts_s string, trip_id string")
    df = df.unionByName(edge.select("event_id", F.to_timestamp_ntz("ts_s").alias("ts"), "trip_id"))
    assert bronze.extract_window(df, cfg_for("")).count() == 3


def test_pages_and_cap(spark):
    paged = bronze.bounded_extract(source(spark, 3), cfg_for("", page_size=2, max_rows=10))
    rows = [(r.event_id, r._rn, r.page, r.page_row) for r in paged.orderBy("_rn").collect()]
    assert rows == [(0, 1, 0, 0), (1, 2, 0, 1), (2, 3, 1, 0)]
    capped = bronze.bounded_extract(source(spark, 5), cfg_for("", page_size=2, max_rows=3))
    assert [r.event_id for r in capped.orderBy("_rn").collect()] == [0, 1, 2]


def test_distributed_numbering_matches_sort(spark):
    """The range-partitioned numbering equals a plain global ordering, for many partitions."""
    n = 2500
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("event_id"),
                               F.to_timestamp_ntz(F.lit("2023-01-01 00:00:00")).alias("ts"))
    numbered = bronze.number_rows(df.repartition(13), ["ts", "event_id"], partitions=11)
    got = sorted((r._rn, r.event_id) for r in numbered.collect())
    assert got == [(i + 1, i) for i in range(n)]


def test_cap_across_many_partitions(spark):
    """Each partition keeps its own first rows; the global first ``max_rows`` survive."""
    src = source(spark, 40).repartition(7)
    capped = bronze.bounded_extract(src, cfg_for("", page_size=3, max_rows=10))
    rows = [(r.event_id, r._rn, r.page) for r in capped.orderBy("_rn").collect()]
    assert rows == [(i, i + 1, i // 3) for i in range(10)]


def pages_of(spark, info):
    return bronze.listed_pages(spark, bronze.read_manifest(spark, info["manifest_key"])).orderBy("key").collect()


def test_ingest_writes_pages_and_manifest(spark, scratch):
    cfg = cfg_for(scratch, page_size=2, max_rows=10)
    info = ingest(spark, cfg, source(spark, 3), batch_id="b1", columns=TRIP_COLUMNS)
    assert info["rows_downloaded"] == 3 and info["pages"] == 2
    manifest = documents.load_json(spark, info["manifest_key"])
    assert manifest["capped"] is False
    pages = pages_of(spark, info)
    assert [p.rows for p in pages] == [2, 1]
    assert all(len(p.sha256) == 64 for p in pages)
    assert all("/bronze/trips/start=2023-01-01/end=2023-01-02/batch=b1/" in p.key for p in pages)
    # The window copy equals the immutable batch copy.
    assert documents.load_json(spark, cfg.metadata_window("manifest.json")) == manifest
    # A page holds exactly the header and its rows.
    first = documents.read_text(spark, pages[0].key)
    assert first.splitlines()[0] == ",".join(RAW_COLUMNS)
    assert len(first.splitlines()) == 3


def test_ingest_capped_and_immutable(spark, scratch):
    cfg = cfg_for(scratch, page_size=2, max_rows=3)
    info = ingest(spark, cfg, source(spark, 5), batch_id="b1", columns=TRIP_COLUMNS)
    manifest = documents.load_json(spark, info["manifest_key"])
    assert manifest["capped"] is True and manifest["rows_downloaded"] == 3
    assert [p.rows for p in pages_of(spark, info)] == [2, 1]
    with pytest.raises(FileExistsError):
        ingest(spark, cfg, source(spark, 5), batch_id="b1", columns=TRIP_COLUMNS)


def test_empty_extract_writes_no_manifest(spark, scratch):
    cfg = PipelineConfig(start_date="2030-01-01", end_date="2030-01-02", root=scratch)
    with pytest.raises(ValueError, match="No trips"):
        ingest(spark, cfg, source(spark, 3), batch_id="b1", columns=TRIP_COLUMNS)
    assert not documents.exists(spark, cfg.metadata_batch("b1", "manifest.json"))


def _write(spark, path, data: bytes):
    documents.write_text(spark, path, data.decode("utf-8"))


def test_page_validation(spark, scratch):
    good = f"{scratch}/p/page=00000/a.csv"
    quoted = f"{scratch}/p/page=00001/a.csv"
    short = f"{scratch}/p/page=00002/a.csv"
    _write(spark, good, b"trip_id,trip_start_timestamp,trip_total\nabc,2023-01-01T00:00:00.000,12.00\n"
                        b"def,2023-01-01T00:00:00.000,12.00\n")
    _write(spark, quoted, b'trip_id,trip_start_timestamp,trip_total\n"id\npart",2023-01-01T00:00:00.000,10\n')
    _write(spark, short, b"trip_id,trip_start_timestamp,trip_total\na,b\nc,d,e\nf,g,h,i\n")
    out = {r.page: r for r in bronze.page_audit(spark, f"{scratch}/p").collect()}
    assert (out["00000"].rows, out["00000"].malformed_rows) == (2, 0)
    assert (out["00001"].rows, out["00001"].malformed_rows) == (1, 0)
    assert out["00002"].malformed_rows == 2
    assert all(r.header_ok for r in out.values())
    assert all(len(r.sha256) == 64 and r.bytes > 0 for r in out.values())


def test_non_csv_payload_fails_header(spark, scratch):
    _write(spark, f"{scratch}/q/page=00000/a.csv", b'{"error":"rate limit"}\n')
    row = bronze.page_audit(spark, f"{scratch}/q").first()
    assert not row.header_ok


def plain_audit(data: bytes):
    """(header_ok, rows, malformed) by the csv module."""
    csv.field_size_limit(1 << 20)
    try:
        records = list(csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")))
    except UnicodeDecodeError:
        return False, 0, 0
    header = records[0] if records else []
    ok = {"trip_id", "trip_start_timestamp", "trip_total"} <= set(header)
    return ok, max(len(records) - 1, 0), sum(len(r) != len(header) for r in records[1:])


def test_records_split_like_the_csv_module(spark):
    head = b"trip_id,trip_start_timestamp,trip_total\n"
    pages = [
        head, head[:-1], b"", b"\n", head + b"a,b,c", head + b"a,b,c\n\n", head + b"\na,b,c\n", head + b",,\n", head + b"a,b\n,,,\n",
        b"\xef\xbb\xbf" + head + b"a,b,c\n", head.replace(b"\n", b"\r\n") + b"a,b,c\r\nd,e\r\n", head.replace(b"\n", b"\r") + b"a,b,c\rd,e,f",
        b'"trip_id","trip_start_timestamp","trip_total","no ""te"""\n1,2,3,4\n', b'"trip_id"x,trip_start_timestamp,trip_total\n1,2,3\n',
        head + b'"a\nb",c,d\n"e,f","g""\n,h",i\n', head + b'a"b,c"d,e\n1,2,3\n', head + b'"a"b"c,d",e\n', head + b'"open,2,3\n4,5,6\n', head + b'""\n"",,""\n',
        head + b"\xff,b,c\n", '{"error":"rate limit"}'.encode(), "trip_id,trip_start_timestamp,trip_total\n\u00e9\u2028,b\u0085,c\n".encode(),
        b"extra," + head + b"1,2,3,4\n1,2,3\n", head + b'"' + b'x""' * 60_000 + b'",b,c\n' + b"y" * 200_000 + b",b,c\n",
    ]
    rng = random.Random(4)
    pages += [head + bytes(rng.choices(b'ab,"\n\r', weights=[4, 4, 4, 2, 2, 1], k=rng.randrange(60))) for _ in range(400)]
    text = csv_pages.text_of(F.col("data"))
    got = spark.createDataFrame([(i, d) for i, d in enumerate(pages)], "i int, data binary").select(
        "i", bronze.header_ok(csv_pages.header_fields(text)).alias("ok"), csv_pages.record_counts(text).alias("c")).collect()
    for r in got:
        seen = (r.ok, r.c.rows or 0, r.c.malformed_rows or 0)
        assert seen == plain_audit(pages[r.i]), pages[r.i][:200]


def test_each_page_has_its_own_header(spark, scratch):
    _write(spark, f"{scratch}/h/page=00000/a.csv", b"trip_id,trip_start_timestamp,trip_total\na,b,c\n")
    _write(spark, f"{scratch}/h/page=00001/a.csv", b"note,trip_total,trip_id,trip_start_timestamp\na,b,c,d\na,b,c\n")
    got = {r.page: (r.header_ok, r.rows, r.malformed_rows) for r in bronze.page_audit(spark, f"{scratch}/h").collect()}
    assert got == {"00000": (True, 1, 0), "00001": (True, 2, 1)}


def test_manifest_names_the_faulty_pages(spark, scratch):
    audit = spark.createDataFrame(
        [("k0", "00000", 9, "x", True, 3, 1, 0), ("k1", "00001", 9, "x", False, 3, 0, 0), ("k2", "00002", 9, "x", True, 4, 0, 0)],
        "key string, page string, bytes long, sha256 string, header_ok boolean, rows long, malformed_rows long, blank_rows long")
    with pytest.raises(ValueError, match=r"header \(k1\), record width \(k0\), page size \(k2\)"):
        bronze.manifest_from_audit(audit, cfg_for("", page_size=3), "b", "s", "o", "t", "r", f"{scratch}/pages")


def test_integrity_detects_tampering(spark, scratch):
    cfg = cfg_for(scratch, page_size=2, max_rows=10)
    info = ingest(spark, cfg, source(spark, 3), batch_id="b1", columns=TRIP_COLUMNS)
    assert check_bronze(spark, info["manifest_key"])["batch_id"] == "b1"
    page = pages_of(spark, info)[1].key
    text = documents.read_text(spark, page)
    documents.write_text(spark, page, text.replace("12.00", "13.00"))  # same size, new bytes
    with pytest.raises(AssertionError, match="differs from what the manifest"):
        build_silver(spark, cfg, info["manifest_key"])
    checks = {r.key: r for r in bronze.verify_pages(spark, bronze.read_manifest(spark, info["manifest_key"])).collect()}
    assert checks[page].bytes_ok and not checks[page].sha256_ok


def test_manifest_row_mismatch_detected(spark, scratch):
    cfg = cfg_for(scratch, page_size=2, max_rows=10)
    info = ingest(spark, cfg, source(spark, 3), batch_id="b1", columns=TRIP_COLUMNS)
    manifest = documents.load_json(spark, info["manifest_key"])
    manifest["rows_downloaded"] = 4
    documents.save_json(spark, info["manifest_key"], manifest)
    with pytest.raises(AssertionError, match="do not add up"):
        check_bronze(spark, info["manifest_key"])


def test_read_pages_requires_columns(spark, scratch):
    _write(spark, f"{scratch}/r/a.csv", b"trip_id,trip_total\nx,1\n")
    with pytest.raises(ValueError, match="Missing columns in Bronze"):
        bronze.read_pages(spark, [f"{scratch}/r/a.csv"], RAW_COLUMNS)


def test_scan_count_must_match_manifest(spark, scratch):
    """S3: a manifest that adds up and whose pages are intact still fails when the CSV scan
    finds another number of records."""
    cfg = cfg_for(scratch, page_size=2, max_rows=10)
    info = ingest(spark, cfg, source(spark, 3), batch_id="b1", columns=TRIP_COLUMNS)
    manifest = documents.load_json(spark, info["manifest_key"])
    rows = [(p.key, 2, p.bytes, p.sha256) for p in pages_of(spark, info)]
    spark.createDataFrame(rows, "key string, rows long, bytes long, sha256 string").write.parquet(f"{scratch}/other_pages")
    documents.save_json(spark, info["manifest_key"], {**manifest, "rows_downloaded": 4, "pages_table": f"{scratch}/other_pages"})
    with pytest.raises(AssertionError, match="hold 3 records, their manifest says 4"):
        build_silver(spark, cfg, info["manifest_key"])


def test_folder_and_page_list_must_agree(spark, scratch):
    cfg = cfg_for(scratch, page_size=2, max_rows=10)
    info = ingest(spark, cfg, source(spark, 5), batch_id="b1", columns=TRIP_COLUMNS)
    assert [p.rows for p in pages_of(spark, info)] == [2, 2, 1] and info["pages"] == 3
    assert build_silver(spark, cfg, info["manifest_key"])["raw_rows"] == 5
    stray = f"{cfg.bronze_prefix('b1')}/page=00099/stray.csv"
    _write(spark, stray, b"trip_id\n")
    with pytest.raises(AssertionError, match="stray.csv"):
        check_bronze(spark, info["manifest_key"])
    documents.delete(spark, stray)
    documents.delete(spark, pages_of(spark, info)[0].key)
    with pytest.raises(AssertionError, match="page=00000"):
        check_bronze(spark, info["manifest_key"])


# ---- ranges from a sketch, pages cut from them ---------------------------------------------------

def many(spark, n, tie=1):
    """n rows in an order of their own; ``tie`` rows share each instant."""
    rank = F.col("id") * 7919 % n
    ts = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(rank / tie))
    return spark.range(0, n, 1, 7).select(rank.alias("event_id"), ts.alias("ts"), F.concat(F.lit("t"), rank).alias("trip_id"))


def test_ranges_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(bronze, "RANGE_BYTES", 5_000)
    few, lots = (bronze.sketch_ranges(many(spark, n), ["ts", "event_id"]) for n in (1_000, 10_000))
    assert len(few.sizes) >= 5 and 8 <= len(lots.sizes) / len(few.sizes) <= 12
    assert few.rows == 1_000 and lots.rows == 10_000
    assert max(lots.sizes) < 3 * lots.rows / len(lots.sizes)
    assert bronze.number_rows(many(spark, 10_000), ["ts", "event_id"]).rdd.getNumPartitions() == len(lots.sizes)
    assert lots == bronze.sketch_ranges(many(spark, 10_000).repartition(3), ["ts", "event_id"])


@pytest.mark.parametrize("n,tie,partitions", [(3_000, 1, 9), (3_000, 1_000, 9), (3_000, 3_000, 40), (5, 1, 9), (0, 1, 4)])
def test_numbers_hold_for_tied_instants_and_few_rows(spark, n, tie, partitions):
    src = many(spark, n, tie) if n else many(spark, 5).limit(0)
    numbered = bronze.number_rows(src, ["ts", "event_id"], partitions)
    assert sorted((r._rn, r.event_id) for r in numbered.collect()) == [(i + 1, i) for i in range(n)]


@pytest.mark.parametrize("key", ["string", "decimal(20,3)", "double", "timestamp", "date"])
def test_ranges_of_other_key_types(spark, key):
    rank = F.col("id") * 37 % 500
    moment = F.timestamp_micros(F.lit(1_699_160_000_000_000) + rank * 60_000_017)  # over the hour that repeats in autumn
    value = moment if key == "timestamp" else F.date_add(F.lit("2024-01-01").cast("date"), rank.cast("int")) if key == "date" else (
        F.concat(F.lit('a},{"'), F.lpad(rank.cast("string"), 4, "0")) if key == "string" else rank.cast(key) / 8)
    src = spark.range(500).select(value.alias("k"), F.when(rank > 3, rank).alias("event_id"))
    got = [r.event_id for r in bronze.number_rows(src, ["k", "event_id"], 6).orderBy("_rn").collect()]
    assert got[4:] == list(range(4, 500)) and got[:4] == [None] * 4
    assert len(bronze.sketch_ranges(src, ["k", "event_id"], 6).sizes) == 6


@pytest.mark.parametrize("page_size,cap,partitions", [(7, None, 5), (100, None, 5), (1_000, None, 6), (7, 200, 5), (5_000, None, 3)])
def test_pages_cut_from_ranges_equal_pages_of_the_whole_order(spark, scratch, page_size, cap, partitions):
    n = 700
    cfg = PipelineConfig(start_date="2023-01-01", end_date="2023-01-02", root=scratch, page_size=page_size, max_rows=cap)
    paged = bronze.bounded_extract(many(spark, n, 3), cfg, partitions=partitions)
    bronze.write_pages(paged, ["event_id", "trip_id"], f"{scratch}/pages", ["ts", "event_id"])
    files = bronze.page_files(spark, f"{scratch}/pages").orderBy("page").collect()
    rows = min(n, cap or n)
    assert len(files) == -(-rows // page_size)
    for i, f in enumerate(files):
        lines = documents.read_text(spark, f.key).splitlines()
        assert f.page == f"{i:05d}" and lines == ["event_id,trip_id"] + [f"{k},t{k}" for k in range(i * page_size, min(rows, (i + 1) * page_size))]


def test_only_border_pages_move_after_the_one_shuffle(spark, scratch):
    n, partitions = 6_000, 6
    cfg = PipelineConfig(start_date="2023-01-01", end_date="2023-01-03", root=scratch, page_size=50)
    src = spark.read.parquet(_stored(many(spark, n), scratch))
    paged = bronze.bounded_extract(src, cfg, partitions=partitions)
    assert paged.where("_on_border").count() <= partitions * 50
    plan = paged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1 and plan.count("FileScan") == 1
    both = paged.where("not _on_border").unionAll(paged.where("_on_border").repartition("page"))
    both.collect()
    final = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1 and final.count("FileScan") == 1


def _stored(df, folder):
    df.write.parquet(f"{folder}/stored")
    return f"{folder}/stored"


def test_ranges_past_the_cap_are_not_shuffled(spark):
    src = many(spark, 1_000)
    numbered = bronze.number_rows(src, ["ts", "event_id"], 10, last=150)
    assert numbered.rdd.getNumPartitions() <= 4
    assert sorted(r._rn for r in numbered.collect()) == list(range(1, 151))


def test_source_columns_may_not_clash(spark):
    with pytest.raises(ValueError, match="page_row"):
        bronze.bounded_extract(source(spark, 3).withColumn("page_row", F.lit(1)), cfg_for(""))


def test_a_range_holds_a_bounded_number_of_pages(spark, monkeypatch):
    monkeypatch.setattr(bronze, "RANGE_PAGES", 4)
    cfg = cfg_for("", page_size=25)
    few, lots = (bronze.bounded_extract(many(spark, n), cfg) for n in (1_000, 4_000))
    assert [df.rdd.getNumPartitions() for df in (few, lots)] == [10, 40]
    rows = lots.orderBy("_rn").collect()
    assert [(r._rn, r.event_id, r.page, r.page_row) for r in rows] == [(i + 1, i, i // 25, i % 25) for i in range(4_000)]


def test_a_range_is_found_without_a_struct_for_each_step(spark):
    borders = [{"k": k} for k in range(0, 70, 2)]
    place = bronze._range_of(json.dumps(borders), "struct<k:int>", F.struct(F.col("id").cast("int").alias("k")))
    assert [r[0] for r in spark.range(-3, 75).select(place).collect()] == [sum(b["k"] <= i for b in borders) for i in range(-3, 75)]
    plan = spark.range(9).select(place.alias("place"))._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(lo" not in plan and "from_json" not in plan


def test_page_folders_are_listed_by_a_bounded_number_of_tasks(spark, scratch):
    zoned = zoned_session(spark)
    spark.range(130).selectExpr("id", "id AS page").write.partitionBy("page").parquet(scratch)
    spark.sparkContext.setJobGroup("listing", "listing")
    assert len(zoned.read.option("recursiveFileLookup", "true").format("binaryFile").load(scratch).inputFiles()) >= 130
    seen = spark.sparkContext.statusTracker()
    stages = [seen.getStageInfo(i) for j in seen.getJobIdsForGroup("listing") for i in seen.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages) <= 96
