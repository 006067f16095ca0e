"""The registered corpus queries against their SQL, and the pipeline stage by stage."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck
from tripgate.llm import decontam, mixing, queries


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, key):
    result = compare(spark, key, queries.QUERIES[key], queries.ORACLE_SQL[key], SF_SMALL, duck(SF_SMALL))
    assert result["ok"], result


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF_SMALL)
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in kept.select("doc_id").collect()}
        if name == "ngram_jaccard":
            assert out.count() == len(ids)
        kept = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL)
    assert last.count() == kept.count() and set(docs.columns) < set(last.columns)


def test_mixing_stage_gives_each_source_its_target(spark):
    rng = random.Random(6)
    rows = [(i, "  " + "".join(f"w{rng.randrange(500)}" + rng.choice([" ", "\n", "\t "]) for _ in range(n)), "xx", f"s{i % 3}", 0)
            for i, n in enumerate(rng.choices([3, 100, 256, 700, 5000], k=240))]
    rows += [(900, None, "xx", "s0", 0), (901, " \n", "xx", "s1", 0), (None, "no id " * 50, "xx", "s2", 0), (None, "no id " * 50, "xx", "s2", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    out = corpus_pipeline.mix(spark, docs, SF_SMALL).collect()
    sizes, got = Counter(), Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    for r in out:
        got[r.source] += len((r.text or "").split())
        assert r.doc_id in (900, 901) or r.text in texts_of(rows, r.doc_id)
    goals = mixing.targets([sizes[s] for s in sorted(sizes)], mixing.WEIGHTS)
    assert [got[s] for s in sorted(sizes)] == [pytest.approx(g, abs=0.5) for g in goals]
    assert sum(r.doc_id in (900, 901) for r in out) == 2


def texts_of(rows, doc_id):
    return "\n".join(t for i, t, *_ in rows if i == doc_id)


def test_stages_judge_rows_and_not_ids(spark):
    rng = random.Random(7)
    item, a, b, c = (" ".join(rng.choices([f"w{i}" for i in range(900)], k=40)) for _ in range(4))
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    rows = [(i, t, "xx", "s", 0) for i, t in [(None, item), (None, None), (1, item), (1, a), (2, b), (2, c), (2, c), (3, a), (None, b), (None, b), (4, ""), (4, ""), (5, None)]]
    docs = spark.createDataFrame(rows, schema)
    key = lambda r: (str(r[0]), str(r[1]))
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_SMALL).collect()
    assert sorted(map(key, kept)) == sorted(map(key, [(None, None), (1, item), (1, a), (2, b), (2, c), (4, ""), (5, None)]))
    known = f"{SF_SMALL}/benchmark.parquet"
    leak = spark.read.parquet(known).where("length(text) > 200").first().text
    docs = spark.createDataFrame([(None, "so " + leak, "xx", "s", 0), (1, leak, "xx", "s", 0), (1, a, "xx", "s", 0), (None, b, "xx", "s", 0), (None, None, "xx", "s", 0)], schema)
    kept = corpus_pipeline.decontaminate(spark, docs, SF_SMALL).collect()
    assert sorted(map(key, kept)) == sorted(map(key, [(1, a), (None, b), (None, None)]))
    found = decontam.contamination(docs, spark.read.parquet(known)).collect()
    assert {r.doc_id for r in found} == {None, 1}


ODD = ("_row", "_of", "_group", "_key", "key", "h", "n", "_size", "_runs", "_piece", "_text", "score", "predicted", "label", "ord", "model", "cell", "_hi", "held_columns", "shard")


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120).select(
        "doc_id", *[F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in ODD], "text", "lang", "source", "n_chars")
    kept = spark.createDataFrame(docs.collect(), docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF_SMALL)
        last = name == "sharding"
        assert out.columns[:len(docs.columns) - last] == [c for c in docs.columns if not (last and c == "shard")], name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in ODD if not (last and c == "shard")), name
        kept = spark.createDataFrame(rows, out.schema)


def test_pipeline_of_empty_tables(spark, tmp_path):
    con = duck(SF_SMALL)
    for table in ("documents", "labels", "benchmark"):
        con.sql(f"SELECT * FROM {table} LIMIT 0").write_parquet(f"{tmp_path}/{table}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "text", "shard"} <= set(out.columns)
    # documents without labels and items: nothing is toxic, nothing leaks
    (tmp_path / "some").mkdir()
    con.sql("SELECT * FROM documents LIMIT 40").write_parquet(f"{tmp_path}/some/documents.parquet")
    for table in ("labels", "benchmark"):
        con.sql(f"SELECT * FROM {table} LIMIT 0").write_parquet(f"{tmp_path}/some/{table}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0
