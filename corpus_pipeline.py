"""A training corpus from raw documents: toxicity, near duplicates, benchmark leaks, mixing, shards.

Columns beyond those of ``documents`` go through every stage untouched, whatever their names; only the
last stage's own (n_bytes, shard, depth, shard_bytes) replace columns of these names. An empty table stays empty.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgate.llm import decontam, jaccard, mixing, sharding, toxicity
from tripgate.llm.common import BLANKS, WORD, materialize, small, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


OWN_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(stage: Stage) -> Stage:
    """``stage`` with all further columns packed away, so that their names can't meet those that it uses."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = [c for c in docs.columns if c not in OWN_COLUMNS]
        if not extra:
            return stage(spark, docs, sf_dir)
        own = [c for c in docs.columns if c in OWN_COLUMNS]
        held = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(extra)])
        out = stage(spark, docs.select(*own, held.alias("held_columns")), sf_dir)
        added = [c for c in out.columns if c not in (*own, "held_columns")]
        back = {c: F.col(f"held_columns.c{i}") for i, c in enumerate(extra)}
        return out.select(*[back[c].alias(c) if c in back else F.col(c) for c in docs.columns if c not in added], *added)

    return run_stage


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``_row``, a number of its own for each row, written once so that all reads see the same numbers."""
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), name)


@shielded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled ones of this stage's input."""
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, weights, keep_text=True)
    return scored.where("predicted = 0").select(*docs.columns)


@shielded
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by 5-word shingles at 0.8 the one with the smallest id stays, null ids last; then the first row.

    Rows are judged, not ids: a null id has no privilege, and different texts under one id are different documents.
    Texts without words are linked with nothing; of rows that repeat one under the same id the first stays.
    """
    rows = keyed(docs, "near-duplicate-rows")
    groups = jaccard.jaccard_components(rows.select(F.col("_row").alias("doc_id"), "text")).where("n_shingles > 0")
    group = F.when(F.col("component_id").isNotNull(), F.struct(F.lit("linked").alias("how"), F.col("component_id").cast("string").alias("by"))).when(
        F.col("doc_id").isNotNull(), F.struct(F.lit("empty").alias("how"), F.col("doc_id").cast("string").alias("by")))
    linked = (rows.select("_row", "doc_id").join(groups.withColumnRenamed("doc_id", "_of"), F.col("_row") == F.col("_of"), "left")
              .select("_row", "doc_id", group.alias("_group")).where("_group is not null"))
    linked = materialize(linked, "near-duplicate-groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    first = materialize(linked.groupBy("_group").agg(F.min(order)["_row"].alias("_first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "near-duplicate-firsts")
    worse = linked.join(small(first, first.count(), 48), "_group").where("_row <> _first").select("_row")
    gone = materialize(worse, "near-duplicates")
    return rows.join(small(gone, gone.count(), 16), "_row", "left_anti").select(*docs.columns)


@shielded
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds a benchmark item go, whatever their id."""
    gone = materialize(decontam.contaminated_texts(docs, table(spark, sf_dir, "benchmark")), "contaminated")
    rows = docs.withColumn("_key", decontam.text_key(F.col("text")))
    return rows.join(small(gone, gone.count(), 48), F.col("_key") == F.col("key"), "left_anti").select(*docs.columns)


def _cut(text: Column, size: Column, runs: Column) -> Column:
    """The text of each run (words ``a`` to ``b``), blanks inside it as they are; a run over all words is the text itself."""
    is_all = lambda r: (r["a"] == 0) & (r["b"] == size)
    # every word with the blanks that follow it
    parts = F.split(F.regexp_replace(text, f"^{BLANKS}", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    piece = lambda p, r: F.regexp_replace(F.array_join(F.slice(p, r["a"] + 1, r["b"] - r["a"]), ""), f"{BLANKS}$", "")
    cut = F.transform(F.array(parts), lambda p: F.transform(runs, lambda r: F.when(is_all(r), text).otherwise(piece(p, r))))[0]
    return F.when(F.forall(runs, is_all), F.transform(runs, lambda r: text)).otherwise(cut)


@shielded
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: a row for every unbroken run of words of each pass, with that text.

    So every source has as many words as its target says. Documents without words weigh nothing in the mix and stay.
    """
    rows = keyed(docs, "mix-rows")
    # the k-th time that a piece is taken belongs to the document's k-th copy; the cut slot is the last
    pieces = (mixing.plan_mix(rows, keep=["_row"]).pieces().groupBy("_row", "size", "from_word")
              .agg(F.sort_array(F.collect_list("n_words"), asc=False).alias("n"))
              .select("_row", "size", "from_word", F.posexplode("n").alias("copy", "n")))
    step = F.struct(F.col("copy"), F.col("from_word").cast("int").alias("a"), (F.col("from_word") + F.col("n")).cast("int").alias("b"))

    def joined(runs: Column, p: Column) -> Column:
        last = F.element_at(runs, -1)
        goes_on = (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["copy"] == p["copy"]) & (F.try_element_at(runs, F.lit(-1))["b"] == p["a"])
        return F.when(goes_on, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(p["copy"].alias("copy"), last["a"].alias("a"), p["b"].alias("b"))))
                      ).otherwise(F.concat(runs, F.array(p)))

    none = F.array().cast("array<struct<copy:int,a:int,b:int>>")
    runs = pieces.groupBy("_row", "size").agg(F.array_sort(F.collect_list(step)).alias("p")).select(
        "_row", F.col("size").alias("_size"), F.aggregate("p", none, joined).alias("_runs"))
    runs = materialize(runs, "mix-runs")
    total = runs.agg(F.sum(F.size("_runs") + 2)).first()[0] or 0
    text = F.col("text").cast("string")
    taken = rows.join(small(runs, total, 24), "_row", "left").where(F.col("_runs").isNotNull() | ~F.coalesce(text.rlike(WORD), F.lit(False)))
    taken = taken.withColumn("_piece", F.explode(F.coalesce(_cut(text, F.col("_size"), F.col("_runs")), F.array(text))))
    if "n_chars" in docs.columns:
        whole = F.col("_piece").eqNullSafe(text)
        taken = taken.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("_piece")).cast(docs.schema["n_chars"].dataType))
    return taken.withColumn("text", F.col("_piece")).select(*docs.columns)


@shielded
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its shard."""
    return sharding.shard(docs, keep=docs.columns)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
