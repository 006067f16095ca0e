"""Choice of the classifier's settings from rows that may teach: ``python tests/llm/choose_toxicity.py SF_DIR...``

Rows with crc32(doc_id) mod 3 = 0 learn and those with 2 judge; rows with 1 are held out by contract and left out
before anything is read of them. Prints, for each setting, the log loss of the judging rows summed over
the given folders, the share of toxic rows caught at the threshold and the clean ones flagged; the least loss wins.
"""

import itertools
import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

GRID = {"epochs": (1, 2, 4), "alpha": (0.3, 1.0, 2.0, 4.0), "l1": (2.0, 4.0, 8.0)}


def judged(spark, sf_dir, **settings):
    """(loss, caught, toxic, flagged, clean) of the judging rows."""
    from pyspark.sql import functions as F

    from tripgate.llm import toxicity

    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(third != 1)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(third != 1)
    weights = toxicity.train(docs.where(third == 0), labels.where(third == 0), **settings)
    known = labels.where((third == 2) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = toxicity.score(docs.where(third == 2).join(known, "doc_id").select("doc_id", "text", "toxic"), weights).select("toxic", "score", "predicted").collect()
    loss = -sum(math.log(min(max(r.score if r.toxic else 1 - r.score, 1e-9), 1)) for r in rows)
    return (loss, sum(r.toxic and r.predicted for r in rows), sum(r.toxic for r in rows), sum(not r.toxic and r.predicted for r in rows), sum(not r.toxic for r in rows))


def choose(spark, folders, grid=None):
    """Settings in order of loss: (loss, settings, counts)."""
    grid = grid or GRID
    out = []
    for values in itertools.product(*grid.values()):
        settings = dict(zip(grid, values, strict=True))
        total = [sum(x) for x in zip(*(judged(spark, f, **settings) for f in folders), strict=True)]
        out.append((total[0], settings, total[1:]))
        print(f"{settings}: loss {total[0]:.2f}, caught {total[1]} of {total[2]}, flagged {total[3]} of {total[4]}", flush=True)
    return sorted(out, key=lambda x: x[0])


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    best = choose(session, sys.argv[1:])[0]
    print("best:", best)
