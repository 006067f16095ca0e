"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of ASCII letters and digits, in either case, and of characters beyond ASCII.
Features of a text are the distinct hashed words, their beginnings of three to five
bytes (languages that inflect), neighbouring word pairs and pairs with one word between,
over its whole length; features met in fewer than ``LEAST_DOCS`` training rows teach nothing. Training visits a bounded sample of labelled rows in one task
(``TRAIN_ROWS`` rows and ``TRAIN_BYTES`` of text at most; one pass after another in a fixed order), with a learning rate for each
coordinate and L1 sparsity, so that what is sent to the executors is a short list of
non-zero weights. Scoring reads every text once, on all executors.

Passes, rate and L1 were chosen by ``tests/llm/choose_toxicity.py`` among rows that may teach: those with
crc32 mod 3 = 0 learn, those with 2 judge. Held-out rows have no part in it.

Defined cases: a null or empty text has the score of the bias alone; without training rows
of both classes every score is 0; several label rows of one id count as their largest
label; null labels and null ids teach nothing; repeated documents are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, ship
from tripgate.llm.wordhash import LETTERS, stretches, word_hashes

DIMENSIONS = 1 << 20
TRAIN_ROWS = 20_000
TRAIN_BYTES = 96 << 20
EPOCHS = 2
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.05
THRESHOLD = 0.7
LEAST_DOCS = 4
BEGINNINGS = (3, 4, 5)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(40)) % np.uint64(DIMENSIONS)).astype(np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of the array, coordinate) of all features; repeats included."""
    lengths, every = word_hashes(texts, LETTERS, BEGINNINGS)
    h, row = every[:, 0], np.repeat(np.arange(len(texts)), lengths)
    rows, coords = [row], [_mixed(h, 1)]
    for k in range(1, every.shape[1]):
        long = every[:, k] != 0
        rows.append(row[long])
        coords.append(_mixed(every[long, k], 4))
    for gap, salt in ((1, 2), (2, 3)):
        if len(h) > gap:
            same = row[:-gap] == row[gap:]
            rows.append(row[:-gap][same])
            coords.append(_mixed((h[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + h[gap:])[same], salt))
    return np.concatenate(rows), np.concatenate(coords)


def _featurized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text")
        for i, j in stretches(texts):
            row, coord = features(texts.slice(i, j - i))
            key = np.unique(row * DIMENSIONS + coord)
            cut = np.searchsorted(key, np.arange(j - i + 1) * DIMENSIONS)
            coords = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array((key % DIMENSIONS).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("ord").slice(i, j - i), b.column("label").slice(i, j - i), coords], ["ord", "label", "coords"])


class Ftrl:
    """Per-coordinate FTRL-proximal state; coordinate ``DIMENSIONS`` is the bias, which has no L1."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == DIMENSIONS, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown


def _slices(coords: np.ndarray, size: int = 1 << 20) -> Iterator[np.ndarray]:
    return (coords[a:a + size] for a in range(0, len(coords), size))


def fitted_parts(parts: list[tuple[np.ndarray, np.ndarray]], ords: np.ndarray, labels: np.ndarray, epochs: int, **settings: float) -> dict[int, float]:
    """Weights from rows given as parts (coordinates of its rows, each row's number of them); rows are visited in an order of their own.

    Nothing without rows of both classes. Beside the parts, which are read where they lie, memory doesn't grow with their coordinates.
    """
    if len(set(labels.tolist())) < 2:
        return {}
    met = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for coords, _ in parts:
        for some in _slices(coords):
            met += np.bincount(some, minlength=len(met))
    met = met >= LEAST_DOCS
    part = np.repeat(np.arange(len(parts)), [len(lengths) for _, lengths in parts])
    ends = np.concatenate([np.cumsum(lengths) for _, lengths in parts])  # inside the row's part
    begins = ends - np.concatenate([lengths for _, lengths in parts])
    model = Ftrl(**settings)
    rows, order = np.lexsort((labels, ords)), np.random.default_rng(7)
    for _ in range(epochs):
        for i in rows[order.permutation(len(rows))]:
            at = parts[part[i]][0][begins[i]:ends[i]]
            model.learn(np.append(at[met[at]], DIMENSIONS), labels[i])
    w = model.weights(np.arange(DIMENSIONS + 1))
    return {int(i): float(w[i]) for i in np.union1d(np.flatnonzero(w), [DIMENSIONS])}


def fitted(coords: np.ndarray, lengths: np.ndarray, ords: np.ndarray, labels: np.ndarray, epochs: int, **settings: float) -> dict[int, float]:
    """``fitted_parts`` of a single part."""
    return fitted_parts([(coords, lengths)], ords, labels, epochs, **settings)


def _trained(epochs: int, settings: dict[str, float]):
    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, ords, labels = [], [np.zeros(0, np.int64)], [np.zeros(0)]
        for b in batches:
            c = b.column("coords")
            parts.append((c.flatten().to_numpy(), np.diff(c.offsets.to_numpy()).astype(np.int64)))  # views of what arrived
            ords.append(b.column("ord").to_numpy())
            labels.append(b.column("label").to_numpy())
        weights = fitted_parts(parts, np.concatenate(ords), np.concatenate(labels), epochs, **settings)
        yield pa.RecordBatch.from_arrays([pa.array(list(weights), pa.int64()), pa.array(list(weights.values()), pa.float64())], ["coord", "weight"])

    return train_all


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS, **settings: float) -> dict[int, float]:
    """Non-zero weights learned from at most about ``train_rows`` labelled, not held-out rows.

    The sample is the rows whose hashed id falls in the share that gives that many; if their texts
    exceed ``TRAIN_BYTES``, a smaller share. The result has at most ``DIMENSIONS`` + 1 entries,
    whatever the corpus. ``settings`` are those of ``Ftrl``.
    """
    ship(docs.sparkSession)
    known = (labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("double").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .withColumn("ord", F.xxhash64("doc_id", F.lit("toxicity"))))
    share = min(1.0, train_rows / max(1, known.count()))
    known = known.where(F.pmod("ord", F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = materialize(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id").select("ord", "label", "text"), "toxicity-sample")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > TRAIN_BYTES:
        rows = rows.where(F.pmod("ord", F.lit(1 << 20)) < int(share * TRAIN_BYTES / size * (1 << 20)))
    rows = rows.mapInArrow(_featurized, "ord long, label double, coords array<int>")
    # one task, whose rows and bytes are bounded
    weights = rows.repartition(1).mapInArrow(_trained(epochs, settings), "coord long, weight double")
    return {r["coord"]: r["weight"] for r in weights.collect()}


def score(docs: DataFrame, weights: dict[int, float], threshold: float = THRESHOLD, keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (the text only if asked for) with ``score`` and ``predicted``; every whole text."""
    spark = docs.sparkSession
    ship(spark)
    text = "text" if keep_text else "_text"
    sent = spark.sparkContext.broadcast(
        (np.fromiter(weights.keys(), dtype=np.int64), np.fromiter(weights.values(), dtype=float)))
    kept = [c for c in docs.columns if c not in ("score", "predicted") and (keep_text or c != "text")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = sent.value
        dense = np.zeros(DIMENSIONS + 1)
        dense[at] = w
        for b in batches:
            texts = b.column(text)
            total = np.full(len(texts), dense[DIMENSIONS])
            for i, j in stretches(texts):
                row, coord = features(texts.slice(i, j - i))
                hit = dense[coord] != 0
                key = np.unique(row[hit] * DIMENSIONS + coord[hit])
                total[i:j] += np.bincount(key // DIMENSIONS, weights=dense[key % DIMENSIONS], minlength=j - i)
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))) if len(at) else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                [*kept, "score", "predicted"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "score double", "predicted int"])
    columns = [F.col(f"`{c}`") for c in kept] + ([] if keep_text else [F.col("text").cast("string").alias(text)])
    return docs.select(*columns).mapInArrow(scored, schema)
