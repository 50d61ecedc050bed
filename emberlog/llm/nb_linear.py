"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: n-gram lengths, hashed features, and labelled rows at most that are fitted on (by class); the score covers whole texts.
LENGTHS = (4, 5)
BITS = 21
SAMPLE = 2500
MODULUS = 5


def points(raw: bytes) -> np.ndarray:
    """Code points of the lower-cased (A-Z) text between single spaces."""
    return np.frombuffer(f" {raw.translate(common.LOWER).decode('utf-8', 'replace')} ".encode("utf-32-le"), np.uint32)


def features(raw: bytes) -> np.ndarray:
    """Hashed n-grams of code points, one for each place."""
    text = points(raw)
    return np.concatenate([hashed(text, n) for n in LENGTHS])


def hashed(text: np.ndarray, n: int) -> np.ndarray:
    if len(text) < n:
        return np.zeros(0, np.uint32)
    grams = np.zeros(len(text) - n + 1, np.uint64)
    for i in range(n):
        grams *= np.uint64(0x100000001B3)
        grams += text[i : len(text) - n + 1 + i]
    grams *= np.uint64(0x9E3779B97F4A7C15)
    grams >>= np.uint64(64 - BITS)
    return grams.astype(np.uint32)


def present(raw: bytes) -> np.ndarray:
    """The distinct features of a text; blocks of a very long one overlap by n - 1 places."""
    text = points(raw)
    return np.unique(np.concatenate([np.unique(hashed(text[at : at + (1 << 20) + n - 1], n)) for n in LENGTHS for at in range(0, len(text), 1 << 20)]))


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 30, least: int = 8) -> tuple[np.ndarray, float]:
    """Weights by feature, and the bias.

    Each feature's presence is scaled by r = log of its smoothed share in class 1 over that in class
    0; logistic regression with an L2 penalty is fitted on the scaled features. Features seen in
    fewer than `least` texts, or with |r| < 1, are left out: they are noise in long texts.
    """
    rows = [present(t) for t in texts]
    labels = np.asarray(labels, np.float64)
    counts = [np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)]
    for row, y in zip(rows, labels):
        counts[int(y)][row] += 1
    n1 = max(1.0, labels.sum())
    n0 = max(1.0, len(labels) - labels.sum())
    ratio = np.log((counts[1] + 0.5) / (n1 + 1)) - np.log((counts[0] + 0.5) / (n0 + 1))
    ratio[(counts[0] + counts[1] < least) | (np.abs(ratio) < 1)] = 0
    rows = [r[ratio[r] != 0] for r in rows]
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, column = np.unique(flat, return_inverse=True)
    scale = ratio[used].astype(np.float64)
    x = scale[column] / 4
    w, bias = np.zeros(len(used)), float(np.log(n1 / n0))
    grow_w, grow_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(epochs):  # full-batch AdaGrad: the sample is small and the result does not depend on an order
        z = np.bincount(owner, x * w[column], len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        gw = np.bincount(column, error[owner] * x, len(used)) / max(1, len(rows)) + 1e-5 * w
        gb = error.mean() if len(rows) else 0.0
        grow_w += gw * gw
        grow_b += gb * gb
        w -= 0.5 * gw / np.sqrt(grow_w)
        bias -= 0.2 * gb / np.sqrt(grow_b)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w * scale / 4
    weights[np.abs(weights) < 0.01] = 0
    return weights, float(bias)


def score(raw: bytes, weights: np.ndarray, bias: float) -> float:
    total = bias
    text = points(raw)
    for n in LENGTHS:
        found: list[np.ndarray] = []
        for at in range(0, max(1, len(text)), 1 << 20):  # blocks of a very long text overlap by n - 1 places
            grams = hashed(text[at : at + (1 << 20) + n - 1], n)
            found.append(grams[weights[grams] != 0])
        total += float(weights[np.unique(np.concatenate(found))].sum())
    return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int, modulus: int = MODULUS) -> list:
    """At most about `sample` rows of each class, chosen by a hash of the id, never those held out.

    Rows with a null id, text or label are not learnt from; of an id's rows, the least text and the least label are. Texts count whole.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id"), modulus)).groupBy("doc_id").agg(F.min("y").alias("y"))
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    keep = F.lit(False)
    for y, count in n.items():
        keep |= (F.col("y") == y) & (part < int(min(1.0, sample / count) * (1 << 20)))
    chosen = F.broadcast(rows.where(keep))  # about 2 * sample rows
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id").where(F.col("text").isNotNull())
    found = found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return sorted(((r.doc_id, bytes(r.text.encode()), r.y) for r in found.collect()), key=lambda r: (str(r[0]), r[1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    rows = labelled(docs, labels, "toxic", sample)
    return fit([r[1] for r in rows], np.array([r[2] for r in rows]))


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, held_out, score, predicted.

    The model has 2**BITS weights whatever it was fitted on, so its broadcast is bounded (8 MB). A
    null text is scored as empty, by the bias alone. Repeated rows and null ids stay. No shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), common.held_out(F.col("doc_id"), MODULUS).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for b in batches:
            scores = np.array([score(raw or b"", weights, bias) for raw in common.binary(b.column(1))], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return common.mapped(source, run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, common.table(spark, sf_dir, "labels")))
