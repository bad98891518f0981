"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

A word counts by three tokens: its letters and digits in lower case, its shape
(case pattern and the punctuation around it), and whether it repeats the word
before. Word 1- and 2-grams and shape 1- and 2-grams are hashed into
``2**BITS`` places; a place's value is 1 + ln count, and vectors have unit length.
A score is the logistic function of one sparse dot product.

Training takes at most ``max_rows`` labelled rows (those of the lowest id hashes;
a documented bound, so the list of ids may be broadcast), never the held-out
fifth. They are dealt over ``shards`` tasks; each runs follow-the-regularised-
leader updates for ``epochs`` passes and the weights are averaged. The driver
receives one dense vector per shard.

Defined results: null, empty and blank texts have no features and score by the
bias alone; without labelled rows every score is 0.5; labels of ids without a
document are not used, a doc_id labelled twice counts twice; an empty table gives
no rows; lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, held_out, id_text, saved, slices

BITS = 18
MAX_ROWS = 20_000
SHARDS = 4
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.0
CHUNK_WORDS = 1 << 18
THRESHOLD = 0.3


class _WordTokens(dict):
    """Word -> (hash of its letters, hash of its shape), remembered up to a bound."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= 200_000:
            self.clear()
        core = re.sub(r"[\W_]+", "", word)
        case = ("u" if core.isupper() and len(core) > 1 else "t" if core[:1].isupper() else
                "l" if core.islower() else "d" if core.isdigit() else "x" if core else "n")
        shape = case + re.sub(r"\w+", "a", word)[:16]
        got = self[word] = tuple(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))
                                 for x in (core.lower() or word, shape))
        return got


class Features:
    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.words = _WordTokens()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted places and their values; place 0 is the bias."""
        found: list[np.ndarray] = []
        words = (text or "").split()
        for at in range(0, len(words), CHUNK_WORDS):  # bounded memory for very long texts
            pairs = np.array([self.words[w] for w in words[at:at + CHUNK_WORDS]], np.uint64)
            core, shape = pairs[:, 0], pairs[:, 1]
            again = (core[1:] == core[:-1]).astype(np.uint64)
            raw = np.concatenate((
                core, core[:-1] * np.uint64(0x9E3779B97F4A7C15) + core[1:],
                shape + np.uint64(3), shape[:-1] * np.uint64(0xD6E8FEB86659FD93) + shape[1:],
                again * np.uint64(0xA0761D6478BD642F) + np.uint64(5)))
            raw ^= raw >> np.uint64(32)
            found.append((raw * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift)
        if not found:
            return np.zeros(1, np.int64), np.ones(1)
        place, count = np.unique(np.concatenate(found).astype(np.int64), return_counts=True)
        value = 1 + np.log(count)
        value *= 3.0 / np.linalg.norm(value)
        return np.concatenate(([0], place + 1)), np.concatenate(([1.0], value))


def _featurise(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for order, y, text in zip(*(c.to_pylist() for c in part.columns)):
                    place, value = features(text)
                    rows.append((order, y, place.astype("<i4").tobytes(), value.astype("<f4").tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["order", "y", "place", "value"])
    return run


def _ftrl(bits: int, epochs: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(y, np.frombuffer(p, "<i4"), np.frombuffer(v, "<f4").astype(np.float64))
                for b in batches for y, p, v in zip(*(b.column(i).to_pylist() for i in range(3)))]
        if not rows:
            return
        z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

        def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
            return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

        for _ in range(epochs):
            for y, at, x in rows:
                zi, ni = z[at], n[at]
                w = weights(zi, ni)
                g = (1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ x))))) - y) * x
                new = ni + g * g
                z[at] = zi + g - (np.sqrt(new) - np.sqrt(ni)) / ALPHA * w
                n[at] = new
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)]), pa.array([weights(z, n).astype("<f8").tobytes()])],
                                         ["rows", "weights"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS, max_rows: int = MAX_ROWS,
        shards: int = SHARDS, epochs: int = EPOCHS) -> np.ndarray:
    """The dense weight vector, learnt from rows that are not held out."""
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select(F.col("doc_id").alias("label_id"), F.col(label).cast("double").alias("y"), order.alias("order"))
              .orderBy("order", "label_id").limit(max_rows))
    d = id_text(docs)
    rows = (d.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("order", "y", "text")
            .mapInArrow(_featurise(bits), "order bigint, y double, place binary, value binary"))
    rows = saved(rows, "quality-rows")
    dealt = rows.withColumn("shard", F.pmod("order", F.lit(shards))).repartition(shards, "shard")
    parts = (dealt.sortWithinPartitions("order", "place").select("y", "place", "value")
             .mapInArrow(_ftrl(bits, epochs), "rows bigint, weights binary").collect())
    total = sum(r["rows"] for r in parts)
    weights = np.zeros((1 << bits) + 1)
    for r in parts:
        weights += np.frombuffer(r["weights"], "<f8") * (r["rows"] / total)
    return weights


def _scorer(weights, bits: int, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(bits), weights.value
        for batch in batches:
            for part in slices(batch):
                logits = []
                for text in part.column(1).to_pylist():
                    place, value = features(text)
                    logits.append(float(w[place] @ value))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, float), -60, 60))))], schema=schema)
    return run


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """``(doc_id, score)`` per row; higher means label 1 is likelier."""
    d = id_text(docs)
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    return d.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(weights), bits, arrow_schema(schema)), schema)
