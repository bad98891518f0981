"""Language identification by nearest centroid over TF-IDF character n-grams.

A text is lower-cased, every run of non-letters becomes one space, and its
2- and 3-grams are hashed into ``2**BITS`` places (tf = 1 + ln count, times
idf, unit length). Document frequencies come from all training rows: each
task adds up its own and sends one row per place. Each language's vectors are
clustered by spherical k-means into a few centroids, fitted on a sample of
at most ``sample_per_lang`` training rows of that language (rows of the lowest hashes
of id, text and place; a documented bound, so a language with a third of all rows costs no
more than others, and neither do rows with null or repeated ids). A text gets the language of the centroid with the highest cosine.

Rejection by distance: a centroid's language also keeps a lowest similarity,
``slack`` times the 0.1 % quantile of its own sample; a text nearer to no
centroid than that is marked ``rejected``.

Defined results: a null text or one without a letter is ``und``, score 0 and
rejected; without any training row every text is ``und``; ties go to the first
language in order; an empty table gives no rows; repeated rows give repeated
rows; lang, source and doc_id are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, bounded, held_out, id_text, saved, slices

BITS = 13
SAMPLE_PER_LANG = 2000
CENTROIDS = 4
SLACK = 0.4
CHUNK = 1 << 20


class Grams:
    """Hashed 2- and 3-gram counts of a text."""

    def __init__(self, bits: int):
        self.bits = np.uint32(32 - bits)
        self.size = 1 << bits
        self.letter = np.array([chr(c).isalpha() for c in range(0x3000)], bool)

    def _codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        low = np.minimum(codes, np.uint32(0x2FFF))
        letter = self.letter[low]
        high = np.flatnonzero(codes >= 0x3000)
        if len(high):
            letter[high] = [chr(c).isalpha() for c in codes[high].tolist()]
        codes = np.where(letter, codes, np.uint32(32))
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of non-letters stays, as a space
        return codes[keep]

    def counts(self, text: str | None) -> np.ndarray | None:
        """Dense counts, or None when there is no letter."""
        total = None
        for at in range(0, len(text or ""), CHUNK):  # bounded memory for very long texts
            codes = self._codes(" " + text[at:at + CHUNK] + " ")
            if not len(codes):
                continue
            codes = np.concatenate((np.array([32], np.uint32), codes))
            two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]
            three = two[:-1] * np.uint32(0x85EBCA6B) + codes[2:] + np.uint32(77)
            place = np.concatenate((two, three)) * np.uint32(0xC2B2AE35)
            place ^= place >> np.uint32(15)
            place = (place * np.uint32(0x27D4EB2F)) >> self.bits
            found = np.bincount(place, minlength=self.size)
            total = found if total is None else total + found
        return total


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts), np.float32)
    at = np.flatnonzero(counts)
    out[at] = (1 + np.log(counts[at])) * idf[at]
    size = np.linalg.norm(out)
    return out / size if size else out


def _frequencies(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, rows = Grams(bits), 0
        df = np.zeros(grams.size, np.int64)
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    if (c := grams.counts(text)) is not None:
                        df += c > 0
                        rows += 1
        if rows:
            place = np.append(np.flatnonzero(df), grams.size)  # the last one counts the rows
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(np.append(df[df > 0], rows))],
                                             ["place", "n"])
    return run


def _sample_vectors(bits: int, idf) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for lang, order, text in zip(*(x.to_pylist() for x in part.columns)):
                    if (c := grams.counts(text)) is not None:
                        v = vector(c, idf.value)
                        at = np.flatnonzero(v)
                        rows.append((lang, order, at.astype("<i4").tobytes(), v[at].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["lang", "order", "place", "value"])
    return run


def _cluster(k: int, size: int, rounds: int = 12) -> Callable:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "place"])
        x = np.zeros((len(rows), size), np.float32)
        for i, (at, v) in enumerate(zip(rows["place"], rows["value"])):
            x[i, np.frombuffer(at, "<i4")] = np.frombuffer(v, np.float32)
        mean = x.mean(axis=0)
        centres = [x[np.argmax(x @ mean)]]
        while len(centres) < min(k, len(x)):  # the next start is the row farthest from those taken
            centres.append(x[np.argmin((x @ np.stack(centres).T).max(axis=1))])
        centres = np.stack(centres)
        for _ in range(rounds):
            near = (x @ centres.T).argmax(axis=1)
            for j in range(len(centres)):
                if (near == j).any():
                    c = x[near == j].sum(axis=0)
                    centres[j] = c / np.linalg.norm(c)
        low = float(np.quantile((x @ centres.T).max(axis=1), 0.001))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "low": low,
                             "centroid": [c.astype(np.float32).tobytes() for c in centres]})
    return run


def fit(docs: DataFrame, bits: int = BITS, sample_per_lang: int = SAMPLE_PER_LANG, centroids: int = CENTROIDS) -> dict:
    """Languages, their centroids, lowest similarities and idf. What reaches the driver is ``2**bits`` counts
    and ``centroids`` vectors a language."""
    spark = docs.sparkSession
    train = id_text(docs, "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    train = train.withColumn("lang", F.col("lang").cast("string"))
    places = (train.select("text").mapInArrow(_frequencies(bits), "place int, n bigint")
              .groupBy("place").agg(F.sum("n").alias("n")).collect())
    size = 1 << bits
    df = np.zeros(size + 1)
    for r in places:
        df[r["place"]] = r["n"]
    idf = (np.log((1 + df[size]) / (1 + df[:size])) + 1).astype(np.float32)
    shared = spark.sparkContext.broadcast(idf)
    share = (F.xxhash64("doc_id", "text", F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 62) - 1))) / float(1 << 62)
    # one row a language, so the texts are not shuffled to meet it
    langs = bounded(saved(train.groupBy("lang").agg(F.count("*").alias("rows")), "lang-rows"))
    # the place of the row keeps equal rows apart; the rank, cut in each task first, holds the sample to its bound
    sample = (train.withColumn("order", share).join(langs, "lang")
              .where(F.col("order") * F.col("rows") < sample_per_lang).select("lang", "order", "text")
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
              .where(F.col("rank") <= sample_per_lang).drop("rank"))
    vectors = saved(sample.mapInArrow(_sample_vectors(bits, shared), "lang string, order double, place binary, value binary"),
                    "lang-sample")
    found = (vectors.groupBy("lang").applyInPandas(_cluster(centroids, size), "lang string, low double, centroid binary")
             .collect())
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    return {"bits": bits, "idf": idf, "langs": [r["lang"] for r in found], "low": np.array([r["low"] for r in found]),
            "centroids": np.array([np.frombuffer(r["centroid"], np.float32) for r in found]).reshape(-1, size)}


def _predictor(model, slack: float, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        grams = Grams(m["bits"])

        def one(text: str | None) -> tuple[str, float, bool]:
            counts = grams.counts(text)
            if counts is None or not m["langs"]:
                return "und", 0.0, True
            near = m["centroids"] @ vector(counts, m["idf"])
            k = int(near.argmax())
            return m["langs"][k], min(1.0, max(0.0, float(near[k]))), bool(near[k] < slack * m["low"][k])

        for batch in batches:
            for part in slices(batch):
                found = [one(t) for t in part.column(1).to_pylist()]
                if found:
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in zip(*found))], schema=schema)
    return run


def predict(docs: DataFrame, model: dict, slack: float = SLACK) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` per row; score is the cosine to the nearest centroid."""
    d = id_text(docs)
    schema = T.StructType([
        T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return d.mapInArrow(_predictor(shared, slack, arrow_schema(schema)), schema)


def _filter(model, slack: float, at: int) -> Callable:
    schema = pa.schema([("doc_id", pa.null()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    judge = _predictor(model, slack, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                pair = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows), part.column(at)], ["doc_id", "text"])
                keep = [not r for out in judge(iter([pair])) for r in out.column(3).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))
    return run


def keep_known(docs: DataFrame, model: dict, slack: float = SLACK) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_filter(shared, slack, docs.columns.index("text")), docs.schema)
