"""Ranked lexical search: hashed max-sketches bound every document, exact rescoring stops at the threshold.

A document's terms fall into ``2**BITS`` hashed coordinates; a coordinate keeps
the largest impact of the terms that meet there. The impact of a term is the
part of its score that knows only the document, ``(10**9 tf) div (1000 tf + 8 m)``;
its weight ``w`` is not negative, so for an item the sum of ``w`` times the
coordinate of each of its terms is an upper bound of the exact score. Sketches
hold impacts in steps of ``STEP``, rounded up.

1. One scan adds up ``N`` and ``L``, the counts of documents and of terms.
2. Items are taken in groups of about ``GROUP`` (a documented bound, by hash of
   the row). For each group one scan counts the document frequencies of its
   terms, and one ranks: a task folds a block of documents into sketches, looks
   all items of the group up in them by one matrix product, and for each item
   walks down the bounds, scoring exactly in steps that double, until the next
   bound is below the k-th score found so far. What was found is carried to the task's next block.
3. Each task's best k rows of an item are merged over ``SALTS`` parts and then as one.

No postings are shuffled, no text is sent anywhere, and the sketches are folded
where texts are read: folding takes less than writing and reading them would.
The driver holds one group of items and their document frequencies at a time.

Defined results: null, empty and term-less texts count neither in ``N`` nor in
``L`` and never rank; an item without terms, or without a document that holds
one, gives no row; equal scores rank by ascending doc_id, a null id last;
repeated rows of a document or an item each count and rank as rows; empty
tables give an empty result; other columns are not read. Texts are read whole,
in pieces of bounded size.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, id_text, saved, saved_parts

BITS = 11
STEP = 16
GROUP = 4096
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20
ITEM_COLUMNS = 512
SALTS = 32
PIECE = 1 << 22

# Term bytes stay (A-Z in lower case), all other ASCII becomes a space; bytes above 0x7F are parts of term characters.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(text: bytes | None) -> Counter:
    """Terms (UTF-8) of a text with their numbers of occurrences."""
    found: Counter = Counter()
    data = (text or b"").translate(_BYTES)
    at = 0
    while at < len(data):  # the list of words stays small for very long texts
        end = len(data) if len(data) - at <= PIECE else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``BLOCK_ROWS`` rows and, but for single rows, ``BLOCK_BYTES`` of text."""
    for batch in batches:
        ends = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column).cast(pa.binary())])
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, min(at + BLOCK_ROWS, int(np.searchsorted(ends, before + BLOCK_BYTES, "right"))))
            yield batch.slice(at, end - at)
            at = end


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for block in _blocks(batches, 0):
        for text in block.column(0).cast(pa.binary()).to_pylist():
            n = sum(term_counts(text).values())
            docs, terms = docs + (n > 0), terms + n
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def _frequencies(wanted) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for block in _blocks(batches, 0):
            for text in block.column(0).cast(pa.binary()).to_pylist():
                found.update(term_counts(text).keys() & wanted.value)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                             ["term", "df"])
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, 2):
        counts = [term_counts(t) for t in block.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [block.column(0), block.column(1), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], ["item", "item_id", "terms", "counts"])


class _Coordinates(dict):
    """Term -> coordinate, remembered up to a bound."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, term: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        got = self[term] = zlib.crc32(term) & self.mask
        return got


def sketches(counts: list[Counter], m: list[int], coordinates: _Coordinates) -> np.ndarray:
    """One row per document: the largest impact at each coordinate, in steps rounded up."""
    width = coordinates.mask + 1
    sizes = [len(c) for c in counts]
    place = np.fromiter(map(coordinates.__getitem__, chain.from_iterable(counts)), np.int64, sum(sizes))
    tf = np.fromiter(chain.from_iterable(c.values() for c in counts), np.int64, sum(sizes))
    # m as double and rounded down: an impact may only come out larger, never smaller
    low_m = np.floor(np.repeat(np.array(m, np.float64), sizes) * (1 - 1e-12))
    impact = 1e9 * tf / (1000.0 * tf + 8.0 * low_m)
    out = np.zeros(len(counts) * width, np.float32)
    np.maximum.at(out, place + np.repeat(np.arange(len(counts)) * width, sizes), np.floor(impact / STEP).astype(np.float32) + 1)
    return out.reshape(len(counts), width)


class _ItemPart:
    """Some items of a group, their weights by coordinate (for bounds) and by term (for exact scores)."""

    def __init__(self, queries: list, first: int, coordinates: _Coordinates):
        self.first = first
        self.terms: dict[bytes, int] = {}
        table = np.zeros((coordinates.mask + 1, len(queries)), np.float32)
        self.weights = []
        for j, (_, terms) in enumerate(queries):
            for term, w in terms:
                table[coordinates[term], j] += w
            self.weights.append((np.array([self.terms.setdefault(t, len(self.terms)) for t, _ in terms]),
                                 np.array([w for _, w in terms], np.int64)))
        self.used = np.flatnonzero(table.any(axis=1))
        self.table = np.ascontiguousarray(table[self.used])

    def bounds(self, sketch: np.ndarray) -> np.ndarray:
        """A row per item, a column per document; a thousandth more covers every rounding of sums that are not negative."""
        return (sketch[:, self.used] @ self.table).astype(np.float64).T * (STEP * 1.001)

    def impacts(self, counts: list[Counter], m: list[int]) -> np.ndarray:
        """Exact impacts of the items' terms, a row per document."""
        out = np.zeros((len(counts), len(self.terms)), np.int32)
        for i, c in enumerate(counts):
            for term in c.keys() & self.terms.keys():
                out[i, self.terms[term]] = (1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m[i])
        return out


def _rank(items, n_docs: int, n_terms: int, k: int, bits: int, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = items.value  # [(item, [(term, weight times count)])]
        coordinates = _Coordinates(bits)
        parts = [_ItemPart(queries[at:at + ITEM_COLUMNS], at, coordinates) for at in range(0, len(queries), ITEM_COLUMNS)]
        best: list[list[tuple]] = [[] for _ in queries]  # (-score, id is null, id), ascending
        for block in _blocks(batches, 1):
            counts = [term_counts(t) for t in block.column(1).cast(pa.binary()).to_pylist()]
            ids = block.column(0).to_pylist()
            m = [25 + (75 * sum(c.values()) * n_docs) // n_terms for c in counts]
            sketch = sketches(counts, m, coordinates)
            for part in parts:
                impacts = part.impacts(counts, m)
                for j, bound in enumerate(part.bounds(sketch)):
                    kept = best[part.first + j]
                    at, w = part.weights[j]
                    rows = np.flatnonzero(bound >= (-kept[-1][0] if len(kept) == k else 1))
                    rows = rows[np.argsort(-bound[rows], kind="stable")]
                    done, step = 0, k
                    while done < len(rows) and (len(kept) < k or bound[rows[done]] >= -kept[-1][0]):
                        now = rows[done:done + step]
                        scores = impacts[now[:, None], at] @ w
                        for i, score in zip(now.tolist(), scores.tolist()):
                            if score > 0 and (len(kept) < k or score >= -kept[-1][0]):
                                kept.append((-score, ids[i] is None, ids[i] if ids[i] is not None else 0))
                                kept.sort()
                                del kept[k:]
                        done, step = done + step, 2 * step
        rows = [(queries[q][0], None if none else doc, -score) for q, kept in enumerate(best) for score, none, doc in kept]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each item: first within parts of the tasks, then over the parts."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["item", "salt"], ["item"]):
        parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return parts.select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, group: int = GROUP, bits: int = BITS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every row of ``items(item_id, text)``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = id_text(docs)
    item_id = items.schema["item_id"].dataType
    doc_id = texts.schema["doc_id"].dataType
    asked = (items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").alias("text"))
             .mapInArrow(_item_terms, T.StructType([
                 T.StructField("item", T.LongType()), T.StructField("item_id", item_id),
                 T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType()))])))
    asked = saved(asked, "search-items")
    n_items = asked.where(F.size("terms") > 0).count()
    total = texts.select("text").mapInArrow(_totals, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = (int(x or 0) for x in total)
    found_type = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", doc_id), T.StructField("score", T.LongType())])
    out_type = T.StructType([T.StructField("item", T.LongType()), T.StructField("rank", T.IntegerType()),
                             T.StructField("doc_id", doc_id), T.StructField("score", T.LongType())])
    groups = math.ceil(n_items / group) if n_docs else 0

    def ranked(g: int) -> DataFrame:
        rows = (asked.where((F.size("terms") > 0) & (F.pmod(F.xxhash64("item"), F.lit(groups)) == g))
                .select("item", "terms", "counts").toArrow().to_pylist())
        wanted = sc.broadcast(frozenset(t for r in rows for t in r["terms"]))
        df = {r["term"]: r["df"] for r in texts.select("text").mapInArrow(_frequencies(wanted), "term binary, df bigint")
              .groupBy("term").agg(F.sum("df").alias("df")).toArrow().to_pylist()}
        queries = [(r["item"], [(t, n * weight(n_docs, df[t])) for t, n in zip(r["terms"], r["counts"]) if t in df]) for r in rows]
        shared = sc.broadcast([q for q in queries if q[1]])
        return _merged(texts.mapInArrow(_rank(shared, n_docs, n_terms, k, bits, arrow_schema(found_type)), found_type), k)

    found = saved_parts(spark, (ranked(g) for g in range(groups)), out_type, "search-ranks")
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
