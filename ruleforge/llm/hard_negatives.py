"""Hard negatives by rotated one-bit codes whose alignment with the vector is stored.

Index. A vector's components become integers ``floor(256 x)``. The integer vector
``o`` is turned by a fixed random rotation (three rounds of sign flips and a
Walsh-Hadamard transform, zero-padded to a power of two, ``P`` places); its code
``c`` is the signs of the turned vector, as the unit vector of +-1/sqrt(P). Stored
with the code are the alignment ``a = <c, o>`` and the norm of ``o``, so that
``o = a c + e`` with ``e`` orthogonal to ``c`` and ``|e|^2 = |o|^2 - a^2``.

Filter. A turned anchor is rounded to ``PLANES``-bit places; its inner product
``s`` with a code comes from popcounts of the code with each bit plane. By
Cauchy-Schwarz the inner product of the anchor and ``o`` lies, without exception,
within ``sqrt(|q|^2 - s^2) |e|`` (residuals) plus the rounding error times ``|o|``
of ``a s``. Only rows whose interval can still matter get an integer score.

Search. Anchors are taken in groups of about ``GROUP`` (a documented bound, by
hash of the row). A group makes two passes over the index:

1. positives: rows of the anchor's own label whose upper bound reaches the
   larger of the task's k-th score so far and the block's k-th lower bound;
2. negatives: rows of other labels whose interval meets the score window of one
   of the anchor's positives, above that window's k-th score so far.

A task carries k rows per anchor (and positive) from block to block and its
results are merged over ``SALTS`` parts and then as one. Every row is compared
with every anchor in blocks; nothing is dropped, so results are exact. The driver
holds one group of anchors at a time; the index is a table in the shared folder.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; a shorter vector counts as padded with zeros; equal
scores rank by ascending vec_id, a null vec_id last (it is no anchor); repeated
rows are rows of their own, each an "other row" to the other; an anchor without
positives, or a positive without negatives, gives no row; an empty table gives
no rows; other columns are not read. A component outside +-2**31 / 256, or
scores that could leave 64 bits, are an error and not a wrong score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, saved_parts

ROUNDS = 3
SEED = 12
PLANES = 8
BLOCK = 2048
CHUNK = 128
GROUP = 16_384
SALTS = 32
NO_ID = np.iinfo(np.int64).max  # stands for a null vec_id; the largest id, so it ranks last

_INDEX = "size int, ids binary, rows binary, labels binary, vectors binary, codes binary, align binary, norm binary"
_FOUND = "anchor bigint, positive int, score bigint, id bigint, row bigint"


def _signs(places: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice([-1.0, 1.0], (ROUNDS, places))


def rotated(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The rows of ``vectors`` (zero-padded) after the rotation; lengths and inner products stay."""
    n, places = len(vectors), signs.shape[1]
    out = np.zeros((n, places))
    out[:, :vectors.shape[1]] = vectors
    for flip in signs:
        out *= flip
        h = 1
        while h < places:
            pair = out.reshape(n, places // (2 * h), 2, h)
            out = np.concatenate((pair[:, :, :1] + pair[:, :, 1:], pair[:, :, :1] - pair[:, :, 1:]), axis=2).reshape(n, places)
            h *= 2
        out /= math.sqrt(places)
    return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(np.uint64)


def _encode(places: int, width: int) -> Callable:
    schema = pa.schema([("size", pa.int32())] + [(n, pa.binary()) for n in
                       ("ids", "rows", "labels", "vectors", "codes", "align", "norm")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = _signs(places)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                ids, rows, labels, flat = (c for c in batch.slice(at, BLOCK).columns)
                n = len(ids)
                vectors = np.zeros((n, width), np.int64)
                for i, v in enumerate(flat):
                    v = v.values.to_numpy(zero_copy_only=False)
                    vectors[i, :len(v)] = v
                if n and np.abs(vectors).max(initial=0) >= 2 ** 31:
                    raise ValueError("a component lies outside +-2**31 / 256")
                turned = rotated(vectors, signs)
                bits = turned >= 0
                align = np.abs(turned).sum(axis=1) / math.sqrt(places)
                norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                cells = [ids.to_numpy(zero_copy_only=False).astype("<i8"), rows.to_numpy(zero_copy_only=False).astype("<i8"),
                         labels.to_numpy(zero_copy_only=False).astype("<i8"), vectors.astype("<i4"), _words(bits),
                         align.astype("<f8"), norm.astype("<f8")]
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32())] + [pa.array([c.tobytes()], pa.binary()) for c in cells],
                                                 schema=schema)
    return run


class _Block:
    """One row of the index table as arrays."""

    def __init__(self, row: list, places: int, width: int):
        n, ids, rows, labels, vectors, codes, align, norm = row
        self.ids, self.rows, self.labels = (np.frombuffer(x, "<i8") for x in (ids, rows, labels))
        self.vectors = np.frombuffer(vectors, "<i4").reshape(n, width).astype(np.int64)
        self.codes = np.frombuffer(codes, np.uint64).reshape(n, -1)
        self.align, self.norm = np.frombuffer(align, "<f8"), np.frombuffer(norm, "<f8")
        self.rest = np.sqrt(np.maximum(0, self.norm ** 2 - self.align ** 2))
        self.ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)


class _Anchors:
    """Anchors as rounded, turned vectors in bit planes."""

    def __init__(self, vectors: np.ndarray, places: int):
        turned = rotated(vectors, _signs(places))
        self.vectors = vectors
        self.norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / (2 ** PLANES - 1), 1e-300)
        level = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, 2 ** PLANES - 1)
        near = self.low[:, None] + self.step[:, None] * level
        self.error = np.sqrt(((turned - near) ** 2).sum(axis=1))
        self.total = near.sum(axis=1)
        self.square = (near ** 2).sum(axis=1)
        self.planes = [_words((level.astype(np.int64) >> j & 1).astype(bool)) for j in range(PLANES)]
        self.places = places

    def intervals(self, some: slice, block: _Block) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products, anchors by rows of the block."""
        set_sum = np.zeros((len(self.low[some]), len(block.ids)))
        for j, plane in enumerate(self.planes):
            hits = np.zeros(set_sum.shape, np.int64)
            for w in range(block.codes.shape[1]):
                hits += np.bitwise_count(plane[some][:, w:w + 1] & block.codes[None, :, w])
            set_sum += hits << j
        set_sum = self.low[some][:, None] * block.ones[None, :] + self.step[some][:, None] * set_sum
        s = (2 * set_sum - self.total[some][:, None]) / math.sqrt(self.places)
        half = np.sqrt(np.maximum(0, self.square[some][:, None] - s ** 2)) * block.rest + self.error[some][:, None] * block.norm
        half += 1e-6 * (1 + self.norm[some][:, None] * block.norm)  # more than any rounding of the doubles above
        middle = block.align * s
        return middle - half, middle + half


def _scores(anchor: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    if len(anchor) * int(np.abs(anchor).max(initial=0)) * int(np.abs(vectors).max(initial=0)) >= 2 ** 63:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    return vectors @ anchor


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((rows, ids, -score))[:k]
    return score[order], ids[order], rows[order]


_NONE = (np.zeros(0, np.int64),) * 3


def _with(kept: tuple, more: tuple, k: int) -> tuple:
    return _best(*(np.concatenate(x) for x in zip(kept, more)), k) if len(kept[0]) else _best(*more, k)


def _rows_out(kept: dict) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("anchor", pa.int64()), ("positive", pa.int32()), ("score", pa.int64()), ("id", pa.int64()), ("row", pa.int64())])
    keys = [key for key, found in kept.items() if len(found[0])]
    for at in range(0, len(keys), 1000):
        some = keys[at:at + 1000]
        sizes = [len(kept[key][0]) for key in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([a for a, _ in some], np.int64), sizes)),
             pa.array(np.repeat(np.array([p for _, p in some], np.int32), sizes)),
             *[pa.array(np.concatenate([kept[key][c] for key in some])) for c in range(3)]], schema=schema)


def _positives(shared, k: int, places: int, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_rows, own_labels, vectors = shared.value
        anchors, kept = _Anchors(vectors, places), {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                block = _Block(row, places, width)
                for at in range(0, len(own_rows), CHUNK):
                    low, high = anchors.intervals(slice(at, at + CHUNK), block)
                    for i in range(len(low)):
                        a = at + i
                        mine = np.flatnonzero((block.labels == own_labels[a]) & (block.rows != own_rows[a]))
                        found = kept.get((a, 0), _NONE)
                        least = -math.inf if len(found[0]) < k else float(found[0][-1]) - 0.5
                        if len(mine) > k:
                            least = max(least, np.partition(low[i, mine], len(mine) - k)[len(mine) - k])
                        mine = mine[high[i, mine] >= least]
                        if len(mine):
                            score = _scores(vectors[a], block.vectors[mine])
                            kept[a, 0] = _with(found, (score, block.ids[mine], block.rows[mine]), k)
        yield from _rows_out(kept)
    return run


def _negatives(shared, k: int, places: int, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_labels, vectors, windows = shared.value  # windows: for each anchor [(positive, low, high)]
        anchors, kept = _Anchors(vectors, places), {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                block = _Block(row, places, width)
                for at in range(0, len(own_labels), CHUNK):
                    low, high = anchors.intervals(slice(at, at + CHUNK), block)
                    for i in range(len(low)):
                        a = at + i
                        asked = []
                        for positive, least, most in windows[a]:
                            found = kept.get((a, positive), _NONE)
                            asked.append((positive, max(least, int(found[0][-1])) if len(found[0]) == k else least, most, found))
                        if not asked:
                            continue
                        other = block.labels != own_labels[a]
                        meets = np.zeros(len(other), bool)
                        for _, least, most, _ in asked:
                            meets |= (high[i] >= least - 0.5) & (low[i] <= most + 0.5)
                        mine = np.flatnonzero(other & meets)
                        if not len(mine):
                            continue
                        score, ids, rows = _best(_scores(vectors[a], block.vectors[mine]), block.ids[mine], block.rows[mine], len(mine))
                        for positive, least, most, found in asked:
                            first, end = np.searchsorted(-score, [-most, -least], "left")[0], np.searchsorted(-score, -least, "right")
                            some = slice(first, min(end, first + k))
                            if some.start < some.stop:
                                kept[a, positive] = _with(found, (score[some], ids[some], rows[some]), k)
        yield from _rows_out(kept)
    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each anchor and positive: first within parts of the tasks, then over the parts."""
    parts = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["anchor", "positive", "salt"], ["anchor", "positive"]):
        w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id", "row")
        parts = parts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return parts.select("anchor", "positive", "rank", "score", "id")


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
         group: int = GROUP) -> DataFrame:
    """Hard negatives among ``rows(vec_id, label, embedding)`` for the rows where ``anchor`` (over these columns) is true.

    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each anchor and each of
    its ``positives`` best rows of the same label, the ``negatives`` best rows of other labels whose score is from
    ``least`` to ``most`` percent of the positive's. Scores are inner products of ``floor(256 x)``.
    """
    spark = rows.sparkSession
    sc = spark.sparkContext
    number = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False)))
    asked = (rows.select("vec_id", "label", number.alias("embedding"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
             .where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
             .select(F.coalesce(F.col("vec_id").cast("bigint"), F.lit(int(NO_ID))).alias("id"), F.monotonically_increasing_id().alias("row"),
                     F.col("label").cast("bigint").alias("label"),
                     F.transform("embedding", lambda x: F.floor(256 * x)).alias("vector"), "anchor"))
    asked = saved(asked, "negatives-vectors")
    seen = asked.agg(F.max(F.size("vector")), F.count_if("anchor")).first()
    width, n_anchors = max(1, seen[0] or 1), seen[1]
    places = max(8, 1 << (width - 1).bit_length())
    index = saved(asked.select("id", "row", "label", "vector").mapInArrow(_encode(places, width), _INDEX), "negatives-index")
    groups = math.ceil(n_anchors / group)
    in_group = F.pmod(F.xxhash64("row"), F.lit(max(1, groups)))

    def mined(g: int) -> DataFrame:
        table = asked.where(F.col("anchor") & (in_group == g)).orderBy("row").select("id", "row", "label", "vector").toArrow()
        own = [table.column(c).to_numpy().astype(np.int64) for c in range(3)]
        vectors = np.zeros((table.num_rows, width), np.int64)
        for i, v in enumerate(table.column(3).to_pylist()):
            vectors[i, :len(v)] = v
        shared = sc.broadcast((own[1], own[2], vectors))
        found = saved(_merged(index.mapInArrow(_positives(shared, positives, places, width), _FOUND), positives), "negatives-positives")
        windows: list[list[tuple[int, int, int]]] = [[] for _ in range(table.num_rows)]
        for r in found.select("anchor", "rank", "score").toArrow().to_pylist():
            windows[r["anchor"]].append((r["rank"], -((-least * r["score"]) // 100), most * r["score"] // 100))
        shared = sc.broadcast((own[2], vectors, [[w for w in some if w[1] <= w[2]] for some in windows]))
        negative = _merged(index.mapInArrow(_negatives(shared, negatives, places, width), _FOUND), negatives)
        names = spark.createDataFrame(pa.table({"anchor": pa.array(range(table.num_rows), pa.int64()), "anchor_id": pa.array(own[0])}))
        first = found.select("anchor", F.col("rank").alias("positive"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
        return (negative.join(first, ["anchor", "positive"]).join(names, "anchor")
                .select("anchor_id", F.nullif("positive_id", F.lit(int(NO_ID))).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        F.nullif("id", F.lit(int(NO_ID))).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))

    schema = T.StructType([T.StructField(n, T.IntegerType() if n == "rank" else T.LongType()) for n in
                           ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])
    return saved_parts(spark, (mined(g) for g in range(groups)), schema, "hard-negatives")
