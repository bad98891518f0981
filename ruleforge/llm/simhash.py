"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint bit is 1 when it is set in more than half of the XXH64 hashes
(seed 42) of the text's word shingles, repeats included. Two fingerprints link
when they differ in at most ``radius`` bits; classes are the components.

Candidates come from ``2**(radius + 1) - 1`` structured bit masks: bit i gets a
non-zero vector phi(i) of radius + 1 bits, and the mask of the non-zero vector
v holds the bits with an odd number of ones in ``phi(i) & v``. The phi of at
most ``radius`` differing bits span less than the whole space, so some v is
orthogonal to all of them: its mask avoids every differing bit, and the pair
is certain to collide in that table. No pair in the radius can be missed.

Equal fingerprints are one node, so copies never multiply. A bucket is split
into blocks (see ``blocks.py``) and searched breadth-first: a fingerprint once
reached is not compared again, so a dense group costs about one row of
comparisons and gives a spanning forest of its links, never all its pairs.

Defined results: null, empty and blank texts have fingerprint zero and link
like any other; a text with fewer words than a shingle is one shingle; an
empty table gives no rows; repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, bucket_blocks
from .common import bounded, id_text, saved, slices, utf8_lists
from .components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
BLOCK = 8192


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text, as an unsigned 64-bit integer."""
    parts = text.lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not parts:
        return 0
    joined = b" ".join(parts)
    span = min(words, len(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_digest
    n = len(parts) - span + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        hashes = b"".join([digest(joined[a:b], 42) for a, b in
                           zip(starts[at:min(at + 65536, n)].tolist(), ends[at + span - 1:at + span - 1 + 65536].tolist())])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(words: int, id_type: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words) for part in slices(batch) for t in utf8_lists(part.column(1))]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp bigint)``, one row per row of ``docs``."""
    d = id_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_fingerprints(words, None), f"doc_id {kind}, fp bigint")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    dims = radius + 1
    phi = [1 + i % (2 ** dims - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if bin(phi[i] & v).count("1") % 2) for v in range(1, 2 ** dims)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(radius: int) -> Callable:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def forest(left: np.ndarray, right: np.ndarray | None) -> tuple[list, list]:
        rest = left if right is None else np.concatenate((left, right))
        a, b = [], []
        while len(rest) > 1:
            todo, rest = [rest[0]], rest[1:]
            while todo and len(rest):
                x = todo.pop()
                near = np.bitwise_count(rest ^ x) <= radius
                if near.any():
                    hit = rest[near]
                    rest = rest[~near]
                    todo.extend(hit)
                    a.append(np.full(len(hit), x))
                    b.append(hit)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = np.frombuffer(left, "<u8")
                more = forest(one, None if right is None else np.frombuffer(right, "<u8"))
                a += more[0]
                b += more[1]
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64))],
                    schema=schema)
    return run


def fingerprint_links(distinct_fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints whose components are those
    of the whole graph of pairs at most ``radius`` bits apart."""
    masks = F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(covering_masks(radius))])
    # xxhash64 only names the bucket; a chance meeting of two buckets adds a comparison, never a wrong link
    rows = distinct_fps.select(F.explode(masks).alias("key"), F.col("fp").alias("member"))
    blocks = saved(bucket_blocks(rows, 8, block), "simhash-blocks")
    # the work lies in few rows: deal them evenly over the tasks
    dealt = block_pairs(blocks).repartition("sig").select("left", "right")
    return dealt.mapInArrow(_links(radius), "a bigint, b bigint")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row; component_id is the smallest doc_id reachable by links."""
    fps = saved(fingerprints(docs, words), "simhash-fps")
    firsts = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-firsts")
    parts = connected_components(fingerprint_links(firsts.select("fp"), radius, block))
    placed = firsts.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = saved(placed.join(smallest, "component").select("fp", "component_id"), "simhash-classes")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their group, all columns as they are."""
    groups = near_groups(docs, words, radius)
    ids = groups.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays"))
    gone = bounded(saved(ids.where("not stays").select(F.col("doc_id").alias("__gone_id")), "simhash-gone"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__gone_id")), "left_anti")
