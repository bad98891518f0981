"""Members of hash buckets, dealt out as blocks of bounded size.

``bucket_blocks`` turns ``(key, member)`` rows into rows of at most ``limit``
members of one bucket; buckets with one member vanish. A bucket larger than
``limit`` gets several blocks, and ``block_pairs`` joins the blocks (not the
members) of such a bucket, so every two members meet in some pair of blocks
while no task ever holds more than two blocks.

Very many small records travel packed: ``packed`` puts those of one bucket number, a hash of their key, into the bytes
of few rows, and ``whole_buckets`` gives a task its buckets back, a bounded number of bytes and the rest of a bucket at
a time. ``list_blocks`` makes the blocks of members that bring all their keys in this way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

BUCKETS = 4096
HELD = 2**23  # bytes of packed records that a task takes at a time, and the rest of their bucket
BLOCK_SCHEMA = "key bigint, block int, sig binary, members binary"


def _blocks(width: int, limit: int) -> Callable:
    schema = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("sig", pa.binary()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, buf, block, out = None, b"", 0, []

        def close(last: bool) -> None:
            if block or len(buf) > width:  # one member alone needs no look
                out.append((key, block if block or not last else -1, hashlib.md5(buf).digest(), buf))

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
            out.clear()
            return rows

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            member = batch.column(1)
            raw = (b"".join(member.to_pylist()) if pa.types.is_binary(member.type)
                   else member.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts = np.concatenate(([0], cuts)).tolist()
            ends = np.concatenate((cuts, [len(keys)])).tolist()
            for s, e in zip(starts, ends):
                k = int(keys[s])
                if k != key:
                    if key is not None:
                        close(True)
                    key, buf, block = k, b"", 0
                elif e - s == 1 and len(buf) < width * limit:
                    buf += raw[s * width:e * width]
                    continue
                at = s
                while at < e:
                    room = limit - len(buf) // width
                    if not room:
                        close(False)
                        buf, block, room = b"", block + 1, limit
                    take = min(room, e - at)
                    buf += raw[at * width:(at + take) * width]
                    at += take
            if len(out) >= 1000:
                yield flush()
        if key is not None:
            close(True)
        if out:
            yield flush()
    return run


def bucket_blocks(rows: DataFrame, width: int, limit: int) -> DataFrame:
    """Blocks of the buckets of ``rows(key bigint, member)``; members are bigint
    (width 8) or binary of ``width`` bytes and are expected distinct in a key.

    ``block`` is -1 for the only block of a bucket, else 0, 1, 2, ...
    """
    dealt = rows.repartition("key").sortWithinPartitions("key", "member")
    return dealt.select("key", "member").mapInArrow(_blocks(width, limit), BLOCK_SCHEMA)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """``(sig, left, right)``: each whole bucket or block alone (right null; equal
    member lists once) and each two blocks of a divided bucket."""
    alone = blocks.dropDuplicates(["sig"]).select("sig", F.col("members").alias("left"),
                                                  F.lit(None).cast("binary").alias("right"))
    part = blocks.where("block >= 0")
    two = (part.select("key", F.col("block").alias("b1"), F.col("sig").alias("s1"), F.col("members").alias("left"))
           .join(part.select("key", F.col("block").alias("b2"), F.col("sig").alias("s2"),
                             F.col("members").alias("right")), "key")
           .where("b1 < b2")
           .select(F.unhex(F.md5(F.concat("s1", "s2"))).alias("sig"), "left", "right"))
    return alone.union(two)


def bucket_numbers(keys: np.ndarray) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.uint16)


def packed(records: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Records with a field ``key`` by bucket: the bucket numbers, their records' bytes, the order in which these take
    the records, and where each bucket begins in it (and the last one ends)."""
    bucket = bucket_numbers(records["key"].astype(np.int64))
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(cuts, len(order))
    raw = pa.Array.from_buffers(pa.binary(), len(cuts), [None, *(pa.py_buffer(x) for x in (
        (ends * records.itemsize).astype(np.int32), records[order]))])
    return pa.array(bucket[cuts].astype(np.int32)), raw, order, ends


def whole_buckets(batches: Iterator[pa.RecordBatch], raw: int, most: int = HELD) -> Iterator[pa.Table]:
    """Rows in the order of their first column, together until ``most`` bytes of column ``raw`` are there and the value
    of the first column ends."""
    held, size, last = [], 0, None
    for batch in batches:
        for part in slices(batch):
            while part.num_rows:
                cut = part.num_rows
                if size >= most:  # up to the end of the bucket begun
                    cut = int(np.searchsorted(part.column(0).to_numpy(), last, "right"))
                if cut:
                    held.append(part.slice(0, cut))
                    size, last = size + held[-1].column(raw).nbytes, held[-1].column(0)[-1].as_py()
                    part = part.slice(cut)
                if part.num_rows:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def joined(raw: pa.ChunkedArray, kind: list) -> np.ndarray:
    """The records in all rows of a binary column."""
    return np.frombuffer(b"".join(raw.to_pylist()), kind)


def _dealer(width: int, chunk: int) -> Callable:
    record = np.dtype([("key", "<i8"), ("member", f"S{width}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> pa.RecordBatch:
            part = pa.Table.from_batches(held).combine_chunks()
            members = np.frombuffer(b"".join(part.column(0).to_pylist()), f"V{width}")
            _, once = np.unique(members.view(f"S{width}"), return_index=True)
            keys = part.column(1).combine_chunks().flatten().to_numpy().reshape(len(members), -1)[once]
            # the place in the list is part of the key, so that the lists' places do not share buckets
            keys = (keys.view(np.uint64) ^ np.arange(1, keys.shape[1] + 1, dtype=np.uint64)) * np.uint64(0xD1342543DE82EF95)
            records = np.empty(keys.size, record)
            records["key"] = (keys ^ (keys >> np.uint64(32))).ravel().view(np.int64)
            records["member"] = np.repeat(members[once].view(f"S{width}"), keys.shape[1])
            bucket, raw, _, _ = packed(records)
            return pa.RecordBatch.from_arrays([bucket, raw], names=["bucket", "raw"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= chunk:
                yield close()
                held, size = [], 0
        if held:
            yield close()
    return run


def _packed_blocks(width: int, limit: int) -> Callable:
    record = [("key", "<i8"), ("member", f"S{width}")]
    schema = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("sig", pa.binary()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_buckets(batches, 1):
            rows = joined(part.column(1), record)
            order = np.argsort(rows["key"], kind="stable")
            key = rows["key"][order]
            several = np.zeros(len(key), bool)
            several[1:] = key[1:] == key[:-1]
            several[:-1] |= several[1:]
            rows = rows[order[several]]
            rows = rows[np.lexsort((rows["member"], rows["key"]))]
            new = (rows["key"][1:] != rows["key"][:-1]) | (rows["member"][1:] != rows["member"][:-1])
            rows = rows[np.append(True, new)] if len(rows) else rows
            key, raw = rows["key"], rows["member"].astype(f"S{width}").tobytes()
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])).tolist() if len(rows) else []
            out = []
            for a, z in zip(cuts, [*cuts[1:], len(key)]):
                if z - a > 1:
                    for no, i in enumerate(range(a, z, limit)):
                        members = raw[i * width:min(i + limit, z) * width]
                        out.append((int(key[a]), no if z - a > limit else -1, hashlib.md5(members).digest(), members))
            for k in range(0, len(out), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[k:k + 1000]), schema)],
                                                 schema=schema)
    return run


def list_blocks(rows: DataFrame, width: int, limit: int, chunk: int = 2**15) -> DataFrame:
    """``bucket_blocks`` of ``rows(member, keys)`` with equally many keys in each list, of which every place is a set of
    buckets of its own. Rows of one member bring the same keys and count once."""
    dealt = rows.select("member", "keys").mapInArrow(_dealer(width, chunk), "bucket int, raw binary")
    return (dealt.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_packed_blocks(width, limit), BLOCK_SCHEMA))
