"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

1. Each task tokenises its documents, cuts only those longer than the
   capacity, and packs the pieces best-fit in blocks of bounded size, longest
   first. Bins whose free space is at most ``slack`` are finished.
2. The underfull bins travel on as items (bin, fill): few per task. Blocks of
   them are packed best-fit again, round after round, until one block holds
   them all or a round no longer saves bins.
3. A bin that moved keeps its pieces in order: their place is the bin's place
   in the sequence plus their place in the bin.

Token ids come from a ``tokenizers`` file (its content is broadcast, about
2 MB). White space never belongs to a token of the vocabulary used, so a text
is tokenised as its white-space separated chunks, each looked up in a bounded
cache; ``tests/llm`` holds the ids against the library's on whole texts.

Defined results: null text is empty; each document ends with ``end_id``, so
even an empty one is a piece of length 1; an empty table gives no rows;
repeated rows are packed each; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, id_text, saved, slices, utf8_lists, worker_state

CAPACITY = 4096
END_ID = 1
SLACK = 32
BLOCK_ITEMS = 100_000
CACHE_CHUNKS = 600_000


class ChunkIds(dict):
    """White-space separated chunk (UTF-8) -> its ids as little-endian unsigned 32-bit bytes.

    Texts are cut only for vocabularies where that changes no id (probed once); others encode whole texts.

    For vocabularies that ignore case and part letters from stops (probed once), texts are lower-cased and
    stops split off before the look-up, so that fewer chunks are new; a text that may hold a special token, whose
    spelling counts, is left as it is. Chunks of a-z alone go straight to the merge model.
    """

    def __init__(self, tokenizer_json: str, limit: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_str(tokenizer_json), limit
        self.stops = re.compile(rb"([a-z])([.,])")
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = {t[:2] for t in special if len(t) > 1}

        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids

        # cutting at white space must be harmless; a vocabulary whose pieces hold spaces gets whole texts
        parts = ("one", "Two,", "x1", "é", "(a)", "don't", "漢字")
        self.cuts = all(ids(a + gap + b) == ids(a) + ids(b) for a in parts for b in parts for gap in (" ", "\n", "  ", "\t", "\r\n"))
        self.cuts = self.cuts and all(ids(gap + a + gap) == ids(a) for a in parts for gap in (" ", "\n"))
        probes = ("probe", "zebra", "a", "tion", "internationalisation", "xqzw")
        self.folds = not any(len(t) < 2 for t in special) and all(
            ids(p) == ids(p.upper()) and ids(p + ".,") == ids(p) + ids(".,") for p in probes)
        self.direct = self.folds and all(ids(p) == [t.id for t in self.tokenizer.model.tokenize(p)] for p in probes)

    def learn(self, chunks: set[bytes]) -> None:
        """Tokenise the chunks not yet known, many at a time."""
        if len(self) > self.limit:
            self.clear()
        new = [c for c in chunks if c not in self]
        if self.direct:
            rest, tokenize = [], self.tokenizer.model.tokenize
            for c in new:
                if c.isascii() and c.isalpha() and c.islower():
                    self[c] = np.array([t.id for t in tokenize(c.decode())], "<u4").tobytes()
                else:
                    rest.append(c)
            new = rest
        for at in range(0, len(new), 5000):
            part = new[at:at + 5000]
            code = self.tokenizer.encode([c.decode("utf-8", "replace") for c in part], is_pretokenized=True,
                                         add_special_tokens=False)
            ids = np.array(code.ids, "<u4")
            words = np.array([-1 if w is None else w for w in code.word_ids], np.int64)
            cuts = np.searchsorted(words, np.arange(len(part) + 1))
            raw = ids.tobytes()
            for k, c in enumerate(part):
                self[c] = raw[4 * cuts[k]:4 * cuts[k + 1]]

    def _chunks(self, text: bytes) -> list[bytes]:
        if self.folds and not any(m in text for m in self.marks):
            text = self.stops.sub(rb"\1 \2", text.lower())
        return text.split()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not self.cuts:
            whole = self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in whole]
        split = [self._chunks(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.__getitem__, s)) for s in split]


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit, longest first: each item's bin and place, and each bin's fill."""
    order = np.argsort(-lengths, kind="stable")
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    fills: list[int] = []
    mask = 0  # bit f is set when a bin has f tokens free
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        if wide := mask >> size:
            free = size + (wide & -wide).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            free, at = capacity, len(fills)
            fills.append(0)
        bins[i], places[i] = at, capacity - free
        free -= size
        fills[at] = capacity - free
        if free:
            by_free[free].append(at)
            mask |= 1 << free
    return bins, places, np.array(fills, np.int64)


def _pack_texts(tokenizer_json, end_id: int, capacity: int, block: int, keep_ids: bool, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = tokenizer_json.value
        cache = worker_state(("chunk ids", hash(raw)), lambda: ChunkIds(raw))
        end = np.array([end_id], "<u4").tobytes()
        next_bin = TaskContext.get().partitionId() << 36
        ids, rows, held = [], {n: [] for n in ("piece", "start", "length", "ids_crc32", "ids")}, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, rows, held, next_bin
            lengths = np.array(rows["length"], np.int64)
            bins, places, fills = best_fit(lengths, capacity)
            made = rows | {"bin": bins + next_bin, "place": places, "fill": fills[bins]}
            next_bin += len(fills)
            out = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids) if f.name == "doc_id" else pa.array(made[f.name], f.type) for f in schema],
                schema=schema)
            ids, rows, held = [], {n: [] for n in rows}, 0
            return out

        for batch in batches:
            for part in slices(batch, 64):
                owner = []
                for row, raw in enumerate(cache.ids(utf8_lists(part.column(1)))):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        piece = raw[at:at + 4 * capacity]
                        owner.append(row)
                        for name, value in (("piece", k), ("start", at // 4), ("length", len(piece) // 4),
                                            ("ids_crc32", zlib.crc32(piece))):
                            rows[name].append(value)
                        if keep_ids:
                            rows["ids"].append(piece)
                            held += len(piece)
                ids.append(part.column(0).take(pa.array(owner, pa.int32())))
                if len(rows["piece"]) >= block or held > 64_000_000:
                    yield flush()
        if rows["piece"]:
            yield flush()
    return run


def _repack(capacity: int, block: int) -> Callable:
    schema = pa.schema([("bin", pa.int64()), ("seq", pa.int64()), ("base", pa.int64()), ("fill", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(names: np.ndarray, fills: np.ndarray) -> pa.RecordBatch:
            at, base, full = best_fit(fills, capacity)
            owner = np.zeros(len(full), np.int64)
            owner[at[base == 0]] = names[base == 0]  # a sequence is named after its first bin
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (names, owner[at], base, full[at])], schema=schema)

        names, fills, n = [], [], 0
        for batch in batches:
            names.append(batch.column(0).to_numpy())
            fills.append(batch.column(1).to_numpy())
            n += batch.num_rows
            if n >= block:
                yield flush(np.concatenate(names), np.concatenate(fills))
                names, fills, n = [], [], 0
        if n:
            yield flush(np.concatenate(names), np.concatenate(fills))
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK,
         block: int = BLOCK_ITEMS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, little-endian
    unsigned 32-bit, with ``keep_ids``)."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = spark.sparkContext.broadcast(f.read())
    d = id_text(docs)
    schema = T.StructType([
        T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("bin", T.LongType()),
        T.StructField("place", T.LongType()), T.StructField("fill", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])
    pieces = saved(d.mapInArrow(_pack_texts(tokenizer_json, end_id, capacity, block, keep_ids, arrow_schema(schema)),
                                schema), "pack-pieces")
    # every bin has exactly one piece at place 0
    items = saved(pieces.where(f"place = 0 and fill < {capacity - slack}").select("bin", "fill"), "pack-items")
    moved = items.select("bin", F.col("bin").alias("seq"), F.lit(0).cast("bigint").alias("base"))
    n = items.count()
    while n > 1:
        tasks = -(-n // block)
        step = saved(items.repartition(tasks, "bin").sortWithinPartitions("bin")
                     .mapInArrow(_repack(capacity, 2 * block), "bin bigint, seq bigint, base bigint, fill bigint"),
                     "pack-round")
        moved = saved(
            moved.select("bin", F.col("seq").alias("was"), F.col("base").alias("place"))
            .join(step.select(F.col("bin").alias("was"), "seq", "base"), "was", "left")
            .select("bin", F.coalesce("seq", "was").alias("seq"),
                    (F.col("place") + F.coalesce("base", F.lit(0))).alias("base")), "pack-moved")
        items = saved(step.where(f"base = 0 and fill < {capacity - slack}").select(F.col("seq").alias("bin"), "fill"),
                      "pack-items")
        before, n = n, items.count()
        if tasks == 1 or n > 0.99 * before:
            break
    extra = ["ids"] if keep_ids else []
    return (pieces.drop("fill").join(moved, "bin", "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("seq", "bin").alias("sequence_id"),
                    (F.col("place") + F.coalesce("base", F.lit(0))).alias("offset"), *extra))
