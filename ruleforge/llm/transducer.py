"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled once per worker from the ``.model`` file's content (broadcast, about 0.5 MB):

* the normaliser N: space -> space mark, with the dummy prefix as an arc that reads nothing;
* the lexicon L: a trie whose final states write a piece; a character without a piece has an arc that
  writes its byte pieces (byte fallback);
* the constraint C. For a unigram model it has one state and gives each piece the weight -score. For a BPE
  model its states are the last piece, and a piece that may not follow it by the pair rule has weight infinity.

Composing the input with N, L and C gives a lattice, and the shortest path in the tropical semiring (min, +) is
the encoding. For BPE all finite weights are 0 and exactly one path per prefix is finite, so the lattice keeps one
state per position. As no piece crosses a segment (``piece_model.py``), the lattice is composed segment by
segment, and segments already solved are looked up in a bounded cache.

Decoding runs the inverse: pieces to text, byte pieces to bytes, space mark to space, dummy prefix dropped.

Defined results: null stays null (ids, text and round trip null); the empty text has no ids; an input that holds
the space mark itself decodes to a space, so its ``round_trip`` is false; an empty table gives no rows; repeated
rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import arrow_schema, id_text, slices, worker_state
from .piece_model import BPE, BYTE, CONTROL, SPACE, UNKNOWN, PieceModel

SEGMENT_CACHE = 600_000


class Transducer:
    def __init__(self, raw: bytes):
        self.model = m = PieceModel(raw)
        # lexicon: a state is {character: (next state, piece written there or -1)}
        self.root: dict[str, tuple[dict, int]] = {}
        for piece, k in m.ids.items():
            state = self.root
            for c in piece[:-1]:
                state = state.setdefault(c, ({}, -1))[0]
            after = state.get(piece[-1], ({}, -1))[0]
            state[piece[-1]] = (after, k)
        self.solve = self._constrained if m.model_type == BPE else self._weighted
        self.cache: dict[str, bytes] = {}
        self.surface = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
                        else p.replace(SPACE, " ").encode() for p, k in zip(m.pieces, m.kinds)]
        self.starts_spaced = [p.startswith(SPACE) and k not in (BYTE, CONTROL, UNKNOWN) for p, k in zip(m.pieces, m.kinds)]

    def _lattice(self, text: str, at: int) -> list[tuple[int, int]]:
        """Arcs (end, piece) of lexicon and input from position ``at``; piece -1 is the byte fallback."""
        state, out = self.root, []
        for end in range(at, len(text)):
            step = state.get(text[end])
            if step is None:
                break
            state, piece = step
            if piece >= 0:
                out.append((end + 1, piece))
        if not out or out[0][0] > at + 1:
            out.append((at + 1, -1))
        return out

    def _weighted(self, text: str) -> list[int]:
        """Shortest path with weights -score; equal weights keep the arc of the earliest start."""
        n = len(text)
        cost, back = [0.0] + [float("inf")] * n, [(0, 0)] * (n + 1)
        for at in range(n):
            for end, piece in self._lattice(text, at):
                w = cost[at] - (self.model.scores[piece] if piece >= 0 else self.model.unknown_score)
                if w < cost[end]:
                    cost[end], back[end] = w, (at, piece)
        return self._write(text, back)

    def _constrained(self, text: str) -> list[int]:
        """The one path whose neighbours all obey the pair rule."""
        n, pairs, allowed = len(text), self.model.pairs, self.model.neighbours
        back: list[tuple[int, int] | None] = [None] * (n + 1)  # (start, piece) of the prefix's last arc
        for arc in self._lattice(text, 0):
            back[arc[0]] = (0, arc[1])
        for at in range(1, n):
            if back[at] is None:
                continue
            before = back[at][1]
            for end, piece in self._lattice(text, at):
                if back[end] is None:
                    ok = pairs.get(before << 24 | piece)
                    if allowed(before, piece) if ok is None else ok:
                        back[end] = (at, piece)
        return self._write(text, back)

    def _write(self, text: str, back: list[tuple[int, int]]) -> list[int]:
        out, end = [], len(text)
        while end:
            at, piece = back[end]
            out += [piece] if piece >= 0 else self.model.unknown_ids(text[at:end])[::-1]
            end = at
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit bytes."""
        cache = self.cache
        if len(cache) > SEGMENT_CACHE:
            cache.clear()
        out = []
        for s in self.model.segments(self.model.normalise(text)):
            ids = cache.get(s)
            if ids is None:
                ids = np.array(self.solve(s), "<i4").tobytes()
                if len(s) < 64:
                    cache[s] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.surface.__getitem__, ids))
        if ids and self.model.dummy_prefix and self.starts_spaced[ids[0]]:
            out = out[1:]
        return out.decode("utf-8", "replace")


def _run(raw, decode: bool, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = worker_state(("transducer", hash(raw.value)), lambda: Transducer(raw.value))
        for batch in batches:
            for part in slices(batch, 64):
                texts = part.column(1).to_pylist()
                codes = [None if x is None else t.encode(x) for x in texts]
                sizes = np.array([0 if c is None else len(c) // 4 for c in codes], np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(c or b"" for c in codes), "<i4"))
                missing = np.append([c is None for c in codes], False)
                ids = pa.ListArray.from_arrays(pa.array(ends, mask=missing), values)
                columns = [part.column(0), ids, pa.array([None if c is None else len(c) // 4 for c in codes], pa.int64())]
                if decode:
                    columns.append(pa.array([None if c is None else t.decode(np.frombuffer(c, "<i4").tolist()) == x
                                             for c, x in zip(codes, texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def model_bytes(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """``(doc_id, ids, n_ids)`` per row, and with ``check`` whether decoding gives the text back (``round_trip``)."""
    d = id_text(docs)
    schema = T.StructType([
        T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.LongType()), *([T.StructField("round_trip", T.BooleanType())] if check else [])])
    return d.mapInArrow(_run(model_bytes(docs.sparkSession, model_path), check, arrow_schema(schema)), schema)


def _decoder(raw, at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = worker_state(("transducer", hash(raw.value)), lambda: Transducer(raw.value))
        for batch in batches:
            texts = [None if ids is None else t.decode(ids) for ids in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text"])
    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, text)`` of ``encoded(doc_id, ids)``."""
    d = encoded.select("doc_id", "ids")
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_decoder(model_bytes(encoded.sparkSession, model_path), 1), f"doc_id {kind}, text string")
