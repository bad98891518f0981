"""Token counts without tokens: Aho-Corasick matches and a count-only Viterbi recursion.

The automaton holds every piece of the vocabulary and reports, for each end position, the pieces ending there,
longest first. Two recursions run over the matches and carry only numbers:

* unigram: the best score of each prefix and the piece count of its best path. Ties follow the tokenizer:
  starts are taken in ascending order and only a strictly better score replaces, so equal scores keep the longer
  last piece. A character without a piece costs the lowest score minus 10 and counts its UTF-8 bytes.
* the file's own type when that is BPE: the last piece and the count of each prefix, where a match may follow only
  what the pair rule allows (``piece_model.py``). This gives the tokenizer's count exactly.

Best paths do not cross segments, so the recursion starts anew at each and solved segments are looked up in a
bounded cache. Scores are added in double precision (libraries that add them in single precision round once the
sum passes 2**24).

Defined results: null, like the empty text, has zero tokens; an empty table gives no rows; repeated rows give
repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_schema, id_text, slices, worker_state
from .piece_model import BPE, PieceModel
from .transducer import SEGMENT_CACHE, model_bytes


class Counter:
    def __init__(self, raw: bytes):
        import ahocorasick
        self.model = m = PieceModel(raw)
        self.automaton = ahocorasick.Automaton()
        for piece, k in m.ids.items():
            self.automaton.add_word(piece, (len(piece), m.scores[k], k))
        if m.ids:
            self.automaton.make_automaton()
        self.cache: dict[str, tuple[int, float, int]] = {}

    def _unknown(self, char: str) -> int:
        return len(char.encode("utf-8", "replace")) if self.model.byte_fallback else 1

    def solve(self, text: str) -> tuple[int, float, int]:
        """(unigram pieces, unigram score, pieces by the model's own type)."""
        n, m = len(text), self.model
        ends: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        for last, match in (self.automaton.iter(text) if m.ids else ()):
            ends[last + 1].append(match)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        bpe, pairs = m.model_type == BPE, m.pairs
        before, parts = [-1] * (n + 1), [0] + [-1] * n
        for end in range(1, n + 1):
            matches = ends[end]
            single = bool(matches) and matches[-1][0] == 1
            top = None
            for size, score, _ in matches:
                if top is None or best[end - size] + score > top:
                    top, count[end] = best[end - size] + score, count[end - size] + 1
            if not single:
                rest = self._unknown(text[end - 1])
                if top is None or best[end - 1] + m.unknown_score > top:
                    top, count[end] = best[end - 1] + m.unknown_score, count[end - 1] + rest
            best[end] = top
            if bpe:
                for size, _, piece in matches if single else [*matches, (1, 0.0, -1)]:
                    at = end - size
                    if parts[at] < 0:
                        continue
                    ok = pairs.get(before[at] << 24 | piece) if at else True
                    if m.neighbours(before[at], piece) if ok is None else ok:
                        before[end] = piece
                        parts[end] = parts[at] + (1 if piece >= 0 else rest)
                        break
        return count[n], best[n], parts[n] if bpe else count[n]

    def __call__(self, text: str | None) -> tuple[int, float, int]:
        if len(self.cache) > SEGMENT_CACHE:
            self.cache.clear()
        pieces, score, own = 0, 0.0, 0
        for s in self.model.segments(self.model.normalise(text or "")):
            got = self.cache.get(s)
            if got is None:
                got = self.solve(s)
                if len(s) < 64:
                    self.cache[s] = got
            pieces += got[0]
            score += got[1]
            own += got[2]
        return own, score, pieces


def _count(raw, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(("counter", hash(raw.value)), lambda: Counter(raw.value))
        for batch in batches:
            for part in slices(batch):
                found = [counter(t) for t in part.column(1).to_pylist()]
                if found:
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in zip(*found))], schema=schema)
    return run


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, n_tokens (the model's own tokenizer), unigram_score and n_unigram (best unigram path)."""
    d = id_text(docs)
    schema = T.StructType([
        T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("unigram_score", T.DoubleType()), T.StructField("n_unigram", T.LongType())])
    return d.mapInArrow(_count(model_bytes(docs.sparkSession, model_path), arrow_schema(schema)), schema)
