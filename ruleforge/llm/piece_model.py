"""Reader of SentencePiece ``.model`` files, and what the two operators on them share.

Only the fields used here are read: pieces with score and type, the model type,
byte fallback and the normaliser's switches. A model with a character map
(``precompiled_charsmap``) is refused, as its normaliser is not the identity.

For models of type BPE, a sequence of pieces is the tokenizer's answer exactly
when every two neighbours are ("pair rule"): merging the two pieces' text on its own
gives these two pieces back. Merge order is by score, then leftmost.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

# Fixed values of the model format: piece types, model types and the space mark.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
PAIR_CACHE = 400_000


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message; 4-byte values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, raw[at:at + size]
            at += size


class PieceModel:
    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.model_type, self.byte_fallback = UNIGRAM, False
        self.dummy_prefix = self.trim_spaces = True
        for field, value in _fields(raw):
            if field == 1:
                one = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
                self.pieces.append(one[1].decode())
                self.scores.append(struct.unpack("<f", one[2])[0])
                self.kinds.append(one[3])
            elif field == 2:
                spec = dict(_fields(value))
                self.model_type = spec.get(3, UNIGRAM)
                self.byte_fallback = bool(spec.get(35, 0))
                if spec.get(24, 0):
                    raise ValueError("models with the space mark as a suffix are not supported")
            elif field == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models with a normaliser character map are not supported")
                self.dummy_prefix, self.trim_spaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if any(k in (USER_DEFINED, UNUSED) for k in self.kinds):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("models with the space mark inside a piece are not supported")
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.bytes_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.unknown_score = min(self.scores[i] for i in self.ids.values()) - UNKNOWN_PENALTY if self.ids else 0.0
        joined = set("".join(p for p in self.ids if len(p) > 1))
        if any(c not in self.ids for c in joined):
            raise ValueError("models whose pieces hold characters outside the vocabulary are not supported")
        # where no piece mixes letters with other characters, a segment ends between them too
        other = re.escape("".join(sorted(c for c in joined if not c.isalpha() and re.match(r"[^\W\d_]", c))))
        letter = rf"[^\W\d_{other}]"
        apart = all(bool(re.match(letter, a)) == bool(re.match(letter, b))
                    for p in self.ids for a, b in zip(p.lstrip(SPACE), p.lstrip(SPACE)[1:]))
        self.segment = re.compile(f"{SPACE}*(?:{letter}+|(?:(?!{letter})[^{SPACE}])+)|{SPACE}+" if apart else
                                  f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.pairs: dict[int, bool] = {}

    def normalise(self, text: str) -> str:
        if self.trim_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        text = text.replace(" ", SPACE)
        return SPACE + text if self.dummy_prefix else text

    def segments(self, text: str) -> list[str]:
        """Parts of a normalised text that no piece crosses: a piece holds the space mark only at its start."""
        return self.segment.findall(text)

    def unknown_ids(self, char: str) -> list[int]:
        """The byte pieces (or the unknown piece) of a character the vocabulary lacks."""
        if self.byte_fallback:
            return [self.bytes_id[b] for b in char.encode("utf-8", "replace")]
        return [self.unknown]

    def merged(self, text: str) -> list[str]:
        """The pieces that merging alone makes of a short text."""
        parts, ids, scores = list(text), self.ids, self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or scores[k] > best):
                    best, at = scores[k], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, left: int, right: int) -> bool:
        """The pair rule for two pieces; -1 is a character outside the vocabulary, which never merges."""
        if left < 0 or right < 0:
            return True
        key = left << 24 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            two = [self.pieces[left], self.pieces[right]]
            known = self.pairs[key] = self.merged("".join(two)) == two
        return known
