"""Secret scans: Aho-Corasick keyword prefilter, anchored patterns near hits, checksum validation.

The automaton holds the keywords of all patterns and runs once over the
lower-cased text (lower-casing keeps every position). A pattern is only tried
at the position its keyword was hit, anchored, and hits inside an earlier match
of the same kind are passed over; this gives exactly the leftmost
non-overlapping matches of scanning with the pattern. Runs of hex digits have
no keyword of letters: there the text is first mapped to the classes
"hex digit" and "other", and the keyword is 24 hex digits in a row.

Base kinds: ``assign``, ``access``, ``hex``. Kinds added by validation, none of
which replaces a base span:

* ``token``: ``gh[pousr]_`` or ``npm_`` and 36 base-62 characters, the last six
  of which must be the CRC-32 of the 30 before them;
* ``jwt``: three base64url parts whose first one decodes to a JSON object with ``alg``;
* ``key``: a PEM private key block, whose body must be whole base64.

Defined results: null is the empty text; texts without spans have zero counts,
an empty span list and the SHA-256 of the empty string; an empty table gives
no rows; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, id_text, slices

# The base patterns of the contract and the layouts of the validated kinds.
KINDS = ("assign", "access", "hex", "token", "jwt", "key")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
TOKEN = r"(?:gh[pousr]_|npm_)[A-Za-z0-9]{36}(?![A-Za-z0-9])"
JWT = r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*"
KEY = r"-----BEGIN ((?:[A-Z0-9]+ )?PRIVATE KEY)-----\s([A-Za-z0-9+/=\s]+)-----END \1-----"
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "jwt": ("eyj",),
    "key": ("-----begin ",),
}
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[int, int, int]  # kind's place in KINDS, start, end


def _token_checksum(match: re.Match) -> bool:
    body = match.group().partition("_")[2]
    value = 0
    for c in body[30:]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body[:30].encode())


def _jwt_header(match: re.Match) -> bool:
    head = match.group().partition(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(found, dict) and "alg" in found


def _key_body(match: re.Match) -> bool:
    try:
        return len(base64.b64decode("".join(match.group(2).split()), validate=True)) >= 32
    except (ValueError, binascii.Error):
        return False


class Scanner:
    def __init__(self) -> None:
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        tests = {
            "assign": (ASSIGN, re.ASCII | re.IGNORECASE, lambda m: len(m.group(2)) >= MIN_ASSIGN),
            "access": (ACCESS, 0, lambda m: m.end() - m.start() >= MIN_ACCESS),
            "token": (TOKEN, 0, _token_checksum),
            "jwt": (JWT, 0, _jwt_header),
            "key": (KEY, 0, _key_body),
        }
        self.tests = {KINDS.index(k): (re.compile(p, flags), ok) for k, (p, flags, ok) in tests.items()}
        for kind, words in KEYWORDS.items():
            for word in words:
                self.automaton.add_word(word, (KINDS.index(kind), len(word)))
        self.automaton.make_automaton()
        self.run_of = re.compile(r"[A-Za-z0-9_-]*").match
        # hex digits become "h", every other byte "."; one byte a character after the ASCII replacement
        self.classes = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(".") for b in range(256))

    def spans(self, text: str) -> list[Span]:
        """All spans, by start, then kind."""
        found: list[Span] = []
        if text:
            low = text.lower()
            if len(low) != len(text):  # the one letter that grows when lower-cased
                low = text.replace("İ", "i").lower()
            past = dict.fromkeys(self.tests, 0)
            jwt, run_of = KINDS.index("jwt"), self.run_of
            for last, (kind, size) in self.automaton.iter(low):
                at = last + 1 - size
                if at >= past[kind]:
                    pattern, valid = self.tests[kind]
                    if m := pattern.match(text, at):
                        past[kind] = m.end()
                        if valid(m):
                            found.append((kind, at, m.end()))
                    elif kind == jwt and text.startswith("eyJ", at):  # a later hit in the same run of characters ends at the same dot and fails as well
                        past[kind] = run_of(text, at).end()
            classes = text.encode("ascii", "replace").translate(self.classes)
            run, end = b"h" * MIN_HEX, 0
            while (at := classes.find(run, end)) >= 0:
                end = classes.find(b".", at + MIN_HEX)
                end = len(classes) if end < 0 else end
                found.append((KINDS.index("hex"), at, end))
        found.sort(key=lambda s: (s[1], s[0]))
        return found


def _scan(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for part in slices(batch):
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in scanner.spans(t or "")]
                         for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, schema.field("spans").type)],
                                                 schema=schema)
    return run


def secret_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` per row; spans are structs of kind, start and end (code points, end exclusive)."""
    d = id_text(docs)
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType),
                           T.StructField("spans", T.ArrayType(span))])
    return d.mapInArrow(_scan(arrow_schema(schema)), schema)


def digest_columns(found: DataFrame) -> DataFrame:
    """The contract's counts, base digest and span string of ``secret_spans``."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"))


def _redactor(at: int, count: int | None, mark: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()

        def clean(text: str | None) -> str | None:
            if not text or not (spans := scanner.spans(text)):
                return text
            out, end = [], 0
            for _, a, b in spans:
                if a >= end:
                    out += [text[end:a], mark]
                end = max(end, b)
            return "".join(out) + text[end:]

        for batch in batches:
            for part in slices(batch):
                old = part.column(at).to_pylist()
                texts = [clean(t) for t in old]
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                if count is not None:
                    sizes = [n if t is o else len(t) for n, t, o in zip(columns[count].to_pylist(), texts, old)]
                    columns[count] = pa.array(sizes, columns[count].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)
    return run


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span (overlapping ones together) replaced by ``mark``; where the text
    changes, ``n_chars`` (if there is such a column) follows it. All other columns and rows stay as they are."""
    names = docs.columns
    count = names.index("n_chars") if "n_chars" in names else None
    return docs.mapInArrow(_redactor(names.index("text"), count, mark), docs.schema)
