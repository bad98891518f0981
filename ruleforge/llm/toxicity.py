"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text (``FEATURES``): densities of hits in learned lexicons of words
and of word beginnings, the hits' weights, their nearness to second-person words,
capitals, punctuation, and rates of obfuscated spellings. A word is looked up by
its letters in lower case; a word that mixes letters with digits or signs is also
looked up with the signs read as letters (``LOOK_ALIKES``) and with runs of
one letter shortened, and a hit found only that way counts as obfuscated.

Training takes at most ``max_rows`` labelled rows that are not held out (those of the
lowest id hashes; a documented bound, so the list of ids may be broadcast). The
lexicons are word and 4- and 5-letter-beginning frequencies by label, counted on
Spark, of which the ``LEXICON`` most telling of each kind are kept. They are learned
twice, on either half of the rows, and a row's training features use the other
half's, so that the trees do not learn from words picked by the row itself; scoring uses
the lexicons of all rows. Trees are fitted on four fifths of the rows, and the
isotonic calibration of their scores on the remaining fifth.

Defined results: null, empty and blank texts have all-zero features and get the
score of that vector; without labelled rows every score is 0.5, and with labels of
one kind only it is that label; labels of ids without a document are not used, an
id labelled twice counts twice; an empty table gives no rows; repeated rows give
repeated rows; lang, source and doc_id are never inputs of a score. Texts are read
whole, in pieces of bounded size.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, saved, slices

MAX_ROWS = 20_000
LEXICON = 2000
MIN_Z = 3.0
TREES, DEPTH, STEP = 24, 4, 0.2
THRESHOLD = 0.3
NEAR = 5
SEED = 11
PIECE = 1 << 20

# Second-person words of English, German, French, Spanish.
SECOND_PERSON = frozenset("""
    you your yours yourself yourselves u ur
    du dich dir dein deine deiner deinem deinen ihr euch euer eure
    tu te toi ton ta tes vous votre vos
    tú ti tuyo tuya usted ustedes vosotros vuestro
""".split())
# Signs and digits commonly written for letters.
LOOK_ALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i",
                             "|": "l", "+": "t", "€": "e"})

FEATURES = ("log_words", "hits_rate", "stems_rate", "weight_rate", "max_weight", "log_hits", "log_stems", "near_rate",
            "second_person_rate", "capitals", "caps_words", "exclamations", "questions", "punctuation", "obfuscated_rate",
            "revealed_rate", "stretched_rate", "spaced_letters")

_HIT, _STEM, _SECOND, _CAPS, _OBFUSCATED, _REVEALED, _STRETCHED, _LETTER = (1 << i for i in range(8))
_WEIGHT_SHIFT, _WEIGHT_UNIT = 8, 1000


def plain_word(word: str) -> str:
    """The letters and digits of a word in lower case, composed."""
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFC", word).lower())


def revealed(word: str) -> str:
    """A word with look-alikes read as letters and runs of three or more of a letter shortened to one."""
    text = re.sub(r"[\W_]+", "", unicodedata.normalize("NFC", word).lower().strip(".,;:!?\"'()").translate(LOOK_ALIKES))
    return re.sub(r"(.)\1{2,}", r"\1", text)


def stems(word: str) -> list[str]:
    return [word[:n] + "-" for n in (4, 5) if len(word) > n]


class _Words(dict):
    """Word -> its flags and weight in one number, remembered up to a bound."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        plain, flags, weight = plain_word(word), 0, 0.0
        mixed = bool(re.search(r"\w[^\w\s'’.,-]+\w|[^\W\d_]\d|\d[^\W\d_]", word))
        stretched = bool(re.search(r"([^\W\d_])\1\1", word.lower()))
        if plain in self.lexicon:
            flags, weight = _HIT, self.lexicon[plain]
        elif (mixed or stretched) and revealed(word) in self.lexicon:
            flags, weight = _HIT | _REVEALED, self.lexicon[revealed(word)]
        else:
            weight = max((self.lexicon.get(s, 0.0) for s in stems(plain)), default=0.0)
            flags = _STEM if weight else 0
        flags |= (_SECOND * (plain in SECOND_PERSON) | _CAPS * (len(plain) > 1 and word.isupper()) | _OBFUSCATED * mixed
                  | _STRETCHED * stretched | _LETTER * (len(plain) == 1 and plain.isalpha()))
        got = self[word] = flags | int(weight * _WEIGHT_UNIT) << _WEIGHT_SHIFT
        return got


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):  # cut at white space, so that only a piece's words are Python objects at a time
        end = at + PIECE
        if end < len(text):
            space = re.compile(r"\s").search(text, end)
            end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def text_features(text: str | None, words: _Words) -> np.ndarray:
    out = np.zeros(len(FEATURES))
    codes, chars = [], np.zeros(256, np.int64)
    for piece in _pieces(text or ""):
        codes.append(np.fromiter(map(words.__getitem__, piece.split()), np.int64))
        chars += np.bincount(np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    n = len(code)
    if not n:
        return out
    count = lambda flag: int(np.count_nonzero(code & flag))
    weight = code >> _WEIGHT_SHIFT
    hit = np.flatnonzero(code & (_HIT | _STEM))
    second = np.flatnonzero(code & _SECOND)
    near = 0
    if len(hit) and len(second):
        at = np.searchsorted(second, hit)
        gap = np.minimum(np.abs(second[np.minimum(at, len(second) - 1)] - hit), np.abs(second[np.maximum(at - 1, 0)] - hit))
        near = int(np.count_nonzero(gap <= NEAR))
    letter = (code & _LETTER) != 0
    spaced = int(np.count_nonzero(letter[2:] & letter[1:-1] & letter[:-2]))
    total = max(1, int(chars.sum()))
    small, large = int(chars[97:123].sum()), int(chars[65:91].sum())
    signs = int(chars[33:48].sum() + chars[58:65].sum() + chars[91:97].sum() + chars[123:127].sum())
    out[:] = (math.log1p(n), 100 * count(_HIT) / n, 100 * count(_STEM) / n, 100 * weight.sum() / _WEIGHT_UNIT / n,
              weight.max() / _WEIGHT_UNIT, math.log1p(count(_HIT)), math.log1p(count(_STEM)), 100 * near / n, 100 * len(second) / n,
              large / max(1, small + large), 100 * count(_CAPS) / n, 100 * int(chars[33]) / total, 100 * int(chars[63]) / total,
              100 * signs / total, 100 * count(_OBFUSCATED) / n, 100 * count(_REVEALED) / n, 100 * count(_STRETCHED) / n, 100 * spaced / n)
    return out


def _feature_rows(lexicons) -> Callable:
    """``(half, kept columns ..., text)`` to the kept columns and features; ``half`` chooses the lexicon."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [_Words(x) for x in lexicons.value]
        for batch in batches:
            names = batch.schema.names[1:-1] + ["features"]
            for part in slices(batch):
                found = [text_features(t, words[h]) for h, t in zip(part.column(0).to_pylist(), part.column(part.num_columns - 1).to_pylist())]
                if found:
                    lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES), np.concatenate(found))
                    yield pa.RecordBatch.from_arrays(part.columns[1:-1] + [lists], names)
    return run


def _with_features(rows: DataFrame, lexicons: list[dict[str, float]], half: Column) -> DataFrame:
    """``rows`` (its last column is the text) with that column replaced by the features."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("features", T.ArrayType(T.DoubleType()))])
    return rows.select(half.cast("int").alias("which"), *rows.columns).mapInArrow(_feature_rows(shared), schema)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(half, y, term, n)``: distinct words and beginnings of each text, added up over a piece of the batch."""
    for batch in batches:
        for part in slices(batch):
            found: dict[tuple, int] = {}
            for half, y, text in zip(*(c.to_pylist() for c in part.columns)):
                terms: set[str] = set()
                for piece in _pieces(text or ""):
                    for word in set(piece.split()):
                        if plain := plain_word(word):
                            terms.add(plain)
                            terms.update(stems(plain))
                for t in terms:
                    found[half, y, t] = found.get((half, y, t), 0) + 1
            if found:
                half, y, term = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(half, pa.int32()), pa.array(y, pa.int32()), pa.array(term),
                                                  pa.array(list(found.values()), pa.int64())], ["half", "y", "term", "n"])


def _lexicons(rows: DataFrame, size: int) -> list[dict[str, float]]:
    """Lexicons for rows of half 0 (learned on half 1), of half 1 (on half 0), and for all others (on both)."""
    counts = rows.select("half", "y", "text").mapInArrow(_distinct_words, "half int, y int, term string, n bigint")
    terms = counts.groupBy("term").agg(*[F.coalesce(F.sum(F.when((F.col("half") == h) & (F.col("y") == y), F.col("n"))), F.lit(0)).alias(f"n{h}{y}")
                                         for h in (0, 1) for y in (0, 1)])
    terms = saved(terms, "toxicity-terms")
    size_of = {(r["half"], r["y"]): r["count"] for r in rows.groupBy("half", "y").count().collect()}
    out = []
    for halves in ((1,), (0,), (0, 1)):
        docs = [sum(size_of.get((h, y), 0) for h in halves) for y in (0, 1)]
        n0, n1 = (sum((F.col(f"n{h}{y}") for h in halves), F.lit(0)) for y in (0, 1))
        odds = (F.log((n1 + 0.5) / (F.lit(docs[1]) - n1 + 0.5)) - F.log((n0 + 0.5) / (F.lit(docs[0]) - n0 + 0.5)))
        error = F.sqrt(1 / (n1 + 0.5) + 1 / (F.lit(docs[1]) - n1 + 0.5) + 1 / (n0 + 0.5) + 1 / (F.lit(docs[0]) - n0 + 0.5))
        kept: dict[str, float] = {}
        for kind in (F.col("term").endswith("-"), ~F.col("term").endswith("-")):
            best = (terms.where(kind & (n1 >= 2)).select("term", odds.alias("odds"), (odds / error).alias("z"))
                    .where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "term").limit(size))
            kept.update({r["term"]: min(r["odds"], 20.0) for r in best.collect()})
        out.append(kept)
    return out


@dataclass
class ToxicityModel:
    """Lexicon, trees and calibration; or a constant score when the labels allow no trees."""
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    constant: float = 0.5


def held_out(doc_id: Column) -> Column:
    """True for the rows whose label must not be learnt: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _raw(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """``rows`` with the trees' probability of label 1 as ``raw``."""
    found = trees.transform(rows.withColumn("features", array_to_vector("features")))
    return found.withColumn("raw", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS, lexicon: int = LEXICON,
        trees: int = TREES, depth: int = DEPTH) -> ToxicityModel:
    """Lexicon, trees and calibration learnt from rows that are not held out."""
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(29))
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("y"), order.alias("order"))
              .orderBy("order", "label_id").limit(max_rows))
    rows = id_text(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    rows = saved(rows.select(F.pmod("order", F.lit(2)).cast("int").alias("half"), (F.pmod("order", F.lit(10)) >= 8).alias("calibrate"),
                             "order", "y", "text"), "toxicity-sample")
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(counts) < 2:
        return ToxicityModel({}, constant=float(next(iter(counts), 0.5)))
    words = _lexicons(rows, lexicon)
    found = saved(_with_features(rows.select("half", "calibrate", "order", F.col("y").cast("double").alias("y"), "text"), words,
                                 F.col("half")), "toxicity-features")
    train, rest = found.where("not calibrate"), found.where("calibrate")
    if train.select("y").distinct().count() < 2 or rest.select("y").distinct().count() < 2:
        train = rest = found  # too few rows to be divided
    ordered = train.orderBy("order", "y").withColumn("features", array_to_vector("features"))
    model = GBTClassifier(labelCol="y", maxIter=trees, maxDepth=depth, stepSize=STEP, maxBins=64, seed=SEED).fit(ordered.coalesce(2))
    raw = _raw(rest.select("y", "features"), model).orderBy("raw", "y")
    return ToxicityModel(words[2], model, IsotonicRegression(featuresCol="raw", labelCol="y").fit(raw))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, score)`` per row; higher means label 1 is likelier."""
    texts = id_text(docs)
    if model.trees is None:
        return texts.select("doc_id", F.lit(model.constant).alias("score"))
    found = _raw(_with_features(texts, [model.lexicon], F.lit(0)), model.trees)
    found = model.calibration.transform(found)
    return found.select("doc_id", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))
