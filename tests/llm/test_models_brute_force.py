"""The trained and estimated models against plain loops: FTRL, TF-IDF centroids, minimum covariance determinant."""

import collections
import math
import random
import re

import numpy as np
import xxhash
from llm_data import edge_docs
from pyspark.sql import functions as F

from ruleforge.llm import classifier, language_id, quality_rules
from ruleforge.llm.common import held_out

M64, M32 = (1 << 64) - 1, (1 << 32) - 1


def _prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) + rng.choice(["", "", "", ",", "."])
                    for _ in range(n))


# ------------------------------------------------------------------ classifier
def plain_features(text, bits):
    def h(x):
        return xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))
    cores, shapes = [], []
    for word in (text or "").split():
        core = re.sub(r"[\W_]+", "", word)
        case = ("u" if core.isupper() and len(core) > 1 else "t" if core[:1].isupper() else
                "l" if core.islower() else "d" if core.isdigit() else "x" if core else "n")
        cores.append(h(core.lower() or word))
        shapes.append(h(case + re.sub(r"\w+", "a", word)[:16]))
    raw = cores + [a * 0x9E3779B97F4A7C15 + b for a, b in zip(cores, cores[1:])]
    raw += [s + 3 for s in shapes] + [a * 0xD6E8FEB86659FD93 + b for a, b in zip(shapes, shapes[1:])]
    raw += [(a == b) * 0xA0761D6478BD642F + 5 for a, b in zip(cores, cores[1:])]
    places = collections.Counter()
    for x in raw:
        x &= M64
        x ^= x >> 32
        places[1 + ((x * 0xBF58476D1CE4E5B9 & M64) >> (64 - bits))] += 1
    dense = np.zeros((1 << bits) + 1)
    for p, c in places.items():
        dense[p] = 1 + math.log(c)
    if places:
        dense *= 3 / np.sqrt((dense ** 2).sum())
    dense[0] = 1
    return dense


def plain_ftrl(rows, size, epochs):
    z, n = np.zeros(size), np.zeros(size)

    def weights():
        w = np.zeros(size)
        for i in np.flatnonzero(np.abs(z) > classifier.L1):
            w[i] = -(z[i] - math.copysign(classifier.L1, z[i])) / (
                (classifier.BETA + math.sqrt(n[i])) / classifier.ALPHA + classifier.L2)
        return w
    for _ in range(epochs):
        for y, x in rows:
            w = weights()
            g = (1 / (1 + math.exp(-(w @ x))) - y) * x
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / classifier.ALPHA
            z += g - sigma * w
            n += g * g
    return weights()


def test_classifier_equals_a_dense_loop(spark):
    rng = random.Random(11)
    texts = [_prose(rng, rng.randint(0, 40), "abcdeXY1" if i % 3 else "klmnop!_") for i in range(60)] + [None, "", "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(63)] + [(7, 0), (900, 1)], "doc_id bigint, quality int")
    bits, shards, epochs = 9, 3, 2
    task = {r["id"]: r["task"] for r in spark.range(shards).selectExpr("id", f"pmod(hash(id), {shards}) as task").collect()}
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))
    kept = sorted((r["o"], r["doc_id"], r["quality"]) for r in labels.where(~held_out(F.col("doc_id")) & (F.col("doc_id") < 900))
                  .select(order.alias("o"), "doc_id", "quality").collect())
    size, total, want = (1 << bits) + 1, len(kept), 0
    for s in range(shards):
        rows = [(y, plain_features(texts[i], bits).astype(np.float32).astype(float)) for o, i, y in kept if task[o % shards] == s]
        want = want + plain_ftrl(rows, size, epochs) * len(rows) / total
    got = classifier.fit(docs, labels, bits=bits, shards=shards, epochs=epochs)
    assert np.abs(want).max() > 0.05 and np.abs(got - want).max() < 1e-6
    scores = {r.doc_id: r.score for r in classifier.score(docs, got, bits=bits).collect()}
    for i, t in enumerate(texts):
        assert abs(scores[i] - 1 / (1 + math.exp(-(want @ plain_features(t, bits))))) < 1e-6


# -------------------------------------------------------------------- language
def plain_vector(text, bits, idf=None):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    codes = [32, *map(ord, " ".join(words)), 32] if words else []
    two = [(a * 0x9E3779B1 + b) & M32 for a, b in zip(codes, codes[1:])]
    three = [(a * 0x85EBCA6B + c + 77) & M32 for a, c in zip(two, codes[2:])]
    out = np.zeros(1 << bits)
    for x in two + three:
        x = x * 0xC2B2AE35 & M32
        x ^= x >> 15
        out[(x * 0x27D4EB2F & M32) >> (32 - bits)] += 1
    if idf is None:
        return out
    out = np.where(out > 0, 1 + np.log(np.maximum(out, 1)), 0) * idf
    return out / np.sqrt((out ** 2).sum()) if out.any() else out


def plain_centroids(x, k, rounds=12):
    centres = [x[np.argmax([v @ x.mean(axis=0) for v in x])]]
    while len(centres) < min(k, len(x)):
        centres.append(x[np.argmin([max(v @ c for c in centres) for v in x])])
    for _ in range(rounds):
        near = [int(np.argmax([v @ c for c in centres])) for v in x]
        for j in range(len(centres)):
            if j in near:
                total = sum(v for v, m in zip(x, near) if m == j)
                centres[j] = total / np.sqrt((total ** 2).sum())
    return centres, np.quantile([max(v @ c for c in centres) for v in x], 0.001)


def test_language_equals_a_dense_loop(spark):
    rng = random.Random(12)
    alphabets = {"aa": "abcdéf", "bb": "defghß", "cc": "漢字仮名ab"}
    rows = [(i, _prose(rng, rng.randint(1, 30), alphabets[lang]), lang) for i, lang in enumerate(list(alphabets) * 30)]
    rows += [(500, None, "aa"), (501, "12 !", "bb"), (502, "abc dda", None), (503, "", "cc"), (504, "zzz yyy 12xxx", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    bits = 10
    out = {r["doc_id"] for r in docs.where(held_out(F.col("doc_id"))).collect()}
    train = [(t, lang) for i, t, lang in rows if t is not None and lang and i not in out and plain_vector(t, bits).any()]
    df = sum((plain_vector(t, bits) > 0).astype(int) for t, _ in train)
    idf = np.log((1 + len(train)) / (1 + df)) + 1
    found = {lang: plain_centroids(np.array([plain_vector(t, bits, idf) for t, la in train if la == lang]), 4) for lang in alphabets}
    model = language_id.fit(docs, bits=bits)
    assert np.abs(model["idf"] - idf).max() < 1e-5 and model["langs"] == sorted(list(alphabets) * 4)
    for lang, (centres, low) in found.items():
        mine = [c for c, la in zip(model["centroids"], model["langs"]) if la == lang]
        assert all(min(np.abs(c - m).max() for m in mine) < 1e-5 for c in centres)
        assert all(abs(x - low) < 1e-5 for x, la in zip(model["low"], model["langs"]) if la == lang)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    for i, t, _ in rows:
        v = plain_vector(t, bits, idf)
        if not v.any():
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
            continue
        best, lang = max((max(v @ c for c in centres), lang) for lang, (centres, _) in found.items())
        assert got[i].lang_pred == lang and abs(got[i].score - best) < 1e-5
        assert got[i].rejected == (best < language_id.SLACK * found[lang][1])


def test_language_ties_go_to_the_first_language(spark):
    rows = [(i, "the same words in both languages", lang) for i, lang in enumerate(["zz", "mm"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    assert {r.lang_pred for r in language_id.predict(docs, model).collect()} == {"mm"}


# --------------------------------------------------------------- quality rules
def statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {k + d for k in range(len(w) - 2) if seen[(w[k], w[k + 1], w[k + 2])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = max(len(w), 1)
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return failed, [math.log1p(len(w)), sum(map(len, w)) / n, math.log1p(100 * len(re.findall(r"[#*$%&|<>]", text or "")) / n),
                    (len(lines) - len(set(lines))) / max(len(lines), 1), len(cover) / n]


def plain_mcd(x, words, binned):
    """Squared distances of a minimum-covariance-determinant estimate. ``binned``: ranks are read from bins of
    1/16 octave, as the operator does; else they are exact."""
    p, floors = x.shape[1], np.array(list(quality_rules.FLOORS.values()))
    middle = np.sort(x, axis=0)[(len(x) - 1) // 2]
    x = x - middle
    x[:, 1] *= words / (words + 100)
    scale = np.maximum(1.4826 * np.sort(np.abs(x), axis=0)[(len(x) - 1) // 2], floors)
    z, least = x / scale, (floors / scale) ** 2

    def estimate(v, mean):
        c = sum(np.outer(r - mean, r - mean) for r in v) / len(v)
        return mean, c + np.diag(np.maximum(least - np.diag(c), 0))

    def distances(mean, c):
        return np.array([(r - mean) @ np.linalg.solve(c, r - mean) for r in z])

    def upto(d, share):  # (rows up to the rank, value at the rank)
        k = math.ceil(share * len(d)) - 1
        if not binned:
            return d <= np.sort(d)[k], np.sort(d)[k]
        b = np.floor(np.log2(d + 1e-6) * 16)
        return b <= np.sort(b)[k], 2 ** ((np.sort(b)[k] + 0.5) / 16)
    length = np.sqrt((z ** 2).sum(axis=1) + 1e-12)
    zero = np.zeros(p)
    best = None
    for mean, c in ((zero, np.eye(p)), estimate(np.tanh(z), zero), estimate(z / length[:, None] * math.sqrt(p), zero)):
        for _ in range(quality_rules.STEPS):
            inside = z[upto(distances(mean, c), quality_rules.SUBSET)[0]]
            mean, c = estimate(inside, inside.mean(axis=0))
        if best is None or np.linalg.slogdet(c)[1] < best[0] - 1e-9:
            best = np.linalg.slogdet(c)[1], mean, c
    d = distances(*best[1:])
    edge = quality_rules.chi2_quantile(0.975, p)
    near = z[d <= upto(d, 0.5)[1] / quality_rules.chi2_quantile(0.5, p) * edge]
    factor = 0.975 / quality_rules.chi2_cdf(edge, p + 2)
    mean = near.mean(axis=0)
    c = factor * np.cov(near.T, bias=True)
    return distances(mean, c + np.diag(np.maximum(least - np.diag(c), 0)))


def _corpus(rng, n=220):
    """Clean texts; symbols and repeats are rare. Every eleventh is mildly odd: words somewhat longer than the group's."""
    texts = []
    for i in range(n):
        low, high = (5, 8) if i % 11 == 10 else (2, 8)
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(low, high))) for _ in range(rng.randint(60, 300))]
        if i % 9 == 0:
            words[3] = "&"
        if i % 13 == 0:
            words[40:43] = words[10:13]
        texts.append("\n".join(" ".join(words[k:k + 30]) for k in range(0, len(words), 30)))
    return texts


def test_verdicts_equal_a_plain_mcd(spark):
    rng = random.Random(13)
    texts = {(i, g): t for g in (0, 1) for i, t in enumerate(_corpus(rng))}
    rows = [(i * 2 + g, t, "en", "web" if g else None) for (i, g), t in texts.items()] + [(9001, None, "en", "web"), (9002, "few words", "en", "web")]
    got = {r.doc_id: r for r in quality_rules.verdicts(spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string").repartition(4)).collect()}
    assert len(got) == len(rows) and not got[9001].kept and not got[9002].kept
    limit = quality_rules.chi2_quantile(quality_rules.CONFIDENCE, 5)
    for g in (0, 1):
        x = np.array([statistics(texts[i, g])[1] for i in range(220)])
        words = np.array([len(texts[i, g].split()) for i in range(220)])
        want, exact = plain_mcd(x, words, binned=True), plain_mcd(x, words, binned=False)
        mine = np.array([got[i * 2 + g].distance for i in range(220)])
        assert np.allclose(mine, want, rtol=1e-6, atol=1e-6)
        kept = np.array([got[i * 2 + g].kept for i in range(220)])
        assert (kept == (want <= limit)).all() and (kept == (exact <= limit)).mean() >= 0.99
        odd = np.arange(220) % 11 == 10
        assert not kept[odd].any() and kept[~odd].mean() >= 0.98  # mild outliers go, the others stay
        # variances are the estimate's own but for the three statistics that nearly all texts have at nought
        assert {got[i * 2 + g].at_floor for i in range(220)} == {0b11100}


def test_constant_groups_have_an_estimate(spark):
    line = " ".join(f"w{i}" for i in range(80))
    rows = [(i, line, "en", "s") for i in range(60)] + [(60, line + " ###" * 40, "en", "s")]
    got = {r.doc_id: r for r in quality_rules.verdicts(spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(got[i].kept and got[i].distance < 1e-9 for i in range(60)) and not got[60].kept
    assert got[0].at_floor == 0b11111


def test_quality_rules_on_awkward_documents_with_an_estimate(spark):
    docs = edge_docs(spark)
    rows = quality_rules.verdicts(docs, min_rows=2).collect()
    assert len(rows) == docs.count() and all(r.kept <= (not r.base_failed) for r in rows)
