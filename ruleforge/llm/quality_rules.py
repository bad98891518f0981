"""Quality rules: base counts per text and robust multivariate outliers per language and source.

Only DataFrame functions are used; nothing here runs Python on the executors.

Base counts are taken in the row itself, without a shuffle. Repeated three-word
windows are found by sorting (window hash, position) pairs of the text; the hash
is 64-bit, so two different windows of one text of n words are taken for equal
with probability below n*n / 2^65.

The verdict on texts that pass the base rules is a minimum-covariance-determinant
(MCD) estimate over five transformed statistics for each (lang, source) group:

1. The statistics are centred on the group's median and scaled by its MAD. A mean
   over few words is a noisy one, so the word length's distance to the median counts
   n / (n + ``PRIOR_WORDS``); its spread is then much the same for short and long texts.
2. Three deterministic starts: unit scatter, the scatter of tanh-squeezed values,
   and the spatial-sign scatter.
3. Concentration steps: distances under the current estimate, the share ``subset``
   of rows with the smallest ones, and their mean and covariance as the next
   estimate. The cut is read from a histogram of log distances (counts combined
   map-side), so a group of any size costs one partial row per bin and task.
4. The start with the smallest determinant wins; its scatter is scaled to the
   median distance and re-weighted once over rows within the 97.5 % quantile, with
   the consistency factor of a normal distribution cut there.
5. A text is rejected when its squared Mahalanobis distance exceeds the chi-squared
   quantile ``confidence``.

Variances are the estimate's own. Only where the chosen rows of a group are next to
constant in a statistic, as when nearly all texts are without symbols, its standard
deviation counts as ``FLOORS`` (in the statistic's unit): the scatter would be
singular, and every text with one symbol an outlier.

Covariances come from sums of products, and Cholesky factors and their inverses
are generated column expressions over one row per group and start.

Defined results: a null text has no words and fails the base rule; null lang or
source is a group of its own; groups of fewer than ``min_rows`` base-passing texts
are pooled by language, and a pool that is still smaller rejects nothing, as there
is no estimate; an empty table gives no rows; repeated rows count each; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, bounded, id_text, saved

MIN_WORDS = 50
SUBSET = 0.75
STEPS = 5
MIN_ROWS = 50
REWEIGHT = 0.975
PRIOR_WORDS = 100
CONFIDENCE = 0.9999
BINS_PER_OCTAVE = 16
GROUPS = 20_000  # up to so many groups, estimates (about 250 bytes a group and start) are broadcast

# Statistic -> smallest standard deviation, for groups in which it is next to constant.
FLOORS = {"log_words": 0.05, "word_length": 0.05, "symbol_rate": 0.4, "dup_lines": 0.1, "repeat_share": 0.1}
P = len(FLOORS)


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function, by the series of the lower incomplete gamma function."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return (low + high) / 2


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed."""
    d = id_text(docs, *keep).withColumn("text", F.coalesce("text", F.lit("")))
    names = ["doc_id", *keep]
    d = d.select(
        *names, "text", F.filter(F.split("text", f"[{SPACE_CLASS}]+"), lambda w: w != "").alias("w"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")).alias("lines"))
    w = F.col("w")
    window = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    d = d.select(
        *names, F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("w") >= 4, F.sort_array(window)).alias("s"))
    s = F.col("s")
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    d = d.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + 3).alias("end"), (acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n")),
        lambda acc: acc["n"])
    d = d.select(*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
                 F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _statistics() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1)).cast("double")
    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.log1p(100.0 * F.col("n_symbols") / words),
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
    }


def _centred() -> list[Column]:
    """The statistics as distances to the medians ``med_i``."""
    n = F.col("n_words").cast("double")
    weight = {"word_length": n / (n + PRIOR_WORDS)}
    return [(F.col(x) - F.col(f"med_{i}")) * weight.get(x, F.lit(1.0)) for i, x in enumerate(FLOORS)]


def _factors(moments: DataFrame) -> DataFrame:
    """Inverse Cholesky factors ``w_i_j`` and ``logdet`` of the covariance columns ``c_i_j``."""
    for j in range(P):
        rest = {i: F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
                for i in range(j, P)}
        moments = moments.withColumns({f"r_{i}": x for i, x in rest.items()})
        moments = moments.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(f"r_{j}", F.lit(1e-9))))
        moments = moments.withColumns({f"l_{i}_{j}": F.col(f"r_{i}") / F.col(f"l_{j}_{j}") for i in range(j + 1, P)})
    for i in range(P):
        moments = moments.withColumns({
            f"w_{i}_{j}": (1.0 if i == j else -sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)),
                                                   F.lit(0.0))) / F.col(f"l_{i}_{i}") for j in range(i + 1)})
    logdet = 2 * sum((F.log(f"l_{i}_{i}") for i in range(P)), F.lit(0.0))
    return moments.withColumn("logdet", logdet)


PARAMS = [f"m_{i}" for i in range(P)] + [f"w_{i}_{j}" for i in range(P) for j in range(i + 1)]


def _distance() -> Column:
    """Squared Mahalanobis distance of z_0.. under the parameter columns."""
    out = F.lit(0.0)
    for i in range(P):
        y = sum((F.col(f"w_{i}_{j}") * (F.col(f"z_{j}") - F.col(f"m_{j}")) for j in range(i + 1)), F.lit(0.0))
        out = out + F.pow(y, F.lit(2.0))
    return out


def _estimate(rows: DataFrame, keys: list[str], values: list[Column], floors: DataFrame, factor: float = 1.0,
              centred: bool = True) -> DataFrame:
    """Mean and covariance (times ``factor``) of ``values`` per group, as parameter columns. ``floors`` has the least
    variances ``f_i`` of each group."""
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(v).alias(f"s_{i}") for i, v in enumerate(values)],
        *[F.sum(values[i] * values[j]).alias(f"p_{i}_{j}") for i in range(P) for j in range(i + 1)])
    sums = sums.join(floors, "g").withColumns(
        {f"m_{i}": F.col(f"s_{i}") / F.col("n") if centred else F.lit(0.0) for i in range(P)})
    sums = sums.withColumns({
        f"c_{i}_{j}": factor * (F.col(f"p_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}"))
        for i in range(P) for j in range(i + 1)})
    at_floor = sum((F.when(F.col(f"c_{i}_{i}") < F.col(f"f_{i}"), 2 ** i).otherwise(0) for i in range(P)), F.lit(0))
    sums = sums.withColumn("at_floor", at_floor)
    sums = sums.withColumns({f"c_{i}_{i}": F.greatest(f"c_{i}_{i}", f"f_{i}") for i in range(P)})
    return _factors(sums).select(*keys, *PARAMS, "logdet", "at_floor")


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + F.lit(1e-6)) * BINS_PER_OCTAVE)


def _cut(bins: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The first bin at which a group's running count reaches ``share`` of its rows."""
    counts = bins.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    run = Window.partitionBy(*keys).orderBy("bin")
    whole = Window.partitionBy(*keys)
    return (counts.withColumn("up_to", F.sum("n").over(run)).withColumn("all", F.sum("n").over(whole))
            .where(F.col("up_to") >= F.ceil(F.lit(share) * F.col("all")))
            .groupBy(*keys).agg(F.min("bin").alias("cut")))


def verdicts(docs: DataFrame, subset: float = SUBSET, steps: int = STEPS, min_rows: int = MIN_ROWS,
             confidence: float = CONFIDENCE) -> DataFrame:
    """Base counts, ``base_failed``, ``distance`` (squared, null without an estimate), ``at_floor`` (the statistics,
    as bits in the order of ``FLOORS``, whose variance in the row's estimate is the floor) and ``kept`` per row."""
    counts = saved(base_counts(docs, "lang", "source"), "quality-counts")
    names = {"ignoreNullFields": "false"}  # a null source is a group of its own, not the pool of its language
    own, pooled = F.to_json(F.struct("lang", "source"), names), F.to_json(F.struct("lang"), names)
    large = saved(counts.where("not base_failed").groupBy(own.alias("own")).agg(F.count("*").alias("rows"))
                  .where(F.col("rows") >= min_rows).select("own"), "quality-groups")
    # one row a group: joined by broadcast while that is bounded, so that the rows are not shuffled for each step
    hint = F.broadcast if bounded(large, GROUPS) is not large else (lambda df: df)
    stats = (counts.withColumn("own_g", own).join(hint(large), F.col("own_g") == F.col("own"), "left")
             .withColumn("g", F.coalesce("own", pooled)).withColumns(_statistics()))
    stats = saved(stats, "quality-stats")
    good = stats.where("not base_failed")
    middle = good.groupBy("g").agg(F.count("*").alias("rows"), *[F.percentile_approx(x, 0.5).alias(f"med_{i}")
                                                                for i, x in enumerate(FLOORS)])
    middle = middle.where(F.col("rows") >= min_rows)
    spread = good.join(hint(middle), "g").groupBy("g").agg(*[
        F.percentile_approx(F.abs(x), 0.5).alias(f"mad_{i}") for i, x in enumerate(_centred())])
    scales = saved(middle.join(spread, "g").select("g", *[f"med_{i}" for i in range(P)], *[
        F.greatest(1.4826 * F.col(f"mad_{i}"), F.lit(floor)).alias(f"scale_{i}")
        for i, floor in enumerate(FLOORS.values())]), "quality-scales")
    floors = hint(scales.select("g", *[F.pow(floor / F.col(f"scale_{i}"), F.lit(2.0)).alias(f"f_{i}")
                                       for i, floor in enumerate(FLOORS.values())]))
    z = {f"z_{i}": x / F.col(f"scale_{i}") for i, x in enumerate(_centred())}
    zs = [F.col(c) for c in z]
    points = saved(good.join(hint(scales), "g").select("g", *[c.alias(n) for n, c in z.items()]), "quality-points")

    # starts: unit scatter (the least variances of values that are all zero), tanh, spatial signs scaled to unit variance
    size = F.sqrt(sum((c * c for c in zs), F.lit(1e-12)) / P)
    ones = floors.select("g", *[F.lit(1.0).alias(f"f_{i}") for i in range(P)])
    starts = [([F.lit(0.0)] * P, ones), ([F.tanh(c) for c in zs], floors), ([c / size for c in zs], floors)]
    params = None
    for k, (values, least) in enumerate(starts):
        one = _estimate(points, ["g"], values, least, centred=False).withColumn("start", F.lit(k))
        params = one if params is None else params.unionByName(one)
    keys = ["g", "start"]
    for _ in range(steps):
        params = saved(params, "quality-params")
        placed = points.join(hint(params), "g").select(*keys, *zs, _bin(_distance()).alias("bin"))
        cut = _cut(placed, keys, subset)
        params = _estimate(placed.join(hint(cut), keys).where("bin <= cut"), keys, zs, floors)
    params = saved(params, "quality-params")
    best = params.groupBy("g").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    raw = params.join(best, keys)

    median_bin = _cut(points.join(hint(raw), "g").select("g", _bin(_distance()).alias("bin")), ["g"], 0.5)
    middle_d2 = F.pow(F.lit(2.0), (F.col("cut") + 0.5) / BINS_PER_OCTAVE)
    scaled = saved(raw.join(median_bin, "g").withColumn(
        "stretch", middle_d2 / F.lit(chi2_quantile(0.5, P))), "quality-raw")
    edge = chi2_quantile(REWEIGHT, P)
    near = points.join(hint(scaled), "g").where(_distance() <= F.col("stretch") * edge)
    final = _estimate(near.select("g", *zs), ["g"], zs, floors, factor=REWEIGHT / chi2_cdf(edge, P + 2))
    final = saved(final.select("g", "at_floor", *PARAMS).join(scales, "g"), "quality-final")

    limit = chi2_quantile(confidence, P)
    judged = (stats.join(hint(final), "g", "left").withColumns(z).withColumn("distance", _distance()))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "at_floor",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"))
