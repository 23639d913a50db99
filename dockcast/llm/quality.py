"""Operator 7: quality rules and robust multivariate outliers.

Base statistics are counted over each whole text. Their transformed vectors are judged inside a
group (language and source; a group of fewer than ``MIN_GROUP`` rows joins its language's small
groups, and those the small groups of all languages) by the minimum-covariance-determinant method:

* four deterministic starts: median and median absolute deviation; middle and width of each coordinate's
  shortest half; covariance of the squashed (tanh) and of the unit-length standardised vectors;
* concentration steps from each start: squared Mahalanobis distances of all rows, the half (``SHARE``)
  of the group's rows that lies nearest, their mean and covariance, until the covariance's determinant
  stops falling by more than ``TOLERANCE``; the start that ends at the least determinant gives the
  estimate, so outliers may make up nearly half of a group, clustered ones too;
* mean and covariance again of the rows within the chi-square quantile 0.975; the distances are scaled
  so that their median is at most that of a normal sample, and rows beyond the quantile 0.999 are rejected.

Every step is one aggregation over all rows into (group, start, distance bin) moments, combined before
its shuffle; a group's small table of bins gives the next centre. "Nearest" goes by whole bins. So a hot group is never in one task,
and nothing is sampled. A coordinate that hardly varies gets a least variance (``FLOOR``), so that
the usual value of a count that is mostly 0 doesn't make every other value an outlier.

Defined results: null text has no words and fails; null language or source is a value of its own;
repeated rows are each judged; an empty text is judged as null is; a text is read whole however long;
input columns stay apart in ``row``, whatever their names; of starts with equal determinants the first
counts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, packed, ship, small_side

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MIN_GROUP = 100
SHARE = 0.5                   # of a group's rows that the estimate rests on
TOLERANCE = 1e-3              # least fall of the logarithm of the determinant that is worth a further step
VECTOR = ("length", "word_length", "symbols", "lines", "repeats")
FLOOR = np.array([0.3, 0.2, 0.2, 0.15, 0.2])     # least standard deviation of each coordinate (they are logarithms)
CUTOFF = 20.515               # chi-square with 5 degrees of freedom, its quantile 0.999
MEDIAN = 4.351                # its median
INNER = 12.833                # its quantile 0.975
# How much less the nearest rows of a normal sample vary than all do: share / (chi-square with 7 degrees of freedom, at the share's quantile).
HALF_SPREAD, INNER_SPREAD = 1.912, 1.0555
BINS = 64                     # bins for each unit of a coordinate, and of the logarithm of a distance

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def text_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()          # splits at ASCII white space alone
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\v\f\r"):
            dup_lines += line in seen
            seen.add(line)
    repeats = 0
    if n > WINDOW:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        rolled = np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k:n - WINDOW + 1 + k]
        order = np.sort(rolled)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            starts = np.isin(rolled, twice)
            edge = np.zeros(n + 1, np.int64)
            edge[:len(starts)] += starts
            edge[WINDOW:WINDOW + len(starts)] -= starts
            repeats = int((np.cumsum(edge)[:n] > 0).sum())
    return n, word_chars, n_symbols, dup_lines, repeats


def statistics(text: Column) -> Column:
    names = [c.split()[0] for c in STATS.split(", ")]

    @F.pandas_udf(STATS)
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_statistics(t) for t in texts], columns=names, dtype="int64")

    return count(text)


def transformed(s: dict[str, Column]) -> list[Column]:
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    return [F.log1p(s["n_words"].cast("double")), F.log1p(s["word_chars"] / words),
            F.log1p(100 * s["n_symbols"] / F.greatest(s["word_chars"], F.lit(1))),
            F.log1p(F.lit(20) * s["n_dup_lines"] / words), F.log1p(F.lit(10) * s["n_repeat_words"] / words)]


def _group_keys(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Adds ``grp``: every row belongs to one group of at least ``MIN_GROUP`` rows, if there are so many."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    fine = cut(rows.groupBy(name(lang).alias("l"), name(source).alias("s")).agg(F.count(F.lit(1)).alias("n")), "quality-groups")
    left = F.sum(F.when(F.col("n") < MIN_GROUP, F.col("n"))).over(Window.partitionBy("l"))
    grp = (F.when(F.col("n") >= MIN_GROUP, F.concat_ws("\x1f", "l", "s"))
           .when(left >= MIN_GROUP, F.col("l")).otherwise(F.lit("")))
    named = cut(fine.withColumn("grp", grp).select(F.col("l").alias("gl"), F.col("s").alias("gs"), "grp"), "quality-names")
    return (rows.withColumns({"l": name(lang), "s": name(source)})
            .join(small_side(named), (F.col("l") == F.col("gl")) & (F.col("s") == F.col("gs"))).drop("l", "s", "gl", "gs"))


D = len(VECTOR)
PAIRS = [(i, j) for i in range(D) for j in range(i, D)]
ESTIMATE = "grp string, start int, center array<double>, inverse array<double>, logdet double"


def _square(upper: np.ndarray) -> np.ndarray:
    full = np.zeros((D, D))
    for (i, j), x in zip(PAIRS, upper):
        full[i, j] = full[j, i] = x
    return full


def _estimate(grp: str, start: int, center: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    """A coordinate that hardly varies gets its least variance."""
    cov = cov + np.diag(np.maximum(FLOOR ** 2 - np.diag(cov), 0) + 1e-9)
    return pd.DataFrame({"grp": [grp], "start": [start], "center": [center.tolist()], "inverse": [np.linalg.inv(cov).ravel().tolist()],
                         "logdet": [float(np.linalg.slogdet(cov)[1])]})


def _middles(hist: pd.DataFrame) -> pd.DataFrame:
    """Starts 0 and 1, from one group's bins of each coordinate: median and median absolute deviation;
    middle and half width of the shortest half."""
    center, spread = np.zeros((2, D)), np.zeros((2, D))
    for k in range(D):
        h = hist[hist["coordinate"] == k].sort_values("bin")
        x, n = h["bin"].to_numpy() / BINS, h["n"].to_numpy()
        upto = np.cumsum(n)
        center[0, k] = x[np.searchsorted(upto, upto[-1] / 2)]
        off = np.abs(x - center[0, k])
        order = np.argsort(off, kind="stable")
        spread[0, k] = 1.4826 * off[order][np.searchsorted(np.cumsum(n[order]), upto[-1] / 2)]
        last = np.searchsorted(upto, upto - n + upto[-1] / 2)       # from each bin on, the bin that completes a half
        fits = last < len(x)
        width = x[last[fits]] - x[fits]
        first = int(width.argmin())
        center[1, k] = x[first] + width[first] / 2
        spread[1, k] = 1.4826 * width[first] / 2
    return pd.concat([_estimate(hist["grp"].iloc[0], s, center[s], np.diag(np.maximum(spread[s], FLOOR) ** 2)) for s in (0, 1)])


def _shapes(sums: pd.DataFrame) -> pd.DataFrame:
    """Starts 2 and 3, from one group's sums over squashed and unit-length vectors around its medians."""
    r = sums.iloc[0]
    center, scale = np.array(r["center"]), np.sqrt(1 / np.diag(np.array(r["inverse"]).reshape(D, D)))
    mean = np.array(r["squashed"]) / r["n"]
    squashed = _square(np.array(r["squashed2"])) / r["n"] - np.outer(mean, mean)
    unit = D * _square(np.array(r["unit2"])) / r["n"]
    around = np.outer(scale, scale)
    return pd.concat([_estimate(r["grp"], 2, center, squashed * around), _estimate(r["grp"], 3, center, unit * around)])


def _nearest(bins: pd.DataFrame, last: int, spread: float) -> pd.DataFrame:
    """Mean and covariance of the rows in the bins up to ``last``."""
    total = bins["n"].to_numpy()[:last + 1].sum()
    first = np.stack(bins["first"].to_numpy())[:last + 1].sum(axis=0) / total
    second = np.stack(bins["second"].to_numpy())[:last + 1].sum(axis=0) / total
    return _estimate(bins["grp"].iloc[0], int(bins["start"].iloc[0]), first, spread * (_square(second) - np.outer(first, first)))


def _concentrated(bins: pd.DataFrame) -> pd.DataFrame:
    """The next estimate from the nearest half, from one group's moments by distance bin."""
    bins = bins.sort_values("bin")
    upto = np.cumsum(bins["n"].to_numpy())
    return _nearest(bins, int(np.searchsorted(upto, SHARE * upto[-1])), HALF_SPREAD)


def _scale(bins: pd.DataFrame) -> float:
    """How far the median distance lies above a normal sample's; 1 if it doesn't. ``bins`` in order."""
    upto = np.cumsum(bins["n"].to_numpy())
    return max(float(np.exp2((bins["bin"].iloc[int(np.searchsorted(upto, 0.5 * upto[-1]))] + 1) / BINS)) / MEDIAN, 1.0)


def _reweighted(bins: pd.DataFrame) -> pd.DataFrame:
    bins = bins.sort_values("bin")
    inner = int(np.searchsorted(bins["bin"].to_numpy(), np.floor(np.log2(INNER * _scale(bins)) * BINS), side="right")) - 1
    return _nearest(bins, inner, INNER_SPREAD)


def _scaled(bins: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"grp": [bins["grp"].iloc[0]], "scale": [_scale(bins.sort_values("bin"))]})


def _moments(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """(grp, start, bin): number, sum and sums of products of the vectors at each distance."""
    far = rows.select("grp", "v").join(small_side(estimates), "grp").withColumn("d2", F.greatest(_distance(), F.lit(1e-6)))
    return far.groupBy("grp", "start", F.floor(F.log2("d2") * BINS).cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[i]) for i in range(D)]).alias("first"),
        F.array(*[F.sum(F.col("v")[i] * F.col("v")[j]) for i, j in PAIRS]).alias("second"))


def _starts(rows: DataFrame) -> DataFrame:
    places = rows.select("grp", F.posexplode("v").alias("coordinate", "x"))
    hist = (places.groupBy("grp", "coordinate", F.floor(F.col("x") * BINS + 0.5).cast("long").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
    middles = cut(hist.groupBy("grp").applyInPandas(_middles, ESTIMATE), "quality-middles")
    medians = cut(middles.where("start = 0").drop("start", "logdet"), "quality-medians")
    z = rows.select("grp", "v").join(small_side(medians), "grp").select(
        "grp", "center", "inverse", *[((F.col("v")[i] - F.col("center")[i]) * F.sqrt(F.col("inverse")[i * D + i])).alias(f"z{i}") for i in range(D)])
    length = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0))
    z = z.withColumn("length2", F.greatest(length, F.lit(1e-12)))
    squashed = [F.tanh(f"z{i}") for i in range(D)]
    sums = z.groupBy("grp").agg(
        F.first("center").alias("center"), F.first("inverse").alias("inverse"), F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x) for x in squashed]).alias("squashed"), F.array(*[F.sum(squashed[i] * squashed[j]) for i, j in PAIRS]).alias("squashed2"),
        F.array(*[F.sum(F.col(f"z{i}") * F.col(f"z{j}") / F.col("length2")) for i, j in PAIRS]).alias("unit2"))
    return cut(middles.union(sums.groupBy("grp").applyInPandas(_shapes, ESTIMATE)), "quality-starts")


def least_determinant(rows: DataFrame) -> DataFrame:
    """(grp, center, inverse, scale) of each ``grp`` of vectors ``v``: the reweighted estimate."""
    first = cut(_moments(rows, _starts(rows)).groupBy("grp", "start").applyInPandas(_concentrated, ESTIMATE), "quality-step")
    names = first.columns
    now = first.withColumn("falls", F.lit(True))
    while not now.where("falls").isEmpty():          # determinants fall and have a least value, that of the least variances
        step = _moments(rows, now.where("falls")).groupBy("grp", "start").applyInPandas(_concentrated, ESTIMATE).alias("step")
        held = small_side(now.where("falls")).alias("held")
        both = step.join(held, (F.col("step.grp") == F.col("held.grp")) & (F.col("step.start") == F.col("held.start")))
        falls = F.col("step.logdet") < F.col("held.logdet") - TOLERANCE
        after = both.select(*[F.when(falls, F.col(f"step.{c}")).otherwise(F.col(f"held.{c}")).alias(c) for c in names], falls.alias("falls"))
        now = cut(now.where("not falls").union(after), "quality-step")
    settled = now.drop("falls")
    best = settled.groupBy("grp").agg(F.min(F.struct("logdet", "start", "center", "inverse")).alias("b"))
    best = cut(best.select("grp", "b.start", "b.center", "b.inverse", "b.logdet"), "quality-best")
    final = cut(_moments(rows, best).groupBy("grp").applyInPandas(_reweighted, ESTIMATE), "quality-reweighted")
    scale = cut(_moments(rows, final).select("grp", "bin", "n").groupBy("grp").applyInPandas(_scaled, "grp string, scale double"), "quality-scale")
    return cut(final.join(scale, "grp").select("grp", "center", "inverse", "scale"), "quality-estimate")


def _distance() -> Column:
    """Squared Mahalanobis distance of ``v`` from ``center``."""
    off = [F.col("v")[k] - F.col("center")[k] for k in range(D)]
    terms = [off[i] * off[j] * F.col("inverse")[i * D + j] * (1 if i == j else 2) for i, j in PAIRS]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def judge(docs: DataFrame, text: str, lang: str, source: str, payload: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``payload`` columns), the base statistics, ``base_failed``,
    ``distance`` (squared, scaled) and ``kept``."""
    ship(docs.sparkSession)
    keep = docs.select(*[col(c) for c in payload]) if payload is not None else docs
    rows = docs.select(packed(keep).alias("row"), col(lang).alias("lang"), col(source).alias("source"),
                       statistics(col(text)).alias("stats"))
    rows = rows.withColumn("v", F.array(*transformed({c.split()[0]: F.col("stats")[c.split()[0]] for c in STATS.split(", ")})))
    rows = cut(_group_keys(cut(rows, "quality-statistics"), "lang", "source"), "quality-rows")
    far = rows.join(small_side(least_determinant(rows)), "grp").withColumn("distance", _distance() / F.col("scale"))
    n, r = F.col("stats.n_words"), F.col("stats.n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)
    return (far.withColumn("base_failed", failed)
            .select("row", "stats.*", "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= CUTOFF)).alias("kept")))
