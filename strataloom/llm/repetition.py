"""Problem 2: the share of repeated content inside a text.

Method: robust multivariate outliers. Each text gives a vector of transformed
statistics. Per language and source, a minimum-covariance-determinant estimate
of centre and scatter is made from several starts, and a text is rejected where its Mahalanobis
distance exceeds the cut-off on the side of more repetition. The vectors are
counted on a grid first, so that the estimate covers all texts while its input
is bounded by the grid and not by the texts. An exact check of the repeated
share may follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import asin, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.text import sentences, words
from strataloom.session import durable

#: Words of a run; a word is repeated where it lies in a run that began earlier.
RUN = 5
#: Steps of the grid to one unit of a transformed statistic.
STEPS = 40
#: Texts below which a stratum is judged by all texts of its language, and a language by all texts.
LEAST = 200
#: Share of a stratum that the estimate is made from.
CORE = 0.75
#: Chi-square with 4 degrees of freedom at CORE, and at 0.975, within which a vector has weight.
AT_CORE, WEIGHTED = 5.385, 11.143
#: Fixed value: a normal law's scatter to that of its part within WEIGHTED.
WITHIN = 1.0646
#: Squared distance beyond which a vector is rejected: chi-square with 4 degrees of freedom at 0.995.
CUTOFF = 14.86
#: Random starts of the search besides the one from the medians, and those followed to the end.
STARTS, FOLLOWED = 24, 4

NAMES = ["repeated", "sentences", "phrases", "types"]
STATISTICS = "words int, share double, " + ", ".join(f"{n} double" for n in NAMES)


def repeated_words(tokens: list[str], run: int = RUN) -> int:
    """Words that lie in a run of ``run`` words that already began earlier."""
    seen: set[tuple[str, ...]] = set()
    marked, upto = 0, 0
    for i, gram in enumerate(zip(*(tokens[k:] for k in range(run)))):
        if gram in seen:
            marked += i + run - max(i, upto)
            upto = i + run
        else:
            seen.add(gram)
    return marked


def statistics_of(text: str | None) -> tuple:
    """(words, repeated share, four transformed statistics) of a text; zeros where there are no words.

    Shares are transformed to arcs, whose variance hardly depends on the share.
    """
    said = [s for s in (words(s) for s in sentences(text)) if s]
    tokens = [w for s in said for w in s]
    n = len(tokens)
    if not n:
        return 0, 0.0, 0.0, 0.0, 0.0, 0.0
    # a text without a run that comes twice, as most are, is told by the number of its different runs
    runs = n - RUN + 1
    repeated = repeated_words(tokens) if runs > 1 and len(set(zip(*(tokens[k:] for k in range(RUN))))) < runs else 0
    twice = len(said) - len(set(map(tuple, said)))
    threes = max(0, n - 2)
    again = threes - len(set(zip(tokens, tokens[1:], tokens[2:])))
    arc = lambda part, whole: asin(sqrt((part + 0.375) / (whole + 0.75)))
    return n, repeated / n, arc(repeated, n), arc(twice, len(said)), arc(again, threes), log(len(set(tokens)) / n**0.8)


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with the columns of ``STATISTICS``."""

    @F.pandas_udf(STATISTICS)
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([statistics_of(t) for t in batch], columns=["words", "share", *NAMES])

    return df.withColumn("_s", measure(F.col(text))).drop(text).select("*", "_s.*").drop("_s")


def _distances(points: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    away = points - centre
    return np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter), away)


def _moments(points: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean and scatter, with a ridge of half a grid step where a statistic is constant."""
    centre = np.average(points, axis=0, weights=weights)
    away = points - centre
    return centre, (away * weights[:, None]).T @ away / weights.sum() + np.eye(points.shape[1]) / (2 * STEPS) ** 2


def _step(points: np.ndarray, weights: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A concentration step: the moments of the nearest ``CORE`` of all weight. It never enlarges the determinant."""
    by = np.argsort(_distances(points, centre, scatter), kind="stable")
    before = np.cumsum(weights[by]) - weights[by]
    kept = np.clip(CORE * weights.sum() - before, 0, weights[by])
    return _moments(points[by][kept > 0], kept[kept > 0])


def core_estimate(points: np.ndarray, weights: np.ndarray, starts: int = STARTS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of weighted points by the fast minimum covariance determinant.

    Starts are the medians and ``starts`` random sets of five points; each takes two
    concentration steps, the ``FOLLOWED`` least determinants go on until nothing
    changes, and the least of them is taken. It is scaled to the normal law at
    ``CORE`` and then re-estimated from all points within ``WEIGHTED`` of it.
    """
    order = np.argsort(points, axis=0, kind="stable")
    middle = np.array([points[o, j][np.searchsorted(np.cumsum(weights[o]), weights.sum() / 2)] for j, o in enumerate(order.T)])
    spread = np.array([max(1 / STEPS, np.average(np.abs(points[:, j] - middle[j]), weights=weights)) for j in range(points.shape[1])])
    random, tried = np.random.default_rng(seed), [(middle, np.diag(spread**2))]
    for _ in range(starts):
        some = random.choice(len(points), points.shape[1] + 1, p=weights / weights.sum())
        tried.append(_moments(points[some], np.ones(len(some))))
    tried = [_step(points, weights, *_step(points, weights, *start)) for start in tried]
    best = None
    for centre, scatter in sorted(tried, key=lambda t: np.linalg.slogdet(t[1])[1])[:FOLLOWED]:
        size = np.linalg.slogdet(scatter)[1]
        for _ in range(100):
            centre, scatter = _step(points, weights, centre, scatter)
            now = np.linalg.slogdet(scatter)[1]
            if now >= size - 1e-12:
                break
            size = now
        if best is None or size < best[0]:
            best = (size, centre, scatter)
    _, centre, scatter = best
    distance = _distances(points, centre, scatter)
    by = np.argsort(distance, kind="stable")
    scatter = scatter * max(1.0, distance[by][np.searchsorted(np.cumsum(weights[by]), CORE * weights.sum())] / AT_CORE)
    inside = _distances(points, centre, scatter) <= WEIGHTED
    centre, scatter = _moments(points[inside], weights[inside])
    return centre, scatter * WITHIN


def estimates(stats: DataFrame) -> DataFrame:
    """Per ``stratum``: ``centre`` and ``inverse`` of its core, from counts on the grid."""
    grid = [F.round(F.col(n) * STEPS).cast("int").alias(n) for n in NAMES]
    cells = stats.where("words > 0").groupBy("stratum", *grid).agg(F.count("*").alias("texts"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        centre, scatter = core_estimate(part[NAMES].to_numpy(float) / STEPS, part["texts"].to_numpy(float))
        return pd.DataFrame({"stratum": [part["stratum"].iloc[0]], "centre": [centre.tolist()], "inverse": [np.linalg.inv(scatter).ravel().tolist()]})

    return cells.groupBy("stratum").applyInPandas(fit, "stratum string, centre array<double>, inverse array<double>")


def repetition(df: DataFrame, key: str, text: str, language: Column, source: Column) -> DataFrame:
    """``key, words, share, distance, rejected`` of every record.

    ``share`` is the share of words in a run of five that began earlier.
    Null languages and sources are strata of their own. Rows with the same key
    count once. Null and empty texts have no words, share 0, distance 0 and are
    not rejected. An empty table gives no rows.
    """
    rows = df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), F.coalesce(language, F.lit("?")).alias("lang"), F.coalesce(source, F.lit("?")).alias("source"), F.col(f"`{text}`").alias("text"))
    # repeated rows of a key are alike; the digest keeps the shuffle free of texts
    stats = durable(statistics(rows).groupBy("key").agg(*(F.min(F.struct("words", "share", *NAMES, "lang", "source")).alias("of"),)).select("key", "of.*"))
    sizes = stats.groupBy("lang", "source").count()
    by_language = sizes.groupBy("lang").agg(F.sum("count").alias("of_lang"))
    strata = sizes.join(by_language, "lang").select(
        "lang", "source",
        F.when(F.col("count") >= LEAST, F.concat_ws("\x1f", F.lit("s"), "lang", "source")).when(F.col("of_lang") >= LEAST, F.concat_ws("\x1f", F.lit("l"), "lang")).otherwise("all").alias("stratum"),
    )
    stats = stats.join(strata, ["lang", "source"])
    # a language with small sources is estimated from all its texts, and so are all languages together
    whole = stats.where(F.col("stratum").startswith("s\x1f")).withColumn("stratum", F.concat_ws("\x1f", F.lit("l"), "lang")).join(strata.select("stratum").distinct(), "stratum", "left_semi")
    levels = stats.unionByName(whole).unionByName(stats.where("stratum <> 'all'").withColumn("stratum", F.lit("all")))
    fitted = estimates(levels)
    away = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NAMES)]
    square = sum((away[i] * F.col("inverse")[i * 4 + j] * away[j] for i in range(4) for j in range(4)), F.lit(0.0))
    out = stats.join(fitted, "stratum", "left").withColumn("distance", F.when(F.col("words") > 0, F.sqrt(F.greatest(square, F.lit(0.0)))).otherwise(0.0))
    more = away[0] > 0
    return out.select(F.col("key").alias(key), "words", "share", "distance", ((F.col("distance") > float(np.sqrt(CUTOFF))) & more & (F.col("words") > 0)).alias("rejected"))
