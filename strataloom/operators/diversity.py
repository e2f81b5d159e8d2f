"""Diversity measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions import text as T
from strataloom.session import durable


def frequencies(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """Rows of each value."""
    return df.groupBy(*by, value.alias("value")).agg(F.count("*").alias("n"))


def entropy(counts: DataFrame, by: list[str]) -> DataFrame:
    """Shannon entropy of the counts over that of equal counts; 0 below two values."""
    total = counts.groupBy(*by).agg(F.sum("n").alias("_total"), F.count("*").alias("values"))
    p = F.col("n") / F.col("_total")
    sums = counts.join(total, by).groupBy(*by, "values").agg((-F.sum(p * F.ln(p))).alias("_h"))
    return sums.select(*by, "values", F.when(F.col("values") > 1, F.col("_h") / F.ln("values")).otherwise(0.0).alias("entropy"))


def top_values(counts: DataFrame, by: list[str], k: int = 10) -> DataFrame:
    """The k most frequent values, ties to the least; each partition keeps k before the exchange."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def hash_sample(df: DataFrame, by: list[str], key: str, tag: str, k: int = 100) -> DataFrame:
    """The k rows of each group with the least tagged digest."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_digest", key))
    return df.withColumn("_digest", T.digest(F.concat_ws(":", F.lit(tag), F.col(key)))).withColumn("sample_rank", rank).where(F.col("sample_rank") <= k).drop("_digest")


def char_grams(text: Column, least: int = 3, most: int = 5) -> Column:
    """Character runs inside words padded by blanks, with repeats."""
    padded = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(\S+)"), 1), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def runs_of(n: int):
        none = F.array().cast("array<string>")

        def of(word: Column) -> Column:
            runs = F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, F.lit(n)))
            return F.when(F.length(word) >= n, runs).otherwise(F.array(word) if n == least else none)

        return F.flatten(F.transform(padded, of))

    runs = [runs_of(n) for n in range(least, most + 1)]
    return F.concat(*runs)


def tfidf_pairs(sample: DataFrame, by: list[str], key: str, text: str, least: float) -> DataFrame:
    """Pairs ``a < b`` of a sample with cosine similarity of at least ``least``.

    Smoothed inverse document frequencies and unit lengths; the join goes over
    shared runs of a bounded sample.
    """
    terms = sample.select(*by, key, F.explode(char_grams(F.col(text))).alias("gram")).groupBy(*by, key, "gram").agg(F.count("*").alias("tf"))
    sizes = sample.groupBy(*by).agg(F.count("*").alias("docs"))
    df = terms.groupBy(*by, "gram").agg(F.count("*").alias("df"))
    weighted = terms.join(df, [*by, "gram"]).join(sizes, by).select(*by, key, "gram", (F.col("tf") * (F.ln((1 + F.col("docs")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = weighted.groupBy(*by, key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = weighted.join(norm, [*by, key]).select(*by, key, "gram", (F.col("w") / F.col("norm")).alias("w"))
    left, right = unit.alias("l"), unit.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in [*by, "gram"]]
    joined = left.join(right, [*same, F.col(f"l.{key}") < F.col(f"r.{key}")])
    sums = joined.groupBy(*(F.col(f"l.{c}").alias(c) for c in by), F.col(f"l.{key}").alias("a"), F.col(f"r.{key}").alias("b")).agg(F.sum(F.col("l.w") * F.col("r.w")).alias("similarity"))
    return sums.where(F.col("similarity") >= least)


def neighbours(pairs: DataFrame, by: list[str], thresholds: list[float]) -> DataFrame:
    """Pairs and distinct rows with a neighbour at each threshold."""
    levels = pairs.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).where("similarity >= threshold")
    ends = levels.select(*by, "threshold", F.explode(F.array("a", "b")).alias("end"))
    return levels.groupBy(*by, "threshold").agg(F.count("*").alias("pairs")).join(ends.groupBy(*by, "threshold").agg(F.count_distinct("end").alias("rows")), [*by, "threshold"])


def lane_report(rows: DataFrame, k: int = 100, thresholds: tuple[float, ...] = (0.65, 0.75, 0.85)) -> tuple[DataFrame, DataFrame]:
    """(report, sample): a line a lane with the variety of its rows, and the sample its texts are compared in.

    ``rows`` has ``id, lane, text`` and a struct ``diversity``. The report has rows,
    different values and entropy of topics, domains and modes, personas and the
    most uses of one, the most frequent openings of the sample, and for each
    threshold the pairs of its rows that are alike and the rows with such a neighbour.
    """
    named = rows.select("lane", *(F.coalesce(F.col(f"diversity.{c}"), F.lit("")).alias(n) for n, c in (("topic", "topic_id"), ("domain", "topic_domain"), ("mode", "interaction_mode"), ("persona", "persona_source_id"))))
    report = named.groupBy("lane").agg(F.count("*").alias("rows"))
    for name in ("topic", "domain", "mode"):
        of = entropy(frequencies(named, ["lane"], F.col(name)), ["lane"])
        report = report.join(of.select("lane", F.col("values").alias(f"{name}s"), F.round("entropy", 9).alias(f"{name}_entropy")), "lane", "left")
    people = frequencies(named, ["lane"], F.col("persona")).groupBy("lane").agg(F.count("*").alias("personas"), F.max("n").alias("most_uses"))
    report = report.join(people, "lane", "left")
    # drawn from the keys; only the sample's texts travel
    drawn = hash_sample(rows.select("id", "lane"), ["lane"], "id", "lane-report", k)
    sample = durable(rows.join(F.broadcast(drawn.select("id", "lane")), ["id", "lane"]).select("id", "lane", "diversity", "text"))
    tops = top_values(frequencies(sample, ["lane"], T.opening(F.col("text"))), ["lane"])
    report = report.join(tops.groupBy("lane").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda t: t["value"]).alias("openings")), "lane", "left")
    near = neighbours(durable(tfidf_pairs(sample, ["lane"], "id", "text", min(thresholds))), ["lane"], list(thresholds))
    for threshold in thresholds:
        mine = near.where(F.col("threshold") == threshold).select("lane", F.col("pairs").alias(f"near_pairs_{int(threshold * 100)}"), F.col("rows").alias(f"near_rows_{int(threshold * 100)}"))
        report = report.join(mine, "lane", "left")
    return report.na.fill(0), sample


def gate(report: dict[str, float]) -> None:
    """Raise where a lane is not diverse enough."""
    if report["topics"] < 130 or report["modes"] != 20 or min(report["topic_entropy"], report["mode_entropy"]) < 0.99 or report["near_rows"] > 10:
        raise ValueError(f"the diversity gate is closed: {report}")
