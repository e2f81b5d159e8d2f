"""Workload planning: apportionment, cell quotas, shards and assignment."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions import text as T


def apportion(df: DataFrame, scope: list[str], key: str, total: Column, share: Column, into: str = "quota") -> DataFrame:
    """Largest-remainder apportionment of ``total`` within ``scope``; ties go to the greatest key.

    The input is a grid of cells, not data.
    """
    raw = df.withColumn("_raw", total * share).withColumn("_base", F.floor("_raw")).withColumn("_total", total)
    scope_window = Window.partitionBy(*scope)
    rank = F.row_number().over(scope_window.orderBy(F.desc(F.col("_raw") - F.col("_base")), F.desc(key)))
    left = F.col("_total") - F.sum("_base").over(scope_window)
    return raw.withColumn("_rank", rank).withColumn("_left", left).withColumn(into, (F.col("_base") + (F.col("_rank") <= F.col("_left")).cast("long")).cast("long")).drop("_raw", "_base", "_total", "_rank", "_left")


def cell_quotas(lanes: DataFrame, complexities: DataFrame, bands: DataFrame, factor: float = 1.0) -> DataFrame:
    """Quotas of lane x complexity x band: the target of a lane, times ``factor``
    and rounded up, is apportioned to complexities and those to bands (G2)."""
    grid = lanes.select("language", F.ceil(F.col("target") * factor).cast("long").alias("lane_target")).crossJoin(F.broadcast(complexities.select("complexity", F.col("share").alias("complexity_share"))))
    grid = apportion(grid, ["language"], "complexity", F.col("lane_target"), F.col("complexity_share"), "complexity_target")
    grid = grid.crossJoin(F.broadcast(bands.select(F.col("length_band").alias("band"), F.col("share").alias("band_share"))))
    return apportion(grid, ["language", "complexity"], "band", F.col("complexity_target"), F.col("band_share")).select("language", "complexity", "band", "quota")


def shard_plan(quotas: DataFrame, size: int) -> DataFrame:
    """Shards of at most ``size`` rows per cell, their keys, and the running
    offset of each within its lane (W6, W8, N8)."""
    shards = quotas.where("quota > 0").withColumn("shard", F.explode(F.expr(f"sequence(0L, (quota - 1) div {size}L)")))
    shards = shards.withColumn("rows", F.least(F.lit(size).cast("long"), F.col("quota") - F.col("shard") * size))
    shards = shards.withColumn("shard_key", F.format_string("%s-%s-%s-%06d", "language", "complexity", "band", "shard"))
    before = Window.partitionBy("language").orderBy("complexity", "band", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard_key", "language", "complexity", "band", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("assignment_start"))


def shard_seeds(count: int, seed: int) -> list[int]:
    """Seeds of ``count`` shards in plan order, from one stream below 2^63."""
    stream = random.Random(seed)
    return [stream.randrange(2**63) for _ in range(count)]


def row_ids(shard: Column, index: Column, seed: Column) -> Column:
    """Stable identifiers of planned rows."""
    return T.uuid5_url(F.concat_ws(":", F.lit("strataloom"), shard, index.cast("string"), seed.cast("string")))


def stride(n: int, start: int) -> int:
    """The first number from ``start`` that has no common divisor with ``n``."""
    step = max(1, start)
    while math.gcd(step, n) != 1:
        step += 1
    return step


def assigner(topics: DataFrame, modes: DataFrame, people: int, seed: int, language: str) -> tuple[DataFrame, DataFrame, int, int]:
    """(topics, modes, offset, step) of a language: catalogues in an order shuffled by the seed, with their ``position``,
    and where persona positions begin and how far they step (G3). Catalogues are small; people must be at least one."""
    if people < 1:
        raise ValueError(f"there are no personas for {language}")
    stream, out = random.Random(f"{seed}:{language}:catalog"), []
    for frame, order in ((topics, ["domain", "id"]), (modes, ["id"])):
        some = frame.orderBy(*order).collect()
        stream.shuffle(some)
        out.append(frame.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(some)], "position long, " + ", ".join(f"`{n}` {k}" for n, k in frame.dtypes)))
    step = 1 + 2 * (seed % max(1, people // 2))
    while math.gcd(step, people) != 1:
        step += 2
    return *out, seed % people, step


def assign(rows: DataFrame, index: Column, topics: DataFrame, modes: DataFrame, personas: DataFrame, n_topics: int, n_modes: int, n_personas: int | Column, offset: int, step: int | Column, language: str | None = None) -> DataFrame:
    """Rows with topic, mode and persona by modular positions.

    ``topics`` and ``modes`` are catalogues with a ``position``; personas are
    joined by position, and by ``language`` where that column is given, and never
    collected; their number and step may be columns then. Every topic comes before one
    repeats, every mode comes with every topic, and personas repeat last.
    """
    at = rows.withColumn("_i", index.cast("long"))
    people, by = n_personas if isinstance(n_personas, Column) else F.lit(n_personas), step if isinstance(step, Column) else F.lit(step)
    at = at.withColumn("_topic", F.pmod("_i", F.lit(n_topics))).withColumn("_mode", F.pmod(F.col("_i") + F.floor(F.col("_i") / n_topics), F.lit(n_modes))).withColumn("_persona", F.pmod(F.lit(offset) + F.col("_i") * by, people))
    topic = F.broadcast(topics.select(F.col("position").alias("_topic"), F.col("id").alias("topic_id"), F.col("domain").alias("topic_domain")))
    mode = F.broadcast(modes.select(F.col("position").alias("_mode"), F.col("id").alias("interaction_mode")))
    keys = ["_persona", language] if language else ["_persona"]
    persona = personas.select(F.col("position").cast("long").alias("_persona"), F.col("source_id").alias("persona_source_id"), *([F.col("language").alias(language)] if language else []))
    return at.join(topic, "_topic", "left").join(mode, "_mode", "left").join(persona, keys, "left").drop("_i", "_topic", "_mode", "_persona")
