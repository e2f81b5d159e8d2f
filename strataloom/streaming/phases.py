"""Streaming: arriving shards, gates and stateful dedup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import text as T


def advance(spark: SparkSession, folder: str, schema: str, checkpoint: str, publish: Callable[[DataFrame, int], None], shard: str | None = None, glob: str = "*.jsonl") -> None:
    """Hand the shards that arrived in a phase folder since the last call to ``publish``.

    A shard is named by its file, or by the column ``shard``. The checkpoint makes
    it idempotent: a shard is handed over once per successful batch.
    """
    rows = spark.readStream.schema(schema).option("pathGlobFilter", glob).json(folder)
    shards = rows.select(F.col(shard).alias("shard_key") if shard else F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1).alias("shard_key"))

    def batch(df: DataFrame, number: int) -> None:
        publish(df.groupBy("shard_key").agg(F.count("*").alias("rows")), number)

    shards.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(stream: DataFrame, text: str, at: str, late: str = "1 hour") -> DataFrame:
    """The first row of every normalised text within the watermark."""
    named = stream.withColumn("digest", T.digest(T.folded(F.col(text)))).withWatermark(at, late)
    return named.dropDuplicatesWithinWatermark(["digest"])


def windows(stream: DataFrame, at: str, by: list[str], length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows by event-time window and group."""
    return stream.withWatermark(at, late).groupBy(F.window(at, length).alias("window"), *by).agg(F.count("*").alias("rows"))


def thresholds_reached(counts: DataFrame, targets: dict[str, int], fraction: float) -> bool:
    """Whether every language has ceil(target x fraction) rows."""
    import math

    have = {r["language"]: r["rows"] for r in counts.groupBy("language").agg(F.sum("rows").alias("rows")).collect()}
    return all(have.get(language, 0) >= math.ceil(target * fraction) for language, target in targets.items())
