"""The task ledger as DataFrame transitions.

A ledger has the columns of ``SCHEMA`` and one row per (phase, shard_key). Every
transition gives a new snapshot, which the caller publishes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "id long, phase string, shard_key string, payload string, status string, attempts int, worker string, claimed_at double, finished_at double, error string"


def _with(tasks: DataFrame, where: Column, **changes: Column) -> DataFrame:
    return tasks.select(*(F.when(where, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in tasks.columns))


def enqueue(tasks: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` (phase, shard_key, payload) as pending tasks where there are none yet, numbered after the last."""
    keys = ["phase", "shard_key"]
    fresh = new.groupBy(*keys).agg(F.min("payload").alias("payload")).join(tasks.select(*keys), keys, "left_anti")
    last = tasks.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    from pyspark.sql import Window

    numbered = fresh.crossJoin(F.broadcast(last)).withColumn("id", F.col("_last") + F.row_number().over(Window.orderBy(*keys)))
    none = F.lit(None)
    return numbered.select("id", *keys, "payload", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), none.cast("string").alias("worker"), none.cast("double").alias("claimed_at"), none.cast("double").alias("finished_at"), none.cast("string").alias("error"))


def next_pending(tasks: DataFrame, phase: str) -> DataFrame:
    """The pending task of a phase with the least number."""
    return tasks.where((F.col("phase") == phase) & (F.col("status") == "pending")).orderBy("id").limit(1)


def claim(tasks: DataFrame, id_: int, worker: str, now: float) -> DataFrame:
    """The snapshot in which a worker runs a pending task."""
    return _with(tasks, (F.col("id") == id_) & (F.col("status") == "pending"), status=F.lit("running"), attempts=F.col("attempts") + 1, worker=F.lit(worker), claimed_at=F.lit(now))


def finish(tasks: DataFrame, id_: int, now: float) -> DataFrame:
    """The snapshot in which a task is done."""
    return _with(tasks, F.col("id") == id_, status=F.lit("done"), finished_at=F.lit(now), error=F.lit(None).cast("string"))


def fail(tasks: DataFrame, id_: int, error: str, most: int) -> DataFrame:
    """The snapshot in which a task waits again, or has failed after ``most`` attempts; the error keeps its last 4,000 characters."""
    return _with(tasks, F.col("id") == id_, status=F.when(F.col("attempts") < most, "pending").otherwise("failed"), error=F.lit(error[-4000:]))


def reset_stale(tasks: DataFrame, now: Column, age: float) -> DataFrame:
    """The snapshot in which tasks running for longer than ``age`` seconds wait again."""
    return _with(tasks, (F.col("status") == "running") & (F.col("claimed_at") < now - age), status=F.lit("pending"), worker=F.lit(None).cast("string"), claimed_at=F.lit(None).cast("double"))


def reset_failed(tasks: DataFrame, phase: str | None = None) -> DataFrame:
    """The snapshot in which failed tasks wait again with no attempts."""
    where = F.col("status") == "failed"
    return _with(tasks, where if phase is None else where & (F.col("phase") == phase), status=F.lit("pending"), attempts=F.lit(0), error=F.lit(None).cast("string"))


def status_counts(tasks: DataFrame) -> DataFrame:
    """Tasks by phase and status."""
    return tasks.groupBy("phase", "status").agg(F.count("*").alias("tasks"))
