"""Hash-ordered quota selection over shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions import text as T


def stable_order(seed: int, stage: str, key: Column) -> Column:
    """The order in which shards are taken: it never depends on which are there (O3)."""
    return T.digest(F.concat_ws(":", F.lit(str(seed)), F.lit(stage), key))


def retention(counts: DataFrame, constant: float) -> DataFrame:
    """``counts`` per cell with ``retention``: of the cell, else of its lane, else a constant."""
    lane = counts.groupBy("language").agg(F.sum("emitted").alias("_e"), F.sum("unresolved").alias("_u"))
    ratio = lambda e, u: F.try_divide(F.col(e), F.col(e) + F.col(u))
    return counts.join(F.broadcast(lane), "language").withColumn("retention", F.coalesce(ratio("emitted", "unresolved"), ratio("_e", "_u"), F.lit(constant))).drop("_e", "_u")


def take_until(candidates: DataFrame, cell: list[str], need: Column, expected: Column, order: Column) -> DataFrame:
    """Candidates with ``selected``: in the stable order of a cell, those before
    which the expected rows have not reached the need. A greater need only adds
    to the selection. Candidates are shards, of which a cell has few."""
    before = Window.partitionBy(*cell).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    rows = candidates.withColumn("_order", order).withColumn("_expected", expected)
    return rows.withColumn("selected", F.coalesce(F.sum("_expected").over(before), F.lit(0.0)) < need).drop("_order", "_expected")


def cell_projection(quotas: DataFrame, kept: DataFrame, had: DataFrame, taken: DataFrame, cell: list[str]) -> DataFrame:
    """Per cell: quota, emitted, what there was before, what is projected with the shards taken, and retention."""
    more = taken.groupBy(*cell).agg(F.sum("expected").alias("_more"))
    rows = quotas.join(kept.select(*cell, "emitted", "retention"), cell, "left").join(had, cell, "left").join(more, cell, "left")
    base = F.coalesce(F.col("had").cast("double"), F.lit(0.0))
    projected = F.bround(base + F.coalesce(F.col("_more").cast("double"), F.lit(0.0))).cast("long")
    return rows.select(
        *cell, "quota", F.coalesce("emitted", F.lit(0)).alias("emitted"), F.bround(base).cast("long").alias("baseline"), projected.alias("projected"), "retention",
        F.greatest(F.lit(0), F.col("quota") - projected).alias("shortfall"),
    )


def receipt(report: DataFrame, taken: DataFrame, cell: list[str]) -> dict:
    """A selection as a document: its cells, its rows by language, the cells that fall short, and its shards. Cells and shards are few."""
    lines = [r.asDict() for r in report.orderBy(*cell).collect()]
    name = lambda line: "/".join(line[c] for c in cell)
    by_language: dict[str, int] = {}
    for line in lines:
        by_language[line["language"]] = by_language.get(line["language"], 0) + line["projected"]
    return {
        "cells": {name(line): {k: v for k, v in line.items() if k not in cell and k != "shortfall"} for line in lines}, "projected_rows": by_language,
        "shortfalls": {name(line): line["shortfall"] for line in lines if line["shortfall"] > 0}, "shard_keys": sorted(r["shard_key"] for r in taken.select("shard_key").collect()),
    }


def hold_and_release(tasks: DataFrame, selected: DataFrame, key: str = "shard_key") -> DataFrame:
    """``tasks`` with their new ``status``: pending surplus is held, held selections are released."""
    flagged = tasks.join(selected.select(key).distinct().withColumn("_in", F.lit(True)), key, "left")
    status = F.when((F.col("status") == "pending") & F.col("_in").isNull(), "held").when((F.col("status") == "held") & F.col("_in"), "pending").otherwise(F.col("status"))
    return flagged.withColumn("status", status).drop("_in").select(*tasks.columns)


def outside(done: DataFrame, selected: DataFrame, key: str = "shard_key") -> DataFrame:
    """Finished tasks that are not selected: there must be none."""
    return done.join(selected, key, "left_anti")
