"""Finalisation: top rows per cell and reports on four levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions import text as T


def flagged(rows: DataFrame, cell: list[str], quotas: DataFrame, key: str = "id", bits: int = 12) -> DataFrame:
    """``rows`` of cells with a quota, with ``chosen``: the rows that ``top_of_cells`` takes.

    Read it once for all reports; ``rows`` itself is read three times, so it
    should be a table or a checkpoint.
    """
    drawn = rows.withColumn("_digest", T.digest(F.col(key))).withColumn("_group", F.substring("_digest", 1, bits // 4))
    counts = drawn.groupBy(*cell, "_group").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*cell).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most 2 ** bits groups a cell of the grid
    groups = counts.withColumn("_before", before).join(F.broadcast(quotas.select(*cell, "quota")), cell)
    placed = drawn.join(groups, [*cell, "_group"])
    cut = (F.col("_before") < F.col("quota")) & (F.col("_before") + F.col("_n") > F.col("quota"))
    rank = F.row_number().over(Window.partitionBy(*cell, "_group").orderBy("_digest", key))
    some = placed.where(cut).withColumn("chosen", F.col("_before") + rank <= F.col("quota"))
    return placed.where(~cut).withColumn("chosen", F.col("_before") < F.col("quota")).unionByName(some).select(*rows.columns, "chosen")


def top_of_cells(rows: DataFrame, cell: list[str], quotas: DataFrame, key: str = "id", bits: int = 12, retain: bool = False) -> DataFrame:
    """The ``quota`` rows of each cell with the least digest of their key.

    Counts by the leading bits of the digests tell which are taken whole; only
    the one group per cell that the quota cuts is ranked, so a cell of any size
    is no single task. Rows of cells without a quota are left out.
    """
    if retain:
        return rows.join(F.broadcast(quotas.select(*cell)), cell, "left_semi")
    drawn = rows.withColumn("_digest", T.digest(F.col(key))).withColumn("_group", F.substring("_digest", 1, bits // 4))
    counts = drawn.groupBy(*cell, "_group").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*cell).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = counts.withColumn("_before", before).join(F.broadcast(quotas.select(*cell, "quota")), cell).where("_before < quota")
    taken = drawn.join(groups, [*cell, "_group"])
    rank = F.row_number().over(Window.partitionBy(*cell, "_group").orderBy("_digest", key))
    cut = taken.where("_before + _n > quota").withColumn("_rank", rank).where("_before + _rank <= quota").drop("_rank")
    return taken.where("_before + _n <= quota").unionByName(cut).select(*rows.columns)


def flagged_report(rows: DataFrame, quotas: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The report of ``cell_report`` from rows with ``chosen``, in one pass."""
    cell = ["language", "complexity", "band"]
    got = rows.groupBy(*cell).agg(F.count("*").alias("available"), F.count_if("chosen").alias("rows"), F.sum(F.when(F.col("chosen"), F.col(tokens))).alias("tokens"))
    out = quotas.withColumnRenamed("quota", "target").join(got, cell, "left").na.fill(0, ["available", "rows", "tokens"])
    return out.select(*cell, "available", "rows", "tokens", "target", F.greatest(F.col("rows") - F.col("target"), F.lit(0)).alias("surplus"), F.greatest(F.col("target") - F.col("rows"), F.lit(0)).alias("shortfall"))


def cell_report(available: DataFrame, chosen: DataFrame, quotas: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Per cell of the grid: rows available and chosen, tokens, target, surplus and shortfall (A10)."""
    cell = ["language", "complexity", "band"]
    have = available.groupBy(*cell).agg(F.count("*").alias("available"))
    got = chosen.groupBy(*cell).agg(F.count("*").alias("rows"), F.sum(tokens).alias("tokens"))
    out = quotas.withColumnRenamed("quota", "target").join(have, cell, "left").join(got, cell, "left").na.fill(0, ["available", "rows", "tokens"])
    return out.select(*cell, "available", "rows", "tokens", "target", F.greatest(F.col("rows") - F.col("target"), F.lit(0)).alias("surplus"), F.greatest(F.col("target") - F.col("rows"), F.lit(0)).alias("shortfall"))


def band_report(cells: DataFrame) -> DataFrame:
    """Per language and band: sums of the cells, surplus and shortfall already clipped there."""
    return cells.groupBy("language", "band").agg(*(F.sum(c).alias(c) for c in ("available", "rows", "tokens", "target", "surplus", "shortfall")))


def lane_report(cells: DataFrame) -> DataFrame:
    """Per language: rows, tokens and target, surplus and shortfall clipped at this level."""
    sums = cells.groupBy("language").agg(*(F.sum(c).alias(c) for c in ("rows", "tokens", "target")))
    return sums.withColumn("surplus", F.greatest(F.col("rows") - F.col("target"), F.lit(0))).withColumn("shortfall", F.greatest(F.col("target") - F.col("rows"), F.lit(0)))


def gate_counts(rows: DataFrame, accepted: Column, dimensions: dict[str, Column]) -> DataFrame:
    """Accepted and rejected rows by each value of each dimension, in one pass."""
    sides = F.array(*(F.struct(F.lit(name).alias("dimension"), F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for name, value in dimensions.items()))
    flat = rows.select(F.coalesce(accepted, F.lit(False)).alias("_ok"), F.explode(sides).alias("_d")).select("_ok", "_d.*")
    return flat.groupBy("dimension", "value").agg(F.count_if("_ok").alias("accepted"), F.count_if(~F.col("_ok")).alias("rejected"))


def require_targets(cells: DataFrame) -> None:
    """Raise where a cell falls short."""
    if cells.where("shortfall > 0").limit(1).count():
        raise ValueError("cells fall short of their targets")
