"""Problem 9: a mix of sources with target shares of the total size.

Method: balanced sampling by the cube method. Every record of a source starts
with the same fractional inclusion probability. Blocks of records move their
probabilities along the null-space of the balancing constraints, token total
and number of records, until all but two of a block are 0 or 1. What is left
over moves on, block by block again, until the few records of one landing
problem per source remain, which is solved by enumeration.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import durable

#: Records whose probabilities move together.
BLOCK = 2000
_NEAR = 1e-9


def flight(sizes: np.ndarray, chances: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all but two at most are 0 or 1, while the
    sum of probabilities and the expected size keep their values."""
    out = chances.astype(float).copy()
    active = [i for i in range(len(out)) if _NEAR < out[i] < 1 - _NEAR]
    window, rest = active[:3], active[:2:-1]
    draws = random.random(len(active) + 1)
    turn = 0
    while len(window) == 3:
        a, b, c = window
        # the null-space of the two constraints on three records
        u = np.array([sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]], float)
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])
        p = out[window]
        up = min((1 - p[k]) / u[k] if u[k] > 0 else -p[k] / u[k] for k in range(3) if u[k])
        down = min(p[k] / u[k] if u[k] > 0 else (p[k] - 1) / u[k] for k in range(3) if u[k])
        p = p + up * u if draws[turn] * (up + down) < down else p - down * u
        turn += 1
        for k, i in enumerate(window):
            out[i] = 0.0 if p[k] < _NEAR else 1.0 if p[k] > 1 - _NEAR else p[k]
        window = [i for i in window if 0 < out[i] < 1]
        while len(window) < 3 and rest:
            window.append(rest.pop())
    return out


def landing(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """The 0/1 choice of the few records left whose size and number are nearest to the expected ones.

    Both differences count in records: sizes are measured by the mean size of those left.
    """
    out = np.round(chances)
    left = np.flatnonzero((chances > _NEAR) & (chances < 1 - _NEAR))
    wanted, number = float(sizes[left] @ chances[left]), float(chances[left].sum())
    mean = float(sizes[left].mean()) if len(left) else 1.0

    def away(bits: int) -> tuple[float, int]:
        size = sum(float(sizes[i]) for k, i in enumerate(left) if bits >> k & 1)
        return abs(size - wanted) / mean + abs(bits.bit_count() - number), bits

    best = min(range(1 << len(left)), key=away)
    for k, i in enumerate(left):
        out[i] = best >> k & 1
    return out


def plan(counts: DataFrame, targets: DataFrame, fraction: float) -> DataFrame:
    """Per source of ``targets``: wanted and present tokens, and what each record is used.

    Sources without records have none.
    """
    present = counts.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("present"), F.count("*").alias("records"))
    total = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens"))
    out = targets.join(present, "source", "left").crossJoin(F.broadcast(total)).na.fill(0, ["present", "records"])
    wanted = F.col("target_share") * fraction * F.col("all_tokens")
    out = out.withColumn("wanted", wanted)
    uses = F.when(F.col("present") > 0, F.least(F.col("wanted") / F.col("present"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return out.withColumn("uses", uses)


def exact_fraction(counts: DataFrame, targets: DataFrame, fraction: float) -> float:
    """The largest fraction, at most ``fraction``, at which no source falls short, so that all shares are met."""
    ratio = plan(counts, targets, fraction).where("wanted > 0").agg(F.min(F.col("present") * F.col("max_repeats") / F.col("wanted"))).first()[0]
    return fraction * min(1.0, 1.0 if ratio is None else ratio)


def mix(counts: DataFrame, targets: DataFrame, fraction: float, key: str = "doc_id", seed: int = 1, block: int = BLOCK, exact_shares: bool = False) -> tuple[DataFrame, DataFrame]:
    """(copies, report) of the mix.

    ``counts`` has ``key``, ``source`` and ``tokens``, a row per record;
    ``targets`` has ``source``, ``target_share`` and ``max_repeats``. ``copies``
    has ``key, source, tokens, copies`` of every record in the mix. ``report`` has
    a row per target: tokens wanted, present and used, the actual share of the
    mix and of all tokens wanted, and whether the source is short: whether all its
    records are drawn as often as allowed and give fewer tokens than wanted. What
    short sources lack makes the mix smaller, and so the shares of others larger;
    ``exact_shares`` takes the mix so small that every share is met. Records of
    other sources, without a source or without tokens are not used. Empty tables
    give empty copies.
    """
    kind = dict(counts.dtypes)[key]
    if exact_shares:
        fraction = exact_fraction(counts, targets, fraction)
    sources = durable(plan(counts, targets, fraction))
    rows = counts.where("tokens > 0").join(F.broadcast(sources.select("source", "uses", "records")), "source")
    whole = F.floor(F.col("uses") + 1e-12)
    rows = rows.select(key, "source", "tokens", whole.cast("int").alias("whole"), F.greatest(F.col("uses") - whole, F.lit(0.0)).alias("chance"), F.col("records").alias("of"))

    def move(last: bool, level: int):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(key, kind="stable").reset_index(drop=True)
            sizes, chances = part["tokens"].to_numpy(float), part["chance"].to_numpy(float)
            moved = flight(sizes, chances, np.random.default_rng([seed, level, int(part["at"].iloc[0]), *str(part["source"].iloc[0]).encode()]))
            return part.assign(chance=landing(sizes, moved) if last else moved)[[key, "source", "tokens", "whole", "chance"]]

        return run

    schema = f"`{key}` {kind}, source string, tokens long, whole int, chance double"
    settled, open_, level = [], rows, 0
    while True:
        # records to a block by a hash, so that a source of any size is many blocks
        blocks = F.greatest(F.lit(1), F.ceil(F.col("of") / block)).cast("long")
        placed = open_.withColumn("at", F.pmod(F.xxhash64(key, F.lit(level)), blocks))
        largest = open_.agg(F.max("of")).first()[0] or 0
        last = largest <= block
        moved = durable(placed.groupBy("source", "at").applyInPandas(move(last, level), schema))
        settled.append(moved.where((F.col("chance") <= _NEAR) | (F.col("chance") >= 1 - _NEAR)))
        if last:
            break
        open_ = moved.where((F.col("chance") > _NEAR) & (F.col("chance") < 1 - _NEAR))
        open_ = open_.join(F.broadcast(open_.groupBy("source").agg(F.count("*").alias("of"))), "source")
        level += 1
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    copies = done.select(key, "source", "tokens", (F.col("whole") + F.round("chance").cast("int")).alias("copies")).where("copies > 0")
    used = copies.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.sum("copies").cast("long").alias("records_used"))
    sum_ = copies.agg(F.sum(F.col("tokens") * F.col("copies")).alias("mix_tokens"))
    got, all_wanted = F.coalesce("used", F.lit(0)), sources.agg(F.sum("wanted").alias("all_wanted"))
    report = sources.join(used, "source", "left").crossJoin(F.broadcast(sum_)).crossJoin(F.broadcast(all_wanted)).select(
        "source", "target_share", F.coalesce(F.col("used") / F.col("mix_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce(F.col("used") / F.col("all_wanted"), F.lit(0.0)).alias("share_of_wanted"),
        "max_repeats", "wanted", "present", got.alias("used"), F.coalesce("records_used", F.lit(0)).alias("records_used"),
        ((got < F.col("wanted")) & (got >= F.col("present") * F.col("max_repeats"))).alias("short"),
    )
    return copies, report
