"""Problem 8: items in containers of fixed capacity.

Method: swap-based local search. Shards of a bounded number of containers are
filled by best fit and then improved: documents of the emptiest container are
moved to others, or exchanged one for one or two for one, as long as the sum of
squared fills grows, until containers become empty.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Containers of one shard; what stays unused is less than about one of them.
CONTAINERS = 500


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers (lists of item numbers) by best fit, longest items first."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(room, (sizes[item], -1))
        if at == len(room):
            bins.append([item])
            insort(room, (capacity - sizes[item], len(bins) - 1))
        else:
            left, bin_ = room.pop(at)
            bins[bin_].append(item)
            insort(room, (left - sizes[item], bin_))
    return bins


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """``bins`` after exchanges that each make the sum of squared fills grow.

    The search ends where there are as few containers as all sizes need, or where
    no container can be changed.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    stuck: set[int] = set()
    fewest = -(-sum(fill) // capacity)
    while True:
        under = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=lambda b: (fill[b], b))
        source = next((b for b in under if b not in stuck), None)
        if source is None or len(under) < 2 or sum(map(bool, bins)) <= fewest:
            return [b for b in bins if b]
        changed = False
        for target in under[:0:-1]:
            if target == source or fill[target] < fill[source]:
                continue
            room = capacity - fill[target]
            give, take = _exchange(bins[source], bins[target], sizes, room)
            if give is None:
                continue
            moved = sum(sizes[i] for i in give) - sum(sizes[i] for i in take)
            bins[source] = [i for i in bins[source] if i not in give] + list(take)
            bins[target] = [i for i in bins[target] if i not in take] + list(give)
            fill[source] -= moved
            fill[target] += moved
            changed = True
            if not bins[source]:
                break
        if changed:
            stuck.clear()
        else:
            stuck.add(source)


def _exchange(source: list[int], target: list[int], sizes: list[int], room: int):
    """Items to give and to take so that the target gains most and at most ``room``; (None, None) if it can't gain."""
    best, pick = 0, (None, None)
    for item in source:
        if best < sizes[item] <= room:
            best, pick = sizes[item], ((item,), ())
    if best == room:
        return pick
    theirs = sorted((sizes[i], i) for i in target)
    for item in source:
        low = sizes[item] - room
        at = bisect_left(theirs, (low, -1))
        if at < len(theirs) and best < sizes[item] - theirs[at][0] <= room:
            best, pick = sizes[item] - theirs[at][0], ((item,), (theirs[at][1],))
        for i, (size, other) in enumerate(theirs):  # one for two of the target
            if size >= sizes[item]:
                break
            at = bisect_left(theirs, (low - size, -1), i + 1)
            if at < len(theirs) and best < sizes[item] - size - theirs[at][0] <= room:
                best, pick = sizes[item] - size - theirs[at][0], ((item,), (other, theirs[at][1]))
    for i, one in enumerate(source):  # two for one of the target
        for two in source[i + 1 :]:
            both = sizes[one] + sizes[two]
            at = bisect_left(theirs, (both - room, -1))
            if at < len(theirs) and best < both - theirs[at][0] <= room:
                best, pick = both - theirs[at][0], ((one, two), (theirs[at][1],))
            if best < both <= room:
                best, pick = both, ((one, two), ())
    return pick


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers of items that each fit."""
    return local_search(best_fit(sizes, capacity), sizes, capacity)


def containers(counts: DataFrame, capacity: int, key: str = "doc_id") -> DataFrame:
    """``container, key, piece, tokens, oversized``: the assignment of all items.

    ``counts`` has ``key`` and ``tokens``, a row per item. An item larger than
    the capacity is cut into pieces of the capacity and a rest; all others stay
    whole. Items without tokens or with a null key or size take no room and
    come with a null container. Containers are numbered within shards.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    kind = dict(counts.dtypes)[key]
    items = counts.select(F.col(key), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
    oversized = F.col("tokens") > capacity
    pieces = items.where("tokens > 0").withColumn("piece", F.explode(F.expr(f"sequence(0L, (tokens - 1) div {capacity}L)")))
    pieces = pieces.select(key, F.col("piece").cast("int").alias("piece"), F.least(F.lit(capacity).cast("long"), F.col("tokens") - F.col("piece") * capacity).alias("size"), oversized.alias("oversized"))
    total = items.agg(F.sum("tokens")).first()[0] or 0
    shards = max(1, round(total / (capacity * CONTAINERS)))
    full = pieces.where(F.col("size") == capacity).select(F.concat_ws("-", F.lit("full"), F.col(key).cast("string"), "piece").alias("container"), key, "piece", F.col("size").alias("tokens"), "oversized")

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([key, "piece"], kind="stable").reset_index(drop=True)
        shard, where = part["shard"].iloc[0], [0] * len(part)
        for number, items in enumerate(pack(part["size"].tolist(), capacity)):
            for item in items:
                where[item] = number
        return pd.DataFrame({"container": [f"{shard}-{n}" for n in where], key: part[key], "piece": part["piece"], "tokens": part["size"], "oversized": part["oversized"]})

    rest = pieces.where(F.col("size") < capacity).withColumn("shard", F.pmod(F.xxhash64(key, "piece"), F.lit(shards)))
    packed = rest.groupBy("shard").applyInPandas(fill, f"container string, `{key}` {kind}, piece int, tokens long, oversized boolean")
    none = items.where("tokens <= 0").select(F.lit(None).cast("string").alias("container"), key, F.lit(0).alias("piece"), "tokens", F.lit(False).alias("oversized"))
    return packed.unionByName(full).unionByName(none)


def fill_report(assigned: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, the fewest there could be, tokens and unused space."""
    filled = assigned.where("container is not null").groupBy("container").agg(F.sum("tokens").alias("fill"))
    return filled.agg(F.count("*").alias("containers"), F.coalesce(F.sum("fill"), F.lit(0)).alias("tokens")).select(
        "containers", F.ceil(F.col("tokens") / capacity).alias("least_containers"), "tokens", (F.col("containers") * capacity - F.col("tokens")).alias("unused"),
    )
