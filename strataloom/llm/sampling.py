"""Problem 6: a sample whose cells have target shares.

Method: controlled rounding. The fractional two-way table of quotas becomes
integer by a maximum flow that keeps every cell, both margins and the total
within their rounding; then exactly that many rows with the least random keys are
taken in each cell. Least numbers of cells are lower bounds of the flow: other
cells of their lane and domain are rounded down for them, so that the margins
stay; as no cell gets less than its quota rounded down, a margin grows where its
lower bounds alone exceed it. The rank of a key is found from counts of its
leading bits, so that no cell is sorted in one task.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Quotas are whole numbers of this part of a row, so that floors and sums are exact.
UNIT = 1_000_000


def exact(value: float) -> Fraction:
    """A quota as a whole number of units."""
    return Fraction(round(value * UNIT), UNIT)


def max_flow(edges: dict[tuple, int], source, sink) -> dict[tuple, int]:
    """The flow on each edge of a maximum flow (augmenting by breadth-first search)."""
    room: dict = {}
    for (a, b), capacity in edges.items():
        room.setdefault(a, {})[b] = room.get(a, {}).get(b, 0) + capacity
        room.setdefault(b, {}).setdefault(a, 0)
    while True:
        came, queue = {source: None}, [source]
        for node in queue:
            for other, left in room.get(node, {}).items():
                if left > 0 and other not in came:
                    came[other] = node
                    queue.append(other)
        if sink not in came:
            break
        path, node = [], sink
        while came[node] is not None:
            path.append((came[node], node))
            node = came[node]
        push = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= push
            room[b][a] += push
    return {(a, b): max(0, capacity - room[a][b]) for (a, b), capacity in edges.items()}


def _sums(table: dict[tuple[str, str], Fraction]) -> dict[tuple, Fraction]:
    """The margins of a table and its total."""
    out: dict[tuple, Fraction] = {("total",): sum(table.values(), Fraction(0))}
    for (a, b), v in table.items():
        out["row", a] = out.get(("row", a), Fraction(0)) + v
        out["column", b] = out.get(("column", b), Fraction(0)) + v
    return out


def _rounded(cells: dict[tuple[str, str], tuple[int, int]], margins: dict[tuple, tuple[int, int]]) -> dict[tuple[str, str], int] | None:
    """Whole numbers within the bounds of the cells and of their sums; null if there are none."""
    bounds = {("s", k): v for k, v in margins.items() if k[0] == "row"}
    bounds |= {(k, "t"): v for k, v in margins.items() if k[0] == "column"}
    bounds |= {(("row", a), ("column", b)): v for (a, b), v in cells.items()}
    bounds["t", "s"] = margins["total",]
    edges: dict[tuple, int] = {}
    for (a, b), (low, high) in bounds.items():
        edges[a, b] = high - low
        if low:
            edges["S", b] = edges.get(("S", b), 0) + low
            edges[a, "T"] = edges.get((a, "T"), 0) + low
    flow = max_flow(edges, "S", "T")
    if any(flow[e] < room for e, room in edges.items() if e[0] == "S"):
        return None  # the lower bounds can't all be met
    return {(a, b): low + flow[("row", a), ("column", b)] for (a, b), (low, _) in cells.items()}


def controlled_rounding(table: dict[tuple[str, str], float], least: dict[tuple[str, str], int] | None = None) -> dict[tuple[str, str], int]:
    """Each entry of a two-way table rounded up or down so that the sums of
    lanes, of domains and of the whole table are rounded up or down too.

    An entry is at least its ``least`` number. The margins are kept where the
    lower bounds of their entries allow it, and else grow to those bounds, or to
    what the plain rounding with the least numbers put in has.
    """
    least = least or {}
    values = {k: exact(v) for k, v in table.items()}
    margins = {k: (floor(v), ceil(v)) for k, v in _sums(values).items()}
    cells = {k: (max(floor(v), least.get(k, 0)), max(ceil(v), least.get(k, 0))) for k, v in values.items()}
    out = _rounded(cells, margins)
    if out is None:
        forced = _sums({k: low for k, (low, _) in cells.items()})
        out = _rounded(cells, {k: (max(low, 0), max(high, int(forced[k]))) for k, (low, high) in margins.items()})
    if out is None:
        plain = _rounded({k: (floor(v), ceil(v)) for k, v in values.items()}, margins)
        out = {k: max(n, least.get(k, 0)) for k, n in plain.items()}
    return out


def least_keys(df: DataFrame, cell: list[str], quotas: DataFrame, key: str, bits: int = 16) -> DataFrame:
    """The ``quota`` rows with the least random keys of each cell, exactly.

    Counts by the leading ``bits`` of the keys tell which buckets are taken
    whole; only the one bucket per cell that the quota cuts is ranked. Ties of
    keys go to the least ``key``.
    """
    drawn = df.withColumn("_key", F.xxhash64(key)).withColumn("_bucket", F.shiftrightunsigned(F.col("_key"), 64 - bits).cast("int"))
    counts = drawn.groupBy(*cell, "_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*cell).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = counts.withColumn("_before", before).join(quotas.select(*cell, "quota"), cell).where("_before < quota").select(*cell, "_bucket", "_before", "_n", "quota")
    taken = drawn.join(buckets, [*cell, "_bucket"])
    whole = taken.where("_before + _n <= quota")
    rank = F.row_number().over(Window.partitionBy(*cell, "_bucket").orderBy("_key", key))
    cut = taken.where("_before + _n > quota").withColumn("_rank", rank).where("_before + _rank <= quota").drop("_rank")
    return whole.unionByName(cut).select(*df.columns)


def cell_sample(df: DataFrame, targets: DataFrame, fraction: float, key: str = "id", lane: str = "language_lane", domain: str = "topic_domain") -> tuple[DataFrame, DataFrame]:
    """(sample, report).

    ``df`` has ``key``, ``lane`` and ``domain``; rows that share a key count once.
    ``targets`` has ``lane, domain, target_share, min_rows``, a bounded table.
    With n the rows in listed cells, the sample has the controlled rounding of
    target_share x floor(fraction x n) rows of each cell, at least ``min_rows``,
    as far as there are rows. ``report`` has for each cell the rows needed (the
    lower bound of its rounding), present, wanted and taken, its actual share of
    the sample, and whether it is short. What short cells lack is not made up for
    by others, whose shares would then exceed their targets. Rows with a null key,
    lane or domain are in no cell. Empty cells and tables give zeros.
    """
    rows = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(lane, domain)).alias("of")).select(key, f"of.{lane}", f"of.{domain}")
    cell = [lane, domain]
    rows = rows.join(F.broadcast(targets.select(*cell)), cell)
    present = {(r[0], r[1]): r[2] for r in rows.groupBy(*cell).count().collect()}
    wanted = {(r[lane], r[domain]): (float(r["target_share"]), int(r["min_rows"])) for r in targets.collect()}
    size = floor(exact(fraction * sum(present.values())))
    quotas, least = {k: share * size for k, (share, _) in wanted.items()}, {k: n for k, (_, n) in wanted.items()}
    rounded = controlled_rounding(quotas, least) if wanted else {}
    drawn = sum(min(rounded[k], present.get(k, 0)) for k in wanted) or 1
    lines = []
    for k, (share, few) in sorted(wanted.items()):
        quota, have, needed = rounded[k], present.get(k, 0), max(few, floor(exact(quotas[k])))
        taken = min(quota, have)
        lines.append((*k, share, taken / drawn, few, needed, have, quota, taken, have < needed))
    report = df.sparkSession.createDataFrame(lines, f"{lane} string, {domain} string, target_share double, actual_share double, min_rows int, needed long, present long, quota long, taken long, short boolean")
    return least_keys(rows, cell, F.broadcast(report.select(*cell, "quota")), key), report
