"""Problem 7: groups of records that are nearly the same text, over all rows.

Method: BK-trees whose children are keyed by the Hamming distance of integer
fingerprints. A fingerprint holds one bit of each of 160 min-hashes of a text's
runs of words, so texts of similarity s differ in about 80 (1 - s) bits. A tree
over all texts would prune nothing at the radius that similarity 0.5 needs, so
the trees stand in shards: one for every band of min-hashes that texts share.
Exact copies are one class before anything else, a tree never holds more than
about ``SHARD`` fingerprints, and what the trees return is verified on the runs of
words themselves. A fuller band is found from counts before its rows meet, and
cut into blocks by a hash; every pair of its blocks is a task of its own.

The issue's method broadcasts the trees. Here each tree lies in the task of its
shard instead: the trees of all rows have no size bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.text import in_parts, words
from strataloom.session import durable, release

BANDS, ROWS, BITS = 40, 4, 160
#: Fingerprints in one tree.
SHARD = 2000
#: Full bands up to which their names (16 bytes each) go to all tasks, so that their rows stay where they are.
FULLEST = 100_000

SKETCH = "field string, id string, cid long, bits_hi long, bits_lo long, bits_ex int, bands array<int>, tails array<smallint>"


class BKTree:
    """A BK-tree over integers under the Hamming distance."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, bits: int, item: int) -> None:
        """Insert ``item``; equal fingerprints share a node."""
        if self.root is None:
            self.root = [bits, [item], {}]
            return
        node = self.root
        while True:
            distance = (node[0] ^ bits).bit_count()
            if not distance:
                node[1].append(item)
                return
            child = node[2].get(distance)
            if child is None:
                node[2][distance] = [bits, [item], {}]
                return
            node = child

    def within(self, bits: int, radius: int) -> list[int]:
        """The items whose distance is at most ``radius``: only edges within
        the radius of the distance to the parent are followed."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            distance = (node[0] ^ bits).bit_count()
            if distance <= radius:
                found += node[1]
            for edge, child in node[2].items():
                if -radius <= edge - distance <= radius:
                    stack.append(child)
        return found


def radius_of(similarity: float) -> int:
    """Bits in which fingerprints of that similarity differ at most, but for
    about one pair in ten thousand: the mean and 3.7 standard deviations."""
    p = (1 - similarity) / 2
    return int(np.ceil(BITS * p + 3.7 * np.sqrt(BITS * p * (1 - p))))


@lru_cache(maxsize=1)
def _hashes() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20260101)
    return random.integers(1, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1), random.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


_WORD_HASH: dict[str, int] = {}


def _word_hashes(tokens: list[str]) -> np.ndarray:
    known = _WORD_HASH
    if len(known) > 500_000:  # bounds the memory, never changes a hash
        known.clear()
    for token in set(tokens).difference(known):
        known[token] = xxhash.xxh64_intdigest(token)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def run_hashes(tokens: list[str], run: int) -> np.ndarray:
    """A 32-bit hash of every run of ``run`` words, in order."""
    h = _word_hashes(tokens)
    n = len(h) - run + 1
    mixed = np.zeros(max(n, 0), np.uint64)
    for k in range(run):
        mixed = (mixed ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def min_hashes(runs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The min-hashes of several texts, whose runs begin at ``starts``."""
    multiply, add = _hashes()
    out = np.empty((len(starts), len(multiply)), np.uint32)
    for at in range(0, len(multiply)):
        out[:, at] = np.minimum.reduceat(runs * multiply[at] + add[at], starts)
    return out


def _band_keys(mins: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper 32 and next 16 bits of a hash of each band: what tells bands apart at any number of texts, in little space."""
    keys = np.empty((len(mins), BANDS), np.uint64)
    for band in range(BANDS):
        mixed = np.full(len(mins), salt * 1009 + band, np.uint64)
        for row in range(ROWS):
            mixed = (mixed ^ mins[:, band * ROWS + row]) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        keys[:, band] = mixed
    return (keys >> np.uint64(32)).astype(np.uint32).view(np.int32), (keys & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)


def _fingerprints(mins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = ((mins[:, :BITS] * np.uint32(0x85EBCA6B)) >> np.uint32(31)).astype(np.uint8)
    packed = np.packbits(bits, axis=1)
    return np.ascontiguousarray(packed[:, :16]).view(">i8").astype(np.int64), np.ascontiguousarray(packed[:, 16:]).view(">i4").astype(np.int32)[:, 0]


def sketches(texts: DataFrame, least_words: dict[str, int], run: int, every: bool = False) -> DataFrame:
    """One row of ``SKETCH`` for each text with enough words.

    ``texts`` has ``field``, ``id`` and ``text``; texts that have fewer words
    than ``least_words`` of their field, or no run at all, take no part, or with
    ``every`` have no bands. ``cid`` is a hash of field and words: equal for texts
    with the same words in order.
    """
    salts = {field: i for i, field in enumerate(sorted(least_words))}

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_parts(batches):
            for field, part in batch.groupby("field"):
                least, ids, classes, runs, short = max(run, least_words[field]), [], [], [], []
                for id_, text in zip(part["id"], part["text"]):
                    tokens = words(text)
                    digest = xxhash.xxh64_intdigest(" ".join(tokens), salts[field])
                    if len(tokens) >= least:
                        ids.append(id_)
                        classes.append(digest)
                        runs.append(run_hashes(tokens, run))
                    elif every:
                        short.append((id_, digest))
                if short:
                    none = [[] for _ in short]
                    yield pd.DataFrame({
                        "field": field, "id": [i for i, _ in short], "cid": np.array([c for _, c in short], np.uint64).view(np.int64), "bits_hi": 0, "bits_lo": 0, "bits_ex": 0, "bands": none, "tails": none,
                    })
                for first in range(0, len(ids), 256):
                    some = runs[first : first + 256]
                    sizes = np.fromiter(map(len, some), np.int64, len(some))
                    mins = min_hashes(np.concatenate(some), np.cumsum(sizes) - sizes)
                    bits, extra = _fingerprints(mins)
                    bands, tails = _band_keys(mins, salts[field])
                    yield pd.DataFrame({
                        "field": field, "id": ids[first : first + 256], "cid": np.array(classes[first : first + 256], np.uint64).view(np.int64),
                        "bits_hi": bits[:, 0], "bits_lo": bits[:, 1], "bits_ex": extra, "bands": list(bands), "tails": list(tails),
                    })

    return texts.select("field", "id", "text").mapInPandas(sketch, SKETCH)


def _fingerprint(high: int, low: int, extra: int) -> int:
    return ((high & (2**64 - 1)) << 64 | low & (2**64 - 1)) << 32 | extra & (2**32 - 1)


def full_bands(members: DataFrame, classes: int, shard: int) -> DataFrame | None:
    """``band, n`` of the bands with more than ``shard`` members; null where there is none.

    Bands are first counted by a hash with so many places that one has less than
    half a shard on average, which takes no more than a few rows of a task; only the
    members of places that are too full are counted by band.
    """
    places = max(1024, 1 << (2 * BANDS * classes // shard).bit_length())
    place = F.pmod(F.xxhash64("band"), F.lit(places))
    full = durable(members.groupBy(place.alias("place")).agg(F.count("*").alias("n")).where(F.col("n") > shard).select("place"))
    if full.isEmpty():  # no member needs to move
        return None
    found = durable(only_keys(members.withColumn("place", place), full, ["place"]).join(full, "place", "left_semi").groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > shard))
    return None if found.isEmpty() else found


def tree_pairs(classes: DataFrame, similarity: float, shard: int = SHARD) -> DataFrame:
    """Pairs ``a < b`` of classes that share a band and whose fingerprints lie within the radius.

    ``classes`` has ``cid``, ``bits_hi``, ``bits_lo``, ``bits_ex``, ``bands`` and ``tails``, and is
    read several times; a class may come more than once. A band with at most ``shard`` classes is one tree. The rows
    of a fuller one never meet: they are cut into blocks of about ``shard`` by a hash,
    and each pair of its blocks is a task, so no tree and no task grows.
    """
    radius = radius_of(similarity)
    spec = Window.partitionBy("band")
    # only the names of bands and classes meet at first: most bands have a single class, whose fingerprint nobody asks for
    prints = classes.select("cid", "bits_hi", "bits_lo", "bits_ex").dropDuplicates(["cid"])
    members = classes.select("cid", "tails", F.posexplode("bands").alias("of", "band"))
    band = F.shiftleft(F.col("of").cast("long"), 48).bitwiseOR(F.shiftleft(F.col("band").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)), 16)).bitwiseOR(F.get("tails", "of").cast("long").bitwiseAND(F.lit(0xFFFF)))
    members = members.select("cid", band.alias("band"))
    full = full_bands(members.select("band"), classes.count(), shard)
    small = members.join(full, "band", "left_anti") if full is not None else members
    small = small.withColumn("among", F.count("*").over(spec)).where("among > 1").select("band", "cid").join(prints, "cid")
    # the rows of a band lie together and in order
    small = small.repartition("band").sortWithinPartitions("band", "cid")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, band = BKTree(), None
        for batch in batches:
            left, right = [], []
            for key, cid, high, low, extra in zip(*(batch[c].tolist() for c in ("band", "cid", "bits_hi", "bits_lo", "bits_ex"))):
                if key != band:
                    tree, band = BKTree(), key
                bits = _fingerprint(high, low, extra)
                for other in tree.within(bits, radius):
                    if other != cid:
                        left.append(other)
                        right.append(cid)
                tree.add(bits, cid)
            yield pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})

    found = small.mapInPandas(search, "a long, b long").distinct()
    if full is None:
        return found

    def block_pair(part: pd.DataFrame) -> pd.DataFrame:
        tree, left, right = BKTree(), [], []
        one, first = bool(part["i"].iloc[0] == part["j"].iloc[0]), part["i"].iloc[0]
        for block, cid, high, low, extra in sorted(zip(*(part[c].tolist() for c in ("block", "cid", "bits_hi", "bits_lo", "bits_ex")))):
            bits = _fingerprint(high, low, extra)
            if one or block != first:
                for other in tree.within(bits, radius):
                    if other != cid:
                        left.append(min(other, cid))
                        right.append(max(other, cid))
            if one or block == first:
                tree.add(bits, cid)
        return pd.DataFrame({"a": left, "b": right}, dtype="int64")

    blocks = (members.join(F.broadcast(full), "band") if full.count() <= FULLEST else members.join(full, "band")).dropDuplicates(["band", "cid"])
    blocks = blocks.join(prints, "cid").withColumn("blocks", F.ceil(F.col("n") / shard).cast("long")).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    blocks = blocks.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    blocks = blocks.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "bits_hi", "bits_lo", "bits_ex")
    return found.unionByName(blocks.groupBy("band", "i", "j").applyInPandas(block_pair, "a long, b long")).distinct()


def similarity_of(a: Column, b: Column) -> Column:
    """Shared distinct runs over all distinct runs of two arrays of runs."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def _run_sets(run: int):
    """A pandas UDF from a text to 32-bit hashes of its distinct runs of words."""

    @F.pandas_udf("array<int>")
    def sets(texts: pd.Series) -> pd.Series:
        def of(text: str) -> list[int]:
            tokens = words(text)
            return [xxhash.xxh32_intdigest(r) - (1 << 31) for r in {" ".join(tokens[i : i + run]) for i in range(len(tokens) - run + 1)}]

        return texts.map(of)

    return sets


#: Bits of the filter that keeps most of the texts out of the verification: 2 MB.
FILTER = 1 << 24


def only_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose key may be in ``keys``, and all whose key is.

    A bitmap of ``FILTER`` hashed keys, of a fixed size whatever the rows, is
    broadcast; a join must follow. Nothing of ``df`` is shuffled.
    """
    spot = F.pmod(F.xxhash64(*on), F.lit(FILTER))
    bitmap = keys.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bitmap"))
    place = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    rows = df.withColumn("bucket", F.bitmap_bucket_number(spot)).withColumn("_place", place).join(F.broadcast(bitmap), "bucket")
    return rows.where((F.getbit(byte, F.expr("cast(_place % 8 as int)")) == 1)).drop("bucket", "_place", "bitmap")


def near_duplicates(texts: DataFrame, least_words: dict[str, int], similarity: float = 0.8, run: int = 5, shard: int = SHARD, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, links) of all texts with at least ``least_words[field]`` words.

    ``texts`` has ``field``, ``id`` and ``text``; other columns are ignored.
    ``members`` has ``field, id, cid``, one row per record: texts with the same
    words in the same order are one class ``cid``. ``links`` has ``field, a, b,
    similarity`` with ``a < b``: the pairs of classes that share at least
    ``similarity`` of their distinct runs of ``run`` words. Rows that share field
    and id count once; null ids, null texts and texts too short for a run take
    no part; an empty table gives empty results. With ``every``, ``members`` also
    has the records whose text is too short, and those of null texts with a null class.

    A pair at similarity 0.5 shares a band with probability 0.92, one at 0.6 with
    0.996 and one at 0.65 or more with over 0.999.
    """
    rows = texts.where("id is not null and text is not null").select("field", F.col("id").cast("string").alias("id"), "text")
    known = durable(sketches(rows, least_words, run, every))
    drawn = known.select("field", "id", "cid")
    if every:
        drawn = drawn.unionByName(texts.where("id is not null and text is null").select("field", F.col("id").cast("string").alias("id"), F.lit(None).cast("long").alias("cid")))
    # one record stands for its class: nearly all others are kept out without moving a sketch, and exactly where the bitmap is crowded
    named = known.where(F.size("bands") > 0)
    ones = named.groupBy("field", "cid").agg(F.min("id").alias("id")).select("field", "id")
    classes = only_keys(named, ones, ["field", "id"])
    if named.count() > FILTER // 8:
        classes = classes.join(ones, ["field", "id"], "left_semi")
    classes = classes.select("cid", "bits_hi", "bits_lo", "bits_ex", "bands", "tails")
    pairs = durable(tree_pairs(classes, similarity, shard))
    del classes
    release(texts.sparkSession)  # the bands are the largest of all and done with
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    ends = durable(drawn.select("field", "cid", "id").join(ends, "cid", "left_semi").groupBy("field", "cid").agg(F.min("id").alias("id")))
    sets = durable(only_keys(rows, ends, ["field", "id"]).join(ends, ["field", "id"]).dropDuplicates(["field", "id"]).select("field", "cid", _run_sets(run)("text").alias("runs")))
    release(texts.sparkSession)
    links = (
        pairs.join(sets.select(F.col("cid").alias("a"), "field", F.col("runs").alias("runs_a")), "a")
        .join(sets.select(F.col("cid").alias("b"), F.col("runs").alias("runs_b")), "b")
        .select("field", "a", "b", similarity_of(F.col("runs_a"), F.col("runs_b")).alias("similarity"))
        .where(F.col("similarity") >= similarity)
    )
    return drawn.select("field", "id", "cid").distinct(), durable(links)


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """``field, id_a, id_b`` with ``id_a < id_b`` for all pairs of records: within a class and between linked classes.

    Its size is that of the pairs asked for; ``grouped`` is the form that stays
    in proportion to the records.
    """
    several = members.groupBy("cid").count().where("count > 1").select("cid")
    twins = members.join(several, "cid", "left_semi")
    within = twins.alias("x").join(twins.alias("y"), (F.col("x.cid") == F.col("y.cid")) & (F.col("x.id") < F.col("y.id"))).select("x.field", F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
    between = (
        links.join(members.select(F.col("cid").alias("a"), F.col("id").alias("p")), "a").join(members.select(F.col("cid").alias("b"), F.col("id").alias("q")), "b")
        .where("p <> q").select("field", F.least("p", "q").alias("id_a"), F.greatest("p", "q").alias("id_b"))
    )
    return within.unionByName(between)


def components(links: DataFrame) -> DataFrame:
    """``cid, group``: every linked class with the least class of its connected component.

    Large and small stars by turns (each node links its larger neighbours, then
    its smaller ones, to the least of them) until no edge changes. A step is an
    aggregate and a join by node, so nothing is collected.
    """
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first())
    edges = durable(links.select(F.col("b").alias("u"), F.col("a").alias("v")).distinct())  # u > v
    last = print_of(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = durable(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = durable(small.distinct())
        now = print_of(edges)
        if now == last:
            return edges.select(F.col("u").alias("cid"), F.col("v").alias("group")).unionByName(edges.select(F.col("v").alias("cid"), F.col("v").alias("group")).distinct())
        last = now


def grouped(members: DataFrame, links: DataFrame) -> DataFrame:
    """``field, id, class_id, links, group_id``: every record with its class of equal
    texts, the number of classes linked to it and the group that the links join.

    A class without links is a group of its own; a null class has a null group.
    """
    degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("links"))
    linked = degree.join(components(links), "cid", "left")
    return members.join(linked, "cid", "left").select("field", "id", F.hex("cid").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.hex(F.coalesce("group", "cid")).alias("group_id"))
