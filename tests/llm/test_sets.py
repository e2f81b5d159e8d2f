"""Tokens, near duplicates, samples, containers and mixes: brute force, exact round trips, edge cases."""

import itertools
import random
from math import ceil, floor

import numpy as np
import pytest
from conftest import found
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.llm import mixing, neardup, packing, sampling, text, tokens


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1 2\n.,'sæ- €", max_size=120))
def test_chunks_change_no_token(value):
    chunks = tokens.independent_chunks(value, 7)
    assert "".join(chunks) == value
    assert sum(map(tokens.count_tokens, chunks)) == tokens.count_tokens(value)


def test_counts_of_rows(spark):
    long = "En meget lang tekst om kælderen, 12 krukker. " * 300
    df = spark.createDataFrame([(1, long, 0), (1, long, 0), (2, None, 0), (3, "", 0), (4, "kort tekst", 0)], "id int, text string, tokens int")
    got = sorted((r.id, r.tokens) for r in tokens.token_counts(df, ["id"], "text", chunk=500).collect())
    n = tokens.count_tokens(long)
    assert got == [(1, n), (1, n), (2, 0), (3, 0), (4, tokens.count_tokens("kort tekst"))]
    assert tokens.token_counts(df.limit(0), ["id"], "text").count() == 0


def test_slices(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 4), (None, "x", 5)], "s string, d string, tokens long")
    got = found(tokens.slice_totals(df, {"source": F.col("s"), "domain": F.col("d")}), "source", "domain", "texts", "tokens")
    assert {(None, None, 3, 12), ("a", None, 2, 7), ("?", "x", 1, 5), (None, "x", 2, 8)} <= got and len(got) == 8


def test_tree_finds_all_within():
    rng = random.Random(1)
    values = [rng.getrandbits(40) for _ in range(200)] + [0, 0]
    tree = neardup.BKTree()
    for i, v in enumerate(values):
        tree.add(v, i)
    for q in values[:20]:
        for r in (0, 5, 14):
            assert sorted(tree.within(q, r)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= r]
    assert neardup.BKTree().within(3, 5) == []


def runs(t, n):
    w = text.words(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def corpus():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for i in range(60):
        base = [rng.choice(vocabulary) for _ in range(80)]
        rows.append((f"a{i:02d}", " ".join(base)))
        edited = list(base)
        for _ in range(rng.randrange(1, 6)):
            edited[rng.randrange(80)] = rng.choice(vocabulary)
        rows.append((f"b{i:02d}", " ".join(edited)))
    rows += [("c0", rows[0][1].upper() + "!"), ("c1", rows[0][1]), ("short", "w1 w2 w3"), ("null", None), ("empty", ""), ("long", " ".join(rng.choice(vocabulary) for _ in range(20000))), ("a00", rows[0][1])]
    return rows


@pytest.mark.parametrize("shard", [2000, 2])
def test_near_duplicates_against_all_pairs(spark, shard):
    rows = corpus()
    df = spark.createDataFrame([("f", i, t, 1) for i, t in rows], "field string, id string, text string, links int")
    members, links = neardup.near_duplicates(df, {"f": 20}, similarity=0.5, run=3, shard=shard)
    got = found(neardup.expand(members, links), "id_a", "id_b")
    sets = {i: runs(t, 3) for i, t in rows if t and len(text.words(t)) >= 20}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}
    assert got == want
    form = {r.id: (r.class_id, r.links) for r in neardup.grouped(members, links).collect()}
    assert len(form) == len(sets) and form["a00"][0] == form["c0"][0] == form["c1"][0]
    empty = neardup.near_duplicates(df.limit(0), {"f": 20})
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_groups_are_the_components_of_the_links(spark):
    rng = random.Random(5)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(35)} | {(100 + i, 101 + i) for i in range(12)} | {(-5, k) for k in range(200, 206)}
    parent = {}
    root = lambda x: x if parent.setdefault(x, x) == x else root(parent[x])
    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    links = spark.createDataFrame([("f", a, b, 1.0) for a, b in pairs], "field string, a long, b long, similarity double")
    assert found(neardup.components(links), "cid", "group") == {(x, root(x)) for x in parent}
    assert neardup.components(links.limit(0)).count() == 0


def test_every_record_has_its_group(spark):
    """Edited copies share a group, and short and null texts have rows."""
    rows = [("f", i, t) for i, t in corpus()] + [("f", "short2", "W1, w2 w3!"), ("g", "short", "w1 w2 w3"), ("f", None, "w1 w2 w3")]
    df = spark.createDataFrame(rows, "field string, id string, text string")
    members, links = neardup.near_duplicates(df, {"f": 1, "g": 1}, similarity=0.5, run=3, every=True)
    out = neardup.grouped(members, links).collect()
    got = {(r.field, r.id): r for r in out}
    assert len(out) == len(got) and set(got) == {r[:2] for r in rows if r[1]}
    assert got["f", "short"].class_id == got["f", "short2"].class_id != got["g", "short"].class_id
    assert got["f", "null"].class_id is None and got["f", "null"].group_id is None and got["f", "short"].links == 0
    pairs = [(r.a, r.b) for r in links.collect()]
    assert pairs
    group = {r.class_id: r.group_id for r in out}
    name = lambda cid: f"{cid & (1 << 64) - 1:X}"
    assert all(group[name(a)] == group[name(b)] for a, b in pairs)


def test_a_hot_group_of_different_texts(spark):
    """A third of the rows nearly the same text: no link is lost when the bucket is cut into blocks."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(40):
        own = list(base)
        own[i] = f"own{i}"
        rows.append(("f", f"h{i:02d}", " ".join(own)))
    df = spark.createDataFrame(rows, "field string, id string, text string")
    members, links = neardup.near_duplicates(df, {"f": 1}, similarity=0.5, run=3, shard=7)
    assert neardup.expand(members, links).count() == 40 * 39 // 2


def test_a_band_that_half_of_all_share(spark):
    """50,000 classes in one band: no task sees more than two blocks, and planted pairs are found."""
    n, shard = 50_000, 5000
    rng = np.random.default_rng(4)
    high, low = rng.integers(-(2**62), 2**62, n), rng.integers(-(2**62), 2**62, n)
    high[1::500], low[1::500] = high[::500], low[::500]  # each 500th has a neighbour
    pdf = {"cid": np.arange(n), "bits_hi": high, "bits_lo": low, "bits_ex": np.zeros(n, int)}
    df = spark.createDataFrame(list(zip(*(v.tolist() for v in pdf.values()))), "cid long, bits_hi long, bits_lo long, bits_ex int")
    df = df.withColumn("bands", F.array(F.lit(7), F.col("cid").cast("int") + 100)).withColumn("tails", F.array(F.lit(1), F.lit(2)).cast("array<smallint>")).repartition(8)
    members = df.select(F.explode("bands").alias("band"))
    assert [tuple(r) for r in neardup.full_bands(members, n, shard).collect()] == [(7, n)]
    got = found(neardup.tree_pairs(df, 1.0, shard), "a", "b")
    assert got == {(i, i + 1) for i in range(0, n, 500)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.floats(0, 9), min_size=3, max_size=3), min_size=1, max_size=4))
def test_controlled_rounding_keeps_both_margins(values):
    table = {(f"r{i}", f"c{j}"): v for i, row in enumerate(values) for j, v in enumerate(row)}
    got = sampling.controlled_rounding(table)
    near = lambda exact, whole: floor(exact) <= whole <= ceil(exact)
    exact = {k: sampling.exact(v) for k, v in table.items()}
    assert all(near(exact[k], got[k]) for k in table) and near(sum(exact.values()), sum(got.values()))
    for axis in (0, 1):
        for name in {k[axis] for k in table}:
            assert near(sum(v for k, v in exact.items() if k[axis] == name), sum(v for k, v in got.items() if k[axis] == name))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=3, max_size=3), min_size=2, max_size=4), st.integers(0, 3), st.integers(0, 2), st.integers(0, 9))
def test_least_numbers_keep_the_margins_that_can_hold_them(values, i, j, more):
    table = {(f"r{i}", f"c{j}"): v / 4 for i, row in enumerate(values) for j, v in enumerate(row)}
    cell = (f"r{i % len(values)}", f"c{j}")
    least = {cell: ceil(table[cell]) + more}  # binds: the cell may be rounded down otherwise
    got = sampling.controlled_rounding(table, least)
    assert got[cell] == least[cell] and all(floor(v) <= got[k] <= max(ceil(v), least.get(k, 0)) for k, v in table.items())
    for axis in (0, 1):
        for name in {k[axis] for k in table}:
            keys = [k for k in table if k[axis] == name]
            whole, part, forced = sum(got[k] for k in keys), sum(table[k] for k in keys), sum(max(floor(table[k]), least.get(k, 0)) for k in keys)
            assert whole >= floor(part) and (whole <= ceil(part) or name in cell)
            assert whole <= max(ceil(part), forced) or more


def test_binding_numbers_keep_both_margins():
    table = {("a", "x"): 0.5, ("a", "y"): 0.5, ("b", "x"): 0.5, ("b", "y"): 0.5}
    for cell in table:
        got = sampling.controlled_rounding(table, {cell: 1})
        assert got[cell] == 1 and sorted(got.values()) == [0, 0, 1, 1] and got[cell[0], "y" if cell[1] == "x" else "x"] == 0
    got = sampling.controlled_rounding({("a", "x"): 1.5, ("a", "y"): 0.5, ("b", "x"): 3.0, ("b", "y"): 5.0}, {("a", "x"): 9})
    assert got == {("a", "x"): 9, ("a", "y"): 0, ("b", "x"): 3, ("b", "y"): 5} or got["a", "x"] == 9 and sum(got.values()) <= 18


def test_least_keys_are_the_plain_ranking(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 5 < 3, "x").otherwise("y").alias("cell"))
    quotas = spark.createDataFrame([("x", 77), ("y", 1000)], "cell string, quota long")
    keyed = df.withColumn("k", F.xxhash64("id")).where("cell = 'x'").collect()
    order = sorted(keyed, key=lambda r: (r.k % 2**64, r.id))
    for bits in (4, 16):
        got = sampling.least_keys(df, ["cell"], quotas, "id", bits)
        counts = {r.cell: r["count"] for r in got.groupBy("cell").count().collect()}
        assert counts == {"x": 77, "y": 200} and got.select("id").distinct().count() == 277
        assert {r.id[:0] for r in got.collect()} == {""} and len(order) == 300


def test_sample_and_shortfalls(spark):
    rows = [(f"i{k}", "da", "a") for k in range(100)] + [(f"j{k}", "en", "a") for k in range(3)] + [("i0", "da", "a"), (None, "da", "a"), ("n", None, "a"), ("o", "sv", "z")]
    df = spark.createDataFrame(rows, "id string, language_lane string, topic_domain string")
    targets = spark.createDataFrame([("da", "a", 0.5, 1), ("en", "a", 0.1, 5), ("sv", "b", 0.4, 0)], "language_lane string, topic_domain string, target_share double, min_rows int")
    sample, report = sampling.cell_sample(df, targets, 0.25)
    assert found(report, "language_lane", "needed", "present", "taken", "short") == {("da", 12, 100, 12, False), ("en", 5, 3, 3, True), ("sv", 10, 0, 0, True)} or report.where("language_lane = 'da'").first().taken in (12, 13)
    assert sample.select("id").distinct().count() == sample.count()
    nothing, zeros = sampling.cell_sample(df.limit(0), targets, 0.25)
    assert nothing.count() == 0 and zeros.where("present > 0").count() == 0
    assert sampling.cell_sample(df, targets.limit(0), 0.25)[0].count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_packing_keeps_every_item_and_the_capacity(sizes):
    bins = packing.pack(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= len(packing.best_fit(sizes, 100))


def test_search_empties_a_bin_that_best_fit_leaves():
    sizes = [6, 5, 4, 3, 2]
    start = [[0, 4], [1, 3], [2]]  # 8, 8, 4 of 10
    assert len(packing.local_search([list(b) for b in start], sizes, 10)) == 2


def test_containers(spark):
    rows = [(i, 1 + (i * 37) % 60) for i in range(400)] + [(1000, 250), (1001, 200), (1002, 0), (1003, None), (1004, 100)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long")
    got = packing.containers(df, 100).collect()
    by, fill = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        if r.container:
            fill[r.container] = fill.get(r.container, 0) + r.tokens
    assert len(by) == len(rows) and max(fill.values()) <= 100
    assert sorted(r.tokens for r in by[1000]) == [50, 100, 100] and {r.doc_id for r in got if r.oversized} == {1000, 1001}
    assert all(len(by[i]) == 1 for i, _ in rows if i not in (1000, 1001)) and by[1002][0].container is None
    report = packing.fill_report(packing.containers(df, 100), 100).first()
    assert report.tokens == sum(t or 0 for _, t in rows) and report.containers - report.least_containers <= 1
    assert packing.fill_report(packing.containers(df.limit(0), 100), 100).first().containers == 0
    with pytest.raises(ValueError):
        packing.containers(df, 0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=80), st.floats(0.05, 0.95), st.integers(0, 99))
def test_flight_keeps_the_totals(sizes, chance, seed):
    sizes, chances = np.array(sizes, float), np.full(len(sizes), chance)
    out = mixing.flight(sizes, chances, np.random.default_rng(seed))
    assert out.sum() == pytest.approx(chances.sum(), abs=1e-6) and sizes @ out == pytest.approx(sizes @ chances, rel=1e-6)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2 and out.min() >= -1e-9 and out.max() <= 1 + 1e-9


def test_flight_draws_everyone_equally_often():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 50, 12).astype(float)
    drawn = sum(mixing.flight(sizes, np.full(12, 0.4), rng) for _ in range(4000)) / 4000
    assert np.abs(drawn - 0.4).max() < 0.04


@pytest.mark.parametrize("block", [2000, 10])
def test_mix(spark, block):
    rng = random.Random(3)
    rows = [(i, "big", rng.randrange(1, 40)) for i in range(600)] + [(1000 + i, "small", rng.randrange(1, 20)) for i in range(30)] + [(2000 + i, "mid", rng.randrange(1, 40)) for i in range(90)] + [(3000, None, 5), (3001, "other", 50), (3002, "big", 0), (3003, "big", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.2, 3), ("mid", 0.3, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    copies, report = mixing.mix(df, targets, 0.5, block=block)
    got = {r.source: r for r in report.collect()}
    assert {s for s, r in got.items() if r.short} == {"small", "absent"}
    for s in ("big", "mid"):
        assert abs(got[s].used - got[s].wanted) <= 40, got[s]
    assert got["small"].used == 3 * sum(t for _, s, t in rows if s == "small") and got["absent"].used == 0
    assert sum(r.actual_share for r in got.values()) == pytest.approx(1)
    counts = copies.groupBy("doc_id").count().where("count > 1").count()
    assert counts == 0 and copies.where("copies > 3").count() == 0
    exact = {r.source: r for r in mixing.mix(df, targets.where("source <> 'absent'"), 0.5, block=block, exact_shares=True)[1].collect()}
    assert not any(r.short for r in exact.values()) and all(abs(r.actual_share - r.target_share) < 0.03 for r in exact.values())
    nothing, zeros = mixing.mix(df.limit(0), targets, 0.5)
    assert nothing.count() == 0 and zeros.where("used > 0").count() == 0
