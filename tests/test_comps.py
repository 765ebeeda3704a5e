"""Compositions, set logic and mining against brute force."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchloom.operators import comps, containment, evolution, mining
from matchloom.operators.containment import canonical

PLAYERS = "game_version string, match_id string, puuid string, placement int, level int"
UNITS = "match_id string, puuid string, character_id string, slot_idx int, rarity int, tier int, items array<string>"
TRAITS = "match_id string, puuid string, trait_id string, num_units int, current_tier int, max_tier int, trait_style int"
NEEDS = {"T_X": [2, 4], "T_Y": [3], "T_Z": [1, 2]}
TRAITS_OF = {"T_A": ["T_X", "T_Z"], "T_B": ["T_X"], "T_C": ["T_Y"], "T_D": ["T_Y", "T_Q"]}


@pytest.fixture
def dims(spark):
    tiers = [(t, i + 1, n) for t, needs in NEEDS.items() for i, n in enumerate(needs)]
    return (
        spark.createDataFrame(list(TRAITS_OF.items()), "character_id string, traits array<string>"),
        spark.createDataFrame(tiers, "trait_id string, tier int, min_units int"),
        spark.createDataFrame([("XEmblem", "T_X")], "item_id string, trait_id string"),
    )


@pytest.fixture(params=["constant", "joined"])
def lookups(request, monkeypatch):
    """Run with dimensions as constants, and with dimensions taken as too long for that."""
    if request.param == "joined":
        monkeypatch.setattr(comps, "MAX_LOOKUP", 0)
    return request.param


def counts_of(units, bonus=()):
    traits = [t for u in units for t in TRAITS_OF.get("_".join(u.split("_")[:2]), [])] + list(bonus)
    return Counter(traits)


def legal(counts, ignore):
    return sum(n >= 2 and n not in NEEDS.get(t, []) for t, n in counts.items()) <= ignore


LISTS = [
    ["T_A_1", "T_B_1"],
    ["T_A_1", "T_A_1", "T_B_1"],
    ["T_C_1", "T_C_1", "T_D_2"],
    ["T_D_1", "T_D_1", "T_C_1", "T_A_1"],
    ["T_A_1", "T_A_1", "T_A_1", "T_B_1", "T_B_1"],
    ["T_Unknown_1"],
    [],
]


def test_legal_by_units(spark, dims, lookups):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(LISTS)], "i int, units array<string>")
    for ignore in (0, 1):
        got = comps.legal_by_units(df, "units", dims[0], dims[1], ignore).collect()
        assert {r.i: r.is_legal for r in got} == {i: legal(counts_of(u), ignore) for i, u in enumerate(LISTS)}


def test_legal_by_traits(spark, dims, lookups):
    lists = [["T_X_2_1"], ["T_X_3_1", "T_Y_1_0"], ["T_X_3_1", "T_Y_2_0"], ["T_Q_2_1"], ["T_X_3_1", "T_X_4_2"], []]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, traits array<string>")
    got = {r.i: r.is_legal for r in comps.legal_by_traits(df, "traits", dims[1], 0).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: True, 5: True}
    assert {r.i: r.is_legal for r in comps.legal_by_traits(df, "traits", dims[1]).collect()}[2] is False


def test_active_traits(spark, dims, lookups):
    bonus = [["T_Y"], [], ["T_X", "T_X"], [], [], ["T_Z"], []]
    rows = [(i, u, b) for i, (u, b) in enumerate(zip(LISTS, bonus))] + [(99, None, [])]
    df = spark.createDataFrame(rows, "i int, units array<string>, more array<string>")
    for column in (None, "more"):
        found = comps.active_traits(df, "units", dims[0], dims[1], bonus=column)
        for r in found.collect():
            if r.units is None:
                assert r.active_traits is None
                continue
            counts = counts_of(r.units, r.more if column else [])
            kept = [(t, n) for t, n in counts.items() if t in NEEDS and n >= NEEDS[t][0]]
            assert [tuple(t) for t in r.active_traits] == sorted(kept, key=lambda p: (-p[1], p[0]))


def test_build_comps(spark, dims, lookups):
    def unit(p, c, slot, items=(), rarity=1):
        return ("m", p, c, slot, rarity, 1 + slot % 2, list(items))

    units = [unit("fits", "T_B", 1, ["XEmblem", "it"]), unit("fits", "T_A", 0, ["LostEmblem"])]
    units += [unit("short", "T_A", 0)]
    units += [unit("big", "T_A", i) for i in range(50)]
    units += [unit("idle", "T_A", 0)]
    units += [unit("wrong", "T_A", 0)]
    units += [unit("gap", "T_A", 0), unit("gap", "T_B", 7), unit("gap", "T_None", 3, rarity=-1)]
    levels = {"fits": 2, "short": 2, "big": 3, "idle": 1, "wrong": 1, "gap": 2, "empty": 1}
    players = [("15.8", "m", p, i + 1, level) for i, (p, level) in enumerate(levels.items())]
    traits = [("m", p, "T_X", 2, 1, 2, 1) for p in levels if p not in ("idle", "wrong")]
    traits += [("m", "idle", "T_X", 1, 0, 2, 0), ("m", "fits", "T_Y", 1, 0, 1, 0), ("m", "fits", "T_Z", 1, 1, 2, 1)]
    traits += [("m", "wrong", t, 3, 1, 2, 1) for t in ("T_X", "T_Z")]
    built = comps.build_comps(
        spark.createDataFrame(players, PLAYERS),
        spark.createDataFrame(units, UNITS),
        spark.createDataFrame(traits, TRAITS),
        dims[1],
        dims[2],
    )
    rows = {r.puuid: r for r in built.collect()}
    assert set(rows) == {"fits", "gap"}
    fits = rows["fits"]
    assert fits.combine_units == ["T_A_1", "T_B_1"] and fits.combine_full_units == ["T_A_1_1", "T_B_1_2"]
    assert fits.combine_active_traits == ["T_X_2_1", "T_Z_1_1"]
    assert fits.combine_full_traits == ["T_X_2_1", "T_Z_1_1", "T_Y_1_0"]
    assert fits.has_emblem and fits.emblems == [None, "T_X"]
    assert not rows["gap"].has_emblem and rows["gap"].emblems == []


def random_comps(rnd, n, versions=("15.8", "15.9"), units="ABCDEF"):
    rows = []
    for i in range(n):
        level = rnd.randint(2, 5)
        picked = sorted((rnd.choice(units), rnd.randint(1, 3)) for _ in range(level))
        base = [f"T_{c}_{ord(c) % 3}" for c, _ in picked]
        full = [f"T_{c}_{ord(c) % 3}_{t}" for c, t in picked]
        order = sorted(range(level), key=lambda k: (int(base[k].split("_")[2]), base[k].split("_")[1], full[k][-1]))
        rows.append(
            (rnd.choice(versions), f"m{i % 40}", f"p{i}", rnd.randint(1, 8), level, [base[k] for k in order], [full[k] for k in order])
        )
    return rows


COMPS = (
    "game_version string, match_id string, puuid string, placement int, level int, combine_units array<string>, "
    "combine_full_units array<string>"
)


@pytest.mark.parametrize("seed", [1, 2])
def test_frequent_comps(spark, seed):
    rows = random_comps(random.Random(seed), 400)
    got = mining.frequent_comps(spark.createDataFrame(rows, COMPS), min_support=0.02, top=5).collect()
    mined = mining.frequent_itemsets_of_level(spark.createDataFrame(rows, COMPS), min_support=0.02, top=5).collect()
    assert sorted(map(str, got)) == sorted(map(str, mined))
    found: dict = {}
    for r in got:
        found.setdefault((r.game_version, r.level), []).append((r.support, tuple(sorted(r.itemsets))))
    for key in {(r[0], r[4]) for r in rows}:
        baskets = [frozenset(r[5]) for r in rows if (r[0], r[4]) == key]
        counts = Counter(b for b in baskets if len(b) == key[1])
        kept = {s: n for s, n in counts.items() if n >= math.ceil(0.02 * len(baskets))}
        supports = sorted((n / len(baskets) for n in kept.values()), reverse=True)[:5]
        assert [s for s, _ in found.get(key, [])] == pytest.approx(supports, abs=5e-5)
        for support, itemset in found.get(key, []):
            assert kept[frozenset(itemset)] / len(baskets) == pytest.approx(support, abs=5e-5)


def test_frequent_itemsets_of_groups_of_any_size(spark):
    rnd = random.Random(3)
    rows = [(g, sorted(rnd.sample("ABCDE", rnd.randint(1, 4)))) for g, n in (("x", 90), ("y", 7), ("z", 1)) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, items array<string>")
    got = {(r.g, tuple(r.itemsets)): r.freq for r in mining.frequent_itemsets(df, "items", ["g"], 0.1).collect()}
    want = {}
    for g in "xyz":
        baskets = [set(i) for k, i in rows if k == g]
        for k in range(1, 5):
            for s in itertools.combinations("ABCDE", k):
                n = sum(set(s) <= b for b in baskets)
                if n >= max(1, math.ceil(0.1 * len(baskets))):
                    want[g, s] = n
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_dedup_comps(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (rnd.choice("vw"), i, [f"U{u}" for u in rnd.sample(range(6), rnd.randint(1, 5))], rnd.randint(1, 9))
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "game_version string, pos int, itemsets array<string>, level int")
    kept: dict[str, list] = {"v": [], "w": []}
    for version, _, items, level in rows:
        if not any(set(k) <= set(items) for k, _ in kept[version]):
            kept[version].append((items, level))
    got = {(r.game_version, tuple(r.itemsets), r.level) for r in mining.dedup_comps(df, [F.col("pos")]).collect()}
    assert got == {(v, tuple(i), n) for v, ks in kept.items() for i, n in ks}


@pytest.mark.parametrize("max_sent", [100, 0])
def test_containing(spark, max_sent):
    rnd = random.Random(5)
    sets = {(v, tuple(sorted(rnd.sample("ABCDEFGH", rnd.randint(1, 6))))) for v in "vw" for _ in range(60)}
    items = {(v, tuple(sorted(rnd.sample("ABCDEFGH", rnd.randint(1, 3))))) for v in "vw" for _ in range(15)}
    s = spark.createDataFrame([(v, list(u)) for v, u in sets], "v string, unit_set array<string>")
    i = spark.createDataFrame([(f"{v}{''.join(u)}", v, list(u)) for v, u in items], "itemset_id string, v string, itemset array<string>")
    ready = containment.prepared(i, s, max_sent)
    assert containment.is_sent(ready) == (max_sent > 0)
    got = Counter((r.itemset_id, tuple(r.unit_set)) for r in containment.containing(ready, s, ["v"]).collect())
    want = Counter((f"{v}{''.join(u)}", x) for v, u in items for w, x in sets if v == w and set(u) <= set(x))
    assert got == want


def grown_by_hand(rows, itemset, level, last, version=None):
    taken, found = None, {}
    for lvl in range(level, last + 1):
        full = Counter(
            tuple(r[6])
            for r in rows
            if r[4] == lvl and set(itemset) <= set(r[5]) and (version is None or r[0] == version)
        )
        for candidate, _ in sorted(full.items(), key=lambda kv: (-kv[1], kv[0])):
            raised = [u[:-1] + "2" if u.endswith("_1") else u for u in candidate]
            base = {u.rsplit("_", 1)[0] for u in raised}
            if taken is None or taken <= base:
                found[lvl] = sorted(raised, key=lambda u: (int(u.split("_")[2]), u.split("_")[1], int(u.split("_")[3])))
                taken = base
                break
    return found


@pytest.mark.parametrize(("within", "max_sent"), [(False, 1000), (True, 1000), (False, 0)])
def test_comp_evolution(spark, within, max_sent):
    rows = random_comps(random.Random(7), 500)
    built = spark.createDataFrame(rows, COMPS)
    freq = mining.frequent_comps(built, min_support=0.001, top=4).filter(F.col("level") < 5)
    freq = freq.unionByName(
        spark.createDataFrame([("15.8", 2, ["T_A_2", "T_Nobody_1"], 0.1)], freq.schema)
    )
    catalog = evolution.comp_catalog(built)
    got = evolution.comp_evolution(catalog, freq, 2, 5, within_version=within, max_sent=max_sent).collect()
    assert len(got) == freq.count()
    for r in got:
        key = r.itemset_id
        want = grown_by_hand(rows, key["itemsets"], key["level"], 5, key["game_version"] if within else None)
        assert {n: r[f"level_{n}"] for n in range(2, 6)} == {n: want.get(n) for n in range(2, 6)}


def test_comp_stats(spark, dims):
    rows = random_comps(random.Random(8), 400, units="ABCD")
    built = spark.createDataFrame(rows, COMPS)
    freq = mining.frequent_comps(built, top=3)
    got = evolution.comp_stats(built, freq, dims[0], dims[1], (3, 4, 5), 5, with_key=True).collect()
    assert len(got) == freq.count()
    for r in got:
        held = [x for x in rows if x[0] == r.game_version and set(r.itemsets) <= set(x[5])]
        matches = len({x[1] for x in rows if x[0] == r.game_version})
        places = [x[3] for x in held]
        assert r.play_rate == pytest.approx(len(held) / matches, abs=0.0051)
        assert r.avg_place == pytest.approx(sum(places) / len(places), abs=0.0051)
        assert r.win == pytest.approx(sum(p == 1 for p in places) / len(places), abs=0.00051)
        grown = grown_by_hand(rows, r.itemsets, r.level, 5)
        for n in (3, 4, 5):
            assert r[f"level_{n}"] == grown.get(n)
            if grown.get(n) is None:
                assert r[f"level_{n}_traits"] is None
            else:
                counts = counts_of(grown[n])
                kept = [(t, c) for t, c in counts.items() if t in NEEDS and c >= NEEDS[t][0]]
                assert [tuple(t) for t in r[f"level_{n}_traits"]] == sorted(kept, key=lambda p: (-p[1], p[0]))
    columns = evolution.comp_stats(built, freq, dims[0], dims[1], last_level=9).columns
    levels = [c for n in (7, 8, 9) for c in (f"level_{n}", f"level_{n}_traits")]
    assert columns == ["game_version", *levels, "play_rate", "avg_place", "win", "top4"]


def test_subsets(spark):
    df = spark.createDataFrame([(["b", "a", "c", "a"],)], "x array<string>")
    got = df.select(containment.subsets(canonical(F.col("x"))).alias("s")).first().s
    want = [list(c) for k in (1, 2, 3) for c in itertools.combinations("abc", k)]
    assert sorted(got) == sorted(want)


def test_boards_above_every_level_are_no_compositions(spark, dims):
    """Nine units at level seven are not cut to seven, even where no player has a higher level."""
    players = spark.createDataFrame([("15.8", "m", "p", 1, 7), ("15.8", "m", "q", 2, 7)], PLAYERS)
    boards = [("m", p, "T_A", i, 1, 1, []) for p, n in (("p", 9), ("q", 7)) for i in range(n)]
    traits = spark.createDataFrame([("m", p, "T_X", 2, 1, 2, 1) for p in "pq"], TRAITS)
    built = comps.build_comps(players, spark.createDataFrame(boards, UNITS), traits, dims[1], dims[2])
    assert [r.puuid for r in built.collect()] == ["q"]


def test_a_tier_without_a_number_comes_last(spark, lookups):
    """The needs of a trait are in the same order whether its tiers are a constant or joined."""
    tiers = spark.createDataFrame([("T_X", 1, 2), ("T_X", None, 4), ("T_Y", None, 3), ("T_X", 2, 6)], "trait_id string, tier int, min_units int")
    units = spark.createDataFrame([("T_A", ["T_X"])], "character_id string, traits array<string>")
    lists = spark.createDataFrame([(n, ["T_A_1"] * n) for n in (2, 3, 4)], "n int, units array<string>")
    got = {r.n: r.active_traits for r in comps.active_traits(lists, "units", units, tiers).collect()}
    assert {n: [tuple(t) for t in found] for n, found in got.items()} == {n: [("T_X", n)] for n in (2, 3, 4)}
