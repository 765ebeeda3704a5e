"""Edge cases of the outcome statistics, worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matchloom.operators import outcome, report

PLAYERS = "game_version string, match_id string, puuid string, placement int, level int"
UNITS = (
    "game_version string, match_id string, puuid string, character_id string, slot_idx int, rarity int, tier int, "
    "items array<string>"
)
TRAITS = (
    "game_version string, match_id string, puuid string, trait_id string, num_units int, current_tier int, "
    "max_tier int, trait_style int"
)


def players(spark, placements):
    rows = [("15.8", f"m{i // 8}", f"p{i}", p, 5) for i, p in enumerate(placements)]
    return spark.createDataFrame(rows, PLAYERS)


def units(spark, rows):
    full = [("15.8", f"m{i // 8}", f"p{i}", c, s, r, 1, items) for s, (i, c, r, items) in enumerate(rows)]
    return spark.createDataFrame(full, UNITS)


def test_unknown_placement_counts_in_rates_only(spark):
    frame = outcome.outcome_stats(players(spark, [1, 4, None, 8]).withColumn("k", F.lit("x")), ["k"])
    row = frame.first()
    assert (row.avg_place, row.frequency, row.win, row.top4) == (13 / 3, 3, 0.25, 0.5)


def test_unit_without_participant_keeps_its_row(spark):
    facts = units(spark, [(0, "A", 1, []), (9, "A", 1, [])])
    row = outcome.unit_stats(players(spark, [2]), facts).first()
    assert (row.frequency, row.avg_place, row.win, row.top4) == (round(1 / 16, 3), 2.0, 0.0, 0.5)


def test_null_keys_and_sentinels_are_left_out(spark):
    facts = units(spark, [(0, "A", 1, []), (1, None, 1, []), (2, "N", -1, [])])
    assert [r.character_id for r in outcome.unit_stats(players(spark, [1, 2, 3]), facts).collect()] == ["A"]


@pytest.mark.parametrize(("count", "rows"), [(9, 0), (10, 1)])
def test_builds_need_ten(spark, count, rows):
    facts = units(spark, [(i, "A", 1, ["x", "y"]) for i in range(count)] + [(i, "A", 1, []) for i in range(count, 16)])
    got = outcome.item_build_stats(players(spark, [1, 8] * 8), facts).collect()
    assert len(got) == rows
    if rows:
        assert (got[0].item_build, got[0].frequency, got[0].avg_place, got[0].avg_delta) == ("x+y", 0.625, 4.5, 0.0)


def test_trait_with_two_spans_fans_out(spark):
    rows = [("15.8", "m0", f"p{i}", "T", 3, 1, 2 + i % 2, 1) for i in range(8)]
    rows += [("15.8", "m0", "p0", "U", 1, 0, 2, 0), ("15.8", "m0", "p1", "TFT_NoneTrait", -1, -1, -1, -1)]
    tiers = spark.createDataFrame([("T", 2, 5)], "trait_id string, tier int, min_units int")
    got = outcome.trait_stats(players(spark, range(1, 9)), spark.createDataFrame(rows, TRAITS), tiers).collect()
    assert [(r.trait_id, r.max_tier, r.min_units_required, r.play_rate, r.avg_place) for r in got] == [
        ("T", 2, 0, 8.0, 4.5),
        ("T", 3, 0, 8.0, 4.5),
    ]


def test_carriers_at_one_percent_and_top_ten(spark):
    rows = [(i, "A", 1, ["x"]) for i in range(188)]
    rows += [(188, "B", 1, ["x"]), (189, "B", 1, ["x"])] + [(190, f"C{c}", 1, ["x"]) for c in range(10)]
    got = outcome.item_top_carriers(players(spark, [1 + i % 8 for i in range(200)]), units(spark, rows)).collect()
    assert [(r["rank"], r.character_id, r.frequency) for r in got] == [(1, "A", 0.94), (2, "B", 0.01)]

    many = [(i, f"U{i % 11:02d}", 1, ["x"]) for i in range(22)]
    got = outcome.item_top_carriers(players(spark, [1] * 24), units(spark, many)).collect()
    assert [r.character_id for r in sorted(got, key=lambda r: r["rank"])] == [f"U{i:02d}" for i in range(10)]


def test_unit_with_two_rarities_is_listed_twice(spark):
    rows = [(0, "A", 1, ["x"]), (1, "A", 2, ["x"])]
    got = outcome.item_top_carriers(players(spark, [1, 8]), units(spark, rows)).collect()
    assert [(r.character_id, r.frequency, r.unit_avg_delta) for r in sorted(got, key=lambda r: r["rank"])] == [
        ("A", 1.0, 3.5),
        ("A", 1.0, -3.5),
    ]


ITEM_TYPES = {
    "TFT_Item_EmptyBag": "EmptyBag",
    "EmptyBag": "EmptyBag",
    "TFT_Item_Spatula": "Component",
    "TFT5_Item_TrapClawRadiant": "Radiant",
    "TFT9_Item_OrnnPrototypeForge": "Artifact",
    "TFT5_Item_ZzRotPortalRadiant": "Support",
    "TFT14_ZeriCyberneticItem": "ExotechItem",
    "TFT14_ZeriCyberneticItem_Radiant": "ExotechRadiantItem",
    "TFT14_Item_AnyEmblemItem": "Emblem",
    "TFT_Item_Unheard": "Craftable",
}


def test_item_types(spark):
    df = spark.createDataFrame([(i,) for i in ITEM_TYPES], "i string")
    assert {r.i: r.t for r in df.select("i", outcome.item_type(F.col("i")).alias("t")).collect()} == ITEM_TYPES
    sizes = [len(x) for x in (outcome.COMPONENT_ITEMS, outcome.RADIANT_ITEMS, outcome.ARTIFACT_ITEMS)]
    assert sizes == [10, 36, 30]
    assert [len(x) for x in (outcome.SUPPORT_ITEMS, outcome.EXOTECH_ITEMS, outcome.EXOTECH_RADIANT_ITEMS)] == [17, 7, 7]


def test_items_in_report_order(spark):
    rows = [(i, "A", 1, [item]) for i, item in enumerate(ITEM_TYPES)]
    got = outcome.item_stats(players(spark, [1] * 16), units(spark, rows)).collect()
    kinds = ["Craftable", "Emblem", "Radiant", "Artifact", "Support", "ExotechItem", "ExotechRadiantItem"]
    assert [r.type for r in got] == kinds
    assert got[0].top_units[0].character_id == "A" and "rank" not in got[0].top_units[0].asDict()


def test_frames_with_and_without_version_agree(spark):
    people = players(spark, [1 + i % 8 for i in range(40)])
    facts = units(spark, [(i % 40, "ABC"[i % 3], i % 2, ["x", "y"][: i % 3]) for i in range(200)])
    bare = facts.drop("game_version")
    for job in (outcome.unit_stats, outcome.item_build_stats, outcome.item_stats, outcome.item_top_carriers):
        assert sorted(map(str, job(people, facts).collect())) == sorted(map(str, job(people, bare).collect()))


def test_report_tables(spark):
    rows = [("15.8", "A", 0.4, 4.0), ("15.9", "A", 0.5, 4.25), ("15.9", "B", 1.5, 5.0)]
    stats = spark.createDataFrame(rows, "game_version string, id string, play_rate double, avg_place double")
    got = {r.id: r for r in report.version_comparison(stats, ["id"], ["play_rate"], "15.8", "15.9").collect()}
    assert got["A"].play_rate_change == 0.1 and got["B"].play_rate_old is None and got["B"].play_rate_change is None
    flags = {(r.game_version, r.id): (r.overpowered, r.better) for r in report.with_flags(stats).collect()}
    assert flags == {("15.8", "A"): (False, True), ("15.9", "A"): (False, True), ("15.9", "B"): (True, False)}
