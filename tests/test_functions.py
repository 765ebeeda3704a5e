from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matchloom.functions import boards
from matchloom.functions.literals import parse_failed, parse_literal
from matchloom.functions.scalars import flag, half_even, joined_key, major_minor, version_order
from matchloom.schemas import TRAIT_LIST


def one(spark, value, column, kind="array<string>"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("value", "digits", "want"),
    [(0.0125, 3, 0.012), (0.0005, 3, 0.0), (0.0625, 3, 0.062), (2.675, 2, 2.68), (4.5, 0, 4.0), (None, 2, None)],
)
def test_half_even(spark, value, digits, want):
    assert one(spark, value, lambda x: half_even(x, digits), "double") == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("Linux Version 15.7.672.4034 (x)", "15.7"), ("15.10.1.2", "15.10"), ("abc", None), ("15.7", None), (None, None)],
)
def test_major_minor(spark, text, want):
    assert one(spark, text, major_minor, "string") == want


def test_versions_sort_by_number_and_unknown_last(spark):
    rows = [("15.9",), (None,), ("15.10",), ("abc",), ("14.24",), ("15.8",)]
    got = [r[0] for r in spark.createDataFrame(rows, "game_version string").orderBy(*version_order()).collect()]
    assert got[:4] == ["14.24", "15.8", "15.9", "15.10"] and set(got[4:]) == {None, "abc"}


def test_flag_and_joined_key(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "p int, s string")
    rows = df.select(flag(F.col("p") == 1).alias("f"), joined_key(F.col("s"), F.col("p")).alias("k")).collect()
    assert [tuple(r) for r in rows] == [(1, "a_1"), (0, None)]


@pytest.mark.parametrize(
    ("items", "want"),
    [
        ([], ""),
        (None, ""),
        (["B", "A"], "A+B"),
        (["X_ThiefsGloves"], "X_ThiefsGloves"),
        (["Z", "X_ThiefsGloves", "A"], "X_ThiefsGloves"),
        (["X_ThiefsGloves", "A", "X_ThiefsGloves"], "A+X_ThiefsGloves+X_ThiefsGloves"),
        (["TFT9_Item_OrnnPrototypeForge", "A"], "TFT9_Item_OrnnPrototypeForge"),
    ],
)
def test_item_build(spark, items, want):
    assert one(spark, items, boards.item_build) == want


def test_unit_order(spark):
    units = ["T_B_2", "junk", "T_A_2", "T_Z_1", "T_A_x", "S_A_2"]
    assert one(spark, units, boards.sort_units) == ["T_Z_1", "T_A_2", "S_A_2", "T_B_2", "junk", "T_A_x"]
    full = ["T_A_2_3", "T_A_2", "T_A_2_1", "T_B_0_1"]
    assert one(spark, full, lambda x: boards.sort_units(x, tier=True)) == ["T_B_0_1", "T_A_2_1", "T_A_2_3", "T_A_2"]


def test_trait_order(spark):
    traits = ["T_A_2_1", "bad", "T_B_4_1", "T_C_4_2", "T_A_4_2"]
    assert one(spark, traits, boards.sort_traits) == ["T_A_4_2", "T_C_4_2", "T_B_4_1", "T_A_2_1", "bad"]


def test_projections(spark):
    full = ["T_A_2_1", "T_A_2_3", "T_B_4", "T_C_1_1"]
    assert one(spark, full, boards.unit_tiers) == [1, 3, 4, 1]
    assert one(spark, full, boards.without_tier) == ["T_A_2", "T_A_2", "T_B", "T_C_1"]
    assert one(spark, full, boards.normalise_tiers) == ["T_C_1_2", "T_A_2_2", "T_A_2_3", "T_B_4"]
    assert one(spark, "T_A_2_1", boards.id_prefix, "string") == "T_A"


def test_emblems(spark):
    assert one(spark, ["aEmblemItem", "b", "cEmblem"], boards.emblem_items) == ["aEmblemItem", "cEmblem"]
    assert one(spark, None, boards.emblem_items) == []
    assert one(spark, ["a"], boards.emblem_items) == []


LITERALS = [
    [{"name": "a: None, b", "num_units": 1, "style": None, "tier_current": 2, "tier_total": 3}],
    [{"name": "it's", "num_units": 1}],
    [{"name": 'it\'s "q"', "num_units": None}],
    [{"name": 'say "x", True', "num_units": 4}],
    [{"name": "back\\slash' \" None", "num_units": None}],
    [{"name": "tab\tnl\n \x07 é \x80 \\x41", "num_units": 5}],
    [{"name": "\\", "num_units": None}, {"name": "None", "num_units": 3}],
    [{"name": "😀 None", "num_units": None}],
    [{"name": "x" * 50_000 + "'" + ", None" * 2_000, "num_units": None}],
    [],
]


def test_literals_come_back_whole(spark):
    rows = spark.createDataFrame([(i, repr(v)) for i, v in enumerate(LITERALS)], "i int, t string")
    for r in rows.select("i", parse_literal(F.col("t"), TRAIT_LIST).alias("p")).collect():
        want = [{f: e.get(f) for f in TRAIT_LIST.elementType.names} for e in LITERALS[r.i]]
        assert [e.asDict() for e in r.p] == want


def test_bad_literals_are_reported(spark):
    rows = spark.createDataFrame([("junk",), ("[{'name': ",), ("[]",), (None,)], "t string")
    parsed = rows.withColumn("p", parse_literal(F.col("t"), TRAIT_LIST))
    got = {r.t: r.bad for r in parsed.select("t", parse_failed(F.col("t"), F.col("p")).alias("bad")).collect()}
    assert got == {"junk": True, "[{'name': ": True, "[]": False, None: False}
