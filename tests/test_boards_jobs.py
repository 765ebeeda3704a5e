"""Normalisation, board clean-up and exact work on heavy groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import acquire, normalise, quality, skew
from matchloom.schemas import MATCHES, RAW_MATCH, TRAIT_LIST, UNIT_LIST

M, S, A, B = "M", "S", "A", "B"
UNITS = "match_id string, puuid string, character_id string, slot_idx int, rarity int, tier int, items array<string>"


def board(name, *units):
    return [("m", name, c, i, 1, 1, ["i"] * n) for i, (c, n) in enumerate(units)]


def cleaned_by_hand(units):
    """The walk over one board, as a loop."""
    units = list(units)
    last = max((i for i, u in enumerate(units) if u[0] == M), default=None)
    if last is None:
        return units
    following = next((i for i in range(last + 1, len(units)) if units[i][0] != S), None)
    if following is not None:
        del units[following]
    elif sum(u[0] == M for u in units) >= 2 and units[last][1] == 1:
        del units[last]
    return units


EDGE = [
    [(A, 0), (B, 1)],
    [(A, 0), (M, 1)],
    [(M, 1), (A, 0), (B, 0)],
    [(M, 1), (S, 0), (S, 0), (A, 2), (B, 0)],
    [(M, 1), (S, 0)],
    [(M, 1), (A, 0), (M, 0)],
    [(M, 1), (A, 0), (M, 1)],
    [(M, 1), (A, 0), (M, 1), (S, 0)],
    [(M, 1), (A, 0), (M, 2)],
    [(M, 1), (M, 1), (A, 0), (B, 0)],
    [(M, 0), (M, 1)],
]


def result_of(df):
    found: dict[str, list] = {}
    for r in df.collect():
        found.setdefault(r.puuid, []).append((r.slot_idx, r.character_id, len(r["items"])))
    for rows in found.values():
        assert sorted(s for s, _, _ in rows) == list(range(len(rows)))
    return {k: [(c, n) for _, c, n in sorted(v)] for k, v in found.items()}


@pytest.mark.parametrize("hot_rows", [10**9, 4])
def test_clean_boards(spark, hot_rows):
    rnd = random.Random(1)
    boards = EDGE + [
        [(rnd.choice([M, S, A, B, A]), rnd.randint(0, 2)) for _ in range(rnd.randint(1, 9))] for _ in range(300)
    ]
    rows = [u for i, b in enumerate(boards) for u in board(str(i), *b)]
    rnd.shuffle(rows)
    units = spark.createDataFrame(rows, UNITS).repartition(5)
    got = result_of(normalise.clean_boards(units, M, [S], hot_rows=hot_rows, fraction=1.0))
    want = {str(i): cleaned_by_hand(b) for i, b in enumerate(boards)}
    assert got == {k: v for k, v in want.items() if v}


def test_clean_unit_lists(spark):
    from pyspark.sql import types as T

    rnd = random.Random(4)
    boards = EDGE + [[(rnd.choice([M, S, A, B]), rnd.randint(0, 2)) for _ in range(rnd.randint(1, 9))] for _ in range(300)]
    rows = [("m", str(i), [(c, ["i"] * n, "", 1, 1) for c, n in b]) for i, b in enumerate(boards)] + [("m", "none", None)]
    fields = [T.StructField(n, T.StringType()) for n in ("match_id", "puuid")]
    people = spark.createDataFrame(rows, T.StructType([*fields, T.StructField("units", UNIT_LIST)]))
    got = result_of(normalise.unit_rows(normalise.clean_unit_lists(people, M, [S])))
    assert got.pop("none") == [(normalise.NO_UNIT, 0)]
    assert got == {str(i): cleaned_by_hand(b) for i, b in enumerate(boards)}


@pytest.mark.parametrize("hot_rows", [10**9, 50, 1])
def test_number_rows_with_heavy_groups(spark, hot_rows):
    rnd = random.Random(2)
    rows = [("hot", rnd.randint(0, 5), "same") for _ in range(3000)]
    rows += [(f"k{rnd.randint(0, 40)}", rnd.randint(0, 9), rnd.choice("xyz")) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(7)
    numbered = skew.number_rows(df, ["k"], ["o", "v"], "n", hot_rows=hot_rows, fraction=1.0)
    got: dict[str, list] = {}
    for r in numbered.collect():
        got.setdefault(r.k, []).append((r.n, r.o, r.v))
    want: dict[str, list] = {}
    for k, o, v in rows:
        want.setdefault(k, []).append((o, v))
    assert set(got) == set(want)
    for k, rs in want.items():
        assert sorted(got[k]) == [(i, *ov) for i, ov in enumerate(sorted(rs))]


def test_heavy_keys_split_nothing_away(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    cold, hot = skew.split_heavy(df, ["k"], hot_rows=100, fraction=1.0)
    assert hot.select("k").distinct().collect()[0].k == 1
    assert cold.count() + hot.count() == 1000
    assert skew.split_heavy(df, ["k"])[1] is None


def test_sentinels_and_positions(spark):
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("match_id", T.StringType()),
            T.StructField("puuid", T.StringType()),
            T.StructField("traits", TRAIT_LIST),
            T.StructField("units", UNIT_LIST),
        ]
    )
    rows = [
        ("m", "none", [], None),
        ("m", "two", [("T", 2, 1, 1, 2)], [("A", ["x"], "", 1, 1), ("A", [], "", 1, 2)]),
    ]
    people = spark.createDataFrame(rows, schema)
    traits = {r.puuid: tuple(r)[2:] for r in normalise.trait_rows(people).collect()}
    assert traits == {"none": (normalise.NO_TRAIT, -1, -1, -1, -1), "two": ("T", 2, 1, 2, 1)}
    units = sorted(tuple(r)[1:] for r in normalise.unit_rows(people).collect())
    assert units == [
        ("none", normalise.NO_UNIT, 0, -1, -1, []),
        ("two", "A", 0, 1, 1, ["x"]),
        ("two", "A", 1, 1, 2, []),
    ]


def test_drop_summons_drops_unknown_ids(spark):
    df = spark.createDataFrame([("A",), ("TFT14_SummonLevel2",), (None,)], "character_id string")
    assert [r[0] for r in normalise.drop_summons(df).collect()] == ["A"]


@pytest.mark.parametrize(("first", "second", "third", "want"), [(3, 2, 9, 8), (6, 5, 9, 11), (1, 0, 2, 3), (8, 0, 4, 8)])
def test_seed_players(spark, first, second, third, want):
    def tier(n, name):
        return spark.range(n).select(F.lit(name).alias("tier"), F.col("id").alias("rank"))

    got = acquire.seed_players(tier(first, "a"), tier(second, "b"), tier(third, "c"), [F.asc("rank")], size=8)
    rows = got.collect()
    assert len(rows) == want
    assert sorted(r["rank"] for r in rows if r.tier == "c") == list(range(want - first - second))


def test_day_window_is_half_open(spark):
    stamps = ["2025-04-13 23:59:59", "2025-04-14 00:00:00", "2025-04-14 23:59:59.5", "2025-04-15 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("ts"))
    assert acquire.of_previous_day(df, "ts", F.lit("2025-04-15")).count() == 2


def test_flatten_raw_records(spark):
    participant = {f.name: None for f in RAW_MATCH["info"].dataType["participants"].dataType.elementType}
    rows = [
        ({"match_id": "a"}, {"queue_id": 1100, "game_datetime": 1, "participants": [{**participant, "puuid": "p", "companion": {"content_ID": "c"}}]}),
        ({"match_id": "b"}, {"queue_id": 1090, "participants": []}),
        ({"match_id": "c"}, None),
    ]
    raw = acquire.of_queue(spark.createDataFrame(rows, RAW_MATCH))
    assert [r.match_id for r in acquire.match_headers(raw).collect()] == ["a"]
    people = acquire.match_participants(raw).collect()
    assert [(r.match_id, r.puuid, r.companion) for r in people] == [("a", "p", "c")]
    assert len(people[0]) == 14


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert [tuple(r) for r in quality.key_violations(df, ["k", "v"]).collect()] == [(1, "a", 2)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in quality.orphans(df, parent, ["k"]).collect()] == [(2, 1)]
    assert {tuple(r) for r in quality.wrong_group_sizes(df, ["v"], 1).collect()} == {("a", 2)}
    drift = quality.schema_drift(spark.createDataFrame([("m", 1)], "match_id string, extra int"), MATCHES)
    assert drift["added"] == ["extra"] and "game_version" in drift["missing"]
