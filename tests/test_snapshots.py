"""What readers see of loads, and what bucketed files spare."""

from __future__ import annotations

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F
from test_plans import no_broadcast, plan  # noqa: F401

from matchloom.operators import comps, containment, mining, normalise, outcome
from matchloom.plans import queries
from matchloom.sources import frames, sample, snapshots, tables
from test_tables import counts, land, match

SF_DIR = "/root/testdata/sf0.001"
DAYS = [datetime.date(2024, 1, d) for d in (1, 2, 3)]


def headers(spark, ids, day):
    rows = spark.createDataFrame([(i,) for i in ids], "match_id string").withColumn("run_date", F.lit(day).cast("date"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in tables.TABLES["matches"].fields if f.name != "match_id"]
    return rows.select("match_id", *missing, "run_date")


def held(spark, root, name="matches"):
    return sorted(r.match_id for r in tables.read_table(spark, root, name).collect())


def test_readers_see_a_load_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    landed_root, root = land(spark, tmp_path, match("a"), match("b", 15))
    write, seen = tables.write_table, []

    def looking(df, root_, name):
        write(df, root_, name)
        seen.append({n: tables.read_table(spark, root, n).count() for n in tables.TABLES} | {"dates": tables.read_ledger(spark, root).count()})

    monkeypatch.setattr(tables, "write_table", looking)
    tables.load_pending(spark, landed_root, root)
    nothing = dict.fromkeys([*tables.TABLES, "dates"], 0)
    assert seen == [nothing] * 4
    whole = {n: tables.read_table(spark, root, n).count() for n in tables.TABLES} | {"dates": tables.read_ledger(spark, root).count()}
    assert whole == {"matches": 2, "participants": 4, "traits": 4, "units": 6, "dates": 2}


def test_a_stopped_load_is_never_seen(spark, tmp_path, monkeypatch):
    landed_root, root = land(spark, tmp_path, match("a"))
    before = tables.load_pending(spark, landed_root, root).count()
    land(spark, tmp_path, match("b", 15), match("c", 16))
    write = tables.write_table

    def failing(df, root_, name):
        if name == "traits":
            raise RuntimeError("lost")
        write(df, root_, name)

    reader = tables.read_table(spark, root, "matches")
    monkeypatch.setattr(tables, "write_table", failing)
    with pytest.raises(RuntimeError):
        tables.load_pending(spark, landed_root, root)
    assert before == 4 and held(spark, root) == ["a"] and tables.read_ledger(spark, root).count() == 1
    monkeypatch.setattr(tables, "write_table", write)
    tables.load_pending(spark, landed_root, root)
    assert held(spark, root) == ["a", "b", "c"]
    assert [r.match_id for r in reader.collect()] == ["a"]  # a frame stays what it was


def test_counts_of_a_load_are_those_of_its_jobs(spark, tmp_path):
    landed_root, root = land(spark, tmp_path, match("a"), match("b"), match("c", 15))
    got = counts(tables.load_pending(spark, landed_root, root))
    again = {(r.table_name, r.run_date): r.n_rows for r in tables.audit_counts({n: tables.read_table(spark, root, n) for n in tables.TABLES}).collect()}
    assert got == again and len(got) == 8


def test_commits_replace_add_and_compact(spark, tmp_path):
    root = str(tmp_path / "tables")
    tables.write_table(headers(spark, "ab", DAYS[0]), root, "matches")
    tables.write_table(headers(spark, "cd", DAYS[1]), root, "matches")
    tables.write_table(headers(spark, "e", DAYS[0]), root, "matches")  # in place of a and b
    assert held(spark, root) == ["c", "d", "e"]
    for one in "fgh":
        commit = snapshots.Commit(spark, root, [DAYS[0], None])
        rows = headers(spark, one, DAYS[0]).unionByName(headers(spark, one.upper(), None))
        tables.write_all({"matches": rows}, commit)
        assert one not in held(spark, root)
        commit.publish(replaces=False)
    everything = ["F", "G", "H", "c", "d", "e", "f", "g", "h"]
    assert held(spark, root) == everything
    assert held(spark, root) == sorted(r.match_id for r in snapshots.read(spark, root, "matches", tables.TABLES["matches"], bucketed=False).collect())
    old = tables.read_table(spark, root, "matches")
    assert tables.compact(spark, root, most=2) == 2  # the first day and the rows without one
    assert held(spark, root) == everything and sorted(r.match_id for r in old.collect()) == everything
    live = {(r.table_name, r.run_date): r.n for r in snapshots.live(spark, root).filter("n_rows > 0").groupBy("table_name", "run_date").agg(F.count("*").alias("n")).collect()}
    assert set(live.values()) == {1} and tables.compact(spark, root, most=2) == 0
    assert [r.loaded_date for r in tables.read_ledger(spark, root).collect()] == [DAYS[0]]


def test_rows_of_other_dates_are_refused(spark, tmp_path):
    root = str(tmp_path / "tables")
    commit = snapshots.Commit(spark, root, [DAYS[0]])
    tables.write_all({"matches": headers(spark, "ab", DAYS[1])}, commit)
    with pytest.raises(ValueError, match="other dates"):
        commit.publish(replaces=True)


def scans(text, name):
    return len(re.findall(rf"Location: \w+ ?(?:\(\d+ paths\))?\[[^\]]*/{name}[\]/]", text))


@pytest.fixture(scope="module")
def store(spark):
    return queries.stored(spark, SF_DIR)


def test_stored_boards_are_not_shuffled(spark, store, no_broadcast):  # noqa: F811
    people = frames.load_participants(store["participants"], store["matches"])
    units = frames.load_units(store["units"], store["participants"], store["matches"], summons=sample.SUMMONS, slot_order=sample.SLOT_ORDER)
    built = comps.build_comps(people, normalise.drop_summons(store["units"], sample.SUMMONS), store["traits"], sample.trait_tiers(spark), sample.emblem_traits(spark))
    for df in (people, units, built):
        text = plan(df)
        assert "Bucketed: true" in text and "Exchange" not in text


@pytest.mark.parametrize("kind", ["units", "traits", "items"])
def test_statistics_scan_each_table_once_and_shuffle_tallies_alone(spark, store, no_broadcast, monkeypatch, kind):  # noqa: F811
    people = frames.load_participants(store["participants"], store["matches"])
    plans = []

    def look(df, name, partition_by=None):
        plans.append(plan(df))
        return spark.createDataFrame([], df.schema)

    monkeypatch.setattr(outcome, "staged", look)
    units = store["units"].withColumn("game_version", F.lit("15.8"))
    if kind == "units":
        text = plan(outcome.tally_and_matches(outcome.placed(outcome._valid_units(units), people), outcome.UNIT))
        assert scans(plan(outcome.unit_stats(people, units)), "units") == 1
    elif kind == "traits":
        outcome.trait_stats(people, store["traits"].withColumn("game_version", F.lit("15.8")), sample.trait_tiers(spark))
        text = plans[0]
    else:
        outcome.item_stats(people, units)
        text = plans[0]
    table = "traits" if kind == "traits" else "units"
    assert (scans(text, table), scans(text, "participants"), scans(text, "matches")) == (1, 1, 1)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_subset_joins_of_long_sets(spark):
    """Sets of forty units, of which there are 2^40 subsets."""
    rnd = random.Random(4)
    units = [f"U{i:02}" for i in range(60)]
    sets = [sorted(rnd.sample(units, 40)) for _ in range(300)]
    items = [sorted(rnd.sample(units, rnd.choice((1, 2, 3, 8)))) for _ in range(80)] + [s[:30] for s in sets[:20]] + sets[20:30]
    s = spark.createDataFrame([("v", u) for u in sets], "v string, unit_set array<string>")
    i = spark.createDataFrame([(k, "v", u) for k, u in enumerate(items)], "itemset_id int, v string, itemset array<string>")
    want = sorted((k, tuple(x)) for k, u in enumerate(items) for x in sets if set(u) <= set(x))
    for max_sent in (1000, 0):
        got = containment.containing(containment.prepared(i, s, max_sent), s, ["v"])
        assert sorted((r.itemset_id, tuple(r.unit_set)) for r in got.collect()) == want
    rows = [("v", k, u, 1) for k, u in enumerate(items + sets)]
    df = spark.createDataFrame(rows, "game_version string, pos int, itemsets array<string>, level int")
    kept = []
    for _, _, u, _ in rows:
        if not any(set(k) <= set(u) for k in kept):
            kept.append(u)
    assert sorted(r.itemsets for r in mining.dedup_comps(df, [F.col("pos")]).collect()) == sorted(kept)
