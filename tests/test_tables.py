"""Landing, loading, reference data and streams in a temporary folder."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from matchloom.operators import acquire
from matchloom.plans import queries
from matchloom.schemas import RAW_PARTICIPANT
from matchloom.sources import dims, landed, sample, tables
from matchloom.streaming import landing

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DAY = {n: datetime.date(2025, 4, n) for n in (14, 15, 16)}
HEADER = "match_id,puuid,name,tagline,placement,level,traits,units,total_damages,player_eliminated,time_eliminated,last_round,gold_left,companion"


def match(match_id, day=14, people=2, queue=1100):
    start = int(datetime.datetime(2025, 4, day, 10, tzinfo=datetime.timezone.utc).timestamp() * 1000)
    units = [
        {"character_id": "TFT14_Viego", "itemNames": ["a"], "name": "", "rarity": 4, "tier": 1},
        {"character_id": "TFT14_Jax", "itemNames": [], "name": "", "rarity": 0, "tier": 2},
        {"character_id": "TFT14_Zed", "itemNames": ["b", "c"], "name": "", "rarity": 4, "tier": 1},
    ]
    traits = [{"name": "T", "num_units": 2, "style": 1, "tier_current": 1, "tier_total": 2}]
    participants = [
        {
            "puuid": f"{match_id}-{i}", "riotIdGameName": 'O\'N "x", y', "riotIdTagline": "EU", "placement": i + 1, "level": 3,
            "traits": traits if i else [], "units": units if i else [], "total_damage_to_players": 10,
            "players_eliminated": 1, "time_eliminated": 9.5, "last_round": 30, "gold_left": 2,
            "companion": {"content_ID": "c"},
        }
        for i in range(people)
    ]
    return {
        "metadata": {"match_id": match_id},
        "info": {
            "queue_id": queue, "game_datetime": start, "game_length": 2000.5, "game_version": "Version 15.8.1.2 (x)",
            "tft_set_number": 14, "participants": participants,
        },
    }


def drop(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def land(spark, root, *records):
    drop(root / "json", f"{len(list((root / 'json').glob('*')))}.json", *records)
    raw = acquire.of_queue(landed.read_raw_matches(spark, str(root / "json")))
    raw = raw.withColumn("run_date", F.to_date(F.timestamp_millis("info.game_datetime")))
    headers = acquire.match_headers(raw).withColumn("run_date", F.to_date(F.timestamp_millis("game_datetime")))
    landed.write_landed(acquire.match_participants(raw, ["run_date"]), str(root / "landed"), "participants")
    landed.write_landed(headers, str(root / "landed"), "matches")
    return str(root / "landed"), str(root / "tables")


def counts(df):
    return {(r.table_name, r.run_date): r.n_rows for r in df.collect()}


def test_load_twice_and_add_a_day(spark, tmp_path):
    landed_root, table_root = land(spark, tmp_path, match("a"), match("b", 15), match("x", 15, queue=1090))
    first = counts(tables.load_pending(spark, landed_root, table_root))
    assert first == {
        ("matches", DAY[14]): 1, ("participants", DAY[14]): 2, ("traits", DAY[14]): 2, ("units", DAY[14]): 3,
        ("matches", DAY[15]): 1, ("participants", DAY[15]): 2, ("traits", DAY[15]): 2, ("units", DAY[15]): 3,
    }
    assert counts(tables.load_pending(spark, landed_root, table_root)) == {}
    assert tables.read_table(spark, table_root, "units").count() == 6
    land(spark, tmp_path, match("c", 16))
    assert set(counts(tables.load_pending(spark, landed_root, table_root))) == {
        (n, DAY[16]) for n in tables.TABLES
    }
    ledger = tables.read_ledger(spark, table_root)
    assert sorted(r.loaded_date for r in ledger.collect()) == list(DAY.values())

    units = {(r.puuid, r.slot_idx): (r.character_id, r["items"]) for r in tables.read_table(spark, table_root, "units").collect()}
    # The unit after the marker is gone and the slots have closed up.
    assert units["a-1", 0] == ("TFT14_Viego", ["a"]) and units["a-1", 1] == ("TFT14_Zed", ["b", "c"])
    assert units["a-0", 0] == ("TFT_NoneUnit", [])
    person = tables.read_table(spark, table_root, "participants").filter("puuid = 'a-1'").first()
    assert (person.player_name, person.placement, person.companion) == ('O\'N "x", y', 2, "c")
    header = tables.read_table(spark, table_root, "matches").filter("match_id = 'a'").first()
    assert header.game_version == "15.8" and header.game_datetime == datetime.datetime(2025, 4, 14, 10)


def test_a_load_that_stops_midway_is_repeated_whole(spark, tmp_path, monkeypatch):
    landed_root, table_root = land(spark, tmp_path, match("a"))
    write = tables.write_table

    def failing(df, root, name):
        if name == "units":
            raise RuntimeError("lost")
        write(df, root, name)

    monkeypatch.setattr(tables, "write_table", failing)
    with pytest.raises(RuntimeError):
        tables.load_pending(spark, landed_root, table_root)
    assert tables.read_ledger(spark, table_root).count() == 0
    monkeypatch.setattr(tables, "write_table", write)
    tables.load_pending(spark, landed_root, table_root)
    assert {n: tables.read_table(spark, table_root, n).count() for n in tables.TABLES} == {
        "matches": 1, "participants": 2, "traits": 2, "units": 3,
    }


def dated(tmp_path, traits):
    folder = tmp_path / "raw" / "2025-04-14"
    folder.mkdir(parents=True)
    quoted = traits.replace('"', '""')
    row = f'a,p,n,t,1,3,"{quoted}","[]",1,0,1.5,30,0,c'
    (folder / "participants.csv").write_text(f"{HEADER}\n{row}\n")
    (folder / "matches.csv").write_text(
        "match_id,game_datetime,game_length,game_version,tft_set_number\na,1744624800000,2000.5,Version 15.8.1.2,14\n"
    )
    return str(tmp_path / "raw"), str(tmp_path / "tables")


def test_folders_by_date_with_literals(spark, tmp_path):
    trait = [{"name": "it's \"T\"", "num_units": 2, "style": None, "tier_current": 1, "tier_total": 2}]
    landed_root, table_root = dated(tmp_path, repr(trait))
    loaded = counts(tables.load_pending(spark, landed_root, table_root, dated_folders=True))
    assert loaded == {(n, DAY[14]): 1 for n in tables.TABLES}
    row = tables.read_table(spark, table_root, "traits").first()
    assert (row.trait_id, row.num_units, row.trait_style) == ("it's \"T\"", 2, None)
    assert tables.read_table(spark, table_root, "units").first().character_id == "TFT_NoneUnit"


def test_text_that_does_not_parse_fails_the_load(spark, tmp_path):
    landed_root, table_root = dated(tmp_path, "[{'name': oops")
    with pytest.raises(tables.LoadError):
        tables.load_pending(spark, landed_root, table_root, dated_folders=True)
    assert tables.read_ledger(spark, table_root).count() == 0


def test_bad_raw_records_are_kept_apart(spark, tmp_path):
    drop(tmp_path, "a.json", match("a"))
    (tmp_path / "b.json").write_text("{broken\n")
    raw = landed.read_raw_matches(spark, str(tmp_path))
    assert [r._corrupt_record for r in raw.cache().collect() if r.metadata is None] == ["{broken"]
    raw.unpersist()


def test_reference_documents(spark, tmp_path):
    sets = {
        "sets": {
            "13": {
                "champions": [{"apiName": "A", "name": "a", "traits": ["Old"]}, {"apiName": "Z", "traits": []}],
                "traits": [{"apiName": "T", "name": "Tee", "effects": [{"minUnits": 9}]}],
            },
            "14": {
                "champions": [{"apiName": "A", "name": "a", "traits": ["Tee", "Nameless"]}, {"apiName": "B", "traits": []}],
                "traits": [{"apiName": "T", "name": "Tee", "effects": [{"minUnits": 2}, {"minUnits": 4}]}],
            },
        }
    }
    names = {"data": {"1": {"id": "T", "name": "Tee"}, "2": {"id": "S", "name": "Ess"}}}
    items = {"data": {k: {"id": k, "name": v} for k, v in {"XEmblemItem": "Tee Emblem", "YEmblem": "Crown", "Z": "Tee Emblem"}.items()}}
    for name, body in (("sets", sets), ("names", names), ("items", items)):
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=1))
    read = dims.read_sets(spark, str(tmp_path / "sets.json"))
    trait_names = dims.read_names(spark, str(tmp_path / "names.json"))
    traits = spark.createDataFrame([("T",)], "trait_id string")
    known = dims.of_facts(trait_names, traits, "trait_id")
    units = spark.createDataFrame([("A",), ("B",), ("A",)], "character_id string")
    unit_names = spark.createDataFrame([(0, "A", "Old"), (1, "A", "Ay")], "position int, id string, name string")
    found = {r.character_id: (r.name, r.traits) for r in dims.unit_dimension(read, units, unit_names, known).collect()}
    assert found == {"A": ("Ay", ["T", None]), "B": (None, [])}
    tiers = sorted(tuple(r) for r in dims.trait_dimension(read, traits, known).collect())
    assert tiers == [("T", "Tee", 1, 2), ("T", "Tee", 2, 4)]
    emblems = dims.emblem_dimension(dims.read_names(spark, str(tmp_path / "items.json")), known)
    assert {tuple(r) for r in emblems.collect()} == {("XEmblemItem", "T"), ("YEmblem", None)}
    versions = spark.createDataFrame([("15.10",), ("15.9",), (None,)], "game_version string")
    assert dims.reference_version(versions).first()[0] == "15.9.1"


def test_stream_loads_each_match_once(spark, tmp_path):
    source, root, check = tmp_path / "in", str(tmp_path / "tables"), str(tmp_path / "check")
    drop(source, "1.json", match("a"), match("a"), match("x", queue=1090))
    landing.load_matches_stream(spark, str(source), root, check)
    drop(source, "2.json", match("a"), match("b", 15))
    landing.load_matches_stream(spark, str(source), root, check)
    got = {n: spark.read.parquet(f"{root}/{n}").count() for n in tables.TABLES}
    assert got == {"matches": 2, "participants": 4, "traits": 4, "units": 6}
    landing.load_matches_stream(spark, str(source), root, check)
    assert spark.read.parquet(f"{root}/matches").count() == 2


def test_stream_keeps_earlier_matches_without_a_date(spark, tmp_path):
    source, root, check = tmp_path / "in", str(tmp_path / "tables"), str(tmp_path / "check")

    def undated(match_id):
        record = match(match_id)
        record["info"]["game_datetime"] = None
        return record

    drop(source, "1.json", undated("a"))
    landing.load_matches_stream(spark, str(source), root, check)
    drop(source, "2.json", undated("a"), undated("b"), match("c"))
    landing.load_matches_stream(spark, str(source), root, check)
    got = {n: tables.read_table(spark, root, n).count() for n in tables.TABLES}
    assert got == {"matches": 3, "participants": 6, "traits": 6, "units": 9}
    assert [r.loaded_date for r in tables.read_ledger(spark, root).collect()] == [DAY[14]]


def test_stream_and_batch_load_share_tables(spark, tmp_path, monkeypatch):
    source, root, check = tmp_path / "in", str(tmp_path / "tables"), str(tmp_path / "check")
    drop(source, "1.json", match("a"), match("b"))
    write = tables.write_table

    def failing(df, root_, name):
        if name == "matches":
            raise RuntimeError("lost")
        write(df, root_, name)

    monkeypatch.setattr(tables, "write_table", failing)
    with pytest.raises(Exception, match="lost"):
        landing.load_matches_stream(spark, str(source), root, check)
    monkeypatch.setattr(tables, "write_table", write)
    landing.load_matches_stream(spark, str(source), root, check)
    drop(source, "2.json", match("b"), match("c"))
    landing.load_matches_stream(spark, str(source), root, check)
    assert {n: tables.read_table(spark, root, n).count() for n in tables.TABLES} == {"matches": 3, "participants": 6, "traits": 6, "units": 9}
    landed_root, _ = land(spark, tmp_path, match("d", 14), match("e", 15))
    loaded = counts(tables.load_pending(spark, landed_root, root))
    assert {d for _, d in loaded} == {DAY[15]}  # the stream entered the other date
    assert sorted(r.loaded_date for r in tables.read_ledger(spark, root).collect()) == [DAY[14], DAY[15]]


def test_a_bad_day_stays_alone_and_columns_go_by_name(spark, tmp_path):
    landed_root, table_root = land(spark, tmp_path, match("a"), match("b", 15), match("c", 16))
    lines = "match_id,puuid,placement\na,p,1\n"
    folder = tmp_path / "landed" / "participants" / "run_date=2025-04-15"
    for old in folder.glob("*.csv"):
        old.write_text(lines)
        next(folder.glob(f".{old.name}.crc")).unlink()
    folder = tmp_path / "landed" / "matches" / "run_date=2025-04-14"
    for old in folder.glob("*.csv"):
        old.write_text("game_length,game_datetime,match_id,tft_set_number,game_version\n7.5,1744624800000,a,14,Version 15.8.1.2\n")
        next(folder.glob(f".{old.name}.crc")).unlink()
    with pytest.raises(tables.LoadError):
        tables.load_pending(spark, landed_root, table_root)
    assert sorted(r.loaded_date for r in tables.read_ledger(spark, table_root).collect()) == [DAY[14], DAY[16]]
    assert [r.run_date for r in tables.rejected_dates(spark, table_root).collect()] == [DAY[15]]
    row = tables.read_table(spark, table_root, "matches").filter("match_id = 'a'").first()
    assert (row.game_duration, row.game_datetime) == (7.5, datetime.datetime(2025, 4, 14, 10))


def test_wrong_values_and_keys_are_named(spark, tmp_path):
    root = str(tmp_path)
    people = landed.typed(spark.createDataFrame([], HEADER.replace(",", " string, ") + " string, run_date date"), "participants")
    rows = [("a", "p", 14, []), ("a", "p", 14, []), ("a", "q", 14, ["placement"]), ("b", "p", 15, []), ("a", "r", 15, []), ("c", None, 16, [])]
    data = spark.createDataFrame([(m, p, DAY[d], b) for m, p, d, b in rows], "match_id string, puuid string, run_date date, bad array<string>")
    people = people.unionByName(data, allowMissingColumns=True)
    heads = spark.createDataFrame([("a", DAY[14], []), ("a", DAY[15], []), ("c", DAY[16], [])], "match_id string, run_date date, bad array<string>")
    got = {(r.run_date.day, r.problem): r.n_rows for r in tables._problems(spark, people, heads, root).collect()}
    assert got == {
        (14, "participants that do not parse"): 1, (14, "participants with repeated keys"): 2, (16, "participants without a key"): 1,
        (15, "matches of an earlier day"): 1, (15, "participants without a match"): 1,
    }


def test_only_folders_of_pending_dates_are_read(spark, tmp_path):
    landed_root, _ = land(spark, tmp_path, match("a"), match("b", 15))
    path = landed.day_path(landed_root, "matches", DAY[15])
    day = landed.read_day(spark, path, landed.header_of(spark, path), DAY[15])
    assert [r.match_id for r in day.collect()] == ["b"] and all("run_date=2025-04-15" in f for f in day.inputFiles())


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from matchloom import session

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_stream_drops_repeats_within_watermark(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = landing.raw_match_stream(spark, str(source)).select(
            F.col("metadata.match_id").alias("match_id"), F.timestamp_millis("info.game_datetime").alias("ts")
        )
        landing.run_available(
            landing.without_repeats(stream, "ts", ["match_id"], "2 days"), check, lambda df, i: landing._write_batch(df, out, i, [])
        )

    drop(source, "1.json", match("a"), match("b"), match("a"))
    run()
    drop(source, "2.json", match("b"), match("c"))
    run()
    assert sorted(r.match_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_daily_counts_over_batches(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        raw = landing.raw_match_stream(spark, str(source))
        people = acquire.match_participants(raw.withColumn("ts", F.timestamp_millis("info.game_datetime")), ["ts"])
        landing.run_daily_counts(people, "ts", ["level"], "placement", out, check)

    drop(source, "1.json", match("a", people=8))
    run()
    drop(source, "2.json", match("b", people=4), match("c", 15, people=1))
    run()
    drop(source, "3.json", match("d", 2, people=1))  # twelve days late
    run()
    got = {r.day: (r.n_rows, r.place_sum, r.n_win, r.n_top4) for r in landing.latest_counts(spark, out, ["level"]).collect()}
    assert got == {DAY[14]: (12, 46, 2, 8), DAY[15]: (1, 1, 1, 1), datetime.date(2025, 4, 2): (1, 1, 1, 1)}


def orders_at(spark, folder, n=2400):
    """Orders alone, as the sample's match records need them."""
    rows = spark.range(n).selectExpr(
        "id as o_orderkey", "id % 50 as o_custkey", "'O' as o_orderstatus", "cast(id as double) as o_totalprice",
        "timestamp_ntz '1995-03-01 00:00:00' + make_interval(int(id % 3)) as o_orderdate", "'1-URGENT' as o_orderpriority",
    )
    rows.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def room_of(monkeypatch, folder):
    """Sends the shared paths of the queries below ``folder``; returns the bytes of the files written under a name, without side files."""
    monkeypatch.setattr(queries, "shared_path", lambda spark, name: f"{folder}/{name}")
    return lambda name: sum(f.stat().st_size for f in (folder / name).rglob("part-*"))


def test_landed_days_take_little_room(spark, tmp_path, monkeypatch):
    room = room_of(monkeypatch, tmp_path)
    got = counts(queries.load_landed_days(spark, orders_at(spark, tmp_path / "in")))
    assert sum(n for (name, _), n in got.items() if name == "matches") == 1600
    assert sum(n for (name, _), n in got.items() if name == "participants") == 12_800
    assert len([name for name, _ in got if name == "rejected_dates"]) == 3
    people = spark.read.text(str(tmp_path / "landed" / "participants")).agg(F.sum(F.length("value") + 1)).first()[0]
    assert 0 < room("landed") < people / 8


def test_shuffles_of_a_load_go_with_their_jobs(spark, tmp_path, monkeypatch):
    seen, write = {}, tables.write_table
    monkeypatch.setattr(tables, "write_table", lambda df, root, name: (seen.update({name: spark.conf.get(CLEANUP)}), write(df, root, name)))
    landed_root, table_root = land(spark, tmp_path, match("a"), match("b", 15))
    before = spark.conf.get(CLEANUP)
    tables.load_pending(spark, landed_root, table_root)
    assert seen == dict.fromkeys(tables.TABLES, "true") and spark.conf.get(CLEANUP) == before
    files = list((tmp_path / "tables" / "units").rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)


def test_streamed_records_take_little_room(spark, tmp_path, monkeypatch):
    room = room_of(monkeypatch, tmp_path)
    got = counts(queries.stream_load_tables(spark, orders_at(spark, tmp_path / "in")))
    assert sum(n for (name, _), n in got.items() if name == "matches") == 1600
    text = spark.read.text(str(tmp_path / "json")).agg(F.sum(F.length("value") + 1)).first()[0]
    assert 0 < room("json") < text / 8


def test_a_backlog_comes_in_bounded_batches(spark, tmp_path):
    source, root, check = tmp_path / "in", str(tmp_path / "tables"), tmp_path / "check"
    for name, records in {"1": "ab", "2": "bc", "3": "ca"}.items():
        drop(source, f"{name}.json", *[match(r) for r in records])
    landing.load_matches_stream(spark, str(source), root, str(check), batch_bytes=1000)
    assert len([f for f in (check / "commits").iterdir() if f.name.isdigit()]) == 3
    assert {n: tables.read_table(spark, root, n).count() for n in tables.TABLES} == {"matches": 3, "participants": 6, "traits": 6, "units": 9}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_participants_that_are_computed_are_made_once(spark, tmp_path):
    raw = acquire.of_queue(sample.raw_matches(spark, orders_at(spark, tmp_path / "in", 24)))
    people = acquire.match_participants(raw)
    assert people.count() == 128 and "size(" not in plan_of(people)
    odd = spark.createDataFrame([("a", None), ("b", []), ("c", [None, {"puuid": "p"}])], "match_id string, participants array<struct<puuid: string>>")
    fields = sorted({f.name for f in RAW_PARTICIPANT} - {"puuid", "companion"})
    p = F.transform("participants", lambda p: F.when(p.isNotNull(), F.struct(p["puuid"].alias("puuid"), *[F.lit(None).cast("int").alias(f) for f in fields], F.struct(F.lit(None).alias("content_ID")).alias("companion"))))
    rows = acquire.match_participants(odd.select(F.struct("match_id").alias("metadata"), F.struct(p.alias("participants")).alias("info")))
    assert [(r.match_id, r.puuid) for r in rows.collect()] == [("c", None), ("c", "p")]


def test_landed_text_is_cast_once(spark):
    names = HEADER.split(",")
    rows = [{"placement": p, "time_eliminated": t} for p, t in (("3", "1.5"), (" +4 ", "NaN"), ("x", "y"), ("", None), (None, "1e3"), ("99999999999", " "), ("1.5", "1,5"))]
    text = spark.createDataFrame([[r.get(n) for n in names] + [None] for r in rows], ", ".join(f"{n} string" for n in names) + ", run_date date")
    typed = landed.typed(text, "participants")
    assert plan_of(typed).count("try_cast(placement") == 1
    assert [(r.placement, str(r.time_eliminated), r.bad) for r in typed.collect()] == [
        (3, "1.5", []), (4, "nan", []), (None, "None", ["placement", "time_eliminated"]), (None, "None", ["placement"]),
        (None, "1000.0", []), (None, "None", ["placement", "time_eliminated"]), (None, "None", ["placement", "time_eliminated"]),
    ]


def test_checks_deal_rows_out_once_to_find_repeats(spark, tmp_path, monkeypatch):
    found = {}
    monkeypatch.setattr(tables, "staged", lambda df, name, **kw: found.setdefault(name, df))
    people = spark.createDataFrame([("a", "p", DAY[14]), (None, "p", DAY[14]), (None, "p", DAY[14]), ("a", "p", DAY[15])], "match_id string, puuid string, run_date date")
    people = people.withColumn("bad", F.array().cast("array<string>"))
    heads = people.select("match_id", "run_date", "bad").where("match_id is not null")
    got = {(r.run_date.day, r.problem): r.n_rows for r in tables._problems(spark, people, heads, str(tmp_path)).collect()}
    assert got == {
        (14, "participants with repeated keys"): 2, (14, "participants without a key"): 2,
        (15, "participants of an earlier day"): 1, (15, "matches of an earlier day"): 1,
    }
    assert {tuple(r) for r in found["repeated-participants"].collect()} == {("a", "p"), (None, "p")}


def test_sample_records_are_compiled(spark, tmp_path):
    rows = spark.range(-20, 480).selectExpr(
        "if(id = 7, null, id) as o_orderkey", "if(id = 9, null, id % 50) as o_custkey", "if(id = 11, null, 'O') as o_orderstatus",
        "timestamp_ntz '1995-03-01 00:00:00' as o_orderdate",
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    raw = sample.raw_matches(spark, str(tmp_path))
    assert plan_of(raw).count("slice(") == 8
    columns = ["match_id", "puuid", "traits", "units"]
    got, wanted = (df.select(F.to_json(F.struct(*columns))).collect() for df in (acquire.match_participants(raw), sample.raw_boards(spark, str(tmp_path))))
    assert len(got) == 4000 and sorted(got) == sorted(wanted)
