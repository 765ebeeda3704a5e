"""Every operator as a query over the test tables.

Lists come out as joined text, so that results compare the same in any engine.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.boards import id_prefix, normalise_tiers, unit_tiers, without_tier
from matchloom.functions.literals import parse_failed, parse_literal
from matchloom.functions.scalars import half_even
from matchloom.operators import acquire, comps, evolution, forecast, mining, normalise, outcome, quality, report, skew
from matchloom.schemas import BOARD, RAW_MATCH, UNIT_LIST
from matchloom.session import shared_path, staged
from matchloom.sources import dims, frames, landed, sample, snapshots, tables
from matchloom.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OLD_VERSION, NEW_VERSION = "15.8", "15.9"
REPORT_LEVELS = (4, 5, 6)
# Landed text takes some twenty times the room of the tables made of it.
LANDED_CODEC = "gzip"
# Of compressed records that a streamed batch takes: some 10 GB of text.
BATCH_BYTES = 512 << 20
# The test boards rarely hold one unit set twice.
FORECAST_BOARDS = 1
HEADER_SCHEMA = T.StructType([RAW_MATCH["metadata"], T.StructField("info", T.StructType([f for f in RAW_MATCH["info"].dataType.fields if f.name != "participants"]))])


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def text(items: str | Column, sep: str = ",") -> Column:
    column = F.col(items) if isinstance(items, str) else items
    return F.array_join(column, sep, "null")


def trait_text(traits: str) -> Column:
    return text(F.transform(traits, lambda t: F.concat(t["trait_id"], F.lit(":"), t["n"].cast("string"))))


def players(spark: SparkSession, sf: str) -> DataFrame:
    return frames.load_participants(sample.participants(spark, sf), sample.matches(spark, sf))


# Statistics


@query
def basic_unit_stats(spark: SparkSession, sf: str) -> DataFrame:
    return outcome.unit_stats(players(spark, sf), sample.units(spark, sf))


@query
def item_build_stats(spark: SparkSession, sf: str) -> DataFrame:
    return outcome.item_build_stats(players(spark, sf), sample.units(spark, sf))


def _trait_stats(spark: SparkSession, sf: str) -> DataFrame:
    return outcome.trait_stats(players(spark, sf), sample.traits(spark, sf), sample.trait_tiers(spark))


@query
def trait_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _trait_stats(spark, sf)


@query
def item_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = outcome.item_stats(players(spark, sf), sample.units(spark, sf))
    return stats.withColumn("top_units", text("top_units.character_id"))


@query
def item_top_carriers(spark: SparkSession, sf: str) -> DataFrame:
    return outcome.item_top_carriers(players(spark, sf), sample.units(spark, sf))


# Load views


@query
def load_matches_view(spark: SparkSession, sf: str) -> DataFrame:
    return frames.load_matches(sample.matches(spark, sf), ordered=True)


@query
def load_participants_view(spark: SparkSession, sf: str) -> DataFrame:
    return frames.load_participants(sample.participants(spark, sf), sample.matches(spark, sf), ordered=True)


@query
def load_units_view(spark: SparkSession, sf: str) -> DataFrame:
    loaded = frames.load_units(
        sample.units(spark, sf),
        sample.participants(spark, sf),
        sample.matches(spark, sf),
        summons=sample.SUMMONS,
        slot_order=sample.SLOT_ORDER,
    )
    return loaded.withColumn("items", text("items"))


@query
def load_traits_view(spark: SparkSession, sf: str) -> DataFrame:
    return frames.load_traits(
        sample.traits(spark, sf), sample.participants(spark, sf), sample.matches(spark, sf)
    )


# The same over stored tables


def stored(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The test views as tables of four run dates: bucketed by match, published by two commits of which the second replaces the first."""
    root = shared_path(spark, "store")
    views = {"matches": sample.matches, "participants": sample.participants, "traits": sample.traits, "units": sample.units}
    rows = {}
    for name, view in views.items():
        df = view(spark, sf)
        columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in tables.TABLES[name].fields]
        rows[name] = df.select(*columns, F.date_add(F.lit("2024-01-01"), (df["match_id"] % 4).cast("int")).alias("run_date"))
    days = [datetime.date(2024, 1, d) for d in (1, 2, 3, 4)]
    for part in (days[:1], days):
        commit = snapshots.Commit(spark, root, part)
        tables.write_all({name: df.filter(F.col("run_date").isin(part)) for name, df in rows.items()}, commit)
        commit.publish(replaces=True)
    return {name: tables.read_table(spark, root, name) for name in rows}


def _loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Players of whom every thirteenth is missing, and the loaded units and traits of all boards."""
    held = stored(spark, sf)
    people, matches = held["participants"], held["matches"]
    some = frames.load_participants(people, matches).filter(F.col("puuid").cast("long") % 13 != 0)
    units = frames.load_units(held["units"], people, matches, summons=sample.SUMMONS, slot_order=sample.SLOT_ORDER)
    return some, units, frames.load_traits(held["traits"], people, matches)


@query
def loaded_unit_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of loaded units without summons; units without a participant stay, without a placement."""
    some, units, _ = _loaded(spark, sf)
    return outcome.unit_stats(some, units)


@query
def loaded_item_build_stats(spark: SparkSession, sf: str) -> DataFrame:
    some, units, _ = _loaded(spark, sf)
    return outcome.item_build_stats(some, units)


@query
def loaded_item_stats(spark: SparkSession, sf: str) -> DataFrame:
    some, units, _ = _loaded(spark, sf)
    return outcome.item_stats(some, units).withColumn("top_units", text("top_units.character_id"))


@query
def loaded_trait_stats(spark: SparkSession, sf: str) -> DataFrame:
    some, _, traits = _loaded(spark, sf)
    return outcome.trait_stats(some, traits, sample.trait_tiers(spark))


@query
def stored_units_view(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf)[1].withColumn("items", text("items"))


@query
def stored_comps(spark: SparkSession, sf: str) -> DataFrame:
    """Compositions of the stored tables, whose boards are never shuffled."""
    held = stored(spark, sf)
    people = frames.load_participants(held["participants"], held["matches"])
    units = normalise.drop_summons(held["units"], sample.SUMMONS)
    built = comps.build_comps(people, units, held["traits"], sample.trait_tiers(spark), sample.emblem_traits(spark))
    return built.withColumns({c: text(c) for c in LISTS})


# Normalisation


@query
def board_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    units = sample.units(spark, sf)
    heavy = skew.heavy_keys(units, BOARD)
    boards = normalise.renumber_slots(units, sample.SLOT_ORDER, heavy=heavy)
    cleaned = normalise.clean_boards(boards, sample.MARKER, sample.SUMMONS, heavy=heavy)
    return cleaned.withColumn("items", text("items"))


def _literal_units(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as participants whose unit list is Python literal text; line 1 of an order is empty."""
    return sample.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_partkey").alias("puuid"),
        "l_linenumber",
        "l_suppkey",
        F.expr(
            r"""if(l_linenumber = 1, '[]', concat(
              '[{\'character_id\': \'T14_U', l_partkey % 12, '\', \'itemNames\': [\'x: None, ', l_returnflag,
              '\', "o\'', l_linestatus, '"], \'name\': \'\', \'rarity\': ', l_partkey % 5, ', \'tier\': ',
              if(l_linenumber % 3 = 0, 'None', '2'), '}',
              if(l_linenumber = 2, '', concat(', {\'character_id\': \'T14_U', l_suppkey % 12,
                '\', \'itemNames\': [], \'name\': None, \'rarity\': ', l_suppkey % 5, ', \'tier\': ',
                l_linenumber % 3 + 1, '}')), ']'))"""
        ).alias("units"),
    )


@query
def parse_and_explode(spark: SparkSession, sf: str) -> DataFrame:
    literal = _literal_units(spark, sf)
    parsed = literal.withColumn("units", parse_literal(F.col("units"), UNIT_LIST))
    rows = normalise.unit_rows(parsed, ["l_linenumber", "l_suppkey"])
    return rows.withColumn("items", text("items", "|"))


@query
def parse_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh part's text is cut short and must be reported, not dropped."""
    literal = _literal_units(spark, sf)
    cut = F.when(F.col("puuid") % 7 == 0, F.expr("substring(units, 1, length(units) - 1)")).otherwise(F.col("units"))
    rows = literal.withColumn("_text", cut)
    parsed = rows.withColumn("units", parse_literal(F.col("_text"), UNIT_LIST))
    failed = parse_failed(F.col("_text"), F.col("units"))
    return parsed.groupBy("l_linenumber").agg(
        F.count("*").alias("n_rows"), F.count(F.when(failed, 1)).alias("n_failed")
    )


@query
def epoch_and_version_extract(spark: SparkSession, sf: str) -> DataFrame:
    headers = acquire.match_headers(sample.raw_matches(spark, sf, header_only=True))
    return normalise.match_table(headers)


# Acquisition


@query
def seed_topup(spark: SparkSession, sf: str) -> DataFrame:
    """Two market segments in full, topped up from a third to just above the two's usual share."""
    customers = sample.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    tier = {s: customers.filter(F.col("c_mktsegment") == s) for s in ("BUILDING", "MACHINERY", "FURNITURE")}
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return acquire.seed_players(tier["BUILDING"], tier["MACHINERY"], tier["FURNITURE"], order)


@query
def day_window(spark: SparkSession, sf: str) -> DataFrame:
    events = sample.table(spark, sf, "events").select("event_id", "ts", "user_id")
    found = acquire.of_previous_day(events, "ts", F.lit("2024-01-16"))
    return found.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def per_key_cap(spark: SparkSession, sf: str) -> DataFrame:
    events = sample.table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return acquire.latest_per_player(events, "user_id", [F.desc("ts"), F.asc("event_id")])


@query
def dedup_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of matches over orders and lines: each match comes up many times."""
    return acquire.distinct_ids(sample.participants(spark, sf), sample.units(spark, sf))


@query
def queue_filter(spark: SparkSession, sf: str) -> DataFrame:
    ranked = acquire.of_queue(sample.raw_matches(spark, sf, header_only=True))
    return acquire.match_headers(ranked).select("match_id", "game_datetime", "game_version")


@query
def flatten_match(spark: SparkSession, sf: str) -> DataFrame:
    return acquire.match_headers(sample.raw_matches(spark, sf, header_only=True))


@query
def flatten_participants(spark: SparkSession, sf: str) -> DataFrame:
    people = acquire.match_participants(acquire.of_queue(sample.raw_matches(spark, sf)))
    return people.withColumn("traits", text("traits.name")).withColumn("units", text("units.character_id"))


@query
def explode_traits(spark: SparkSession, sf: str) -> DataFrame:
    return normalise.trait_rows(sample.raw_boards(spark, sf))


@query
def board_cleanup_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The clean-up on lists, before they are exploded."""
    people = sample.raw_boards(spark, sf)
    cleaned = normalise.clean_unit_lists(people, sample.MARKER, sample.SUMMONS)
    return normalise.unit_rows(cleaned).withColumn("items", text("items"))


@query
def explode_units(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalise.unit_rows(sample.raw_boards(spark, sf))
    return rows.withColumn("items", text("items"))


# Checks


@query
def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_violations(sample.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Keys without a parent, in both directions of two foreign keys."""
    orders = sample.table(spark, sf, "orders")
    lines = sample.table(spark, sf, "lineitem")
    customers = sample.table(spark, sf, "customer")
    checks = {
        "line without order": (lines, "l_orderkey", orders, "o_orderkey"),
        "order without line": (orders, "o_orderkey", lines, "l_orderkey"),
        "order without customer": (orders, "o_custkey", customers, "c_custkey"),
        "customer without order": (customers, "c_custkey", orders, "o_custkey"),
    }
    found = None
    for name, (child, key, parent, parent_key) in checks.items():
        one = quality.orphans(child, parent, [key], [parent_key])
        one = one.select(F.lit(name).alias("check_name"), F.col(key).alias("key"), "n_rows")
        found = one if found is None else found.unionByName(one)
    return found


@query
def group_size_check(spark: SparkSession, sf: str) -> DataFrame:
    """Users and days of the event table that do not have exactly eight events."""
    events = sample.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return quality.wrong_group_sizes(events, ["day", "user_id"], 8)


@query
def cast_failures(spark: SparkSession, sf: str) -> DataFrame:
    events = sample.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("user_text"),
        F.when(F.col("event_id") % 4 == 0, None).otherwise(F.col("value").cast("string")).alias("value_text"),
        "event_type",
    )
    return quality.cast_failures(events, {"user_text": "int", "value_text": "double", "event_type": "int"})


@query
def unknown_ids(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unknown_ids(sample.units(spark, sf), sample.unit_traits(spark), "character_id")


@query
def landed_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Headers landed as JSON by year: one year has a key too many, one lacks a key, one has text for a number, one broken lines."""
    rows = sample.table(spark, sf, "orders").select(F.year("o_orderdate").alias("run_year"), "o_orderkey")
    kind = F.col("run_year") % 4
    info = F.struct(
        F.lit(1100).alias("queue_id"),
        (F.col("o_orderkey") + 1_700_000_000_000).alias("game_datetime"),
        F.when(kind == 1, F.lit("1500.5")).alias("text_length"),
        F.when(kind != 1, F.lit(1500.5)).alias("game_length"),
        F.lit("15.8").alias("game_version"),
        F.when(kind != 2, F.lit(14)).alias("tft_set_number"),
        F.when(kind == 3, F.array(F.struct(F.lit(1).alias("kind")))).alias("extras"),
    )
    metadata = F.struct(F.concat(F.lit("M"), "o_orderkey").alias("match_id"))
    line = F.replace(F.to_json(F.struct(metadata.alias("metadata"), info.alias("info"))), F.lit("text_length"), F.lit("game_length"))
    broken = (kind == 0) & (F.col("o_orderkey") % 5 == 0)
    path = shared_path(spark, "lines")
    rows.select("run_year", F.when(broken, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.partitionBy("run_year").text(path)
    landed_lines = spark.read.schema("value string, run_year int").text(path)
    return quality.nested_drift(landed_lines, HEADER_SCHEMA, "run_year")


# Incremental load


def _run_dates(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc("o_orderdate", "month").alias("run_date")
    return sample.table(spark, sf, "orders").select(month, "o_orderkey")


def _ledger(landed_rows: DataFrame) -> DataFrame:
    even = landed_rows.filter(F.month("run_date") % 2 == 0).select(F.col("run_date").alias("loaded_date")).distinct()
    return even.withColumn("last_loaded", F.lit("2024-01-01").cast("timestamp"))


@query
def pending_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = _run_dates(spark, sf)
    return tables.pending_dates(rows, _ledger(rows))


@query
def ledger_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger after all dates were entered: known dates keep their time."""
    rows = _run_dates(spark, sf)
    ledger = _ledger(rows)
    return ledger.unionByName(tables.new_ledger_rows(rows, ledger, F.lit("2024-02-01").cast("timestamp")))


@query
def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc("l_shipdate", "month").alias("run_date")
    lines = sample.table(spark, sf, "lineitem").select(month)
    return tables.audit_counts({"participants": _run_dates(spark, sf), "units": lines})


@query
def load_landed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Land ranked matches as files by year, load them twice and count what the tables hold.

    Three more dates can't be loaded and stay pending. The second load finds only these and must change nothing.
    The columns of the match files are in another order than the table's.
    """
    raw = acquire.of_queue(sample.raw_matches(spark, sf))
    year = F.trunc(F.timestamp_millis(F.col("info.game_datetime")), "year")
    dated = raw.withColumn("run_date", year)
    headers = acquire.match_headers(acquire.of_queue(sample.raw_matches(spark, sf, header_only=True)))
    headers = headers.withColumn("run_date", F.trunc(F.timestamp_millis(F.col("game_datetime")), "year"))
    landed_root, table_root = shared_path(spark, "landed"), shared_path(spark, "tables")
    people = acquire.match_participants(dated, ["run_date"])
    landed.write_landed(people, landed_root, "participants", LANDED_CODEC)
    landed.write_landed(headers.select(*reversed(headers.columns)), landed_root, "matches", LANDED_CODEC)
    first = headers.agg(F.min("run_date")).first()[0]
    again = people.filter(F.col("run_date") == F.lit(first))
    ids = staged(again.select("match_id").distinct(), "ids", compression=snapshots.CODEC)
    prefixed = F.concat(F.lit("again-"), "match_id")
    renamed, renamed_ids = (rows.withColumn("match_id", prefixed) for rows in (again, ids))
    # a value that does not parse, keys of another day, a column that is not there
    bad_days = zip(sample.BAD_DAYS, (renamed.withColumn("placement", F.lit("x")), again, renamed.drop("level")), (renamed_ids, ids, renamed_ids))
    for day, rows, of_day in bad_days:
        at = F.lit(day).cast("date")
        landed.write_landed(rows.withColumn("run_date", at), landed_root, "participants", LANDED_CODEC)
        rest = headers.filter(F.col("run_date") == F.lit(first)).limit(1).drop("match_id", "run_date")
        landed.write_landed(of_day.withColumn("run_date", at).join(F.broadcast(rest)), landed_root, "matches", LANDED_CODEC)
    tables.load_pending(spark, landed_root, table_root, strict=False)
    tables.load_pending(spark, landed_root, table_root, strict=False)
    held = {name: tables.read_table(spark, table_root, name) for name in tables.TABLES}
    held["loaded_dates"] = tables.read_ledger(spark, table_root).select(F.col("loaded_date").alias("run_date"))
    held["rejected_dates"] = tables.rejected_dates(spark, table_root).select("run_date").distinct()
    return tables.audit_counts(held)


# Reference data


def _sets(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as sets: each brings one unit and one trait; later parts redefine the same ids."""
    return sample.table(spark, sf, "part").select(
        F.col("p_partkey").alias("set_position"),
        F.expr(
            """array(named_struct('apiName', concat('T14_U', p_partkey % 14), 'name', p_name,
                 'traits', array(p_brand, p_type)))"""
        ).alias("champions"),
        F.expr(
            """array(named_struct('apiName', concat('T14_R', p_partkey % 7), 'name', p_brand,
                 'effects', transform(sequence(1, cast(1 + p_partkey % 3 as int)),
                    i -> named_struct('minUnits', cast(i * (1 + p_size % 4) as int)))))"""
        ).alias("traits"),
    )


def _trait_names(spark: SparkSession, sf: str) -> DataFrame:
    """Brands with an even number have an id."""
    brands = sample.table(spark, sf, "part").select("p_brand").distinct()
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return brands.filter(number % 2 == 0).select(
        number.alias("position"), F.concat(F.lit("T14_"), "p_brand").alias("id"), F.col("p_brand").alias("name")
    )


@query
def dim_trait_tiers(spark: SparkSession, sf: str) -> DataFrame:
    names = sample.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("position"),
        F.concat(F.lit("T14_R"), (F.col("s_suppkey") % 5).cast("string")).alias("id"),
        F.col("s_name").alias("name"),
    )
    return dims.trait_dimension(_sets(spark, sf), sample.traits(spark, sf), names)


def _unit_traits_dim(spark: SparkSession, sf: str, traits: DataFrame | None = None) -> DataFrame:
    names = sample.table(spark, sf, "part").select(
        F.col("p_partkey").alias("position"),
        F.concat(F.lit("T14_U"), (F.col("p_partkey") % 10).cast("string")).alias("id"),
        F.col("p_name").alias("name"),
    )
    found = dims.unit_dimension(_sets(spark, sf), sample.units(spark, sf), names, _trait_names(spark, sf), traits)
    return found.withColumn("traits", text("traits"))


def _emblems_dim(spark: SparkSession, sf: str, traits: DataFrame | None = None) -> DataFrame:
    items = sample.table(spark, sf, "part").select(
        F.expr("concat('T_Item_P', p_partkey, if(p_partkey % 3 = 0, 'EmblemItem', ''))").alias("id"),
        F.expr("concat(p_brand, if(p_partkey % 2 = 0, ' Emblem', ' Blade'))").alias("name"),
    )
    return dims.emblem_dimension(items, _trait_names(spark, sf), traits)


def _brand_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Trait facts that lack every second trait with a name."""
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return sample.table(spark, sf, "part").filter(number % 4 == 0).select(F.concat(F.lit("T14_"), "p_brand").alias("trait_id"))


@query
def dim_unit_traits(spark: SparkSession, sf: str) -> DataFrame:
    return _unit_traits_dim(spark, sf)


@query
def dim_unit_traits_of_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _unit_traits_dim(spark, sf, _brand_facts(spark, sf))


@query
def dim_emblems(spark: SparkSession, sf: str) -> DataFrame:
    return _emblems_dim(spark, sf)


@query
def dim_emblems_of_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _emblems_dim(spark, sf, _brand_facts(spark, sf))


@query
def dim_version(spark: SparkSession, sf: str) -> DataFrame:
    return dims.reference_version(sample.matches(spark, sf))


# Compositions


def _comps(spark: SparkSession, sf: str) -> DataFrame:
    units = normalise.drop_summons(sample.units(spark, sf), sample.SUMMONS)
    return comps.build_comps(
        players(spark, sf),
        units,
        sample.traits(spark, sf),
        sample.trait_tiers(spark),
        sample.emblem_traits(spark),
    )


LISTS = ["combine_units", "combine_full_units", "combine_active_traits", "combine_full_traits", "emblems"]


@query
def comps_(spark: SparkSession, sf: str) -> DataFrame:
    return _comps(spark, sf).withColumns({c: text(c) for c in LISTS})


@query
def legal_comps_by_units(spark: SparkSession, sf: str) -> DataFrame:
    """Legality of every composition by the traits of its units, no illegal trait ignored."""
    checked = comps.legal_by_units(
        _comps(spark, sf), "combine_units", sample.unit_traits(spark), sample.trait_tiers(spark), ignore_threshold=0
    )
    return checked.select(*BOARD, text("combine_units").alias("combine_units"), "is_legal")


@query
def legal_comps_by_traits(spark: SparkSession, sf: str) -> DataFrame:
    checked = comps.legal_by_traits(_comps(spark, sf), "combine_full_traits", sample.trait_tiers(spark), 0)
    return checked.select(*BOARD, text("combine_full_traits").alias("combine_full_traits"), "is_legal")


@query
def active_traits(spark: SparkSession, sf: str) -> DataFrame:
    """Traits activated by the units of every composition, its emblems counted as extra traits."""
    found = comps.active_traits(
        _comps(spark, sf), "combine_units", sample.unit_traits(spark), sample.trait_tiers(spark), bonus="emblems"
    )
    return found.select(*BOARD, trait_text("active_traits").alias("active_traits"))


@query
def unit_list_projections(spark: SparkSession, sf: str) -> DataFrame:
    """Tiers, ids without tier, raised tiers and bare ids of every full unit list."""
    full = F.col("combine_full_units")
    return _comps(spark, sf).select(
        *BOARD,
        text(unit_tiers(full).cast("array<string>")).alias("tiers"),
        text(without_tier(full)).alias("bases"),
        text(normalise_tiers(full)).alias("raised"),
        text(F.transform(full, id_prefix)).alias("ids"),
    )


@query
def frequent_comps(spark: SparkSession, sf: str) -> DataFrame:
    return mining.frequent_comps(_comps(spark, sf)).withColumn("itemsets", text("itemsets"))


@query
def frequent_comps_mined(spark: SparkSession, sf: str) -> DataFrame:
    """The same compositions by FP-growth, which does not rely on boards being as long as their level."""
    return mining.frequent_itemsets_of_level(_comps(spark, sf)).withColumn("itemsets", text("itemsets"))


FPGROWTH_SUPPORT = 0.02


@query
def itemsets_fpgrowth(spark: SparkSession, sf: str) -> DataFrame:
    found = mining.frequent_itemsets(_comps(spark, sf), "combine_units", ["game_version"], FPGROWTH_SUPPORT)
    support = half_even(F.col("support"), 4).alias("support")
    return found.select("game_version", text("itemsets").alias("itemsets"), "freq", support)


def _frequent(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    built = staged(_comps(spark, sf), "comps")
    return built, mining.frequent_comps(built, top=100)


def _dedup(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    built, freq = _frequent(spark, sf)
    order = [F.col("level"), (-F.col("support")).alias("less"), F.col("itemsets")]
    return built, mining.dedup_comps(freq, order)


@query
def dedup_comps(spark: SparkSession, sf: str) -> DataFrame:
    return _dedup(spark, sf)[1].withColumn("itemsets", text("itemsets"))


@query
def comp_stats(spark: SparkSession, sf: str) -> DataFrame:
    built, freq = _dedup(spark, sf)
    stats = evolution.comp_stats(
        built,
        freq,
        sample.unit_traits(spark),
        sample.trait_tiers(spark),
        report_levels=REPORT_LEVELS,
        last_level=sample.MAX_LEVEL,
        with_key=True,
    )
    shown = {"itemsets": text("itemsets")}
    for level in REPORT_LEVELS:
        shown[f"level_{level}"] = text(f"level_{level}")
        shown[f"level_{level}_traits"] = trait_text(f"level_{level}_traits")
    return stats.withColumns(shown)


def _evolution(spark: SparkSession, sf: str, within_version: bool) -> DataFrame:
    built, freq = _dedup(spark, sf)
    freq = staged(freq, "freq")
    catalog = staged(evolution.comp_catalog(built), "catalog")
    grown = evolution.comp_evolution(catalog, freq, 2, sample.MAX_LEVEL, within_version)
    return grown.select(
        F.col("itemset_id.game_version").alias("game_version"),
        F.col("itemset_id.level").alias("level"),
        text("itemset_id.itemsets").alias("itemsets"),
        *[text(f"level_{n}").alias(f"level_{n}") for n in range(2, sample.MAX_LEVEL + 1)],
    )


@query
def comp_evolution(spark: SparkSession, sf: str) -> DataFrame:
    return _evolution(spark, sf, within_version=False)


@query
def comp_evolution_by_version(spark: SparkSession, sf: str) -> DataFrame:
    return _evolution(spark, sf, within_version=True)


# Report


@query
def version_delta(spark: SparkSession, sf: str) -> DataFrame:
    measures = ["frequency", "avg_place", "win", "top4"]
    stats = basic_unit_stats(spark, sf)
    return report.version_comparison(stats, ["character_id", "rarity"], measures, OLD_VERSION, NEW_VERSION)


@query
def top_traits_by_style(spark: SparkSession, sf: str) -> DataFrame:
    return report.top_traits(_trait_stats(spark, sf))


@query
def flags(spark: SparkSession, sf: str) -> DataFrame:
    return report.with_flags(_trait_stats(spark, sf))


@query
def item_scatter(spark: SparkSession, sf: str) -> DataFrame:
    stats = outcome.item_stats(players(spark, sf), sample.units(spark, sf))
    return report.item_scatter(stats, NEW_VERSION, "Craftable")


@query
def performance_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return report.performance_tiers(basic_unit_stats(spark, sf))


@query
def performance_tiers_hold(spark: SparkSession, sf: str) -> DataFrame:
    """What SQL can repeat of the tiers: every row is nearest to its own centre, and tiers are in order of placement."""
    return report.tier_facts(performance_tiers(spark, sf)).drop("performance_tier")


def _comp_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome of every frequent composition; one that no board holds has no row."""
    built, freq = _dedup(spark, sf)
    catalog = staged(evolution.comp_catalog(built), "catalog")
    totals = built.groupBy("game_version").agg(F.count_distinct("match_id").alias("matches"))
    found = evolution.comp_outcomes(catalog, staged(freq, "freq"), totals)
    return found.select("itemset_id.*", "play_rate", "avg_place", "win", "top4")


COMP_FEATURES = ["avg_place", "play_rate", "win", "top4"]


@query
def comp_tiers_hold(spark: SparkSession, sf: str) -> DataFrame:
    """Tiers of compositions by version, and what SQL can repeat of them."""
    tiered = report.performance_tiers(_comp_outcomes(spark, sf).withColumn("itemsets", text("itemsets")), COMP_FEATURES)
    return report.tier_facts(tiered, COMP_FEATURES).drop("performance_tier")


@query
def comp_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Placement to expect of the last version's compositions in the next one."""
    found = forecast.forecast(forecast.strengths(_comps(spark, sf), FORECAST_BOARDS))
    if found is None:
        return spark.createDataFrame([], "game_version string, level int, itemsets string, place double, expected_place double")
    return found.select("game_version", "level", text("itemsets").alias("itemsets"), half_even(F.col("place"), 6).alias("place"), half_even(F.col("expected_place"), 6).alias("expected_place"))


@query
def comp_forecast_error(spark: SparkSession, sf: str) -> DataFrame:
    """The line fitted without the last version, and its error there."""
    found = forecast.held_out_error(forecast.strengths(_comps(spark, sf), FORECAST_BOARDS))
    return found.select("n_tested", *[half_even(F.col(c), 6).alias(c) for c in ("slope", "intercept", "error", "error_unchanged")])


# Streams


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = sample.table(spark, sf, "events").schema
    # As a pattern the path may be a file or a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_daily_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Events as outcomes, placed by user, counted per day and type on the stream."""
    stream = _event_stream(spark, sf).withColumn("placement", (F.col("user_id") % 8 + 1).cast("int"))
    path, keys = shared_path(spark, "daily"), ["event_type"]
    landing.run_daily_counts(stream, "ts", keys, "placement", path, shared_path(spark, "daily-checkpoint"))
    return landing.latest_counts(spark, path, keys).select(
        "day",
        *keys,
        F.col("n_placed").alias("frequency"),
        half_even(outcome.mean_place(), 2).alias("avg_place"),
        half_even(outcome.win_rate(), 3).alias("win"),
        half_even(outcome.top4_rate(), 3).alias("top4"),
    )


def _event_files(spark: SparkSession, sf: str, n: int = 3) -> DataFrame:
    """The events as a stream of ``n`` batches, a file each; neighbouring events come in different ones."""
    events = sample.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = shared_path(spark, "events")
    for part in range(n):
        events.filter(F.col("event_id") % n == part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query
def stream_load_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Ids seen on the stream, each once, however often and in whatever of the three batches they come.

    State is kept for a millisecond, so repeats across batches come after it has expired and are found by the look-up.
    """
    ids = F.concat("event_type", F.lit("-"), (F.col("event_id") % 997).cast("string"))
    stream = _event_files(spark, sf).select(ids.alias("match_id"))
    path = shared_path(spark, "ids")
    landing.load_new_keys(stream, ["match_id"], path, shared_path(spark, "ids-checkpoint"), ttl_ms=1)
    return spark.read.parquet(path).select("match_id")


@query
def stream_dedup_state(spark: SparkSession, sf: str) -> DataFrame:
    """The same ids by kept state alone, which no repeat of the three batches outlives."""
    ids = F.concat("event_type", F.lit("-"), (F.col("event_id") % 997).cast("string"))
    stream = landing.first_of_keys(_event_files(spark, sf).select(ids.alias("match_id")), ["match_id"], 3_600_000)
    path = shared_path(spark, "ids")
    landing.run_available(stream, shared_path(spark, "ids-checkpoint"), lambda batch, i: landing._write_batch(batch, path, i, []), state=True)
    return spark.read.parquet(path).select("match_id")


@query
def stream_daily_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Play rates of event types per day, over matches that come up in several of the three batches."""
    stream = _event_files(spark, sf).withColumns({"placement": (F.col("user_id") % 8 + 1).cast("int"), "match_no": F.expr("event_id div 8")})
    path, keys = shared_path(spark, "rates"), ["event_type"]
    landing.run_daily_rates(stream, "ts", keys, "placement", "match_no", path, shared_path(spark, "rates-checkpoint"), least=2)
    return landing.daily_rates(spark, path, keys).select(
        "day",
        *keys,
        "matches",
        half_even(F.col("n_rows") / (F.col("matches") * outcome.PLAYERS), 3).alias("frequency"),
        half_even(F.col("n_rows") / F.col("matches"), 2).alias("play_rate"),
        half_even(outcome.mean_place(), 2).alias("avg_place"),
    )


@query
def stream_load_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Load matches from JSON files in three batches with repeats within and across them, then a landed day.

    Returns what the tables and the ledger hold by year.
    """
    raw = acquire.of_queue(sample.raw_matches(spark, sf))
    third = F.pmod(F.xxhash64("metadata.match_id"), F.lit(3))
    source, root, checkpoint = (shared_path(spark, name) for name in ("json", "tables", "stream"))

    def year(at: Column) -> Column:
        return F.trunc(at, "year")

    for batch in range(3):
        part = raw.filter((third == batch) | (third == (batch + 1) % 3))  # every match comes in two batches
        landed.write_raw_matches(part.union(part.filter(third == batch)), source, LANDED_CODEC)
        landing.load_matches_stream(spark, source, root, checkpoint, run_date=year, batch_bytes=BATCH_BYTES)
    landed_root = shared_path(spark, "landed")
    later = raw.filter(third == 0).withColumn("run_date", F.lit(sample.BAD_DAYS[0]).cast("date"))
    later = later.withColumn("metadata", F.struct(F.concat(F.lit("later-"), "metadata.match_id").alias("match_id")))
    landed.write_landed(acquire.match_participants(later, ["run_date"]), landed_root, "participants", LANDED_CODEC)
    headers = acquire.match_headers(later).withColumn("run_date", F.lit(sample.BAD_DAYS[0]).cast("date"))
    landed.write_landed(headers, landed_root, "matches", LANDED_CODEC)
    tables.load_pending(spark, landed_root, root)
    held = {name: tables.read_table(spark, root, name) for name in tables.TABLES}
    held["loaded_dates"] = tables.read_ledger(spark, root).select(F.col("loaded_date").alias("run_date"))
    landed_day = F.col("run_date") == F.lit(sample.BAD_DAYS[0]).cast("date")
    return tables.audit_counts({name: rows.filter(~landed_day) for name, rows in held.items()})
