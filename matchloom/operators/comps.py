"""Team compositions: building them, their legality and their active traits."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.boards import emblem_items, id_prefix, sort_traits, sort_units
from matchloom.functions.scalars import joined_key, version_order
from matchloom.schemas import BOARD

MAX_LOOKUP = 1_000


def is_small(df: DataFrame, rows: int) -> bool:
    """True if ``df`` has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def _few_rows(dimension: DataFrame, *columns: str) -> list | None:
    """The rows of a dimension of at most ``MAX_LOOKUP`` rows; None if it is longer."""
    found = dimension.na.drop(subset=columns[0]).select(*columns).limit(MAX_LOOKUP + 1).collect()
    return found if len(found) <= MAX_LOOKUP else None


def _constant(values: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>")


def lookup(dimension: DataFrame, key: str, value: str) -> Column | None:
    """A short dimension as a constant map; None if it is long.

    A constant needs no join, so facts are not moved to where a popular id is looked up.
    """
    found = _few_rows(dimension, key, value)
    if found is None:
        return None
    return _constant({r[0]: r[1] for r in found}, dimension.schema[value].dataType.simpleString())


def needs_lookup(trait_tiers: DataFrame) -> Column | None:
    """``thresholds`` as a constant map; None if there are too many tiers for that."""
    found = _few_rows(trait_tiers, "trait_id", "tier", "min_units")
    if found is None:
        return None
    needs: dict[str, list[int]] = {}
    for r in sorted(found, key=lambda r: (r["tier"] is None, r["tier"] or 0, r["min_units"] is None, r["min_units"] or 0)):  # NULLs last
        needs.setdefault(r["trait_id"], []).append(r["min_units"])
    return _constant(needs, "array<int>")


def thresholds(trait_tiers: DataFrame) -> DataFrame:
    """Per trait the unit counts that reach a tier, in tier order. The lists are as long as the tiers."""
    # a tier without a number comes last, as in `needs_lookup`
    listed = F.array_sort(F.collect_list(F.struct(F.col("tier").isNull().alias("unknown"), "tier", "min_units")))
    return (
        trait_tiers.groupBy("trait_id")
        .agg(listed.alias("tiers"))
        .select("trait_id", F.col("tiers.min_units").alias("needs"))
    )


def trait_lookups(unit_traits: DataFrame, trait_tiers: DataFrame) -> tuple[Column, Column] | None:
    """Traits of units and needs of traits as constant maps; None if either dimension is long."""
    traits_of, needs_of = lookup(unit_traits, "character_id", "traits"), needs_lookup(trait_tiers)
    return None if traits_of is None or needs_of is None else (traits_of, needs_of)


def off_threshold(count: Column, needs: Column) -> Column:
    """True for a count of two or more that is no tier's exact need; an unknown trait has no tiers."""
    return (count >= 2) & ~F.coalesce(F.array_contains(needs, count), F.lit(False))


def _boards_of_level(units: DataFrame, players: DataFrame, max_level: int) -> DataFrame:
    """Unit lists of the boards that have exactly as many units as the player's level.

    No level is above ``max_level``, so a board with more units can be cut to one unit more and still
    fails the test. Spark applies that cut in every task before the shuffle, which bounds what any
    one board sends and what its list can grow to.
    """
    unit = joined_key(F.col("character_id"), F.col("rarity"))
    valid = units.filter(F.col("rarity") > -1).select(
        *BOARD,
        "slot_idx",
        unit.alias("unit"),
        joined_key(unit, F.col("tier")).alias("full"),
        emblem_items(F.col("items")).alias("held"),
    )
    by_slot = Window.partitionBy(*BOARD).orderBy("slot_idx")
    few = valid.withColumn("_n", F.row_number().over(by_slot)).filter(F.col("_n") <= max_level + 1).drop("_n")
    in_order = F.array_sort(F.collect_list(F.struct("slot_idx", "unit", "full", "held")))
    boards = few.groupBy(*BOARD).agg(in_order.alias("slots"))

    levels = players.select("game_version", *BOARD, "level", "placement").distinct()
    fitting = boards.join(levels, BOARD).filter(F.size("slots") == F.col("level"))
    return fitting.withColumn("held", F.flatten("slots.held"))


def _with_emblem_traits(boards: DataFrame, emblems: DataFrame) -> DataFrame:
    """Replace the emblem items a board holds by their traits, in order; an unknown emblem gives NULL."""
    known = lookup(emblems, "item_id", "trait_id")
    if known is not None:
        return boards.withColumn("emblems", F.transform("held", lambda i: known[i])).drop("held")
    columns = [c for c in boards.columns if c != "held"]
    named = boards.select("*", F.posexplode_outer("held").alias("pos", "item_id")).join(emblems, "item_id", "left")
    in_order = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "trait_id"))))
    return (
        named.groupBy(*columns).agg(in_order.alias("listed")).select(*columns, F.col("listed.trait_id").alias("emblems"))
    )


def _trait_lists(traits: DataFrame, trait_tiers: DataFrame) -> DataFrame:
    """Full and active trait lists per board and the number of active traits off their threshold.

    A board has one row per trait (the table's key, see ``key_violations``), so the lists are no
    longer than the list of traits.
    """
    needs_of = needs_lookup(trait_tiers)
    valid = traits.filter(F.col("max_tier") > 0).select(*BOARD, "trait_id", "num_units", "current_tier")
    if needs_of is not None:
        valid = valid.withColumn("needs", needs_of[F.col("trait_id")])
    else:
        valid = valid.join(thresholds(trait_tiers), "trait_id", "left")
    active = F.col("current_tier") > 0
    text = joined_key(F.col("trait_id"), F.col("num_units"), F.col("current_tier"))
    grouped = valid.groupBy(*BOARD).agg(
        F.array_sort(F.collect_list(F.struct(text.alias("trait"), active.alias("active")))).alias("traits"),
        F.count(F.when(active, 1)).alias("n_active"),
        F.count(F.when(active & off_threshold(F.col("num_units"), F.col("needs")), 1)).alias("n_illegal"),
    )
    return grouped.filter(F.col("n_active") > 0)


def build_comps(
    players: DataFrame,
    units: DataFrame,
    traits: DataFrame,
    trait_tiers: DataFrame,
    emblems: DataFrame,
    ignore_threshold: int = 1,
    ordered: bool = False,
) -> DataFrame:
    """Legal compositions with as many units as the player's level, one row per board.

    ``players`` has game_version, match_id, puuid, placement and level; the version and the two ids
    name a board, and a match has one version. The highest level is looked up among them.
    """
    boards = _boards_of_level(units, players, players.agg(F.max("level")).first()[0] or 0)
    listed = _trait_lists(traits, trait_tiers).filter(F.col("n_illegal") <= ignore_threshold)
    # Lists are put in order only for the few boards that are left.
    comps = boards.join(listed, BOARD).select(
        "game_version",
        *BOARD,
        "placement",
        "level",
        sort_units(F.col("slots.unit")).alias("combine_units"),
        sort_units(F.col("slots.full"), tier=True).alias("combine_full_units"),
        sort_traits(F.filter("traits", lambda t: t["active"])["trait"]).alias("combine_active_traits"),
        sort_traits(F.col("traits.trait")).alias("combine_full_traits"),
        (F.size("held") > 0).alias("has_emblem"),
        "held",
    )
    comps = _with_emblem_traits(comps, emblems)
    return comps.orderBy(*version_order(), "match_id", "placement", "puuid") if ordered else comps


def _counted(traits: Column) -> Column:
    """Each trait of a list once, with its number of copies."""
    return F.transform(
        F.array_distinct(traits),
        lambda t: F.struct(t.alias("trait_id"), F.size(F.filter(traits, lambda x: x.eqNullSafe(t))).alias("n")),
    )


def _unit_trait_counts(units: Column, traits_of: Column, bonus: Column | None) -> Column:
    """Array of (trait_id, n) over a unit list; every copy of a unit counts, unknown units add nothing."""
    none = F.array().cast("array<string>")
    listed = F.flatten(F.transform(units, lambda u: F.coalesce(traits_of[id_prefix(u)], none)))
    if bonus is not None:
        listed = F.concat(listed, F.coalesce(bonus, none))
    return _counted(listed)


def _joined_trait_counts(
    df: DataFrame, units: str, unit_traits: DataFrame, needs: DataFrame, bonus: str | None
) -> DataFrame:
    """The same counts by joins, for dimensions too large to send along: one row per list and trait.

    The lists are worked on once each; equal lists share their result.
    """
    keys = [units] + ([bonus] if bonus else [])
    lists = df.select(*keys).distinct()
    named = lists.select(*keys, F.explode(units).alias("unit"))
    named = named.withColumn("character_id", id_prefix(F.col("unit"))).join(unit_traits, "character_id")
    rows = named.select(*keys, F.explode("traits").alias("trait_id"))
    if bonus:
        rows = rows.unionByName(lists.select(*keys, F.explode(bonus).alias("trait_id")))
    counted = rows.groupBy(*keys, "trait_id").agg(F.count("*").cast("int").alias("n"))
    return counted.join(needs, "trait_id", "left")


def illegal_traits(df: DataFrame, units: str, unit_traits: DataFrame, trait_tiers: DataFrame) -> DataFrame:
    """Add ``n_illegal``: traits of a unit list whose count is two or more but not an exact tier need."""
    known = trait_lookups(unit_traits, trait_tiers)
    if known:
        traits_of, needs_of = known
        counts = _unit_trait_counts(F.col(units), traits_of, None)
        illegal = F.filter(counts, lambda c: off_threshold(c["n"], needs_of[c["trait_id"]]))
        return df.withColumn("n_illegal", F.size(illegal))
    counted = _joined_trait_counts(df, units, unit_traits, thresholds(trait_tiers), None)
    off = counted.groupBy(units).agg(F.count(F.when(off_threshold(F.col("n"), F.col("needs")), 1)).alias("n_illegal"))
    joined = df.join(off, units, "left")
    return joined.withColumn("n_illegal", F.coalesce(F.col("n_illegal"), F.lit(0)).cast("int"))


def legal_by_units(
    df: DataFrame, units: str, unit_traits: DataFrame, trait_tiers: DataFrame, ignore_threshold: int = 1
) -> DataFrame:
    """Add ``is_legal`` to rows with a unit list."""
    counted = illegal_traits(df, units, unit_traits, trait_tiers)
    return counted.withColumn("is_legal", F.col("n_illegal") <= ignore_threshold).drop("n_illegal")


def legal_by_traits(df: DataFrame, traits: str, trait_tiers: DataFrame, ignore_threshold: int = 1) -> DataFrame:
    """Add ``is_legal`` to rows with a trait list; a trait listed twice counts with its last entry."""
    column = F.col(traits)
    later = F.transform(
        column,
        lambda t, i: F.struct(
            id_prefix(t).alias("trait_id"),
            F.get(F.split(t, "_"), F.lit(2)).try_cast("int").alias("n"),
            F.exists(F.slice(column, i + 2, F.size(column)), lambda o: id_prefix(o) == id_prefix(t)).alias("again"),
        ),
    )
    last = F.filter(later, lambda s: ~s["again"])
    needs_of = needs_lookup(trait_tiers)
    if needs_of is not None:
        illegal = F.size(F.filter(last, lambda s: off_threshold(s["n"], needs_of[s["trait_id"]])))
        return df.withColumn("is_legal", illegal <= ignore_threshold)
    rows = df.select(traits).distinct().select(traits, F.inline(last))
    rows = rows.join(thresholds(trait_tiers), "trait_id", "left")
    off = rows.groupBy(traits).agg(F.count(F.when(off_threshold(F.col("n"), F.col("needs")), 1)).alias("_off"))
    joined = df.join(off, traits, "left")
    return joined.withColumn("is_legal", F.coalesce(F.col("_off"), F.lit(0)) <= ignore_threshold).drop("_off")


def active_traits(
    df: DataFrame,
    units: str,
    unit_traits: DataFrame,
    trait_tiers: DataFrame,
    bonus: str | None = None,
    out: str = "active_traits",
    known: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Add the traits a unit list activates as (trait_id, n), largest count first, then by id.

    ``bonus`` names a column of extra traits, each adding one. A trait below its first tier is left
    out, as is one without tiers. A NULL list gives NULL. ``known`` saves looking the dimensions up
    again.
    """

    def in_order(counts: Column) -> Column:
        ranked = F.transform(
            counts, lambda c: F.struct((-c["n"]).alias("less"), c["trait_id"].alias("trait_id"), c["n"].alias("n"))
        )
        return F.transform(F.array_sort(ranked), lambda r: F.struct(r["trait_id"].alias("trait_id"), r["n"].alias("n")))

    known = known or trait_lookups(unit_traits, trait_tiers)
    if known:
        traits_of, needs_of = known
        counts = _unit_trait_counts(F.col(units), traits_of, F.col(bonus) if bonus else None)
        reached = F.filter(counts, lambda c: c["n"] >= F.get(needs_of[c["trait_id"]], F.lit(0)))
        return df.withColumn(out, in_order(reached))
    counted = _joined_trait_counts(df, units, unit_traits, thresholds(trait_tiers), bonus)
    counted = counted.filter(F.col("n") >= F.get("needs", F.lit(0)))
    keys = [units] + ([bonus] if bonus else [])
    found = counted.groupBy(*keys).agg(F.collect_list(F.struct("trait_id", "n")).alias("_found"))
    same = [df[k].eqNullSafe(found[k]) for k in keys]
    joined = df.join(found, same, "left").drop(*[found[k] for k in keys])
    empty = F.array().cast("array<struct<trait_id:string,n:int>>")
    value = F.when(F.col(units).isNotNull(), in_order(F.coalesce("_found", empty)))
    return joined.withColumn(out, value).drop("_found")
