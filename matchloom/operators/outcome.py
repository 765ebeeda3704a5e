"""Outcome statistics of units, item builds, traits and items.

All statistics come from one mergeable tally per key (rows, placed rows, sum of placements, wins and
top-four finishes). A job tallies the facts once at its finest key and rolls the small result up.
Where several branches roll it up, the tally is staged: each branch filters differently, and Spark
would push those filters below the tally and read and join the facts once per branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.boards import EMBLEM, item_build
from matchloom.functions.scalars import half_even, version_order
from matchloom.operators.skew import largest_per_group
from matchloom.schemas import BOARD
from matchloom.session import staged

PLAYERS = 8
MIN_BUILDS = 10
MIN_SHARE = 0.01
TOP_CARRIERS = 10

# Item ids by type.
COMPONENT_ITEMS = [
    "TFT_Item_BFSword", "TFT_Item_RecurveBow", "TFT_Item_NeedlesslyLargeRod", "TFT_Item_TearOfTheGoddess",
    "TFT_Item_ChainVest", "TFT_Item_NegatronCloak", "TFT_Item_GiantsBelt", "TFT_Item_SparringGloves",
    "TFT_Item_Spatula", "TFT_Item_FryingPan",
]
RADIANT_ITEMS = [
    "TFT5_Item_AdaptiveHelmRadiant", "TFT5_Item_ArchangelsStaffRadiant", "TFT5_Item_BloodthirsterRadiant",
    "TFT5_Item_BlueBuffRadiant", "TFT5_Item_BrambleVestRadiant", "TFT5_Item_CrownguardRadiant",
    "TFT5_Item_DeathbladeRadiant", "TFT5_Item_DragonsClawRadiant", "TFT5_Item_FrozenHeartRadiant",
    "TFT5_Item_GargoyleStoneplateRadiant", "TFT5_Item_GiantSlayerRadiant", "TFT5_Item_GuardianAngelRadiant",
    "TFT5_Item_GuinsoosRagebladeRadiant", "TFT5_Item_HandOfJusticeRadiant", "TFT5_Item_HextechGunbladeRadiant",
    "TFT5_Item_InfinityEdgeRadiant", "TFT5_Item_IonicSparkRadiant", "TFT5_Item_JeweledGauntletRadiant",
    "TFT5_Item_LastWhisperRadiant", "TFT5_Item_LeviathanRadiant", "TFT5_Item_MorellonomiconRadiant",
    "TFT5_Item_NightHarvesterRadiant", "TFT5_Item_QuicksilverRadiant", "TFT5_Item_RabadonsDeathcapRadiant",
    "TFT5_Item_RapidFirecannonRadiant", "TFT5_Item_RedemptionRadiant", "TFT5_Item_RunaansHurricaneRadiant",
    "TFT5_Item_SpearOfShojinRadiant", "TFT5_Item_SpectralGauntletRadiant", "TFT5_Item_StatikkShivRadiant",
    "TFT5_Item_SteraksGageRadiant", "TFT5_Item_SunfireCapeRadiant", "TFT5_Item_ThiefsGlovesRadiant",
    "TFT5_Item_TitansResolveRadiant", "TFT5_Item_TrapClawRadiant", "TFT5_Item_WarmogsArmorRadiant",
]
ARTIFACT_ITEMS = [
    "TFT4_Item_OrnnAnimaVisage", "TFT9_Item_OrnnPrototypeForge", "TFT_Item_Artifact_BlightingJewel",
    "TFT4_Item_OrnnDeathsDefiance", "TFT9_Item_OrnnDeathfireGrasp", "TFT_Item_Artifact_Fishbones",
    "TFT7_Item_ShimmerscaleGamblersBlade", "TFT4_Item_OrnnTheCollector", "TFT_Item_Artifact_HorizonFocus",
    "TFT9_Item_OrnnHullbreaker", "TFT4_Item_OrnnInfinityForce", "TFT_Item_Artifact_InnervatingLocket",
    "TFT_Item_Artifact_LichBane", "TFT_Item_Artifact_LightshieldCrest", "TFT_Item_Artifact_LudensTempest",
    "TFT4_Item_OrnnMuramana", "TFT_Item_Artifact_Mittens", "TFT7_Item_ShimmerscaleMogulsMail",
    "TFT_Item_Artifact_ProwlersClaw", "TFT_Item_Artifact_RapidFirecannon", "TFT_Item_Artifact_SeekersArmguard",
    "TFT_Item_Artifact_SilvermereDawn", "TFT9_Item_OrnnHorizonFocus", "TFT_Item_Artifact_SpectralCutlass",
    "TFT_Item_Artifact_SuspiciousTrenchCoat", "TFT_Item_Artifact_TalismanOfAscension",
    "TFT9_Item_OrnnTrickstersGlass", "TFT_Item_Artifact_UnendingDespair", "TFT_Item_Artifact_WitsEnd",
    "TFT4_Item_OrnnZhonyasParadox",
]
SUPPORT_ITEMS = [
    "TFT_Item_AegisOfTheLegion", "TFT_Item_BansheesVeil", "TFT_Item_Chalice", "TFT_Item_SupportKnightsVow",
    "TFT_Item_LocketOfTheIronSolari", "TFT_Item_Moonstone", "TFT7_Item_ShimmerscaleHeartOfGold",
    "TFT4_Item_OrnnObsidianCleaver", "TFT4_Item_OrnnRanduinsSanctum", "TFT_Item_Shroud", "TFT_Item_Spite",
    "TFT_Item_EternalFlame", "TFT_Item_UnstableTreasureChest", "TFT_Item_RadiantVirtue", "TFT_Item_ZekesHerald",
    "TFT_Item_Zephyr", "TFT5_Item_ZzRotPortalRadiant",
]
EXOTECH_ITEMS = [
    "TFT14_JaxCyberneticItem", "TFT14_JhinCyberneticItem", "TFT14_MordekaiserCyberneticItem",
    "TFT14_NaafiriCyberneticItem", "TFT14_SejuaniCyberneticItem", "TFT14_VarusCyberneticItem",
    "TFT14_ZeriCyberneticItem",
]
EXOTECH_RADIANT_ITEMS = [
    "TFT14_JaxCyberneticItem_Radiant", "TFT14_JhinCyberneticItem_Radiant", "TFT14_MordekaiserCyberneticItem_Radiant",
    "TFT14_NaafiriCyberneticItem_Radiant", "TFT14_SejuaniCyberneticItem_Radiant", "TFT14_VarusCyberneticItem_Radiant",
    "TFT14_ZeriCyberneticItem_Radiant",
]
EMPTY_BAG = "TFT_Item_EmptyBag"
TYPE_ORDER = ["Craftable", "Emblem", "Radiant", "Artifact", "Support", "ExotechItem"]
LEFT_OUT_TYPES = ["Component", "EmptyBag"]


def placed(facts: DataFrame, players: DataFrame) -> DataFrame:
    """Facts with the placement of their board.

    Facts that carry the version keep rows without a participant; facts that do not take the version
    from the players, so only their rows stay.
    """
    if "placement" in facts.columns:
        return facts
    outcome = players.select("game_version", *BOARD, "placement")
    if "game_version" in facts.columns:
        return facts.join(outcome, ["game_version", *BOARD], "left")
    return facts.join(outcome, BOARD)


def match_totals(facts: DataFrame, players: DataFrame) -> DataFrame:
    """Distinct matches per version among the facts."""
    if "game_version" not in facts.columns:
        boards = facts.select(*BOARD).distinct()
        facts = players.select("game_version", *BOARD).join(boards, BOARD, "left_semi")
    return facts.groupBy("game_version").agg(F.count_distinct("match_id").alias("matches"))


COUNTS = ("n_rows", "n_placed", "place_sum", "n_win", "n_top4")


def _counts() -> list[Column]:
    place = F.col("placement")
    return [
        F.count("*").alias("n_rows"),
        F.count(place).alias("n_placed"),
        F.sum(place).cast("long").alias("place_sum"),
        F.count(F.when(place == 1, 1)).alias("n_win"),
        F.count(F.when(place <= 4, 1)).alias("n_top4"),
    ]


def tally(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mergeable outcome counts per key; rows with a NULL key are left out."""
    return df.na.drop(subset=keys).groupBy(*keys).agg(*_counts())


def tally_and_matches(df: DataFrame, keys: list[str]) -> DataFrame:
    """Tallies per key and, in the same pass over the facts, one row per version and match, with ``is_tally`` false.

    Both kinds of row are combined in each task before the one shuffle. Rows with a NULL key are left out of the tallies;
    the matches keep them.
    """
    seen = df.groupingSets([keys, ["game_version", "match_id"]], *keys, "match_id")
    rows = seen.agg((F.grouping("match_id") == 1).alias("is_tally"), *_counts())
    whole = F.least(*[F.col(k).isNotNull() for k in [*keys, keys[0]]])
    return rows.filter(F.when(F.col("is_tally"), whole).otherwise(F.col("game_version").isNotNull() & F.col("match_id").isNotNull()))


def tallies_of(seen: DataFrame) -> DataFrame:
    return seen.filter("is_tally").drop("match_id", "is_tally")


def totals_of(seen: DataFrame) -> DataFrame:
    """Distinct matches per version, of the rows of ``tally_and_matches``."""
    return seen.filter("not is_tally").groupBy("game_version").agg(F.count("*").alias("matches"))


def rolled_up(tallies: DataFrame, keys: list[str]) -> DataFrame:
    """Tallies summed to a coarser key."""
    return tallies.na.drop(subset=keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def mean_place() -> Column:
    return F.try_divide(F.col("place_sum"), F.col("n_placed"))


def win_rate() -> Column:
    """An unknown placement counts in this denominator, though not in the mean placement."""
    return F.col("n_win") / F.col("n_rows")


def top4_rate() -> Column:
    return F.col("n_top4") / F.col("n_rows")


def _rounded_rates() -> list[Column]:
    return [half_even(win_rate(), 3).alias("win"), half_even(top4_rate(), 3).alias("top4")]


def outcome_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Unrounded mean placement, frequency, win and top-four rate per key."""
    return tally(df, keys).select(
        *keys,
        mean_place().alias("avg_place"),
        F.col("n_placed").alias("frequency"),
        win_rate().alias("win"),
        top4_rate().alias("top4"),
    )


UNIT = ["game_version", "character_id", "rarity"]


def _valid_units(units: DataFrame) -> DataFrame:
    return units.filter(F.col("rarity") > -1)


def _unit_overall(tallies: DataFrame) -> DataFrame:
    return rolled_up(tallies, UNIT).select(
        *UNIT, F.col("n_placed"), half_even(mean_place(), 2).alias("avg_place"), win_rate().alias("win"), top4_rate().alias("top4")
    )


def unit_stats(players: DataFrame, units: DataFrame) -> DataFrame:
    """Frequency per player slot, mean placement, win and top-four rate of every unit."""
    seen = tally_and_matches(placed(_valid_units(units), players), UNIT)
    # a version has as many tallies as units are known, so they fit in a list beside its count of matches
    tallies = F.when(F.col("is_tally"), F.struct(*UNIT[1:], *COUNTS))
    versions = seen.groupBy("game_version").agg(F.count_if(~F.col("is_tally")).alias("matches"), F.collect_list(tallies).alias("tallies"))
    rows = versions.select("game_version", "matches", F.inline("tallies"))
    stats = rows.select(
        *UNIT, "matches", "n_placed", half_even(mean_place(), 2).alias("avg_place"), win_rate().alias("win"), top4_rate().alias("top4")
    )
    return stats.select(
        *UNIT,
        half_even(F.col("n_placed") / (F.col("matches") * PLAYERS), 3).alias("frequency"),
        "avg_place",
        half_even(F.col("win"), 3).alias("win"),
        half_even(F.col("top4"), 3).alias("top4"),
    ).orderBy(*version_order(), "rarity", F.desc("character_id"))


def item_build_stats(players: DataFrame, units: DataFrame, min_count: int = MIN_BUILDS) -> DataFrame:
    """Share, mean placement and difference to the unit's own mean for every item build of a unit."""
    valid = _valid_units(units).withColumn("item_build", item_build(F.col("items")))
    builds = staged(tally(placed(valid, players), [*UNIT, "item_build"]), "builds")
    overall = _unit_overall(builds).select(
        *UNIT, F.col("n_placed").alias("unit_placed"), F.col("avg_place").alias("unit_place")
    )
    frequent = builds.filter((F.col("item_build") != "") & (F.col("n_placed") >= min_count))
    stats = frequent.join(overall, UNIT).select(
        *UNIT,
        "item_build",
        half_even(F.col("n_placed") / F.col("unit_placed"), 3).alias("frequency"),
        half_even(mean_place(), 2).alias("avg_place"),
        half_even(mean_place() - F.col("unit_place"), 2).alias("avg_delta"),
        *_rounded_rates(),
    )
    return stats.filter(F.col("frequency") > 0).orderBy(
        *version_order(), "rarity", F.desc("character_id"), "item_build"
    )


def trait_stats(players: DataFrame, traits: DataFrame, trait_tiers: DataFrame) -> DataFrame:
    """Play rate per match and outcome of every active trait tier and style.

    ``trait_tiers`` has trait_id, tier and min_units. A tier seen with two values of max_tier gives
    one row for each.
    """
    valid = traits.filter((F.col("current_tier") > 0) & (F.col("max_tier") > 0))
    tier = ["game_version", "trait_id", "current_tier"]
    seen = staged(tally_and_matches(placed(valid, players), [*tier, "trait_style", "max_tier"]), "traits")
    finest, totals = tallies_of(seen), totals_of(seen)
    spans = finest.select(*tier, "max_tier").distinct()
    needs = trait_tiers.select("trait_id", F.col("tier").alias("current_tier"), "min_units")
    spans = spans.join(needs, ["trait_id", "current_tier"], "left").withColumn(
        "min_units_required", F.coalesce("min_units", F.lit(0))
    )
    stats = rolled_up(finest, [*tier, "trait_style"]).join(totals, "game_version").join(spans, tier, "left")
    return stats.select(
        *tier,
        "max_tier",
        "trait_style",
        "min_units_required",
        half_even(F.col("n_rows") / F.col("matches"), 2).alias("play_rate"),
        half_even(mean_place(), 2).alias("avg_place"),
        *_rounded_rates(),
    ).orderBy(*version_order(), "trait_id", "current_tier", "trait_style", "max_tier")


def item_type(item: Column) -> Column:
    """Type of an item; the first rule that applies wins."""
    return (
        F.when(F.lit(EMPTY_BAG).contains(item), "EmptyBag")
        .when(item.isin(COMPONENT_ITEMS), "Component")
        .when(item.isin(RADIANT_ITEMS), "Radiant")
        .when(item.isin(ARTIFACT_ITEMS), "Artifact")
        .when(item.isin(SUPPORT_ITEMS), "Support")
        .when(item.isin(EXOTECH_ITEMS), "ExotechItem")
        .when(item.isin(EXOTECH_RADIANT_ITEMS), "ExotechRadiantItem")
        .when(item.contains(EMBLEM), "Emblem")
        .otherwise("Craftable")
    )


def type_rank(kind: Column) -> Column:
    """Place of a type in the report; types not listed have none and sort last."""
    rank = F.lit(None).cast("int")
    for i, name in enumerate(TYPE_ORDER):
        rank = F.when(kind == name, i).otherwise(rank)
    return rank


ITEM = ["game_version", "items"]


def _item_tallies(players: DataFrame, units: DataFrame) -> DataFrame:
    """One tally per version, unit and item list, and one row per version and match: all that the item statistics are made of.

    ``n_held`` counts the units that hold items.
    """
    facts = placed(units, players).withColumns({"items": F.sort_array("items"), "held": F.size("items") > 0})
    facts = facts.filter(F.col("game_version").isNotNull())
    seen = facts.groupingSets([[*UNIT, "items"], ["game_version", "match_id"]], *UNIT, "items", "match_id")
    return staged(seen.agg((F.grouping("match_id") == 1).alias("is_tally"), F.count_if("held").alias("n_held"), *_counts()), "items")


def _per_item(lists: DataFrame, keys: list[str]) -> DataFrame:
    exploded = lists.filter(F.size("items") > 0).withColumn("items", F.explode("items"))
    return rolled_up(exploded, keys)


def _top_carriers(lists: DataFrame, n: int, min_share: float) -> DataFrame:
    carriers = _per_item(lists, [*ITEM, "character_id"]).select(
        *ITEM,
        "character_id",
        F.col("n_placed").alias("carried"),
        mean_place().alias("place"),
        win_rate().alias("carrier_win"),
        top4_rate().alias("carrier_top4"),
    )
    items = _per_item(lists, ITEM).select(
        *ITEM, F.col("n_rows").alias("total_count"), half_even(mean_place(), 2).alias("item_place")
    )
    units = _unit_overall(_valid_units(lists)).select(*UNIT, F.col("avg_place").alias("unit_place"))
    stats = (
        carriers.join(items, ITEM)
        .join(units, ["game_version", "character_id"], "left")
        .withColumn("share", F.col("carried") / F.col("total_count"))
        .filter(F.col("share") >= min_share)
    )
    order = [F.desc("share"), F.asc("character_id"), F.asc_nulls_last("rarity")]
    return largest_per_group(stats, ITEM, order, n).select(
        *ITEM,
        "rank",
        "character_id",
        half_even(F.col("share"), 3).alias("frequency"),
        half_even(F.col("place"), 2).alias("avg_place"),
        half_even(F.col("place") - F.col("item_place"), 2).alias("item_avg_delta"),
        half_even(F.col("place") - F.col("unit_place"), 2).alias("unit_avg_delta"),
        half_even(F.col("carrier_win"), 3).alias("win"),
        half_even(F.col("carrier_top4"), 3).alias("top4"),
    )


def item_top_carriers(
    players: DataFrame, units: DataFrame, n: int = TOP_CARRIERS, min_share: float = MIN_SHARE
) -> DataFrame:
    """The units that carry an item most often, one row per item and rank.

    Units with two rarities appear once per rarity, as the unit's own mean is kept per rarity.
    """
    return _top_carriers(tallies_of(_item_tallies(players, units)), n, min_share)


def item_stats(players: DataFrame, units: DataFrame, n: int = TOP_CARRIERS, min_share: float = MIN_SHARE) -> DataFrame:
    """Frequency, play rate, outcome, type and top carriers of every finished item."""
    seen = _item_tallies(players, units)
    lists, totals = tallies_of(seen), totals_of(seen.filter("is_tally or (n_held > 0 and match_id is not null)"))
    carriers = (
        _top_carriers(lists, n, min_share)
        .groupBy(*ITEM)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "rank",
                        "character_id",
                        "frequency",
                        "avg_place",
                        "item_avg_delta",
                        "unit_avg_delta",
                        "win",
                        "top4",
                    )
                )
            ).alias("ranked")
        )
        .select(*ITEM, F.transform("ranked", lambda s: s.dropFields("rank")).alias("top_units"))
    )
    kept = _per_item(lists, ITEM).withColumn("type", item_type(F.col("items")))
    kept = kept.filter(~F.col("type").isin(LEFT_OUT_TYPES))
    stats = kept.join(totals, "game_version").join(carriers, ITEM, "left")
    return stats.select(
        *ITEM,
        half_even(F.col("n_rows") / (F.col("matches") * PLAYERS), 3).alias("frequency"),
        half_even(F.col("n_rows") / F.col("matches"), 2).alias("play_rate"),
        half_even(mean_place(), 2).alias("avg_place"),
        *_rounded_rates(),
        "top_units",
        "type",
    ).orderBy(*version_order(), type_rank(F.col("type")).asc_nulls_last(), "items")
