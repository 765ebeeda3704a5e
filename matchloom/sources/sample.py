"""The test tables seen as match records.

Every view is a projection of one table (a wide order table stands for participants, its lines for
units), so no query pays for the mapping with a shuffle. FIXTURES.md section 3 has the same rules in
words.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-ins for the copying unit, the summons and the level range of the views.
MARKER = "T14_U0"
SUMMONS = ["T14_U11"]
MAX_LEVEL = 6
# Run dates that no order has.
BAD_DAYS = ("2100-01-01", "2100-01-02", "2100-01-03")
SLOT_ORDER = ["slot_idx", "character_id", "rarity", "tier", "items"]
SPECIAL_ITEMS = [
    "TFT_Item_BFSword",
    "TFT5_Item_DeathbladeRadiant",
    "TFT4_Item_OrnnMuramana",
    "TFT_Item_Zephyr",
    "TFT14_JaxCyberneticItem",
    "TFT14_JaxCyberneticItem_Radiant",
    "TFT_Item_EmptyBag",
    "T_Item_Plain",
    "T_Item_RareBlade",
]
TRAIT_NEEDS = [[2, 4], [3], [2, 4], [3], [1, 2], [2]]
UNITS_KNOWN = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _version(match_id: Column) -> Column:
    return F.concat(F.lit("15."), (match_id % 4 + 8).cast("string"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of every eight stands for the match."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 8 == 0)
    match_id = F.expr("o_orderkey div 8")
    return orders.select(
        match_id.alias("match_id"),
        F.col("o_orderdate").cast("timestamp").alias("game_datetime"),
        (F.col("o_orderkey") % 600 + 1200).cast("double").alias("game_duration"),
        _version(match_id).alias("game_version"),
        F.lit(14).alias("tft_set_number"),
    )


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("o_orderkey div 8").alias("match_id"),
        F.col("o_orderkey").alias("puuid"),
        (F.col("o_orderkey") % 8 + 1).cast("int").alias("placement"),
        (F.col("o_orderkey") % 5 + 2).cast("int").alias("level"),
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as units. Slots are line numbers, so they may repeat and have gaps until renumbered."""
    unit = F.col("l_partkey") % UNITS_KNOWN
    sentinel = F.col("l_quantity") == 50
    cost = unit % 5
    rarity = F.when(cost == 3, 4).when(cost == 4, 6).otherwise(cost)
    special = F.element_at(F.array(*[F.lit(i) for i in SPECIAL_ITEMS]), (F.col("l_partkey") % 9 + 1).cast("int"))
    craft = F.concat(F.lit("T_Item_"), "l_returnflag", (F.col("l_partkey") % 4).cast("string"))
    emblem = F.concat(F.lit("T_Item_R"), (F.col("l_suppkey") % 6).cast("string"), F.lit("EmblemItem"))
    none = F.array().cast("array<string>")
    items = F.concat(
        F.when(F.col("l_tax") >= 0.04, F.array(craft)).otherwise(none),
        F.when(F.col("l_discount") >= 0.05, F.array(special)).otherwise(none),
        F.when(F.col("l_suppkey") % 10 == 0, F.array(emblem)).otherwise(none),
        F.when(F.col("l_quantity") == 7, F.array(F.lit("T_Item_ThiefsGloves"))).otherwise(none),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey div 8").alias("match_id"),
        F.col("l_orderkey").alias("puuid"),
        F.when(sentinel, F.lit("T14_NoneUnit"))
        .otherwise(F.concat(F.lit("T14_U"), unit.cast("string")))
        .alias("character_id"),
        (F.col("l_linenumber") - 1).cast("int").alias("slot_idx"),
        F.when(sentinel, -1).otherwise(rarity).cast("int").alias("rarity"),
        F.when(sentinel, -1).otherwise(F.col("l_quantity").cast("int") % 3 + 1).cast("int").alias("tier"),
        items.alias("items"),
    )


def traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six possible traits per order, with the unit count taken from the order key."""
    needs = F.array(*[F.array(*[F.lit(n) for n in tiers]) for tiers in TRAIT_NEEDS])
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.posexplode(needs).alias("r", "needs")
    ).select(
        F.expr("o_orderkey div 8").alias("match_id"),
        F.col("o_orderkey").alias("puuid"),
        F.concat(F.lit("T14_R"), F.col("r").cast("string")).alias("trait_id"),
        F.expr("cast((o_orderkey div (2 * r + 3)) % 5 as int)").alias("num_units"),
        "needs",
    )
    tier = F.size(F.filter("needs", lambda n: n <= F.col("num_units")))
    return rows.filter(F.col("num_units") > 0).select(
        "match_id",
        "puuid",
        "trait_id",
        "num_units",
        tier.alias("current_tier"),
        F.size("needs").alias("max_tier"),
        tier.alias("trait_style"),
    )


def unit_traits(spark: SparkSession) -> DataFrame:
    """Dimension: unit id to trait ids."""
    rows = []
    for u in range(UNITS_KNOWN):
        own = [f"T14_R{u % 4}"] + ([f"T14_R{4 + u % 2}"] if u % 3 == 0 else [])
        rows.append((f"T14_U{u}", own))
    return spark.createDataFrame(rows, "character_id string, traits array<string>")


def trait_tiers(spark: SparkSession) -> DataFrame:
    """Dimension: trait id and tier to units needed."""
    rows = [(f"T14_R{r}", tier + 1, n) for r, tiers in enumerate(TRAIT_NEEDS) for tier, n in enumerate(tiers)]
    return spark.createDataFrame(rows, "trait_id string, tier int, min_units int")


def emblem_traits(spark: SparkSession) -> DataFrame:
    """Dimension: emblem item to trait id."""
    rows = [(f"T_Item_R{r}EmblemItem", f"T14_R{r}") for r in range(len(TRAIT_NEEDS))]
    return spark.createDataFrame(rows, "item_id string, trait_id string")


# Participant ``i`` (0 to 7) of the match that stands for an order, field by field.
_TRAITS = """if((o_orderkey + i) % 4 = 0,
  cast(array() as array<struct<name:string,num_units:int,style:int,tier_current:int,tier_total:int>>),
  array(named_struct('name', concat('T14_R', (o_orderkey + i) % 6),
    'num_units', cast(1 + (o_orderkey + i) % 4 as int), 'style', 1,
    'tier_current', cast((o_orderkey + i) % 3 as int), 'tier_total', 2)))"""
_UNIT = """named_struct(
    'character_id', concat('T14_U', (o_orderkey * (j + 1) + 5 * i + 11 * j) % 12),
    'itemNames', if((o_orderkey + j) % 2 = 0, array(concat('T_Item_', o_orderstatus)), cast(array() as array<string>)),
    'name', '', 'rarity', cast(j % 5 as int), 'tier', 1 + j % 3)"""
_NO_UNITS = "cast(array() as array<struct<character_id:string,itemNames:array<string>,name:string,rarity:int,tier:int>>)"
_UNITS = f"""if((o_orderkey + i) % 7 = 0, {_NO_UNITS},
  transform(sequence(0, cast((o_orderkey + i) % 7 as int) - 1), j -> {_UNIT}))"""
_PARTICIPANT = {
    "puuid": "cast(o_orderkey * 8 + i as string)",
    "riotIdGameName": "concat('player', o_custkey)",
    "riotIdTagline": "o_orderstatus",
    "placement": "i + 1",
    "level": "cast(2 + (o_orderkey + i) % 5 as int)",
    "traits": _TRAITS,
    "units": _UNITS,
    "total_damage_to_players": "cast(o_orderkey % 150 as int)",
    "players_eliminated": "i % 3",
    "time_eliminated": "cast(1000 + i as double)",
    "last_round": "30 + i",
    "gold_left": "cast(o_custkey % 50 as int)",
    "companion": "named_struct('content_ID', concat('C', o_custkey % 9))",
}


def _participants() -> str:
    """The eight participants of an order, written out, so that they are compiled: lambdas are interpreted, which takes twice the time.

    Only keys below zero still take the lambda. It also keeps Spark from making a single method of the projection, too long for
    the JVM to compile.
    """
    units = ", ".join(re.sub(r"\bj\b", str(j), _UNIT) for j in range(6))
    some = f"slice(array({units}), 1, cast((o_orderkey + i) % 7 as int))"
    values = _PARTICIPANT | {"units": f"if((o_orderkey + i) % 7 <= 0, {_UNITS}, {some})"}
    one = "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in values.items()) + ")"
    return f"array({', '.join(re.sub(r'\bi\b', str(i), one) for i in range(8))})"


def raw_matches(spark: SparkSession, sf_dir: str, header_only: bool = False) -> DataFrame:
    """Orders as nested match records with eight participants each.

    With ``header_only`` they look as to a reader whose schema leaves the participants out.
    """
    fields = {
        "queue_id": "if(o_orderkey % 3 = 0, 1090, 1100)",
        "game_datetime": "unix_millis(cast(o_orderdate as timestamp))",
        "game_length": "cast(1500 + o_orderkey % 300 as double)",
        "game_version": """if(o_orderkey % 11 = 0, 'unknown',
                              concat('Linux Version 15.', 8 + o_orderkey % 4, '.672.4034 (x)'))""",
        "tft_set_number": "14",
    }
    if not header_only:
        fields["participants"] = _participants()
    info = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return table(spark, sf_dir, "orders").select(
        F.expr("named_struct('match_id', concat('M', o_orderkey))").alias("metadata"),
        F.expr(f"named_struct({info})").alias("info"),
    )


def raw_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and lists of the same participants, one row each."""
    rows = table(spark, sf_dir, "orders").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return rows.select(
        F.expr("concat('M', o_orderkey)").alias("match_id"),
        *[F.expr(_PARTICIPANT[name]).alias(name) for name in ("puuid", "traits", "units")],
    )
