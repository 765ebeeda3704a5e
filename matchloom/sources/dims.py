"""Reference data: units, traits and emblems out of set and name documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.scalars import version_part
from matchloom.schemas import NAME_DOCUMENT, SET_DOCUMENT

EMBLEM_NAME = r"^(.+?)\s+Emblem$"


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    """One row per set of a set document: set_position, champions, traits."""
    document = spark.read.schema(SET_DOCUMENT).option("multiLine", "true").json(path)
    return document.select(F.posexplode("sets").alias("set_position", "set_name", "body")).select(
        "set_position", "body.champions", "body.traits"
    )


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """position, id and name of every entry of a name document."""
    document = spark.read.schema(NAME_DOCUMENT).option("multiLine", "true").json(path)
    entries = document.select(F.posexplode("data").alias("position", "key", "entry"))
    return entries.select("position", "entry.id", "entry.name")


def of_facts(names: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Names of ids that occur in the facts."""
    used = facts.select(F.col(key).alias("id")).distinct()
    return names.join(used, "id", "left_semi")


def _ids_by_name(names: DataFrame) -> DataFrame:
    """The id of every name; one shared by several ids stands for the last of them."""
    return names.groupBy(F.col("name").alias("trait_name")).agg(F.max_by("id", "position").alias("trait_id"))


def unit_dimension(
    sets: DataFrame, units: DataFrame, unit_names: DataFrame, trait_names: DataFrame, traits: DataFrame | None = None
) -> DataFrame:
    """character_id, name and trait ids of every unit in the facts.

    A unit in several sets keeps the entry of the last one. A trait name without an id becomes NULL
    at its place in the list. ``traits``: trait facts; only traits that occur in them have an id then.
    """
    trait_names = trait_names if traits is None else of_facts(trait_names, traits, "trait_id")
    used = units.select("character_id").distinct()
    entries = sets.select("set_position", F.posexplode("champions").alias("pos", "c"))
    last = (
        entries.groupBy(F.col("c.apiName").alias("character_id"))
        .agg(F.max_by("c.traits", F.struct("set_position", "pos")).alias("trait_names"))
        .join(used, "character_id", "left_semi")
    )
    ids = _ids_by_name(trait_names)
    listed = last.select("character_id", F.posexplode_outer("trait_names").alias("pos", "trait_name"))
    listed = listed.join(ids, "trait_name", "left")
    slots = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "trait_id"))))
    units_listed = listed.groupBy("character_id").agg(slots.alias("slots"))
    names = unit_names.groupBy(F.col("id").alias("character_id")).agg(F.max_by("name", "position").alias("name"))
    return units_listed.join(names, "character_id", "left").select(
        "character_id", "name", F.col("slots.trait_id").alias("traits")
    )


def trait_dimension(sets: DataFrame, traits: DataFrame, trait_names: DataFrame) -> DataFrame:
    """trait_id, name, tier and min_units of every trait in the facts; tiers count from 1."""
    used = traits.select("trait_id").distinct()
    entries = sets.select("set_position", F.posexplode("traits").alias("pos", "t"))
    last = (
        entries.groupBy(F.col("t.apiName").alias("trait_id"))
        .agg(F.max_by("t.effects", F.struct("set_position", "pos")).alias("effects"))
        .join(used, "trait_id", "left_semi")
    )
    names = trait_names.groupBy(F.col("id").alias("trait_id")).agg(F.max_by("name", "position").alias("name"))
    tiers = last.select("trait_id", F.posexplode("effects").alias("pos", "effect"))
    return tiers.join(names, "trait_id", "left").select(
        "trait_id", "name", (F.col("pos") + 1).alias("tier"), F.col("effect.minUnits").alias("min_units")
    )


def emblem_dimension(items: DataFrame, trait_names: DataFrame, traits: DataFrame | None = None) -> DataFrame:
    """item_id and trait_id of every emblem; the trait is found by the emblem's display name.

    ``traits``: trait facts; only traits that occur in them have an id then.
    """
    trait_names = trait_names if traits is None else of_facts(trait_names, traits, "trait_id")
    ids = _ids_by_name(trait_names)
    emblems = items.filter(F.col("id").contains("Emblem")).select(
        F.col("id").alias("item_id"), F.nullif(F.regexp_extract("name", EMBLEM_NAME, 1), F.lit("")).alias("trait_name")
    )
    return emblems.join(ids, "trait_name", "left").select("item_id", "trait_id")


def reference_version(facts: DataFrame) -> DataFrame:
    """The lowest version of the facts with ``.1`` appended: the one whose documents apply."""
    version = F.col("game_version")
    order = F.struct(version_part(version, 1), version_part(version, 2))
    known = facts.filter(version.isNotNull())
    return known.agg(F.concat(F.min_by(version, order), F.lit(".1")).alias("reference_version"))
