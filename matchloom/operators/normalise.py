"""Landed records to the four normalised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.literals import parse_literal
from matchloom.functions.scalars import major_minor
from matchloom.operators.skew import HOT_ROWS, SAMPLE, number_rows, split_heavy
from matchloom.schemas import BOARD, TRAIT_LIST, UNIT_LIST
from matchloom.session import staged

# Sentinel ids, the unit that copies another, and summoned units.
NO_TRAIT = "TFT_NoneTrait"
NO_UNIT = "TFT_NoneUnit"
MARKER = "TFT14_Viego"
SUMMONS = ["TFT14_SummonLevel2", "TFT14_SummonLevel4", "TFT14_Summon_Turret", "TFT14_AnnieTibbers"]


def _or_sentinel(items: Column, sentinel: Column) -> Column:
    return F.when(F.size(items) > 0, items).otherwise(F.array(sentinel))


def with_parsed_lists(landed: DataFrame) -> DataFrame:
    """Landed participants with ``traits`` and ``units`` parsed from their literals."""
    return landed.withColumn("traits", parse_literal(F.col("traits"), TRAIT_LIST)).withColumn(
        "units", parse_literal(F.col("units"), UNIT_LIST)
    )


def trait_rows(participants: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per trait of a participant; a participant without traits gets one sentinel row."""
    none = F.struct(
        F.lit(NO_TRAIT).alias("name"),
        F.lit(-1).alias("num_units"),
        F.lit(-1).alias("style"),
        F.lit(-1).alias("tier_current"),
        F.lit(-1).alias("tier_total"),
    )
    exploded = participants.select(*BOARD, *(carry or []), F.explode(_or_sentinel(F.col("traits"), none)).alias("t"))
    return exploded.select(
        *BOARD,
        F.col("t.name").alias("trait_id"),
        F.col("t.num_units").alias("num_units"),
        F.col("t.tier_current").alias("current_tier"),
        F.col("t.tier_total").alias("max_tier"),
        F.col("t.style").alias("trait_style"),
        *(carry or []),
    )


def unit_rows(participants: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per unit of a participant with its slot; a participant without units gets a sentinel."""
    none = F.struct(
        F.lit(NO_UNIT).alias("character_id"),
        F.array().cast("array<string>").alias("itemNames"),
        F.lit("").alias("name"),
        F.lit(-1).alias("rarity"),
        F.lit(-1).alias("tier"),
    )
    exploded = participants.select(
        *BOARD, *(carry or []), F.posexplode(_or_sentinel(F.col("units"), none)).alias("slot_idx", "u")
    )
    return exploded.select(
        *BOARD,
        F.col("u.character_id").alias("character_id"),
        "slot_idx",
        F.col("u.rarity").alias("rarity"),
        F.col("u.tier").alias("tier"),
        F.col("u.itemNames").alias("items"),
        *(carry or []),
    )


def match_table(landed: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Landed match headers as the ``matches`` table."""
    return landed.select(
        "match_id",
        F.timestamp_millis(F.col("game_datetime")).alias("game_datetime"),
        F.col("game_length").alias("game_duration"),
        major_minor(F.col("game_version")).alias("game_version"),
        "tft_set_number",
        *(carry or []),
    )


def participant_table(landed: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Landed participants as the ``participants`` table."""
    return landed.select(
        "match_id",
        "puuid",
        F.col("name").alias("player_name"),
        F.col("tagline").alias("player_tagline"),
        "placement",
        "level",
        F.col("total_damages").alias("total_damage_to_players"),
        F.col("player_eliminated").alias("eliminated_player_count"),
        "time_eliminated",
        "last_round",
        "gold_left",
        "companion",
        *(carry or []),
    )


def _marker_facts(marker: str) -> dict[str, Column]:
    """Last marker slot, number of markers and items on the last marker."""
    slot = F.when(F.col("character_id") == marker, F.col("slot_idx"))
    return {"_last": F.max(slot), "_markers": F.count(slot), "_last_items": F.max_by(F.size("items"), slot)}


def _copied_slot(summons: list[str]) -> Column:
    summon = F.coalesce(F.col("character_id").isin(summons), F.lit(False))
    follows = (F.col("slot_idx") > F.col("_last")) & ~summon
    return F.min(F.when(follows, F.col("slot_idx")))


def _without_removed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the one removed slot of a board and close the gap it leaves."""
    spare = F.when((F.col("_markers") >= 2) & (F.col("_last_items") == 1), F.col("_last"))
    gone = F.coalesce(F.col("_copied"), spare)
    return (
        df.withColumn("_gone", gone)
        .filter(F.col("_gone").isNull() | (F.col("slot_idx") != F.col("_gone")))
        .withColumn("slot_idx", F.col("slot_idx") - F.when(F.col("slot_idx") > F.col("_gone"), 1).otherwise(0))
        .select(*columns)
    )


def clean_boards(
    units: DataFrame,
    marker: str = MARKER,
    summons: list[str] = SUMMONS,
    keys: list[str] = BOARD,
    hot_rows: int = HOT_ROWS,
    fraction: float = SAMPLE,
    seen_in: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Remove the copied unit that follows the last marker of a board.

    The first unit after the last marker that is not a summon goes. If there is none, the board has
    two markers or more, and the last one holds exactly one item, that marker goes instead. Slots
    must run from 0 without gaps; they do so again afterwards. At most one unit leaves a board.
    """
    columns = units.columns
    cold, hot = split_heavy(units, keys, hot_rows, fraction, seen_in, heavy)

    board = Window.partitionBy(*keys)
    marked = cold.withColumns({name: fact.over(board) for name, fact in _marker_facts(marker).items()})
    marked = marked.withColumn("_copied", _copied_slot(summons).over(board))
    cleaned = _without_removed(marked, columns)
    if hot is None:
        return cleaned

    # Heavy boards: the same facts as aggregates, which combine before the shuffle, one row per heavy
    # key. They are written, so Spark decides by real sizes how to join them.
    facts = hot.groupBy(*keys).agg(*[fact.alias(name) for name, fact in _marker_facts(marker).items()])
    marked = hot.join(staged(facts, "board_facts"), keys)
    copied = marked.groupBy(*keys).agg(_copied_slot(summons).alias("_copied"))
    marked = marked.join(staged(copied, "copied_slots"), keys)
    return cleaned.unionByName(_without_removed(marked, columns))


def clean_unit_lists(
    participants: DataFrame, marker: str = MARKER, summons: list[str] = SUMMONS, units: str = "units"
) -> DataFrame:
    """``clean_boards`` for participants that still hold their units as one list: no shuffle at all."""
    column = F.col(units)

    def place(condition) -> Column:
        return F.transform(column, lambda u, i: F.when(condition(u, i), i))

    def follows(u: Column, i: Column) -> Column:
        return (i > F.col("_last")) & ~F.coalesce(u["character_id"].isin(summons), F.lit(False))

    marked = participants.withColumn("_markers", place(lambda u, i: u["character_id"] == marker))
    marked = marked.withColumn("_last", F.array_max("_markers"))
    marked = marked.withColumn("_copied", F.when(F.col("_last").isNotNull(), F.array_min(place(follows))))
    single = F.size(F.get(column, F.col("_last"))["itemNames"]) == 1
    spare = F.when((F.size(F.array_compact("_markers")) >= 2) & single, F.col("_last"))
    marked = marked.withColumn("_gone", F.coalesce("_copied", spare))
    kept = F.when(F.col("_gone").isNull(), column).otherwise(F.filter(column, lambda u, i: i != F.col("_gone")))
    return marked.withColumn(units, kept).drop("_markers", "_last", "_copied", "_gone")


def renumber_slots(
    units: DataFrame,
    order: list[str] | None = None,
    keys: list[str] = BOARD,
    hot_rows: int = HOT_ROWS,
    fraction: float = SAMPLE,
    seen_in: DataFrame | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Number the slots of every board from 0, in slot order."""
    return number_rows(units, keys, order or ["slot_idx"], "slot_idx", hot_rows, fraction, seen_in, heavy)


def drop_summons(units: DataFrame, summons: list[str] = SUMMONS) -> DataFrame:
    """Leave summoned units out; an unknown id is left out as well."""
    return units.filter(~F.col("character_id").isin(summons))
