"""Analysis frames: the normalised tables with the match's version."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchloom.functions.scalars import version_order
from matchloom.operators.normalise import SUMMONS, drop_summons, renumber_slots
from matchloom.operators.skew import HOT_ROWS, SAMPLE
from matchloom.schemas import BOARD


def _ordered(df: DataFrame, ordered: bool, *then: str) -> DataFrame:
    """Sort over all partitions. Only for a last step: a job that goes on would lose the order again."""
    return df.orderBy(*version_order(), *then) if ordered else df


def load_matches(matches: DataFrame, ordered: bool = False) -> DataFrame:
    return _ordered(matches, ordered, "match_id")


def load_participants(participants: DataFrame, matches: DataFrame, ordered: bool = False) -> DataFrame:
    """Version, ids, placement and level of every participant of a known match."""
    version = matches.select("match_id", "game_version")
    joined = participants.select(*BOARD, "placement", "level").join(version, "match_id")
    return _ordered(
        joined.select("game_version", "match_id", "puuid", "placement", "level"), ordered, "match_id", "placement"
    )


def load_units(
    units: DataFrame,
    participants: DataFrame,
    matches: DataFrame,
    ordered: bool = False,
    summons: list[str] = SUMMONS,
    slot_order: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
    fraction: float = SAMPLE,
) -> DataFrame:
    """Units without summons, slots numbered from 0 per board, with the version.

    A board is in or out of the inner join as a whole, so its slots can be numbered first; numbering
    and join then share one shuffle of the units.
    """
    players = load_participants(participants, matches, ordered=False).select("game_version", *BOARD)
    own = units.select(*BOARD, "character_id", "slot_idx", "rarity", "tier", "items")
    numbered = renumber_slots(drop_summons(own, summons), slot_order, BOARD, hot_rows, fraction, seen_in=units)
    joined = numbered.join(players, BOARD).select(
        "game_version", *BOARD, "character_id", "slot_idx", "rarity", "tier", "items"
    )
    return _ordered(joined, ordered, *BOARD, "slot_idx")


def load_traits(traits: DataFrame, participants: DataFrame, matches: DataFrame, ordered: bool = False) -> DataFrame:
    players = load_participants(participants, matches, ordered=False).select("game_version", *BOARD)
    own = traits.select(*BOARD, "trait_id", "num_units", "current_tier", "max_tier", "trait_style")
    joined = own.join(players, BOARD).select(
        "game_version", *BOARD, "trait_id", "num_units", "current_tier", "max_tier", "trait_style"
    )
    return _ordered(joined, ordered, *BOARD, "trait_id")
