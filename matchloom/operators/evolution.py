"""Statistics of frequent compositions and how they grow from level to level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.boards import contains_all, normalise_tiers, without_tier
from matchloom.functions.scalars import half_even, version_order
from matchloom.operators.comps import active_traits, trait_lookups
from matchloom.operators.containment import MAX_SENT, canonical, containing, is_sent, prepared
from matchloom.operators.outcome import mean_place, rolled_up, tally, top4_rate, win_rate
from matchloom.session import staged

LAST_LEVEL = 9
REPORT_LEVELS = (7, 8, 9)


def comp_catalog(comps: DataFrame) -> DataFrame:
    """Equal boards counted together: outcome tally per version, level and full unit list."""
    counted = tally(comps, ["game_version", "level", "combine_units", "combine_full_units"])
    return counted.withColumn("unit_set", canonical(F.col("combine_units")))


def _itemsets(freq: DataFrame) -> DataFrame:
    """Itemsets with an id. The id is made of the row itself, so it is the same in every branch."""
    itemset = canonical(F.col("itemsets"))
    return freq.select(
        F.struct("game_version", "level", "itemsets").alias("itemset_id"),
        itemset.alias("itemset"),
        "game_version",
        F.col("level").alias("start_level"),
    ).distinct()


def comp_outcomes(
    catalog: DataFrame, freq: DataFrame, total_matches: DataFrame, max_sent: int = MAX_SENT
) -> DataFrame:
    """Play rate and outcome of the boards of a version that hold all of an itemset.

    Itemsets that no board holds have no row. Boards are tallied per unit set before the subset join.
    """
    sets = rolled_up(catalog, ["game_version", "unit_set"])
    itemsets = prepared(_itemsets(freq).select("itemset_id", "itemset", "game_version"), sets, max_sent)
    pairs = containing(itemsets, sets, ["game_version"])
    stats = rolled_up(pairs, ["game_version", "itemset_id"]).join(total_matches, "game_version")
    return stats.select(
        "itemset_id",
        half_even(F.col("n_rows") / F.col("matches"), 2).alias("play_rate"),
        half_even(mean_place(), 2).alias("avg_place"),
        half_even(win_rate(), 3).alias("win"),
        half_even(top4_rate(), 3).alias("top4"),
    )


def comp_evolution(
    catalog: DataFrame,
    freq: DataFrame,
    first_level: int,
    last_level: int = LAST_LEVEL,
    within_version: bool = False,
    max_sent: int = MAX_SENT,
) -> DataFrame:
    """Per itemset and level, the most common full board that grows out of the level before.

    Candidates of a level hold the whole itemset, in any version unless ``within_version``. Levels
    are gone through upwards from the itemset's own; the most common candidate is taken whose units
    include those of the board taken last. A level without one is NULL and leaves the last board in
    force. Equally common candidates are taken in order of their unit lists.

    Returns itemset_id and one array column ``level_N`` per level from ``first_level`` on. The loop
    only builds the plan, and each level's step refers to the step before once.
    """
    by = ["game_version"] if within_version else []
    itemsets = prepared(_itemsets(freq).select("itemset_id", "itemset", "start_level", *by), catalog, max_sent)
    boards = catalog.groupBy("level", "combine_full_units", "unit_set", *by).agg(F.sum("n_rows").alias("n"))
    board = normalise_tiers(F.col("combine_full_units"))
    boards = boards.select("*", board.alias("board"), canonical(without_tier(board)).alias("base"))
    boards = staged(boards, "boards", ["level"])

    steps = itemsets.select("itemset_id", F.lit(None).cast("array<string>").alias("taken"))
    done: list[str] = []
    for level in range(first_level, last_level + 1):
        found = containing(itemsets, boards.filter(F.col("level") == level), by)
        found = found.filter(F.col("start_level") <= level)
        candidates = found.select(
            "itemset_id",
            "board",
            "base",
            F.struct((-F.col("n")).alias("less"), "combine_full_units").alias("place"),
        )
        # A row that stands for "none" keeps every itemset in the join.
        blanks = [F.lit(None).cast(candidates.schema[c].dataType).alias(c) for c in ("board", "base", "place")]
        none = itemsets.select("itemset_id", *blanks)
        last = F.broadcast(steps) if is_sent(itemsets) else steps
        open_ = candidates.unionByName(none).join(last, "itemset_id")
        grows = contains_all(F.col("base"), F.col("taken"))
        open_ = open_.filter(F.col("board").isNull() | F.col("taken").isNull() | grows)
        best = F.min_by(F.struct("board", "base"), "place")
        column = f"level_{level}"
        steps = (
            open_.groupBy("itemset_id")
            .agg(best.alias("best"), F.first("taken").alias("taken"), *[F.first(c).alias(c) for c in done])
            .select(
                "itemset_id",
                F.coalesce("best.base", "taken").alias("taken"),
                *done,
                F.col("best.board").alias(column),
            )
        )
        done.append(column)
    return steps.drop("taken")


def comp_stats(
    comps: DataFrame,
    freq: DataFrame,
    unit_traits: DataFrame,
    trait_tiers: DataFrame,
    report_levels: tuple[int, ...] = REPORT_LEVELS,
    last_level: int = LAST_LEVEL,
    within_version: bool = False,
    with_key: bool = False,
) -> DataFrame:
    """Outcome of every frequent composition with its most common growth and the traits it activates.

    ``with_key`` adds the level and itemset of the row. ``comps`` is read three times, so it should
    be a stored table or staged.
    """
    freq = staged(freq.select("game_version", "level", "itemsets"), "freq")
    catalog = staged(comp_catalog(comps), "catalog")
    totals = comps.groupBy("game_version").agg(F.count_distinct("match_id").alias("matches"))
    first_level = freq.agg(F.min("level")).first()[0]
    if first_level is None:
        first_level = min(report_levels)
    outcomes = comp_outcomes(catalog, freq, totals)
    # Only levels that are reported, or that lead up to one, matter.
    grown = comp_evolution(
        catalog, freq, min(first_level, *report_levels), min(last_level, max(report_levels)), within_version
    )
    stats = outcomes.join(grown, "itemset_id")
    known = trait_lookups(unit_traits, trait_tiers)
    columns = []
    for level in report_levels:
        name = f"level_{level}"
        stats = active_traits(stats, name, unit_traits, trait_tiers, out=f"{name}_traits", known=known)
        columns += [name, f"{name}_traits"]
    key = [F.col("itemset_id.level").alias("level"), F.col("itemset_id.itemsets").alias("itemsets")] if with_key else []
    return stats.orderBy(*version_order("itemset_id.game_version"), "itemset_id").select(
        F.col("itemset_id.game_version").alias("game_version"), *key, *columns, "play_rate", "avg_place", "win", "top4"
    )
