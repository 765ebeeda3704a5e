"""Frequent compositions, frequent itemsets and the removal of supersets."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.boards import sort_units
from matchloom.functions.scalars import half_even, version_order
from matchloom.operators.containment import canonical, containing, with_rarest
from matchloom.operators.skew import largest_per_group
from matchloom.session import staged

MIN_SUPPORT = 1e-3
TOP_COMPS = 10
GROUP = ["game_version", "level"]


def frequent_comps(
    comps: DataFrame, min_support: float = MIN_SUPPORT, top: int = TOP_COMPS, units: str = "combine_units"
) -> DataFrame:
    """The most frequent full-length unit sets per version and level.

    A board has as many units as its level, so an itemset of that length can only be a whole board
    without repeated units: counting equal boards finds all of them. Boards with a repeated unit
    count in the support's denominator only. At most 1 / min_support sets of a group pass.
    """
    sets = comps.groupBy(*GROUP, canonical(F.col(units)).alias("itemset")).agg(F.count("*").alias("n"))
    # Two branches read the counts, and only one of them filters; staged, the boards are read once.
    sets = staged(sets, "sets")
    totals = sets.groupBy(*GROUP).agg(F.sum("n").alias("n_boards"))
    whole = sets.filter(F.size("itemset") == F.col("level")).join(totals, GROUP)
    kept = whole.filter(F.col("n") >= F.ceil(F.col("n_boards") * F.lit(min_support)))
    kept = kept.withColumn("itemsets", sort_units(F.col("itemset")))
    ranked = largest_per_group(kept, GROUP, [F.desc("n"), F.asc("itemsets")], top)
    return ranked.select(*GROUP, "itemsets", half_even(F.col("n") / F.col("n_boards"), 4).alias("support")).orderBy(
        *version_order(), "level", F.desc("support"), "itemsets"
    )


def frequent_itemsets(
    baskets: DataFrame, items: str, groups: list[str], min_support: float = MIN_SUPPORT
) -> DataFrame:
    """All itemsets of any length whose support within their group reaches ``min_support``.

    FP-growth runs over the groups together, items carrying their group. It knows one threshold, so
    groups of like size (within a factor of two) share a run with the threshold of the smallest, and
    each group's own threshold is applied to the result.
    """
    group = F.struct(*groups)
    own = baskets.na.drop(subset=groups).select(
        *groups, F.transform(F.array_distinct(items), lambda x: F.struct(group.alias("g"), x.alias("item"))).alias("items")
    )
    sizes = own.groupBy(*groups).agg(F.count("*").alias("n_baskets"))
    own = own.join(sizes, groups).withColumn("scale", F.floor(F.log2("n_baskets")))
    own = staged(own, "baskets", ["scale"])
    # One row per power of two that occurs as a group size.
    runs = own.groupBy("scale").agg(F.count("*").alias("n"), F.min("n_baskets").alias("smallest")).collect()
    found = None
    for run in runs:
        # Half a basket below the smallest group's threshold, so rounding cannot raise it.
        least = max(1, math.ceil(min_support * run["smallest"])) - 0.5
        model = FPGrowth(itemsCol="items", minSupport=least / run["n"])
        result = model.fit(own.filter(F.col("scale") == run["scale"]).select("items")).freqItemsets
        found = result if found is None else found.unionByName(result)
    if found is None:
        found = own.select("items").withColumn("freq", F.lit(0).cast("long"))
    named = found.select(
        F.col("items")[0]["g"].alias("g"), canonical(F.col("items.item")).alias("itemsets"), "freq"
    ).select("g.*", "itemsets", "freq")
    kept = named.join(sizes, groups).filter(F.col("freq") >= F.ceil(F.col("n_baskets") * F.lit(min_support)))
    return kept.select(*groups, "itemsets", "freq", (F.col("freq") / F.col("n_baskets")).alias("support"))


def frequent_itemsets_of_level(
    baskets: DataFrame, units: str = "combine_units", min_support: float = MIN_SUPPORT, top: int = TOP_COMPS
) -> DataFrame:
    """``frequent_comps`` for baskets that may hold more distinct units than their level."""
    found = frequent_itemsets(baskets, units, GROUP, min_support).filter(F.size("itemsets") == F.col("level"))
    found = found.withColumn("itemsets", sort_units(F.col("itemsets")))
    ranked = largest_per_group(found, GROUP, [F.desc("freq"), F.asc("itemsets")], top)
    return ranked.select(*GROUP, "itemsets", half_even(F.col("support"), 4).alias("support")).orderBy(
        *version_order(), "level", F.desc("support"), "itemsets"
    )


def dedup_comps(comps: DataFrame, order: list[Column], by: list[str] | None = None) -> DataFrame:
    """Drop a composition if one that comes earlier within ``by`` is a subset of it (or equal).

    It is enough to look at all earlier rows, kept or not: if the earlier subset was dropped itself,
    what dropped it is earlier still and a subset too. Equal sets are looked up once, each through the lists of
    its pairs of units, so no two compositions are compared unless one holds the other's two rarest units.
    """
    by = by or ["game_version"]
    own = comps.withColumn("_order", F.struct(*order)).withColumn("_set", canonical(F.col("itemsets")))
    first = staged(own.groupBy(*by, "_set").agg(F.min("_order").alias("_first")), "first")
    sets = first.select(*by, F.col("_set").alias("unit_set"))
    itemsets = first.select(F.struct(*by, "_set").alias("itemset_id"), *by, F.col("_set").alias("itemset"), "_first")
    seen = containing(with_rarest(itemsets, sets), sets, by)
    earliest = seen.groupBy(*by, F.col("unit_set").alias("_set")).agg(F.min("_first").alias("_earliest"))
    kept = own.join(earliest, [*by, "_set"]).filter(F.col("_order") <= F.col("_earliest"))
    kept = kept.groupBy(*by, "_set", "_order").agg(F.first("itemsets").alias("itemsets"), F.first("level").alias("level"))
    return kept.select(*by, "itemsets", "level")
