"""Report tables: tiers, comparisons between versions, top traits, flags and scatter data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.scalars import half_even
from matchloom.operators.skew import largest_per_group
from matchloom.session import staged

TIERS = ["S", "A", "B", "C", "D"]
FEATURES = ["avg_place", "frequency", "win", "top4"]
OVERPOWERED_PLAY_RATE = 1
BETTER_PLACE = 4.5


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)


def grouped_kmeans(rows: DataFrame, groups: list[str], features: list[str], k: int, most: int = 100) -> DataFrame:
    """Add ``cluster``: k-means within each group, all groups at once.

    Features are scaled to their group's mean and spread. A group starts from k of its distinct points, evenly spaced in their
    order, and takes part in a step, which is one join with the groups' few centres and one aggregate, until no row of any group
    changes its cluster. So the number of jobs is that of the slowest group's steps, whatever the number of groups.
    Fewer distinct points than k give as many clusters.
    """
    spread = rows.groupBy(*groups).agg(*[F.avg(f).alias(f"_mean_{f}") for f in features], *[F.stddev_samp(f).alias(f"_sd_{f}") for f in features])
    point = F.array(*[F.when(F.col(f"_sd_{f}") > 0, (F.col(f) - F.col(f"_mean_{f}")) / F.col(f"_sd_{f}")).otherwise(0.0) for f in features])
    points = staged(rows.join(spread, groups).select(*rows.columns, point.alias("_point"), F.lit(-1).alias("cluster")), "points")
    in_order = Window.partitionBy(*groups).orderBy("_point")
    distinct = points.select(*groups, "_point").distinct()
    distinct = distinct.withColumns({"_i": F.row_number().over(in_order) - 1, "_n": F.count("*").over(Window.partitionBy(*groups))})
    of = F.least(F.lit(k), F.col("_n"))
    # with step = n / of, the points at step / 2, 3 step / 2, ...
    chosen = F.floor((2 * F.floor(F.col("_i") * of / F.col("_n")) + 1) * F.col("_n") / (2 * of))
    starts = distinct.filter(F.col("_i") == chosen)
    centres = starts.groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct(F.col("_i").cast("int").alias("id"), F.col("_point").alias("at")))).alias("_centres"))
    for _ in range(most):
        near = F.transform("_centres", lambda c: F.struct(_distance(F.col("_point"), c["at"]).alias("away"), c["id"].alias("id")))
        after = points.join(staged(centres, "centres"), groups).withColumn("_to", F.array_min(near)["id"])
        after = staged(after.select(*rows.columns, "_point", F.col("cluster").alias("_was"), F.col("_to").alias("cluster")), "points")
        points = after.drop("_was")
        if after.filter("_was != cluster").isEmpty():
            break
        means = points.groupBy(*groups, "cluster").agg(*[F.avg(F.col("_point")[i]).alias(f"_{i}") for i in range(len(features))])
        at = F.array(*[F.col(f"_{i}") for i in range(len(features))])
        centres = means.groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct(F.col("cluster").alias("id"), at.alias("at")))).alias("_centres"))
    return points.drop("_point")


def performance_tiers(stats: DataFrame, features: list[str] | None = None, groups: list[str] | None = None) -> DataFrame:
    """Five k-means clusters per version, or per other ``groups``, named S to D by their mean placement.

    ``stats`` is a finished statistic with one row per unit, composition or the like and group. Rows without a
    group or a feature are left out; fewer distinct rows than tiers give fewer tiers.
    """
    features, groups = features or FEATURES, groups or ["game_version"]
    known = staged(stats.na.drop(subset=[*groups, *features]), "tiers")
    tiered = grouped_kmeans(known, groups, features, len(TIERS))
    means = tiered.groupBy(*groups, "cluster").agg(F.avg("avg_place").alias("mean_place"))
    ranked = largest_per_group(means, groups, [F.asc("mean_place"), F.asc("cluster")], len(TIERS), "place")
    names = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("place"))
    named = ranked.select(*groups, "cluster", names.alias("performance_tier"))
    return tiered.join(named, [*groups, "cluster"]).drop("cluster")


def tier_facts(tiered: DataFrame, features: list[str] | None = None, slack: float = 1e-9) -> DataFrame:
    """What holds for tiers that k-means has settled on, by row: ``nearest``, no other tier's centre is nearer than
    the own one, and ``in_order``, no better tier has a worse mean placement. Centres are means of scaled features.
    """
    features = features or FEATURES
    version = Window.partitionBy("game_version")
    spread = {f: F.coalesce(F.stddev_samp(f).over(version), F.lit(0.0)) for f in features}
    scaled = {f"_{f}": F.when(sd > 0, (F.col(f) - F.avg(f).over(version)) / sd).otherwise(0.0) for f, sd in spread.items()}
    rows = tiered.withColumns(scaled)
    means = [F.avg(f"_{f}").alias(f"_mean_{f}") for f in features]
    centres = rows.groupBy("game_version", F.col("performance_tier").alias("_tier")).agg(*means, F.avg("avg_place").alias("_place"))
    # five rows a version at most
    centres = centres.groupBy("game_version").agg(F.collect_list(F.struct("*")).alias("_centres"))
    rank = lambda name: F.array_position(F.array(*[F.lit(t) for t in TIERS]), name)
    away = lambda c: sum((F.col(f"_{f}") - c[f"_mean_{f}"]) ** 2 for f in features)
    rows = rows.join(centres, "game_version")
    rows = rows.withColumn("_own", F.filter("_centres", lambda c: c["_tier"] == F.col("performance_tier"))[0])
    nearest = F.forall("_centres", lambda c: away(F.col("_own")) <= away(c) + slack)
    worse = lambda c: (rank(c["_tier"]) < rank(F.col("performance_tier"))) & (c["_place"] > F.col("_own._place") + slack)
    return rows.select(*tiered.columns, nearest.alias("nearest"), (~F.exists("_centres", worse)).alias("in_order"))


def version_comparison(stats: DataFrame, keys: list[str], measures: list[str], old: str, new: str) -> DataFrame:
    """Each measure in two versions side by side, with its change. Keys of either version are kept."""
    both = stats.filter(F.col("game_version").isin(old, new))
    sides = [
        F.max(F.when(F.col("game_version") == version, F.col(m))).alias(f"{m}_{name}")
        for m in measures
        for name, version in (("old", old), ("new", new))
    ]
    wide = both.groupBy(*keys).agg(*sides)
    changes = [half_even(F.col(f"{m}_new") - F.col(f"{m}_old"), 3).alias(f"{m}_change") for m in measures]
    return wide.select("*", *changes)


def top_traits(stats: DataFrame, n: int = 5) -> DataFrame:
    """The most played traits of every version and style."""
    order = [F.desc("play_rate"), F.asc("trait_id"), F.asc("current_tier"), F.asc("max_tier")]
    return largest_per_group(stats, ["game_version", "trait_style"], order, n)


def with_flags(stats: DataFrame) -> DataFrame:
    """Mark traits that are played more than once a match and those that place better than average."""
    return stats.withColumn("overpowered", F.col("play_rate") > OVERPOWERED_PLAY_RATE).withColumn(
        "better", F.col("avg_place") < BETTER_PLACE
    )


def item_scatter(stats: DataFrame, version: str, kind: str) -> DataFrame:
    """Mean placement and frequency of the items of one version and type."""
    chosen = stats.filter((F.col("game_version") == version) & (F.col("type") == kind))
    return chosen.select("items", "avg_place", "frequency")
