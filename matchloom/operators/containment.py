"""Subset joins: which unit sets contain which itemsets.

Unit sets are few compared with the boards they come from, because equal boards are counted together
first. Pairs are found through inverted lists: an itemset stands in one list alone, that of its two
rarest units, and a unit set looks into the lists of its pairs of units. A set of n units has n (n + 1) / 2
of them, never its 2^n subsets, and meets only itemsets whose rarest two units it holds. The route is the same for any number of
itemsets; a checked-small table of them is sent to every task, a longer one is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.boards import contains_all
from matchloom.operators.comps import is_small
from matchloom.session import staged

MAX_SENT = 20_000


def canonical(items: Column) -> Column:
    """A list as a set: distinct and in order."""
    return F.array_sort(F.array_distinct(items))


def subsets(items: Column) -> Column:
    """All non-empty subsets of a canonical set, each canonical itself."""
    empty = F.array(F.array().cast("array<string>"))
    powerset = F.aggregate(
        items,
        empty,
        lambda acc, x: F.concat(acc, F.transform(acc, lambda s: F.array_append(s, x))),
    )
    return F.filter(powerset, lambda s: F.size(s) > 0)


def pairs_of(items: Column) -> Column:
    """All pairs of units of a canonical set, a unit with itself included, each canonical."""
    size = F.size(items)
    return F.flatten(F.transform(items, lambda x, i: F.transform(F.slice(items, i + 1, size), lambda y: F.array(x, y))))


def with_rarest(itemsets: DataFrame, sets: DataFrame) -> DataFrame:
    """Add ``key``: the two units of each itemset that the fewest of the sets hold; one unit stands twice.

    ``itemsets``: itemset_id (unique), itemset (canonical) and others. Empty itemsets have no row.
    """
    use = sets.select(F.explode("unit_set").alias("item")).groupBy("item").agg(F.count("*").alias("n_sets"))
    rows = itemsets.select("itemset_id", F.explode("itemset").alias("item")).join(use, "item", "left")
    # an itemset is as long as a board; the two least of its units are kept
    listed = F.array_sort(F.collect_list(F.struct(F.coalesce("n_sets", F.lit(0)).alias("n_sets"), "item")))
    first = rows.groupBy("itemset_id").agg(F.slice(listed, 1, 2)["item"].alias("few"))
    key = F.array_sort(F.when(F.size("few") == 1, F.array(F.col("few")[0], F.col("few")[0])).otherwise(F.col("few")))
    return itemsets.join(first.select("itemset_id", key.alias("key")), "itemset_id")


def prepared(itemsets: DataFrame, sets: DataFrame, max_sent: int = MAX_SENT) -> DataFrame:
    """Itemsets with their ``key``, written; marked as ``sent`` if there are at most ``max_sent``."""
    rows = with_rarest(itemsets, sets)
    return staged(rows.withColumn("sent", F.lit(True)) if is_small(itemsets, max_sent) else rows, "itemsets")


def is_sent(itemsets: DataFrame) -> bool:
    """True if ``prepared`` found the itemsets few enough to send them to every task."""
    return "sent" in itemsets.columns


def containing(itemsets: DataFrame, sets: DataFrame, by: list[str]) -> DataFrame:
    """Pairs of an itemset and a unit set holding all of it, with equal ``by`` columns.

    ``itemsets``, out of ``prepared`` or ``with_rarest``: itemset_id (unique), itemset (canonical), the ``by`` columns
    and others. ``sets``: unit_set (canonical), the ``by`` columns and others.
    """
    listed = F.broadcast(itemsets.drop("sent")) if is_sent(itemsets) else itemsets
    keyed = sets.select("*", F.explode(pairs_of(F.col("unit_set"))).alias("key"))
    return keyed.join(listed, [*by, "key"]).filter(contains_all(F.col("unit_set"), F.col("itemset"))).drop("key")
