"""Canonical orders and projections of unit, trait and item lists.

Unit ids look like ``Set_Name_Rarity[_Tier]``, trait ids like ``Set_Name_NumUnits_Tier``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A board slot holding one of these counts as that item alone.
SOLE_ITEMS = ["ThiefsGloves", "TFT9_Item_OrnnPrototypeForge"]
EMBLEM = "Emblem"


def _number(text: Column, position: int) -> Column:
    return F.get(F.split(text, "_"), F.lit(position)).try_cast("int")


def _name(text: Column) -> Column:
    return F.get(F.split(text, "_"), F.lit(1))


def _sorted_by(items: Column, key) -> Column:
    ranked = F.transform(items, lambda x, i: F.struct(*key(x), i.alias("pos"), x.alias("value")))
    return F.transform(F.array_sort(ranked), lambda s: s["value"])


def sort_units(units: Column, tier: bool = False) -> Column:
    """Order by rarity, name (and tier); ids that do not parse go last; equal keys keep their order."""

    def key(x: Column) -> list[Column]:
        fields = [("rarity", _number(x, 2), 999), ("unit_name", _name(x), "ZZZ")]
        if tier:
            fields.append(("unit_tier", _number(x, 3), 999))
        parsed = F.lit(True)
        for _, value, _ in fields:
            parsed = parsed & value.isNotNull()
        return [F.when(parsed, v).otherwise(F.lit(last)).alias(n) for n, v, last in fields]

    return _sorted_by(units, key)


def sort_traits(traits: Column) -> Column:
    """Order by unit count and tier, both descending, then name; ids that do not parse go last."""

    def key(x: Column) -> list[Column]:
        count, tier, name = _number(x, 2), _number(x, 3), _name(x)
        parsed = count.isNotNull() & tier.isNotNull() & name.isNotNull()
        return [
            F.when(parsed, -count).otherwise(F.lit(999)).alias("num_units"),
            F.when(parsed, -tier).otherwise(F.lit(999)).alias("trait_tier"),
            F.when(parsed, name).otherwise(F.lit("ZZZ")).alias("trait_name"),
        ]

    return _sorted_by(traits, key)


def unit_tiers(units: Column) -> Column:
    """The trailing tier of every unit."""
    return F.transform(units, lambda x: F.element_at(F.split(x, "_"), -1).try_cast("int"))


def without_tier(units: Column) -> Column:
    """Every unit without its last ``_`` part."""
    return F.transform(units, lambda x: F.regexp_replace(x, "_[^_]*$", ""))


def normalise_tiers(units: Column) -> Column:
    """Four-part ids of tier 1 become tier 2, then the list is put in order again."""
    lifted = F.transform(
        units,
        lambda x: F.when(
            (F.size(F.split(x, "_")) == 4) & x.endswith("_1"),
            F.regexp_replace(x, "_1$", "_2"),
        ).otherwise(x),
    )
    return sort_units(lifted, tier=True)


def id_prefix(value: Column) -> Column:
    """The first two ``_`` parts: the bare unit or trait id."""
    return F.substring_index(value, "_", 2)


def emblem_items(items: Column) -> Column:
    """The items of a list that are emblems; a missing list gives an empty one.

    Most lists have none, which the joined text shows without going through the items.
    """
    found = F.filter(items, lambda x: x.contains(EMBLEM))
    return F.when(F.array_join(items, ",").contains(EMBLEM), found).otherwise(F.array().cast("array<string>"))


def item_build(items: Column) -> Column:
    """One string per set of items: a sole item alone, else all of them sorted and joined by ``+``."""
    sole = F.filter(items, lambda x: F.coalesce(x.contains(SOLE_ITEMS[0]) | x.contains(SOLE_ITEMS[1]), F.lit(False)))
    joined = F.array_join(F.sort_array(items), "+")
    maybe_sole = joined.contains(SOLE_ITEMS[0]) | joined.contains(SOLE_ITEMS[1])
    return (
        F.when(items.isNull() | (F.size(items) == 0), F.lit(""))
        .when(maybe_sole & (F.size(sole) == 1), F.get(sole, F.lit(0)))
        .otherwise(joined)
    )


def contains_all(whole: Column, part: Column) -> Column:
    """True when every element of ``part`` is in ``whole``."""
    return F.forall(part, lambda x: F.array_contains(whole, x))
