"""What the plans must and must not hold."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries
from matchloom.operators import comps, normalise
from matchloom.sources import sample

SF_DIR = "/root/testdata/sf0.001"
PLAIN = [
    "basic_unit_stats",
    "item_build_stats",
    "trait_stats",
    "item_stats",
    "item_top_carriers",
    "load_units_view",
    "load_traits_view",
    "board_cleanup",
    "parse_and_explode",
    "flatten_participants",
    "seed_topup",
    "per_key_cap",
    "orphan_rows",
    "comps",
    "legal_comps_by_units",
    "active_traits",
    "unit_list_projections",
    "dim_unit_traits",
    "version_delta",
]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_cross_join(spark, no_broadcast, name):
    text = plan(queries()[name](spark, SF_DIR))
    for operator in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_numbering_and_cleaning_share_one_shuffle(spark, no_broadcast):
    units = sample.units(spark, SF_DIR)
    boards = normalise.renumber_slots(units, sample.SLOT_ORDER)
    text = plan(normalise.clean_boards(boards, sample.MARKER, sample.SUMMONS))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_unit_statistics_read_three_columns(spark):
    text = plan(queries()["basic_unit_stats"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "l_extendedprice" not in text


def test_day_window_reaches_the_scan(spark):
    text = plan(queries()["day_window"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "LessThan(ts,2024-01-16" in text


def test_caps_apply_before_the_shuffle(spark, no_broadcast):
    for name in ("per_key_cap", "comps"):
        text = plan(queries()[name](spark, SF_DIR))
        tree = text[: text.index("(1) ")] if "\n(1) Scan" not in text else text[: text.index("\n(1) Scan")]
        lines = [line for line in tree.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
        kinds = ["limit" if "WindowGroupLimit" in line else "exchange" for line in lines]
        assert "".join(k[0] for k in kinds).find("lel") >= 0, tree


def test_trait_facts_are_not_moved_by_trait(spark, no_broadcast):
    listed = comps._trait_lists(sample.traits(spark, SF_DIR), sample.trait_tiers(spark))
    assert not re.search(r"hashpartitioning\(trait_id", plan(listed))
