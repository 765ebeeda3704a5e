"""Every registered query against its SQL."""

from __future__ import annotations

import os
import re

import pytest
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, queries()[name], oracle_sql()[name]) is None


def test_every_query_has_sql_but_the_clustering():
    own = {name for name in queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own - set(oracle_sql()) == {"performance_tiers"}
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_performance_tiers(spark):
    rows = queries()["performance_tiers"](spark, SF_DIR).collect()
    assert len(rows) == queries()["basic_unit_stats"](spark, SF_DIR).count()
    for version in {r.game_version for r in rows}:
        places: dict[str, list[float]] = {}
        for r in rows:
            if r.game_version == version:
                places.setdefault(r.performance_tier, []).append(r.avg_place)
        means = [sum(p) / len(p) for _, p in sorted(places.items(), key=lambda kv: "SABCD".index(kv[0]))]
        assert means == sorted(means) and len(means) <= 5
