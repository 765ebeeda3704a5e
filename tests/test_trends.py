"""Clusters of many groups, forecasts, drift of nested records, streams with state and rates."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import forecast, quality, report
from matchloom.schemas import RAW_MATCH
from matchloom.streaming import landing
from test_tables import match


def blobs(rnd, groups):
    rows = []
    for g in groups:
        centres = [(rnd.uniform(-9, 9), rnd.uniform(-9, 9)) for _ in range(3)]
        rows += [(g, i, *(c + rnd.gauss(0, 0.1) for c in centres[i % 3])) for i in range(30)]
    return rows


def test_kmeans_of_groups_settles_in_each(spark):
    rows = blobs(random.Random(2), ["a", "b", "c"]) + [("one", 0, 1.0, 1.0), ("same", 0, 2.0, 2.0), ("same", 1, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, i int, x double, y double")
    got = report.grouped_kmeans(df, ["g"], ["x", "y"], 3).collect()
    assert len(got) == len(rows)
    for g in "abc":
        of = [r for r in got if r.g == g]
        sd = {f: (sum((r[f] - sum(q[f] for q in of) / len(of)) ** 2 for r in of) / (len(of) - 1)) ** 0.5 for f in "xy"}
        clusters = {c: [r for r in of if r.cluster == c] for c in {r.cluster for r in of}}
        centres = {c: [sum(r[f] for r in rs) / len(rs) for f in "xy"] for c, rs in clusters.items()}

        def away(r, c):
            return sum(((r[f] - m) / sd[f]) ** 2 for f, m in zip("xy", centres[c], strict=True))

        assert all(away(r, r.cluster) <= min(away(r, c) for c in centres) + 1e-9 for r in of)
    assert len({r.cluster for r in got if r.g == "same"}) == 1


def test_jobs_of_tiers_do_not_grow_with_versions(spark):
    """Steps are shared by all groups: as many staged tables for forty groups as for the slowest one of them."""
    rnd = random.Random(3)
    rows = blobs(rnd, [f"g{i}" for i in range(40)])
    df = spark.createDataFrame(rows, "g string, i int, x double, y double")
    steps = []
    real = report.staged

    def counted(frame, name, partition_by=None):
        steps.append(name)
        return real(frame, name, partition_by)

    report.staged = counted
    try:
        report.grouped_kmeans(df, ["g"], ["x", "y"], 3)
        together, worst = len(steps), 0
        for g in ("g0", "g1"):
            steps.clear()
            report.grouped_kmeans(df.filter(F.col("g") == g), ["g"], ["x", "y"], 3)
            worst = max(worst, len(steps))
    finally:
        report.staged = real
    assert worst <= together <= 40


def test_forecast_is_least_squares(spark):
    rnd = random.Random(4)
    sets = [(2, [f"U{j}", f"U{i}"]) for i in range(6) for j in range(i)]
    rows = [(f"15.{v}", f"m{v}{k}{n}", "p", rnd.randint(1, 8), level, units) for v in (8, 9, 10) for k, (level, units) in enumerate(sets) for n in range(3)]
    rows.append((None, "x", "p", 1, 2, ["U0", "U1"]))
    built = spark.createDataFrame(rows, "game_version string, match_id string, puuid string, placement int, level int, combine_units array<string>")
    strength = forecast.strengths(built, 3)
    mean = {(v, tuple(u)): sum(r[3] for r in rows if r[0] == v and r[5] == u) / 3 for v in ("15.8", "15.9", "15.10") for _, u in sets}
    order = ["15.8", "15.9", "15.10"]

    def line(pairs):
        mx, my = (sum(p[i] for p in pairs) / len(pairs) for i in (0, 1))
        slope = sum((x - mx) * (y - my) for x, y in pairs) / sum((x - mx) ** 2 for x, _ in pairs)
        return slope, my - slope * mx

    steps = [[(mean[a, u], mean[b, u]) for _, u in ((v, tuple(x)) for v, x in sets)] for a, b in zip(order, order[1:], strict=False)]
    found = forecast.held_out_error(strength).first()
    slope, intercept = line(steps[0])
    assert (found.slope, found.intercept) == pytest.approx((slope, intercept)) and found.n_tested == len(sets)
    assert found.error == pytest.approx((sum((y - slope * x - intercept) ** 2 for x, y in steps[1]) / len(sets)) ** 0.5)
    slope, intercept = line(steps[0] + steps[1])
    for r in forecast.forecast(strength).collect():
        assert r.game_version == "15.10" and r.expected_place == pytest.approx(slope * mean["15.10", tuple(r.itemsets)] + intercept)
    assert forecast.forecast(strength.limit(0)) is None
    assert forecast.held_out_error(strength.filter("game_version = '15.10'")).first().n_tested == 0


def test_drift_of_nested_records(spark):
    good = match("a")
    whole = dict.fromkeys(f.name for f in RAW_MATCH["info"].dataType["participants"].dataType.elementType.fields)
    good["info"]["participants"] = [whole | {"units": [{"character_id": "U", "itemNames": ["i"], "name": "", "rarity": 1, "tier": 2}], "placement": 1, "traits": [], "companion": {"content_ID": "x"}}]
    changed = json.loads(json.dumps(good))
    changed["info"]["participants"][0]["units"][0] |= {"tier": "two", "chosen": True}
    del changed["metadata"]
    rows = [(1, json.dumps(good)), (2, json.dumps(changed)), (3, "{broken"), (3, None), (3, json.dumps(good)), (4, "[1]")]
    lines = spark.createDataFrame(rows, "run_date int, value string")
    got = {(r.run_date, r.path, r.problem): (r.found, r.expected, r.n_rows) for r in quality.nested_drift(lines, RAW_MATCH).collect()}
    unit = "info.participants[].units[]"
    assert got[2, f"{unit}.tier", "retyped"] == ("string", "int", None) and got[2, f"{unit}.chosen", "added"] == ("boolean", None, None)
    assert got[2, "metadata", "missing"] == (None, "nested", None) and got[3, "", "does not parse"] == (None, None, 1)
    assert got[4, "", "retyped"][0] == "array<bigint>"
    assert not any(k[0] == 1 for k in got) and {k[1:] for k in got if k[0] == 3} == {("", "does not parse")}


def feed(spark, path, rows, kind):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(kind).parquet(path)


def test_new_keys_over_batches_whatever_the_expiry(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for batch in (["a", "b", "a"], ["b", "c"], ["a", "c", "d"]):
        stream = feed(spark, source, [(k,) for k in batch], "k string")
        landing.load_new_keys(stream, ["k"], out, check, ttl_ms=1)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_rates_count_a_match_of_several_batches_once(spark, tmp_path):
    rnd = random.Random(5)
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [(f"2024-01-0{rnd.randint(1, 2)} 10:00:00", rnd.choice("xy"), rnd.randint(1, 8), rnd.choice([*range(40), 10**9, -7, None])) for _ in range(200)]
    for at in range(0, 200, 40):
        part = spark.createDataFrame(rows[at : at + 40], "ts string, k string, placement int, no long").withColumn("ts", F.col("ts").cast("timestamp"))
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        landing.run_daily_rates(stream, "ts", ["k"], "placement", "no", out, check, least=2)
    got = {(str(r.day), r.k): (r.n_rows, r.matches) for r in landing.daily_rates(spark, out, ["k"]).collect()}
    days = {r[0][:10] for r in rows}
    want = {(d, k): (sum(r[0][:10] == d and r[1] == k for r in rows), len({r[3] for r in rows if r[0][:10] == d and r[3] is not None})) for d in days for k in "xy"}
    assert got == want
    merged = landing.snapshots.log(spark, f"{out}/counts").collect()
    assert sorted(r.n_rows for r in merged) == [1, 3]  # after the second and the fourth batch
