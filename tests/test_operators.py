"""Weighted aggregates, percentile, merge, rollups, quality counts."""

import datetime as dt
import os
import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthgrid import schemas
from hearthgrid import constants as C
from hearthgrid.functions import units
from hearthgrid.functions import weighted as W
from hearthgrid.operators import dq, merge, percentile, rollup

T0 = dt.datetime(2024, 1, 1)

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b"]),
        st.one_of(st.none(), st.integers(-40, 40).map(lambda v: v / 4)),
        st.one_of(st.none(), st.integers(-40, 40).map(lambda v: v / 4)),
        st.integers(1, 4),
    ),
    min_size=1,
    max_size=20,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_weighted_aggregates_equal_repeated_rows(spark, data):
    df = spark.createDataFrame(data, "k string, x double, y double, fan_out bigint")
    repeated = W.repeat(df)
    assert repeated.count() == sum(r[3] for r in data)
    got = df.groupBy("k").agg(
        W.rows().alias("n"), W.rows_of("x").alias("nx"), W.rows_if(F.col("x") > 0).alias("pos"),
        W.total("x").alias("s"), W.mean("x").alias("m"),
    )
    parts = W.parts(df, ["k"], "x", pairs=(("x", "y"),)).groupBy("k")
    spread = parts.agg(
        W.part_rows().alias("n2"), W.part_mean("x").alias("m2"), W.part_stddev("x").alias("sd"), W.part_corr("x", "y").alias("r")
    )
    got = got.join(spread.withColumnRenamed("k", "k2"), F.col("k").eqNullSafe(F.col("k2")))
    for row in got.collect():
        plain = [(x, y) for k, x, y, w in data if k == row["k"] for _ in range(w)]
        xs = [x for x, _ in plain if x is not None]
        assert row["n"] == len(plain) and row["nx"] == len(xs) and row["pos"] == sum(x > 0 for x in xs)
        assert row["s"] == (sum(xs) if xs else None)
        assert row["m"] == (pytest.approx(sum(xs) / len(xs)) if xs else None)
        assert row["n2"] == row["n"] and row["m2"] == (pytest.approx(row["m"], abs=1e-9) if xs else None)
        assert row["sd"] == (pytest.approx(statistics.stdev(xs), abs=1e-6) if len(xs) > 1 else None)
        both = [(x, y) for x, y in plain if x is not None and y is not None]
        if len({x for x, _ in both}) > 1 and len({y for _, y in both}) > 1:
            assert row["r"] == pytest.approx(np.corrcoef(*zip(*both))[0, 1], abs=1e-9)
        else:
            assert row["r"] is None


def test_spreads_of_large_values(spark):
    """Values far from zero with small differences, as many rows as make sums of squares useless."""
    values = F.lit(1e8) + (F.col("id") % 7) / 10
    df = spark.range(70_000).select(values.alias("x"), (values * 2 + 5).alias("y"), F.lit(3.5).alias("c"), (F.col("id") % 3 + 1).alias("fan_out"))
    staged = W.parts(df, [], "x", "c", pairs=(("x", "y"), ("x", "c")))
    got = staged.agg(W.part_stddev("x").alias("sd"), W.part_stddev("c").alias("zero"), W.part_corr("x", "y").alias("r"), W.part_corr("x", "c").alias("none")).first()
    plain = W.repeat(df).agg(F.stddev("x"), F.corr("x", "y")).first()
    assert got["sd"] == pytest.approx(plain[0], rel=1e-7) and got["r"] == pytest.approx(1.0, rel=1e-9)
    assert got["zero"] == 0.0 and got["none"] is None


def test_moments_of_many_groups_and_weights(spark):
    """Thousands of parts: 1e8 and noise, in groups of 40 weights, merged by sums."""
    x = F.lit(1e8) + F.sin(F.col("id"))
    df = spark.range(200_000).withColumn("k", F.col("id") % 50).select("k", x.alias("x"), (F.cos(F.col("id") * 3) + x).alias("y"), (F.col("id") % 40 + 1).alias("fan_out"))
    got = {r["k"]: r for r in W.parts(df, ["k"], "x", pairs=(("x", "y"),)).groupBy("k").agg(W.part_mean("x").alias("m"), W.part_stddev("x").alias("sd"), W.part_corr("x", "y").alias("r")).collect()}
    rows = df.toPandas()
    for k, part in rows.groupby("k"):
        a, b, w = (part[c].to_numpy(np.longdouble) for c in ("x", "y", "fan_out"))
        n, da, db = w.sum(), a - (a * w).sum() / w.sum(), b - (b * w).sum() / w.sum()
        assert got[k]["sd"] == pytest.approx(float(np.sqrt((w * da * da).sum() / (n - 1))), rel=1e-9, abs=1e-9)
        assert got[k]["r"] == pytest.approx(float((w * da * db).sum() / np.sqrt((w * da * da).sum() * (w * db * db).sum())), abs=1e-9)


def test_rounding_once(spark):
    got = spark.sql("select 2.4999998D a, 0.12449999996D b, 2.5D c, -2.5D d").select(
        units.half_up(F.col("a"), 0), units.half_up(F.col("b"), 3), units.half_up(F.col("c"), 0), units.half_up(F.col("d"), 0)
    )
    assert tuple(got.first()) == (2.0, 0.124, 3.0, -3.0)


def test_global_aggregates_of_nothing(spark):
    df = spark.createDataFrame([], "x double, fan_out bigint")
    row = df.agg(W.rows().alias("n"), W.total("x").alias("s"), W.mean("x").alias("m")).first()
    assert tuple(row) == (0, None, None)


def test_newest_repeats_up_to_the_limit(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, 1000000)], "t int, fan_out bigint")
    out = [r["t"] for r in W.newest(df, [F.desc("t")], 5).collect()]
    assert out == [3] * 5
    assert [r["t"] for r in W.newest(df.filter("t < 3"), [F.desc("t")], 5).collect()] == [2, 1, 1]


@pytest.mark.parametrize("splits", [4, 50, 64, 2000])
@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_percentile_equals_numpy(spark, p, splits):
    rng = random.Random(7)
    values = [rng.gauss(0, 1) for _ in range(900)] + [0.5] * 500 + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    want = float(np.percentile([v for v in values if v is not None], p * 100))
    assert percentile.percentile_cont(df, "v", p, splits=splits) == pytest.approx(want, abs=1e-12)


def test_percentile_weights_and_empty(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 1)], "v double, w bigint")
    assert percentile.percentile_cont(df, "v", 0.5, F.col("w")) == 1.0
    assert percentile.percentile_cont(df.limit(0), "v", 0.5) is None


def test_percentile_of_many_values(spark):
    values = F.pmod(F.col("id") * 7919, F.lit(300_007)).cast("double")
    assert percentile.percentile_cont(spark.range(300_007).select(values.alias("v")), "v", 0.95) == pytest.approx(0.95 * 300_006)


# --- merge

KEYS = ["home_id", "timestamp"]
SCHEMA = "home_id string, timestamp timestamp_ntz, commodity string, kwh double, cost double"


def reading(home, hour, kwh, commodity="e", cost=1.0):
    return (home, T0 + dt.timedelta(hours=hour), commodity, kwh, cost)


def test_upsert_newest_batch_wins_and_is_idempotent(spark, rows):
    old = spark.createDataFrame([reading("a", 0, 1.0), reading("a", 0, 9.0), reading("a", 1, 2.0)], SCHEMA)
    new = spark.createDataFrame([reading("a", 1, 0.5), reading("b", 0, 3.0)], SCHEMA)
    once = merge.upsert(old, new, KEYS)
    assert rows(once, "home_id", "kwh") == [("a", 0.5), ("a", 9.0), ("b", 3.0)]
    assert rows(merge.upsert(once, new, KEYS)) == rows(once)
    assert merge.duplicate_keys(once, KEYS).count() == 0


def test_upsert_does_not_depend_on_row_order(spark, rows):
    data = [reading("a", 0, float(i), cost=None if i % 2 else float(i)) for i in range(40)]
    shuffled = random.Random(1).sample(data, len(data))
    nothing = spark.createDataFrame([], SCHEMA)
    results = [
        rows(merge.upsert(nothing, spark.createDataFrame(d, SCHEMA).repartition(5), KEYS)) for d in (data, shuffled)
    ]
    assert results[0] == results[1] and len(results[0]) == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([reading("a", 0, float(i)) for i in range(100)], SCHEMA)
    plan = merge.upsert(df.limit(0), df, KEYS)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and ", 1, Partial" in before_shuffle


def test_insert_if_absent(spark, rows):
    target = spark.createDataFrame([reading("a", 0, 1.0, "g")], SCHEMA)
    batch = spark.createDataFrame([reading("a", 0, 5.0, "g"), reading("a", 1, 6.0, "g")], SCHEMA)
    out = merge.insert_if_absent(target, batch, ["home_id", "timestamp", "commodity"], blank=["cost"])
    assert rows(out, "kwh", "cost") == [(1.0, 1.0), (6.0, None)]


def test_high_water_mark_is_strict_and_per_key(spark, rows):
    loaded = spark.createDataFrame([reading("a", 5, 1.0)], SCHEMA)
    batch = spark.createDataFrame([reading("a", 5, 1.0), reading("a", 6, 2.0), reading("b", 1, 3.0)], SCHEMA)
    assert rows(merge.newer_than(batch, loaded, "timestamp", ["home_id"]), "kwh") == [(2.0,), (3.0,)]
    assert rows(merge.newer_than(batch, loaded, "timestamp"), "kwh") == [(2.0,)]
    ancient = spark.createDataFrame([("c", dt.datetime(2019, 1, 1), "e", 1.0, 1.0)], SCHEMA)
    assert merge.newer_than(ancient, loaded, "timestamp", ["home_id"], C.FIRST_CURSOR).count() == 0


def test_merge_partitions_rewrites_only_touched_days(spark, rows, tmp_path):
    def daily(data):
        return spark.createDataFrame(data, SCHEMA).withColumn("day", F.to_date("timestamp"))

    path = str(tmp_path / "table")
    merge.merge_partitions(
        spark, path, daily([reading("a", 1, 1.0), reading("a", 30, 2.0)]), KEYS, "day", str(tmp_path / "s0")
    )
    untouched = {f: os.stat(tmp_path / "table" / "day=2024-01-01" / f).st_mtime_ns
                 for f in os.listdir(tmp_path / "table" / "day=2024-01-01")}
    update = daily([reading("a", 30, 7.0), reading("b", 31, 3.0)])
    for step in ("s1", "s2"):
        merge.merge_partitions(spark, path, update, KEYS, "day", str(tmp_path / step))
    assert rows(spark.read.parquet(path), "home_id", "kwh") == [("a", 1.0), ("a", 7.0), ("b", 3.0)]
    assert untouched == {f: os.stat(tmp_path / "table" / "day=2024-01-01" / f).st_mtime_ns
                         for f in os.listdir(tmp_path / "table" / "day=2024-01-01")}


# --- rollups and quality


def test_rollups_add_up(spark):
    data = [("h", T0 + dt.timedelta(hours=13 * i), float(i), 1.0, 1 + i % 3) for i in range(200)]
    df = spark.createDataFrame(data, "home_id string, timestamp timestamp_ntz, kwh double, cost double, fan_out bigint")
    out = rollup.rollups(df, ["home_id"], "kwh").cache()
    totals = {r["grain"]: (r["t"], r["n"]) for r in out.groupBy("grain").agg(
        F.sum("total").alias("t"), F.sum("reading_count").alias("n")).collect()}
    want = (sum(k * w for _, _, k, _, w in data), sum(w for *_, w in data))
    assert totals == {g: want for g in rollup.GRAINS}
    with pytest.raises(ValueError):
        rollup.rollup(df, "decade", [], "kwh")


def test_null_counts(spark, rows):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y int")
    assert rows(dq.null_counts(df, ["x", "y"])) == [("x", 1), ("y", 2)]


def test_observed_power_counts(spark):
    data = [("h", "d", 0, "c", T0, w, None, None, None) for w in (-1.0, 0.0, 50000.0, 50000.5)]
    watched, counts = dq.observe_power(spark.createDataFrame(data, schemas.POWER))
    watched.write.format("noop").mode("overwrite").save()
    assert counts.get == {"negative_watts": 1, "above_limit": 1}
