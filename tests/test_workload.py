"""Inputs that the registered queries derive from the tables, over rows of its own."""

import datetime as dt
import gzip
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearthgrid.operators import merge  # noqa: E402
from hearthgrid.sinks import bucketed  # noqa: E402
from workload.env import Env  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def write_tables(spark, folder, lines, events=()):
    spark.createDataFrame(lines, LINEITEM).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(list(events), EVENTS).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def line(order, supplier, day, number=1, quantity=8.0):
    return (order, order % 7, supplier, number, quantity, 10.5, "A", "F", dt.datetime(1998, 1, 1) + dt.timedelta(days=day))


@pytest.fixture
def tables(spark, tmp_path):
    """Home 1 with four meters, home 2 with one; two months."""
    lines = [line(24 * i + i % 5, 4 + i % 4, i, 1 + i % 3) for i in range(50)] + [line(24 * i, 8, i) for i in range(10)]
    return write_tables(spark, tmp_path / "tables", lines)


def files(path):
    return [os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_feeds_are_packed_and_hold_every_reading_once(spark, tables):
    """F1-F3: the text of a feed is many times as long as its readings."""
    env = Env(spark, tables)
    found = files(env.feeds)
    assert len(found) == 2 and all(f.endswith(".xml.gz") for f in found)
    text = sum(len(gzip.open(f).read()) for f in found)
    assert sum(os.path.getsize(f) for f in found) * 5 < text
    read = QUERIES["src_espi_xml"](env)
    assert read.count() == 60 and read.filter("usage_point_idx is null or meter_reading_idx is null").isEmpty()
    got = sorted(tuple(r) for r in read.select("meter_id", "timestamp", "raw_value", "cost", "quality_code", "commodity", "uom", "tou_bucket").collect())
    want = sorted(tuple(r) for r in env.readings.select("meter_id", "timestamp", "raw_value", "cost", "quality_code", "commodity", "uom", "tou_bucket").collect())
    assert [str(r) for r in got] == [str(r) for r in want]
    by_home = {r["home_id"]: r["n"] for r in QUERIES["src_espi_many"](env).groupBy("home_id").agg({"n": "sum"}).toDF("home_id", "n").collect()}
    assert by_home == {"home-1": 50, "home-2": 10}


@pytest.mark.parametrize(
    "key, column, commodity",
    [
        ("src_partitioned_lake", None, "CommodityKindValue.VALUE_1"),
        ("sink_keyed_table", None, "CommodityKindValue.VALUE_7"),
        ("sink_csv", None, "CommodityKindValue.VALUE_2"),
        ("sink_view_over_lake", "gas", "CommodityKindValue.VALUE_7"),
        ("sink_view_over_lake", "water", "CommodityKindValue.VALUE_2"),
    ],
)
def test_home_join_repeats_a_reading_for_every_meter(spark, tables, key, column, commodity):
    """F4-F7: home 1 has four meters, so each of its readings comes four times."""
    env = Env(spark, tables)
    n = env.readings.filter(f"home_id = 'home-1' and commodity = '{commodity}'").count()
    out = QUERIES[key](env)
    assert n > 5
    if column:
        assert out.filter(f"view_name = '{column}'").first()["n"] == 4 * n
    else:
        home = out.filter("home_id = 'home-1'") if "home_id" in out.columns else out
        assert home.count() == 4 * n and home.select("meter_id_hash").distinct().count() == 4


def test_a_batch_merged_twice_is_shuffled_once(spark, rows):
    """keys may repeat and be null; the second merge finds both sides laid out by their keys."""
    base = spark.range(0, 400, 1, 3).selectExpr("if(id % 50 = 0, null, id % 150) k", "id % 7 t", "id v")
    once = merge.upsert(base.limit(0), base, ["k"], ["t"])
    twice = merge.upsert(once, base, ["k"], ["t"])
    best = {}
    for r in base.collect():
        best[r["k"]] = max(best.get(r["k"], (-1, -1)), (r["t"], r["v"]))
    assert {r["k"]: (r["t"], r["v"]) for r in twice.collect()} == best and rows(once) == rows(twice)
    out = twice.unionByName(once)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") + final.count("ReusedQueryStage") >= 2 or final.count(" Exchange hashpartitioning") == 1, final


def test_buckets_grow_with_the_table(spark, monkeypatch, tmp_path):
    """F8: a bucket keeps its size, so a task's memory does."""
    base = spark.range(5000).selectExpr("id", "id % 3 v")
    base.write.parquet(str(tmp_path / "base"))
    monkeypatch.setattr(bucketed, "BUCKET_BYTES", 1 << 10)
    few = bucketed.buckets_for(spark.read.parquet(str(tmp_path / "base")), 2)
    base.unionByName(base.selectExpr("id + 5000 id", "v")).write.parquet(str(tmp_path / "twice"))
    many = bucketed.buckets_for(spark.read.parquet(str(tmp_path / "twice")), 2)
    assert 2 < few < many
    monkeypatch.setattr(bucketed, "BUCKET_BYTES", 1 << 40)
    assert bucketed.buckets_for(base, 2) == 2


def event(i, day):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=i % 600), i, "meter", float(i % 9) + 4)


def test_a_batch_of_events_is_written_by_several_tasks(spark, tmp_path, monkeypatch, rows):
    """F17-F19: as many files for each batch, so that a stream takes a batch at a time, with the rows of that batch alone."""
    folder = write_tables(spark, tmp_path / "tables", [line(1, 4, 1)], [event(i, i % 28) for i in range(300)])
    env = Env(spark, folder)
    assert env.arrival_files == 1
    monkeypatch.setattr(Env, "ARRIVAL_BYTES", 1 << 10)
    env = Env(spark, folder)
    n, path = env.arrival_files, env.arrivals.removesuffix("/*")
    assert n > 2 and len(files(path)) == (Env.LAST_BATCH + 4) * n
    for number in range(Env.LAST_BATCH + 4):
        landed = spark.read.schema(EVENTS).parquet(*[f"{path}/{number}-{part}" for part in range(n)])
        assert rows(landed) == rows(env.deliveries.filter(f"batch = {number}").drop("batch"))
    newest = [max(os.path.getmtime(f) for f in files(f"{path}/{number}-0")) for number in range(Env.LAST_BATCH + 4)]
    assert newest == sorted(newest)
