"""Stored cursors, retention, bucketed tables, sketches, late rows, tariffs, weather-normal use and staged readings."""

import datetime as dt
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthgrid import schemas, session
from hearthgrid.functions import units
from hearthgrid.operators import cursors, merge, sketches
from hearthgrid.plans import baseline, staging, store, tariffs
from hearthgrid.plans.marts import Marts
from hearthgrid.sinks import bucketed, tables
from hearthgrid.streaming import power as stream
from hearthgrid.streaming import reconcile

T = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def measured(hour, device="d", watts=1000.0):
    return ("h", device, 0, "c", T + dt.timedelta(hours=hour), watts, 120.0, 1.0, 0.9)


def power(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.POWER)


# --- cursors


def test_a_second_load_starts_at_the_marks(spark, tmp_path, rows):
    table, marks = str(tmp_path / "table"), str(tmp_path / "marks")
    first = power(spark, measured(1), measured(2), measured(5, "e"))
    assert cursors.load_newer(first, table, marks, "timestamp", ["device_id"]) == 1
    # d has moved on, e sends a row behind its mark, f was never loaded
    second = power(spark, measured(2), measured(3), measured(4, "e"), measured(0, "f"))
    assert cursors.load_newer(second, table, marks, "timestamp", ["device_id"]) == 2
    brought = cursors.loaded(spark, table, schemas.POWER, 2)
    assert rows(brought, "device_id", "timestamp") == [("d", T + dt.timedelta(hours=3)), ("f", T)]
    assert cursors.loaded(spark, table, schemas.POWER).count() == 5
    assert rows(cursors.read_marks(spark, marks)) == [("d", T + dt.timedelta(hours=3)), ("e", T + dt.timedelta(hours=5)), ("f", T)]
    assert cursors.load_newer(second, table, marks, "timestamp", ["device_id"]) == 3
    assert cursors.loaded(spark, table, schemas.POWER, 3).count() == 0


def test_a_load_without_marks_is_done_again(spark, tmp_path):
    table, marks = str(tmp_path / "table"), str(tmp_path / "marks")
    batch = power(spark, measured(1), measured(2))
    batch.write.parquet(f"{table}/load=1")  # an attempt that failed before its marks
    assert cursors.load_newer(batch, table, marks, "timestamp", ["device_id"]) == 1
    assert cursors.loaded(spark, table, schemas.POWER).count() == 2


def test_the_target_is_not_read_by_a_load(spark, tmp_path):
    table, marks, source = (str(tmp_path / n) for n in ("table", "marks", "source"))
    power(spark, measured(1), measured(2)).write.parquet(source)
    batch = spark.read.schema(schemas.POWER).parquet(source)
    cursors.load_newer(batch, table, marks, "timestamp")
    for name in os.listdir(f"{table}/load=1"):
        (tmp_path / "table" / "load=1" / name).write_bytes(b"not Parquet")
    power(spark, measured(3)).write.mode("append").parquet(source)
    assert cursors.load_newer(spark.read.schema(schemas.POWER).parquet(source), table, marks, "timestamp") == 2
    assert cursors.loaded(spark, table, schemas.POWER, 2).count() == 1
    late = cursors.load_newer(spark.read.schema(schemas.POWER).parquet(source), table, marks, "timestamp", start="2030-01-01")
    assert late == 3 and cursors.loaded(spark, table, schemas.POWER, 3).count() == 0


# --- retention


def test_expired_folders_are_removed_without_reading_them(spark, tmp_path, rows):
    path = str(tmp_path / "power")
    df = power(spark, *[measured(h) for h in range(0, 240, 5)]).withColumn("day", F.to_date("timestamp"))
    tables.write_partitioned(df, path, ["day"])
    for name in os.listdir(f"{path}/day=2024-01-01"):
        (tmp_path / "power" / "day=2024-01-01" / name).write_bytes(b"not Parquet")
    newest = T + dt.timedelta(hours=235)
    done = tables.expire(spark, path, 3, schemas.POWER)
    assert done == {"removed": 6, "rewritten": 1}
    assert session.folders(spark, path) == ["day=2024-01-07", "day=2024-01-08", "day=2024-01-09", "day=2024-01-10"]
    left = [t for (t,) in rows(spark.read.schema(schemas.POWER).parquet(path), "timestamp")]
    assert sorted(left) == [T + dt.timedelta(hours=h) for h in range(0, 240, 5) if T + dt.timedelta(hours=h) >= newest - dt.timedelta(days=3)]
    assert tables.expire(spark, path, 3, schemas.POWER) == {"removed": 0, "rewritten": 0}
    assert tables.expire(spark, str(tmp_path / "none"), 3, schemas.POWER) == {"removed": 0, "rewritten": 0}


# --- bucketed tables


@pytest.fixture
def shuffled_joins(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_merge_into_buckets_moves_the_batch_alone(spark, tmp_path, rows, shuffled_joins):
    keys, name = ["device_id", "timestamp"], f"t{uuid.uuid4().hex[:8]}"
    base = power(spark, *[measured(h, f"d{h % 3}") for h in range(60)], measured(0, "d0", 5.0))
    target = bucketed.create(base, f"{name}_1", str(tmp_path / "1"), keys, 4)
    assert target.count() == 60 and rows(target.filter("device_id = 'd0' and watts <> 1000")) == []
    batch = power(spark, measured(0, "d0", 7.0), measured(0, "d0", 6.0), measured(1, "new"))
    outcome = bucketed.merged(target, batch, keys, 4)
    text = plan(outcome)
    scan = text.index("Bucketed: true")
    # the scan of the target is joined in place: no exchange stands between it and the join
    above = text[text.index("SortMergeJoin") : scan]
    assert "Exchange" not in above
    new = bucketed.merge(spark, f"{name}_1", f"{name}_2", str(tmp_path / "2"), batch, keys, 4)
    assert rows(new, "device_id", "timestamp", "watts") == rows(merge.upsert(target, batch, keys), "device_id", "timestamp", "watts")
    again = bucketed.merged(new, batch, keys, 4)
    assert rows(again) == rows(new) and "Exchange" not in plan(again)[plan(again).index("SortMergeJoin") : plan(again).index("Bucketed: true")]
    with pytest.raises(Exception, match="no key"):
        bucketed.merged(target, base.withColumn("device_id", F.lit(None).cast("string")), keys, 4).collect()


def test_insert_if_absent_leaves_the_target_in_place(spark, tmp_path, rows):
    power(spark, *[measured(h) for h in range(50)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.schema(schemas.POWER).parquet(str(tmp_path / "t"))
    batch = power(spark, measured(3, watts=1.0), measured(70), measured(70))
    out = merge.insert_if_absent(target, batch, ["device_id", "timestamp"], ["watts"])
    assert out.count() == 52 and rows(out.filter("watts is null"), "timestamp") == [(T + dt.timedelta(hours=70),)] * 2
    text = plan(out)
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


# --- sketches


def test_sketches_of_stored_hours_count_years(spark, tmp_path):
    ts = F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") % 9000).cast("int"))
    df = spark.range(400_000).select(ts.alias("timestamp"), (F.xxhash64("id") % 60_000).alias("user"), F.lit("all").alias("site"))
    stored = sketches.store_rollups(df, str(tmp_path), "timestamp", {"users": "user"}, ["site"])
    for grain in ("hour", "day", "month", "year"):
        exact = {r["p"]: (r["u"], r["n"]) for r in df.groupBy(units.floor_to(grain, F.col("timestamp")).alias("p")).agg(F.count_distinct("user").alias("u"), F.count(F.lit(1)).alias("n")).collect()}
        got = stored[grain].select("period_start", sketches.estimate("users").alias("u"), "row_count").collect()
        assert len(got) == len(exact)
        for r in got:
            assert abs(r["u"] - exact[r["period_start"]][0]) <= 0.02 * exact[r["period_start"]][0] and r["row_count"] == exact[r["period_start"]][1]
    assert "user" not in spark.read.parquet(str(tmp_path / "day")).columns


# --- late rows


@pytest.fixture
def arrivals(spark, tmp_path):
    folder = str(tmp_path / "in")

    def write(*batches):
        for batch in batches:
            power(spark, *batch).coalesce(1).write.mode("append").parquet(folder)
        return folder

    return write


def test_late_rows_are_kept_and_the_batch_answer_is_restored(spark, arrivals, tmp_path, rows):
    first = [measured(0), measured(0.5, watts=500.0), measured(3)]
    second = [measured(0.25, watts=9000.0), measured(2.9), measured(8), measured(3.5, watts=-4.0)]
    third = [measured(7, "e"), measured(8.1), measured(3.75)]
    folder = arrivals(first, second, third)
    path = str(tmp_path / "run")
    done = reconcile.run(stream.ingest(spark, folder, files_per_batch=1), "t", "10 minutes", path)
    everything = spark.read.schema(schemas.POWER).parquet(folder)
    # after the first batch the mark is 03:00, less the delay: hours 0 and 1 are closed; after the second it is 08:00
    assert rows(done.late(), "timestamp", "batch") == [(T + dt.timedelta(hours=0.25), 1), (T + dt.timedelta(hours=3.75), 2)]
    counts = {(r["hour"] - T).total_seconds() / 3600: (r["accepted"], r["late"]) for r in done.counts().collect()}
    assert counts == {0: (2, 1), 2: (1, 0), 3: (2, 1), 7: (1, 0), 8: (2, 0)}
    assert sum(a + b for a, b in counts.values()) == everything.count()
    batch = staging.power_hourly(everything)
    near = lambda df: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df.select(*batch.columns))]
    assert near(done.hourly()) == near(batch) and near(done.hourly(with_late=False)) != near(batch)
    # a batch that is replayed replaces its own folders
    arrivals([measured(9)])
    more = reconcile.run(stream.ingest(spark, folder, files_per_batch=1), "t", "10 minutes", path)
    assert more.counts().agg(F.sum("accepted") + F.sum("late")).first()[0] == everything.count() + 1


# --- staged readings


def test_views_of_staged_readings_read_their_folders_alone(spark, tmp_path, rows):
    readings = spark.sql(
        "select 'h' home_id, 0 usage_point_idx, cast(id as int) meter_reading_idx, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int) * 9) timestamp, 3600 duration_seconds,"
        " 5D * id kwh, id raw_value, null::double cost, 'QualityOfReading.VALIDATED' quality_code, '1' tou_bucket,"
        " element_at(array('CommodityKindValue.VALUE_1', 'CommodityKindValue.VALUE_7', 'CommodityKindValue.VALUE_2', null), cast(id % 4 + 1 as int)) commodity,"
        " 'UnitSymbolKindValue.VALUE_42' uom, null::string service_kind, 'm' meter_id from range(40)"
    )
    staged = store.stage(readings, str(tmp_path / "staged"))
    assert staged.count() == 40 and {"commodity_type=water", "commodity_type=unknown"} <= set(session.folders(spark, str(tmp_path / "staged")))
    for view, kind in ((staging.electricity, "electricity"), (staging.gas, "natural_gas"), (staging.water, "water")):
        assert rows(view(staged)) == rows(view(readings)) and view(staged).columns == view(readings).columns
        text = plan(view(staged))
        assert f"PartitionFilters: [isnotnull(commodity_type" in text and f"= {kind})" in text
    month = staging.gas(staged.filter(F.col("ts_month") == 202403))
    assert "ts_month" in plan(month).split("PartitionFilters: [")[1].split("]")[0] and month.count() > 0
    # months that a small table names are found while the query runs
    spark.range(3).selectExpr("cast(202401 + id as int) ts_month", "id").write.parquet(str(tmp_path / "months"))
    few = spark.read.parquet(str(tmp_path / "months")).filter("id = 1")
    joined = staged.filter(F.col("commodity_type") == "water").join(few, "ts_month")
    assert "dynamicpruning" in plan(joined).lower()


def test_the_store_decodes_once(spark, tmp_path, monkeypatch):
    calls = []
    decode_all = staging.decoded
    monkeypatch.setattr(staging, "decoded", lambda readings: calls.append(1) or decode_all(readings))
    made = Marts(schemas.empty(spark, "green_button_interval_readings"))
    store.save(made, str(tmp_path / "store"))
    assert calls == [1]
    loaded = store.load(spark, str(tmp_path / "store"))
    assert "commodity_type" in loaded.readings.columns and loaded.electricity_facts.count() == 0


# --- tariffs


def test_tiers_split_readings_and_hot_homes_have_small_windows(spark):
    draw = random.Random(4)
    data = [(f"h{draw.randrange(3)}", T + dt.timedelta(hours=draw.randrange(24 * 70)), draw.randrange(0, 80) * 0.25, i) for i in range(4000)]
    df = spark.createDataFrame(data, "home_id string, ts timestamp, kwh double, i int").withColumn("ts", F.col("ts").cast("timestamp_ntz")).repartition(5)
    got = {r["i"]: (r["used_before"], r["tiered_cents"]) for r in tariffs.tiered_readings(df, ["i"]).collect()}
    used = {}
    for home, ts, kwh, i in sorted(data, key=lambda r: (r[0], r[1], r[3])):
        before = used.get((home, ts.year, ts.month), 0.0)
        cents = 10.5 * (min(before + kwh, 600) - min(before, 600)) + 12.8 * (max(before + kwh - 600, 0) - max(before - 600, 0))
        assert got[i] == (before, pytest.approx(cents, abs=1e-9))
        used[(home, ts.year, ts.month)] = before + kwh
    text = plan(tariffs.used_before(df, ["i"]))
    assert text.count("Window [") == 2 and "_day" in text


def test_tier_costs():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    three = ((10.0, 1.0), (20.0, 2.0), (None, 4.0))
    got = spark.sql("select explode(array(-2D, 0D, 10D, 15D, 20D, 25D)) u").select(tariffs.tiered_cents(F.col("u"), three).alias("c"))
    assert [r["c"] for r in got.collect()] == [-2.0, 0.0, 10.0, 20.0, 30.0, 50.0]


# --- weather-normal use


def test_models_are_least_squares_and_unusual_days_stand_out(spark):
    rng = np.random.default_rng(2)
    data, truth = [], {"a": (15.0, 10.0, 1.5), "b": (18.0, 4.0, 0.5)}
    for home, (balance, base, slope) in truth.items():
        for i in range(200):
            t = float(rng.uniform(-10, 28))
            y = base + slope * max(balance - t, 0) + float(rng.normal(0, 0.05)) + (30.0 if i == 77 else 0.0) * (home == "a")
            data.append((home, (T + dt.timedelta(days=i)).date(), y, t))
    data += [("few", T.date(), 1.0, 3.0), ("warm", T.date(), 1.0, 25.0), ("warm", T.date(), 2.0, 26.0), ("warm", T.date(), 2.0, 27.0)]
    days = spark.createDataFrame(data, "home_id string, date date, kwh double, temperature double").repartition(4)
    fitted = {r["home_id"]: r for r in baseline.models(days).collect()}
    assert set(fitted) == {"a", "b"}
    for home, (balance, *_ ) in truth.items():
        r = fitted[home]
        assert r["balance"] == balance
        x, y = (np.array(v) for v in zip(*[(max(balance - t, 0), k) for h, _, k, t in data if h == home]))
        slope, intercept = np.polyfit(x, y, 1)
        assert (r["kwh_per_degree_day"], r["baseline"]) == (pytest.approx(slope, abs=1e-8), pytest.approx(intercept, abs=1e-8))
        rest = y - intercept - slope * x
        assert r["error"] == pytest.approx(float(np.sqrt((rest * rest).sum() / (len(y) - 2))), abs=1e-8)
    odd = baseline.unusual_days(days, baseline.models(days), 5.0).collect()
    assert [(r["home_id"], r["date"]) for r in odd] == [("a", (T + dt.timedelta(days=77)).date())]


def test_a_folder_that_holds_much_is_staged_by_many_tasks(spark, tmp_path, rows):
    """F10-F15, F20: one month of one commodity is split over tasks, and only raw columns are shuffled."""
    readings = spark.range(0, 20_000, 1, 4).selectExpr(
        "'h' home_id", "0 usage_point_idx", "cast(id as int) meter_reading_idx", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 700 as int)) timestamp", "3600 duration_seconds",
        "5D * id kwh", "id raw_value", "null::double cost", "'QualityOfReading.VALIDATED' quality_code", "'1' tou_bucket", "'CommodityKindValue.VALUE_1' commodity",
        "'UnitSymbolKindValue.VALUE_42' uom", "null::string service_kind", "concat('m', id % 5) meter_id",
    )
    limit = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(limit, "16KB")
    try:
        staged = store.stage(readings, str(tmp_path / "staged"))
    finally:
        spark.conf.unset(limit)
    assert len(list((tmp_path / "staged" / "commodity_type=electricity" / "ts_month=202401").glob("*.parquet"))) > 1
    assert rows(staging.electricity(staged)) == rows(staging.electricity(readings))


def test_readings_are_packed_without_loss(spark, tmp_path, rows):
    """F11-F14: usual codes travel as one number, others and nulls as they are; the decoded rows are the same."""
    codes = {
        "quality_code": ["QualityOfReading.VALIDATED", "QualityOfReading.VALUE_14", "DERIVED or ESTIMATED", "", None],
        "tou_bucket": ["1", "3", "4", "0", None],
        "commodity": ["CommodityKindValue.VALUE_1", "CommodityKindValue.VALUE_2", "CommodityKindValue.VALUE_12", "VALUEx7", None],
        "uom": ["UnitSymbolKindValue.VALUE_119", "UnitSymbolKindValue.VALUE_72", "VALUE-42", "?", None],
    }
    every = [(q, t, c, u) for q in codes["quality_code"] for t in codes["tou_bucket"] for c in codes["commodity"] for u in codes["uom"]]
    raw = spark.createDataFrame(every, "quality_code string, tou_bucket string, commodity string, uom string")
    late = F.when(F.col("uom") != "?", F.lit("0099-02-03 04:05:06").cast("timestamp_ntz"))
    rest = {"home_id": F.lit("h"), "timestamp": late, "kwh": F.lit(1.5), "raw_value": F.lit(3).cast("bigint"), "cost": F.lit(None).cast("double"), "service_kind": F.lit("s"), "meter_id": F.lit(None).cast("string")}
    whole = raw.withColumns({**rest, **{c: F.lit(7) for c in ("usage_point_idx", "meter_reading_idx", "duration_seconds")}})
    packed = staging.packed(whole)
    usual = packed.filter("quality_code is null and tou_bucket is null and commodity is null and uom is null")
    assert usual.count() == 3**4 and packed.select(staging.CODES).distinct().count() == 3**4
    staged = store.stage(whole, str(tmp_path / "staged"))
    plain = staging.decoded(whole)
    assert [f.dataType for f in staged.schema] == [f.dataType for f in plain.schema]
    assert rows(staged) == rows(plain.select(*staged.columns))


def test_meters_are_counted_over_the_stored_homes(spark, tmp_path):
    """F11-F14: readings are scanned once for both dimensions."""
    spark.createDataFrame([], schemas.READINGS).write.parquet(str(tmp_path / "readings"))
    made = Marts(spark.read.parquet(str(tmp_path / "readings")))
    counted = []
    marts_module = __import__("hearthgrid.plans.marts", fromlist=["home_meters"])
    plain = marts_module.home_meters
    marts_module.home_meters = lambda homes: counted.append(homes.inputFiles()) or plain(homes)
    try:
        made.settle(str(tmp_path / "dims"))
    finally:
        marts_module.home_meters = plain
    assert len(counted) == 1 and all("/dims/homes/" in f for f in counted[0]) and counted[0]
