"""Streams against their batch forms."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from hearthgrid import schemas
from hearthgrid.plans import staging
from hearthgrid.streaming import power as stream

T = dt.datetime(2024, 1, 1)


def at(minutes, watts=1000.0, device="d", channel=0):
    return ("h", device, channel, "c", T + dt.timedelta(minutes=minutes), watts, 120.0, 1.0, 0.9)


@pytest.fixture
def arrivals(spark, tmp_path):
    """Writes batches as single files, in order of arrival."""

    def write(*batches):
        folder = tmp_path / "in"
        for i, batch in enumerate(batches):
            target = tmp_path / f"b{i}"
            spark.createDataFrame(batch, schemas.POWER).coalesce(1).write.parquet(str(target))
            part = next(f for f in os.listdir(target) if f.startswith("part-"))
            folder.mkdir(exist_ok=True)
            os.rename(target / part, folder / f"{i}-{part}")
            stamp = time.time() - 1000 + i
            os.utime(folder / f"{i}-{part}", (stamp, stamp))
        return str(folder)

    return write


def test_ingest_reads_every_file_once(spark, arrivals, rows):
    folder = arrivals([at(0), at(1)], [at(2)])
    assert rows(stream.run(stream.ingest(spark, folder), "t"), "timestamp") == rows(
        spark.read.schema(schemas.POWER).parquet(folder), "timestamp"
    )


def test_dedupe_across_files(spark, arrivals):
    folder = arrivals([at(0), at(0), at(1)], [at(1), at(2)])
    out = stream.run(stream.dedupe(stream.ingest(spark, folder, files_per_batch=1)), "t")
    assert out.count() == 3
    assert dict(out.dtypes)["timestamp"] == "timestamp_ntz"


def test_hourly_rollup_equals_batch_on_closed_hours(spark, arrivals, rows):
    first = [at(m, 100.0 + m) for m in range(0, 150, 2)]
    second = [at(m, 200.0 + m) for m in range(151, 400, 3)] + [at(m, -5.0) for m in (155, 156)]
    sentinel = [at(100_000)]
    folder = arrivals(first, second, sentinel)
    out = stream.run(stream.hourly_power(stream.ingest(spark, folder, files_per_batch=1)), "t")
    batch = staging.power_hourly(spark.read.schema(schemas.POWER).parquet(folder))
    closed = batch.filter(F.col("timestamp") < T + dt.timedelta(minutes=90_000))
    assert rows(out.select(*batch.columns)) == rows(closed)


def test_late_rows_within_the_delay_count_and_later_ones_do_not(spark, arrivals, rows):
    folder = arrivals([at(0), at(65)], [at(2), at(200)], [at(210)], [at(3), at(190), at(10_000)], [at(20_000)])
    out = stream.run(stream.late_rows(stream.ingest(spark, folder, files_per_batch=1), "10 minutes"), "t")
    counts = {(r["hour"] - T).total_seconds() / 3600: r["accepted"] for r in out.collect()}
    # minute 2 arrives while its hour is open; minute 3 arrives after the hour has been emitted,
    # one batch after the watermark has passed it
    assert counts[0.0] == 2 and counts[3.0] == 3


def test_upsert_is_idempotent_and_newest_wins(spark, arrivals, tmp_path, rows):
    folder = arrivals([at(0, 1.0), at(60 * 30, 2.0)], [at(0, 9.0), at(1, 3.0)])
    table = str(tmp_path / "table")
    out = stream.run_upsert(stream.ingest(spark, folder, files_per_batch=1), "t", path=table)
    assert rows(out, "watts") == [(2.0,), (3.0,), (9.0,)]
    again = stream.run_upsert(stream.ingest(spark, folder, files_per_batch=1), "t", path=table)
    assert again.count() == 3  # nothing new behind the checkpoint


def test_charge_sessions(spark, rows):
    data = [at(m, 7000.0) for m in range(0, 40, 5)]  # 35 minutes
    data += [at(m, 7000.0) for m in (100, 105)]  # too short
    data += [at(m, 500.0) for m in range(200, 260, 5)]  # too weak
    data += [at(m, 2000.0, "ev2") for m in range(0, 20, 5)]  # exactly 15 minutes
    df = spark.createDataFrame(data, schemas.POWER)
    out = stream.charge_sessions(df, delay=None)
    assert rows(out, "device_id", "minutes", "measurements") == [("d", 35.0, 8), ("ev2", 15.0, 4)]
    assert out.filter("device_id = 'd'").first()["started"] == T
