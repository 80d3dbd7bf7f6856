"""Readers on small files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid import schemas, session
from hearthgrid.operators import merge
from hearthgrid.sources import bills, climate, espi_xml, files, meter_csv, power
from hearthgrid.sinks.tables import with_home_bucket
from workload.env import as_payloads

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:espi="http://naesb.org/espi">
{entries}
</feed>"""


def entry(self, up=None, related=(), content=""):
    links = f'<link rel="self" href="{self}"/>'
    links += f'<link rel="up" href="{up}"/>' if up else ""
    links += "".join(f'<link rel="related" href="{r}"/>' for r in related)
    return f"<entry><id>urn:uuid:{abs(hash(self))}</id>{links}<content>{content}</content></entry>"


def reading(start, value, cost="", quality=17, tou=None):
    tou_tag = f"<espi:tou>{tou}</espi:tou>" if tou else ""
    return (
        f"<espi:IntervalReading><espi:cost>{cost}</espi:cost>"
        f"<espi:ReadingQuality><espi:quality>{quality}</espi:quality></espi:ReadingQuality>"
        f"<espi:timePeriod><espi:duration>3600</espi:duration><espi:start>{start}</espi:start></espi:timePeriod>"
        f"<espi:value>{value}</espi:value>{tou_tag}</espi:IntervalReading>"
    )


def meter(point, commodity, uom, power_of_ten, blocks):
    up = f"/r/UsagePoint/{point}"
    out = [
        entry(up, related=[f"{up}/MeterReading"],
              content="<espi:UsagePoint><espi:ServiceCategory><espi:kind>0</espi:kind></espi:ServiceCategory>"
                      "</espi:UsagePoint>"),
        entry(f"/r/ReadingType/{point}",
              content=f"<espi:ReadingType><espi:commodity>{commodity}</espi:commodity>"
                      f"<espi:powerOfTenMultiplier>{power_of_ten}</espi:powerOfTenMultiplier>"
                      f"<espi:uom>{uom}</espi:uom></espi:ReadingType>"),
    ]
    for i, readings in enumerate(blocks):
        mr = f"{up}/MeterReading/{i}"
        out.append(entry(mr, f"{up}/MeterReading", [f"{mr}/IntervalBlock", f"/r/ReadingType/{point}"],
                         "<espi:MeterReading/>"))
        out.append(entry(f"{mr}/IntervalBlock/1", f"{mr}/IntervalBlock",
                         content=f"<espi:IntervalBlock>{''.join(readings)}</espi:IntervalBlock>"))
    return out


@pytest.fixture
def feed(tmp_path):
    first = meter("900", 1, 72, -3, [[reading(1700000000, 1500, "12.5", tou=1), reading(1700003600, 2500, quality=8)],
                                     [reading(1700000000, 7)]])
    second = meter("901", 7, 42, 0, [[reading(1700000000, 80, quality=14)]])
    (tmp_path / "one.xml").write_text(FEED.format(entries="\n".join(first + second)))
    (tmp_path / "two.xml").write_text(FEED.format(entries="\n".join(meter("902", 1, 72, 0, [[reading(1700007200, 3)]]))))
    return tmp_path


def test_espi_feed(spark, feed, rows):
    df = espi_xml.read(spark, str(feed / "one.xml"), "h1")
    assert [f.simpleString() for f in df.schema] == [
        f.simpleString() for f in spark.createDataFrame([], schemas.READINGS).select(*df.columns).schema
    ]
    first = df.filter("meter_id = '900' and meter_reading_idx = 0").orderBy("timestamp").collect()
    assert [(r["kwh"], r["raw_value"], r["cost"], r["quality_code"], r["tou_bucket"]) for r in first] == [
        (1.5, 1500, 12.5, "QualityOfReading.VALIDATED", "1"), (2.5, 2500, None, "QualityOfReading.ESTIMATED", None),
    ]
    assert first[0]["timestamp"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert first[0]["duration_seconds"] == 3600
    assert rows(df, "usage_point_idx", "meter_reading_idx", "meter_id", "commodity", "uom") == [
        (0, 0, "900", "CommodityKindValue.VALUE_1", "UnitSymbolKindValue.VALUE_72"),
        (0, 0, "900", "CommodityKindValue.VALUE_1", "UnitSymbolKindValue.VALUE_72"),
        (0, 1, "900", "CommodityKindValue.VALUE_1", "UnitSymbolKindValue.VALUE_72"),
        (1, 0, "901", "CommodityKindValue.VALUE_7", "UnitSymbolKindValue.VALUE_42"),
    ]


def test_espi_many_files_by_home(spark, feed, rows):
    paths = [(session.qualified(spark, str(feed / name)), home) for name, home in (("one.xml", "h1"), ("two.xml", "h2"))]
    homes = spark.createDataFrame(paths, "file_path string, home_id string")
    df = espi_xml.read(spark, str(feed), homes)
    assert rows(df.groupBy("home_id").count()) == [("h1", 4), ("h2", 1)]
    assert rows(df.filter("home_id = 'h2'"), "usage_point_idx", "kwh") == [(0, 3.0)]


def test_one_large_feed_is_read_by_many_tasks(spark, tmp_path, rows):
    """A feed of a thousand entries in ranges of 16 KB: the same rows and places as in one range, in the file's order."""
    meters = [m for i in range(60) for m in meter(f"9{i:02}", 1, 72, 0, [[reading(1700000000 + 3600 * k, 100 * i + k) for k in range(20)], [reading(1700000000, i)]])]
    path = tmp_path / "large.xml"
    path.write_text(FEED.format(entries="\n".join(meters)))
    whole = rows(espi_xml.read(spark, str(path), "h"))
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, 16_384)
    try:
        assert espi_xml.entries(spark, str(path)).rdd.getNumPartitions() > 10
        split = espi_xml.read(spark, str(path), "h")
        assert rows(split) == whole and len(whole) == 60 * 21
        places = {(r["meter_id"], r["usage_point_idx"]) for r in split.collect()}
        assert places == {(f"9{i:02}", i) for i in range(60)}
    finally:
        spark.conf.set(limit, before)


def wide_file(tmp_path, lines, name="SmartMeter8493_2026-07-22.csv"):
    header = ["Reading Date", *[f"{i} am kWh Usage" for i in range(1, 12)], "12 pm kWh Usage",
              *[f"{i} pm kWh Usage" for i in range(1, 12)], "12 pm kWh Usage"]
    path = tmp_path / name
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return path


def test_wide_csv(spark, tmp_path, rows):
    cells = [str(i) for i in range(1, 25)]
    cells[4], cells[5] = "", "n/a"
    path = wide_file(tmp_path, ["2024-12-31," + ",".join(cells), "31/12/2024," + ",".join(cells), ",", "* footer"])
    df = meter_csv.read(spark, str(path), "h1")
    assert df.count() == 22
    out = {r["timestamp"]: r for r in df.collect()}
    noon = out[dt.datetime(2024, 12, 31, 17)]
    assert (noon["kwh"], noon["raw_value"], noon["tou_bucket"], noon["meter_id"]) == (12000.0, 12000, "2", "8493")
    # the last column is midnight, which is the next day, and 5 hours more in UTC
    assert out[dt.datetime(2025, 1, 1, 5)]["kwh"] == 24000.0
    assert out[dt.datetime(2025, 1, 1, 0)]["kwh"] == 19000.0  # 19 h local on Dec 31


def test_files_with_one_name(spark, tmp_path, rows):
    """Every home downloads a file of the same name."""
    for home, value in (("a", 1), ("b b", 2)):
        (tmp_path / home).mkdir()
        (tmp_path / home / "usage.xml").write_text(FEED.format(entries="\n".join(meter("900", 1, 72, 0, [[reading(1700000000, value)]]))))
        wide_file(tmp_path / home, [f"2024-06-03,{','.join([str(value)] * 24)}"], "usage.csv")
    config = [{"path": str(tmp_path / h / f"usage.{x}"), "home_id": h, "format": kind} for h in ("a", "b b") for x, kind in (("xml", "greenbutton_xml"), ("csv", "enova_csv"))]
    readings, skipped = files.read_configured(spark, config)
    assert skipped == []
    assert rows(readings.groupBy("home_id", "duration_seconds", "raw_value").count()) == [
        ("a", 3600, 1, 1), ("a", 3600, 1000, 24), ("b b", 3600, 2, 1), ("b b", 3600, 2000, 24)
    ]
    with pytest.raises(ValueError, match="twice"):
        files.read_configured(spark, [config[0], config[0]])


def test_first_load_takes_everything(spark):
    old = spark.sql("select 'h' home_id, 'd' device_id, timestamp_ntz'2019-05-01 00:00:00' timestamp, 5D watts")
    assert power.accept(old).count() == 1
    assert merge.newer_than(old, old.limit(0), "timestamp", ["device_id"]).count() == 1
    marks = merge.advance(merge.high_water(old.limit(0), "timestamp", ["device_id"]), old, "timestamp", ["device_id"])
    assert merge.newer_than(old, marks, "timestamp", ["device_id"]).count() == 0


def test_wide_csv_by_header_name(spark, tmp_path):
    path = wide_file(tmp_path, ["2024-06-03," + ",".join(str(i) for i in range(1, 25))], "other.csv")
    df = meter_csv.read(spark, str(path), "h1", parity=True)
    out = {r["timestamp"]: r for r in df.collect()}
    assert out[dt.datetime(2024, 6, 3, 17)]["kwh"] == 24.0 and out[dt.datetime(2024, 6, 3, 5)]["kwh"] == 24.0
    assert out[dt.datetime(2024, 6, 3, 17)]["raw_value"] == 24000 and len(out) == 24
    assert out[dt.datetime(2024, 6, 3, 17)]["meter_id"] is None


def test_bills(spark, tmp_path, rows):
    power_bill = tmp_path / "electricity.csv"
    power_bill.write_text(
        "Date,Total,Total Consumption,Off Peak Consumption,Mid Peak Consumption,On Peak Consumption,"
        "Off Peak Rate,Mid Peak Rate,On Peak Rate\n"
        "2024-01-31,80.5,600,300,150,150,0.08,0.11,0.17\n"
        "2024-02-29,oops,600,300,150,150,0.08,0.11,0.17\n"
        "bad,80.5,600,300,150,150,0.08,0.11,0.17\n"
    )
    gas_bill = tmp_path / "gas.csv"
    gas_bill.write_text(
        "Date,Gas Consumption,Gas Charges,Water Consumption,Water Charges\n"
        "2024-01-31,100,55.5,12,30\n2024-02-29,90,50,,\n2024-03-31,90,50,x,\n"
    )
    good, rejected = bills.read_electricity(spark, str(power_bill), "h1")
    assert rows(good, "month_end_date", "total_kwh", "total_cost") == [(dt.date(2024, 1, 31), 600.0, 80.5)]
    assert rejected.count() == 2 and any("oops" in r["line"] for r in rejected.collect())
    gas, rejected = bills.read_gas(spark, str(gas_bill), "h1")
    assert rows(gas, "gas_m3", "water_m3", "water_cost") == [(100.0, 12.0, 30.0), (90.0, None, None)]
    assert rejected.count() == 1
    both = bills.read(spark, str(power_bill), str(gas_bill), "h1")
    assert sorted(both) == ["utility_bill_monthly_electricity", "utility_bill_monthly_gas"]
    assert list(bills.read(spark, gas_csv=str(gas_bill))) == ["utility_bill_monthly_gas"]


def test_bills_without_a_required_column_are_all_rejected(spark, tmp_path):
    path = tmp_path / "gas.csv"
    path.write_text("Date,Gas Consumption\n2024-01-31,100\n")
    good, rejected = bills.read_gas(spark, str(path), "h1")
    assert (good.count(), rejected.count()) == (0, 1)


def test_power(spark, tmp_path, rows):
    t = dt.datetime(2024, 1, 1)
    data = [("h", "d", 0, "c", t + dt.timedelta(hours=i), w, 120.0, 1.0, 1.0)
            for i, w in enumerate([5.0, -1.0, 0.0, 60000.0])]
    spark.createDataFrame(data, schemas.POWER).write.parquet(str(tmp_path / "p"))
    df, counts = power.read(spark, str(tmp_path / "p"), "2024-01-01 00:00:00")
    assert rows(df, "watts") == [(0.0,), (60000.0,)]
    assert counts.get == {"negative_watts": 1, "above_limit": 1}


def test_weather_payload(spark, tmp_path, rows):
    hours = ["2019-12-31T23:00", "2024-03-01T00:00", "2024-03-01T01:00"]
    hourly = {"time": hours, **{f: [0.5, 1.5, None] for f in C.WEATHER_FIELDS}}
    hourly["shortwave_radiation"] = [1.0, 2.0, 3.0]
    folder = tmp_path / "location_name=toronto"
    folder.mkdir()
    doc = {"latitude": 43.6, "longitude": -79.4, "elevation": 76.0, "timezone": "America/Toronto", "hourly": hourly}
    (folder / "a.json").write_text(json.dumps(doc))
    df = climate.read_weather(spark, str(tmp_path))
    assert set(df.columns) == set(spark.createDataFrame([], schemas.WEATHER).columns)
    late = [("toronto", dt.datetime(2024, 3, 1), 1.5, 2.0), ("toronto", dt.datetime(2024, 3, 1, 1), None, 3.0)]
    columns = ("location_name", "timestamp", "temperature_c", "ghi_wm2")
    assert rows(df, *columns) == [("toronto", dt.datetime(2019, 12, 31, 23), 0.5, 1.0), *late]
    assert rows(climate.read_weather(spark, str(tmp_path), C.FIRST_CURSOR), *columns) == late
    assert df.columns == climate.read_weather(spark, str(tmp_path), multi_line=True).columns


def test_air_quality_payload_round_trip(spark, tmp_path, rows):
    t = dt.datetime(2024, 3, 1)
    row = ("toronto", 43.6, -79.4, "America/Toronto")
    data = [row + (t + dt.timedelta(hours=i),) + tuple(float(i + k) for k in range(16)) for i in range(30)]
    raw = spark.createDataFrame(data, schemas.AIR_QUALITY)
    payloads = as_payloads(raw, {f: f for f in C.AIR_QUALITY_FIELDS},
                           {c: c for c in ("latitude", "longitude", "timezone")})
    payloads.write.partitionBy("location_name").json(str(tmp_path / "aq"))
    back = climate.read_air_quality(spark, str(tmp_path / "aq")).select(*raw.columns)
    assert rows(back) == rows(raw)


def test_configured_files(spark, feed, tmp_path, rows):
    csv = wide_file(tmp_path, ["2024-06-03," + ",".join("1" for _ in range(24))])
    (tmp_path / "empty.xml").write_text("")
    config = [
        {"path": str(feed / "one.xml"), "home_id": "h1"},
        {"path": str(feed / "two.xml"), "home_id": "h2", "format": "greenbutton_xml"},
        {"path": str(csv), "home_id": "h3", "format": "enova_csv"},
        {"path": str(tmp_path / "missing.xml"), "home_id": "x"},
        {"path": str(tmp_path / "empty.xml"), "home_id": "x"},
        {"path": str(csv), "home_id": "x", "format": "pdf"},
    ]
    df, skipped = files.read_configured(spark, config)
    assert rows(df.groupBy("home_id").count()) == [("h1", 4), ("h2", 1), ("h3", 24)]
    assert [reason for _, reason in skipped] == ["file not found", "file is empty", "unknown format pdf"]
    nothing, _ = files.read_configured(spark, config[3:])
    assert nothing.count() == 0 and "kwh" in nothing.columns


def test_lake_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    spark.range(20).withColumn("year", F.col("id") % 4).write.partitionBy("year").parquet(path)
    plan = files.read_lake(spark, path).filter("year = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_lake_of_one_home_reads_one_bucket(spark, tmp_path, rows):
    df = spark.range(40).selectExpr("concat('h', id % 10) as home_id", "id")
    path = str(tmp_path / "lake")
    with_home_bucket(df, 4).write.partitionBy("home_bucket").parquet(path)
    one = files.read_lake(spark, path, "h3", 4)
    assert rows(one, "id") == [(13,), (23,), (3,), (33,)]
    assert "PartitionFilters: [isnotnull(home_bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_grid(spark, tmp_path, rows):
    cols = spark.createDataFrame([], schemas.GRID)
    t = dt.datetime(2024, 1, 1)
    data = [(t, 30.0, 90.0, *[1.0] * 7, True, False), (t, None, 90.0, *[1.0] * 7, True, False)]
    spark.createDataFrame(data, cols.schema).write.parquet(str(tmp_path / "g"))
    assert rows(files.read_grid(spark, str(tmp_path / "g")), "timestamp_hour", "co2e_intensity_gco2_per_kwh") == [(t, 30.0)]
