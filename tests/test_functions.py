"""Decoding, bands and units at their boundaries."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode, units


def evaluate(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.withColumn("out", expression(F.col("v"))).orderBy("i").collect()]


def test_quality_codes(spark):
    codes = ["Q.VALIDATED", "Q.ESTIMATED", "Q.DERIVED", "Q.PROJECTED", "Q.MANUAL", "Q.VALUE_14", None]
    assert evaluate(spark, codes, "string", decode.quality) == [
        "validated", "estimated", "derived", "projected", "manual", "unknown", "unknown",
    ]
    assert evaluate(spark, codes, "string", decode.is_estimated) == [False, True, True, True, False, False, False]


def test_commodity_order_and_wildcard(spark):
    codes = ["K.VALUE_1", "K.VALUE_14", "K.VALUE_7", "K.VALUE_2", "K.VALUE_9", "K.VALUEx1", None]
    assert evaluate(spark, codes, "string", decode.commodity) == [
        "electricity", "electricity", "natural_gas", "water", "unknown", "electricity", "unknown",
    ]


def test_units_of_measure(spark):
    codes = ["U.VALUE_72", "U.VALUE_42", "U.VALUE_38", "U.VALUE_119", None]
    assert evaluate(spark, codes, "string", decode.unit) == ["Wh", "m3", "W", "unknown", "unknown"]
    assert evaluate(spark, codes, "string", lambda c: decode.unit(c, water=True)) == ["Wh", "m3", "W", "gal", "unknown"]


def test_display_names_differ_from_decoded_ones(spark):
    codes = ["CommodityKindValue.VALUE_2", "CommodityKindValue.VALUE_5", None]
    assert evaluate(spark, codes, "string", decode.display_commodity) == [
        "natural-gas", "CommodityKindValue.VALUE_5", None,
    ]


@pytest.mark.parametrize(
    "bands, values, labels, options",
    [
        (C.PM25_BANDS, [None, -1.0, 12.0, 35.0, 55.0, 150.0],
         ["unknown", "good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy"], {"missing": "unknown"}),
        (C.AQI_BANDS, [20.0, 40.0, 60.0, 80.0, 100.0, 100.5],
         ["good", "fair", "moderate", "poor", "very_poor", "extremely_poor"], {"inclusive": True}),
        (C.UV_BANDS, [2.9, 3.0, 6.0, 8.0, 11.0], ["low", "moderate", "high", "very_high", "extreme"], {}),
        (C.TEMPERATURE_BANDS, [-10.5, -10.0, 0.0, 10.0, 20.0, 25.0, None],
         ["very_cold", "cold", "cool", "mild", "warm", "hot", "hot"], {}),
    ],
)
def test_bands(spark, bands, values, labels, options):
    assert evaluate(spark, values, "double", lambda c: decode.band(c, bands, **options)) == labels


def test_power_quality(spark):
    cases = [
        (0.0, 120.0, "valid"), (-0.01, 120.0, "invalid_negative"), (50000.0, None, "valid"),
        (50000.01, None, "invalid_high"), (1.0, 99.9, "voltage_out_of_range"), (1.0, 100.0, "valid"),
        (1.0, 140.0, "valid"), (1.0, 140.1, "voltage_out_of_range"), (1.0, None, "valid"), (None, None, "valid"),
    ]
    df = spark.createDataFrame(cases, "watts double, volts double, want string")
    wrong = df.filter(decode.power_quality(F.col("watts"), F.col("volts")) != F.col("want"))
    assert wrong.count() == 0


def test_weather_quality(spark):
    assert evaluate(spark, [None, -50.0, 60.0, -50.1, 60.1], "double", decode.weather_quality) == [
        "missing", "valid", "valid", "out_of_range", "out_of_range",
    ]


def tou(when):
    """The schedule, hour by hour."""
    if when.weekday() >= 5:
        return 3
    if when.hour in (11, 12, 13, 14, 15, 16):
        return 1 if when.month in (5, 6, 7, 8, 9, 10) else 2
    if when.hour in (7, 8, 9, 10, 17, 18):
        return 2 if when.month in (5, 6, 7, 8, 9, 10) else 1
    return 3


def test_tou_bucket_all_hours_of_boundary_weeks(spark):
    starts = [dt.datetime(2024, 4, 27), dt.datetime(2024, 10, 28), dt.datetime(2024, 12, 30)]
    times = [s + dt.timedelta(hours=h) for s in starts for h in range(24 * 8)]
    assert evaluate(spark, times, "timestamp_ntz", decode.tou_bucket) == [tou(t) for t in times]


def test_degree_hours_and_season(spark):
    t = [None, 10.0, 18.0, 20.0, 22.0, 22.5]
    assert evaluate(spark, t, "double", units.heating_degree_hours) == [0.0, 8.0, 0.0, 0.0, 0.0, 0.0]
    assert evaluate(spark, t, "double", units.cooling_degree_hours) == [0.0, 0.0, 0.0, 2.0, 4.0, 4.5]
    assert evaluate(spark, t, "double", units.hvac_season) == [
        "shoulder", "heating", "shoulder", "shoulder", "shoulder", "cooling",
    ]


def test_conversions(spark):
    assert evaluate(spark, [264.172], "double", units.gallons_to_m3) == [1.0]
    assert evaluate(spark, [1500.0], "double", units.wh_to_kwh) == [1.5]
    assert evaluate(spark, [100.0], "double", units.gas_to_thermal_kwh) == [pytest.approx(1002.25)]


def test_floor_to(spark):
    at = [dt.datetime(2024, 12, 31, 19, 59, 59, 999999)]
    want = {
        "hour": dt.datetime(2024, 12, 31, 19), "day": dt.datetime(2024, 12, 31), "week": dt.datetime(2024, 12, 30),
        "month": dt.datetime(2024, 12, 1), "year": dt.datetime(2024, 1, 1),
    }
    for grain, start in want.items():
        assert evaluate(spark, at, "timestamp_ntz", lambda c: units.floor_to(grain, c)) == [start]


def test_day_of_week_starts_on_sunday(spark):
    days = [dt.datetime(2024, 9, 1), dt.datetime(2024, 9, 7)]
    assert evaluate(spark, days, "timestamp_ntz", units.day_of_week) == [0, 6]


def test_half_up_is_stable_at_the_edge(spark):
    values = [2.675, 0.125, -0.125, 6622.2349999999997, 6622.2350000000006, None]
    assert evaluate(spark, values, "double", lambda c: units.half_up(c, 2)) == [
        2.68, 0.13, -0.13, 6622.24, 6622.24, None,
    ]


def test_anonymize(spark):
    df = spark.createDataFrame([("m-1", "1 Main St"), (None, "2 Main St")], "meter_id string, address string")
    out = {r["meter_id"]: r["address"] for r in decode.anonymize(df, ["meter_id"], ["address"], "s").collect()}
    assert out == {hashlib.sha256(b"sm-1").hexdigest(): None, None: None}
