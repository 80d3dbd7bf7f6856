"""Staging and fact tables on hand-written rows."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from hearthgrid import schemas
from hearthgrid.functions import weighted as W
from hearthgrid.plans import climate_report, dashboard, staging, store, usage
from hearthgrid.plans.marts import EXTRACTS, Marts, extract
from hearthgrid.sources.power import accept

T = dt.datetime(2024, 7, 1, 12)


def hours(n):
    return dt.timedelta(hours=n)


def reading(home, meter, ts, wh, commodity=1, uom=72, cost=10.0, tou="1", quality="VALIDATED"):
    return (home, 0, 0, ts, 3600, float(wh), int(wh), cost, f"Q.{quality}", tou,
            f"CommodityKindValue.VALUE_{commodity}", f"UnitSymbolKindValue.VALUE_{uom}", None, meter)


def weather(ts, t, place="toronto"):
    return (place, 1.0, 2.0, 3.0, "UTC", ts, t, *[1.0] * 12)


def air(ts, pm, place="toronto", pm10=5.0, aqi=10.0, aod=0.1, dust=1.0):
    values = {"pm10": pm10, "pm2_5": pm, "dust": dust, "uv_index": 2.0, "aerosol_optical_depth": aod, "european_aqi": aqi}
    from hearthgrid.constants import AIR_QUALITY_FIELDS

    return (place, 1.0, 2.0, "UTC", ts, *[values.get(f, 0.0) for f in AIR_QUALITY_FIELDS])


def grid(ts, intensity):
    return (ts, intensity, 90.0, *[100.0] * 7, True, False)


def power(ts, watts, device="d", channel=0, volts=120.0, home="h1"):
    return (home, device, channel, "c", ts, watts, volts, 1.0, 0.9)


def build(spark, readings, powers=(), weathers=(), airs=(), grids=(), **options):
    return Marts(
        readings=spark.createDataFrame(list(readings), schemas.READINGS),
        power=spark.createDataFrame(list(powers), schemas.POWER),
        weather=spark.createDataFrame(list(weathers), schemas.WEATHER),
        air_quality=spark.createDataFrame(list(airs), schemas.AIR_QUALITY),
        grid=spark.createDataFrame(list(grids), schemas.GRID),
        **options,
    )


TWO_METERS = [
    reading("h1", "m1", T, 1000),
    reading("h1", "m2", T + hours(1), 2000),
    reading("h1", "g1", T, 50, commodity=7, uom=42),
    reading("h2", None, T, 4000),
    reading("h2", None, T, 264.172 * 2, commodity=2, uom=119),
]


def test_home_join_repeats_readings_per_meter(spark, rows):
    m = build(spark, TWO_METERS)
    assert rows(m.electricity_facts, "home_id", "kwh", "fan_out") == [("h1", 1.0, 3), ("h1", 2.0, 3), ("h2", 4.0, 1)]
    assert m.fct_electricity.count() == 7
    hashes = {hashlib.md5(x).hexdigest() for x in (b"m1", b"m2", b"g1")}
    assert {r[0] for r in m.fct_electricity.filter("home_id = 'h1'").select("meter_id_hash").collect()} == hashes
    total = m.electricity_facts.agg(W.total("kwh")).first()[0]
    assert total == m.fct_electricity.agg(F.sum("kwh")).first()[0] == 13.0


def test_own_meter_join_keeps_every_reading_once(spark, rows):
    m = build(spark, TWO_METERS, dim_key="home_meter")
    assert rows(m.fct_electricity, "kwh", "meter_id_hash") == sorted([
        (1.0, hashlib.md5(b"m1").hexdigest()), (2.0, hashlib.md5(b"m2").hexdigest()), (4.0, None),
    ], key=str)
    assert m.electricity_facts.agg(W.total("kwh")).first()[0] == 7.0


def test_gallons_become_cubic_metres(spark):
    row = build(spark, TWO_METERS).fct_water.first()
    assert row["m3"] == pytest.approx(2.0) and row["raw_unit"] == "gal"
    assert row["gallons"] == pytest.approx(528.344) and row["liters"] == pytest.approx(2000.0)


def test_hourly_power_thresholds(spark, rows):
    data = [power(T + dt.timedelta(seconds=i), 100.0, device=f"d{n}") for n in (59, 60, 359, 360) for i in range(n)]
    data += [power(T, -5.0, "bad"), power(T, 10.0, "bad", volts=99.0), power(T, 10.0, "null", volts=None)]
    out = staging.power_hourly(spark.createDataFrame(data, schemas.POWER))
    assert rows(out, "device_id", "measurement_count", "quality", "estimated") == [
        ("d359", 359, "medium_quality", False), ("d360", 360, "high_quality", False),
        ("d59", 59, "low_quality", True), ("d60", 60, "medium_quality", False), ("null", 1, "low_quality", True),
    ]
    assert out.filter("device_id = 'd60'").first()["kwh"] == 0.1


def test_power_joins_the_electricity_facts(spark, rows):
    m = build(spark, [reading("h1", "m1", T, 1000)], [power(T, 500.0, channel=2)])
    assert rows(m.fct_electricity, "source", "device_id", "kwh", "tou_period") == [
        ("green_button", "0", 1.0, "on_peak"), ("power_monitoring", "d_ch2", 0.5, None),
    ]
    assert m.fct_utility.count() == 1


def test_weather_join(spark):
    m = build(
        spark,
        [reading("h1", "m", T + hours(i) + dt.timedelta(minutes=30), 1000) for i in range(4)],
        weathers=[weather(T, 10.0), weather(T + hours(1), 30.0), weather(T + hours(2), 99.0)],
        airs=[air(T, 40.0), air(T + hours(1), 5.0, place="elsewhere"), air(T + hours(3), 5.0)],
    )
    out = m.fct_weather.orderBy("timestamp").collect()
    assert [r["temperature_c"] for r in out] == [10.0, 30.0, None, None]
    assert [r["hvac_season"] for r in out] == ["heating", "cooling", "shoulder", "shoulder"]
    assert [(r["hdh"], r["cdh"]) for r in out] == [(8.0, 0.0), (0.0, 12.0), (0.0, 0.0), (0.0, 0.0)]
    # air quality needs a weather row of the same place
    assert [r["pm2_5"] for r in out] == [40.0, None, None, None]
    assert out[0]["is_high_pollution"] is True
    assert [r["missing_weather_data"] for r in out] == [False, False, True, True]


def test_two_locations(spark, rows):
    readings = [reading("h1", "m", T, 1000), reading("h2", "m", T, 2000)]
    weathers = [weather(T, 10.0), weather(T, 20.0, "ottawa")]
    assert build(spark, readings, weathers=weathers).fct_weather.count() == 4
    homes = spark.createDataFrame([("h1", "ottawa"), ("h2", "toronto")], "home_id string, location_name string")
    m = build(spark, readings, weathers=weathers, home_locations=homes)
    assert rows(m.fct_weather, "home_id", "temperature_c") == [("h1", 20.0), ("h2", 10.0)]
    assert m.hourly_weather.count() == 2


def test_weather_zone(spark):
    local = T - hours(4)  # Toronto summer time
    m = build(spark, [reading("h1", "m", T, 1000)], weathers=[weather(local, 10.0)], weather_tz="America/Toronto")
    assert m.fct_weather.first()["temperature_c"] == 10.0


def test_carbon(spark, rows):
    m = build(spark, TWO_METERS[:1] + TWO_METERS[3:4], grids=[grid(T, 50.0), grid(T + hours(1), None)])
    assert rows(m.fct_carbon, "kwh", "kg_co2e", "g_co2e") == [(1.0, 0.05, 50.0), (4.0, 0.2, 200.0)]


def test_feeds_that_have_not_arrived(spark):
    m = build(spark, TWO_METERS)
    assert m.fct_carbon.filter("kg_co2e is not null").count() == 0
    assert m.fct_weather.filter("not missing_weather_data").count() == 0
    assert climate_report.a_hvac_impact_pct(m).count() == 0
    assert dashboard.q_temp_usage_stats(m).first()["temperature_correlation"] is None


def test_impact_uses_rounded_averages(spark):
    readings = [reading("h1", "m", T, 2_400_000), reading("h1", "m", T + hours(1), 3_600_000)]
    m = build(spark, readings, weathers=[weather(T, 20.0), weather(T + hours(1), 20.0)],
              airs=[air(T, 5.0), air(T + hours(1), 60.0)])
    assert climate_report.a_hvac_impact_pct(m).first()["impact_pct"] == 50.0


def test_air_quality_flags_at_their_limits(spark, rows):
    data = [air(T, 35.0, aqi=60.0, aod=0.3, dust=20.0), air(T + hours(1), 35.5), air(T + hours(2), None, pm10=None),
            air(T + hours(3), -1.0), air(T + hours(4), 1.0, aqi=-1.0), air(T + hours(5), 1.0, aod=0.31)]
    out = staging.air_quality(spark.createDataFrame(data, schemas.AIR_QUALITY)).orderBy("ts").collect()
    assert [(r["quality"], r["is_high_pollution"], r["is_high_soiling_risk"]) for r in out] == [
        ("valid", False, False), ("valid", True, False), ("missing_pm", False, False), ("valid", False, True),
    ]


def test_heat_pump_days_match_a_join_of_all_rows(spark):
    readings = [reading("h1", "m", T + hours(i), 1000 * (i + 1)) for i in range(3)]
    m = build(spark, readings, [power(T + hours(i), 1000.0 * (i + 1), "hvac") for i in range(3)])
    sensors = spark.createDataFrame(
        [(T + hours(i), -5.0 - i, 21.0) for i in range(4)], "timestamp timestamp_ntz, outdoor_temp double, indoor_temp double"
    )
    hvac = m.fct_electricity.filter("device_id like '%hvac%'")
    joined = hvac.alias("e").join(sensors.alias("s"), F.to_date("e.timestamp") == F.to_date("s.timestamp")).agg(
        F.sum("kwh").alias("kwh"), F.avg("outdoor_temp").alias("out"), F.avg("indoor_temp").alias("ind")).first()
    row = usage.d_heat_pump_cop(m, sensors).first()
    assert (row["hvac_kwh"], row["avg_outdoor_temp"]) == (joined["kwh"], joined["out"])
    assert row["estimated_cop"] == pytest.approx(joined["kwh"] / (joined["ind"] - joined["out"]) * 100)
    assert usage.d_heat_pump_cop(m, sensors, repeat_by_sensor=False).first()["hvac_kwh"] == row["hvac_kwh"] / 4


def test_extract_columns(spark):
    m = build(spark, TWO_METERS)
    for name, columns in EXTRACTS.items():
        assert extract(m, name, ordered=True).columns == columns


def test_store_round_trip(spark, tmp_path, rows):
    readings = TWO_METERS + [reading("h1", "m1", T + hours(5), 3000)]
    m = build(spark, readings, [power(T, 100.0)], [weather(T, 10.0)], [air(T, 5.0)], [grid(T, 40.0)])
    store.save(m, str(tmp_path / "plain"))
    store.save(m, str(tmp_path / "folders"), ("year", "month"))
    for path in ("plain", "folders"):
        loaded = store.load(spark, str(tmp_path / path))
        for query in (dashboard.q_elec_monthly, dashboard.q_carbon_daily, climate_report.a_by_temp_category,
                      dashboard.q_weather_summary, dashboard.q_water_readings):
            assert rows(query(loaded)) == rows(query(m))
        assert rows(loaded.fct_weather.select(*m.fct_weather.columns)) == rows(m.fct_weather)


def test_settled_dimensions_are_broadcast_below_the_limit_and_shuffled_above(spark, tmp_path):
    m = build(spark, TWO_METERS).settle(str(tmp_path / "dims"))

    def plan():
        return m.electricity_facts.select("kwh", "fan_out")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        m.__dict__.pop("electricity_facts", None)
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.fixture
def small_limits(spark):
    """Limits at which test-sized partitions count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("hot", ["home", "hour"])
def test_a_hot_home_or_hour_is_split_over_tasks(spark, tmp_path, small_limits, hot):
    """Half of all readings in one home, then in one hour, with both dimensions too large to broadcast."""
    n = F.col("id")
    varied = F.when(n % 2 == 0, F.lit(0)).otherwise(n % 997)
    home, hour = (varied, n % 5) if hot == "home" else (n % 997, varied)
    readings = (
        spark.range(0, 120_000, 1, 8)
        .select(
            F.concat(F.lit("h"), home).alias("home_id"),
            F.lit(0).alias("usage_point_idx"),
            n.cast("int").alias("meter_reading_idx"),
            (F.lit(T).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))).alias("timestamp"),
            F.lit(3600).alias("duration_seconds"),
            (n % 1000 * 125).cast("double").alias("kwh"),
            n.alias("raw_value"),
            F.xxhash64("id").cast("double").alias("cost"),
            F.lit("Q.VALIDATED").alias("quality_code"),
            F.lit("1").alias("tou_bucket"),
            F.lit("K.VALUE_1").alias("commodity"),
            F.lit("U.VALUE_72").alias("uom"),
            F.lit(None).cast("string").alias("service_kind"),
            F.lit("m").alias("meter_id"),
        )
    )
    weathers = [weather(T + hours(i), float(i % 30)) for i in range(997)]
    m = build(spark, [], weathers=weathers)
    m.readings = readings
    m = m.settle(str(tmp_path / "dims"))
    out = m.weather_facts.groupBy("temperature_category").agg(W.total("kwh").alias("kwh"), W.total("cost").alias("c"))
    total = sum(r["kwh"] for r in out.collect())
    assert total == sum(i % 1000 for i in range(120_000)) / 8
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_power_cursor(spark, rows):
    data = [power(T, 1.0), power(T + hours(1), 2.0)]
    df = spark.createDataFrame(data, schemas.POWER)
    assert rows(accept(df, "2024-07-01 12:00:00"), "watts") == [(2.0,)]


def test_own_meter_survives_the_store(spark, tmp_path):
    """Two meters in one home: each reading has its own, before and after it is stored, and without other feeds."""
    reading = (
        "select 'h' home_id, 0 usage_point_idx, 0 meter_reading_idx, timestamp_ntz'2024-01-01 00:00:00' timestamp, 3600 duration_seconds,"
        " 5D kwh, 5L raw_value, null::double cost, 'QualityOfReading.VALIDATED' quality_code, null::string tou_bucket,"
        " 'CommodityKindValue.VALUE_7' commodity, 'UnitSymbolKindValue.VALUE_42' uom, null::string service_kind, '{}' meter_id"
    )
    readings = spark.sql(" union all ".join(reading.format(m) for m in ("m1", "m2")))
    for key, n in (("home_meter", 2), ("home", 4)):
        made = Marts(readings, dim_key=key)
        store.save(made, f"{tmp_path}/{key}")
        loaded = store.load(spark, f"{tmp_path}/{key}")
        assert made.fct_gas.count() == loaded.fct_gas.count() == n
        assert made.settle(f"{tmp_path}/settled-{key}").fct_gas.count() == n
        assert sorted(made.fct_gas.columns) == sorted(loaded.fct_gas.columns)
        assert climate_report.a_weather_range(loaded).count() == 1
