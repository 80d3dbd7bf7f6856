"""Raw utility tables derived from star-schema test tables (orders, line items, events).

Amounts are exact binary fractions, so sums do not depend on the order of the rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid.plans.marts import Marts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _label(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def readings(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return readings_of(table(spark, sf_dir, "lineitem"), keep)


def readings_of(lineitem: DataFrame, keep=()) -> DataFrame:
    """Interval readings from line items, four meters to a home."""
    meter, line = F.col("l_suppkey"), F.col("l_linenumber")
    flags = F.concat("l_returnflag", "l_linestatus")
    quality = F.lit(None).cast("string")
    for code, name in [
        ("AF", "VALIDATED"),
        ("AO", "MANUAL"),
        ("NF", "ESTIMATED"),
        ("NO", "DERIVED"),
        ("RF", "PROJECTED"),
        ("RO", "VALUE_14"),
    ]:
        quality = F.when(flags == code, f"QualityOfReading.{name}").otherwise(quality)
    kind = meter % 4
    raw = F.col("l_quantity").cast("bigint") * 125
    bucket = F.col("l_partkey") % 4
    return lineitem.select(
        _label("home-", F.floor(meter / 4)).alias("home_id"),
        meter.cast("int").alias("usage_point_idx"),
        line.cast("int").alias("meter_reading_idx"),
        F.expr("l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 as int))").alias("timestamp"),
        F.lit(3600).alias("duration_seconds"),
        raw.cast("double").alias("kwh"),
        raw.alias("raw_value"),
        F.floor("l_extendedprice").cast("double").alias("cost"),
        quality.alias("quality_code"),
        F.when(bucket != 0, bucket.cast("string")).alias("tou_bucket"),
        F.when(kind == 2, "CommodityKindValue.VALUE_7")
        .when(kind == 3, "CommodityKindValue.VALUE_2")
        .otherwise("CommodityKindValue.VALUE_1")
        .alias("commodity"),
        F.when(kind < 2, "UnitSymbolKindValue.VALUE_72")
        .when((kind == 3) & (line % 2 == 1), "UnitSymbolKindValue.VALUE_119")
        .otherwise("UnitSymbolKindValue.VALUE_42")
        .alias("uom"),
        F.lit(None).cast("string").alias("service_kind"),
        _label("meter-", meter).alias("meter_id"),
        *keep,
    )


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power_of(table(spark, sf_dir, "events"))


def power_of(events: DataFrame) -> DataFrame:
    """Power measurements from events."""
    channel = F.col("user_id") % 2
    event = F.col("event_id")
    return events.select(
        _label("home-", F.col("user_id") % 3).alias("home_id"),
        F.col("event_type").alias("device_id"),
        channel.alias("channel"),
        _label("ch", channel).alias("channel_name"),
        F.col("ts").alias("timestamp"),
        (F.col("value") * 150 - 500).alias("watts"),
        F.when(event % 17 != 0, (95 + event % 50).cast("double")).alias("volts"),
        F.lit(1.0).alias("amps"),
        F.lit(0.875).alias("power_factor"),
    )


def hours(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Distinct hours of the readings as (timestamp, d = day of year, h = hour).

    Written once, like any landed feed, so that the hourly tables do not read the line items.
    """
    distinct = (
        readings(spark, sf_dir)
        .select(F.to_date("timestamp").alias("date"), F.hour("timestamp").alias("h"))
        .distinct()
        .select(
            F.expr("cast(date as timestamp_ntz) + make_dt_interval(0, h)").alias("timestamp"),
            F.dayofyear("date").alias("d"),
            "h",
        )
    )
    distinct.write.mode("overwrite").parquet(f"{folder}/hours")
    return spark.read.parquet(f"{folder}/hours")


def _double(value: Column, name: str) -> Column:
    return value.cast("double").alias(name)


def weather(hourly: DataFrame, location: str = "toronto") -> DataFrame:
    """Hourly weather for every hour that has readings."""
    d, h = F.col("d"), F.col("h")
    temperature = (
        F.when(d % 53 == 0, F.lit(None).cast("double"))
        .when(d % 61 == 0, 99.0)
        .otherwise(22 - F.abs(d - 200) / 4 + h % 5)
    )
    cloud = (d * 7 + h) % 101
    ghi = F.greatest(F.lit(0), 600 - F.abs(h - 12) * 100)
    return hourly.select(
        F.lit(location).alias("location_name"),
        F.lit(43.65).alias("latitude"),
        F.lit(-79.38).alias("longitude"),
        F.lit(76.0).alias("elevation_m"),
        F.lit("America/Toronto").alias("timezone"),
        "timestamp",
        _double(temperature, "temperature_c"),
        _double(40 + (d + h) % 60, "humidity_pct"),
        _double((d * h) % 8 / 4, "precipitation_mm"),
        _double((d + 3 * h) % 50, "windspeed_kmh"),
        *[_double(cloud, f"cloud_cover{level}_pct") for level in ("", "_low", "_mid", "_high")],
        _double(ghi, "ghi_wm2"),
        _double(ghi / 2, "dni_wm2"),
        _double(ghi / 2, "dhi_wm2"),
        _double(ghi / 2, "direct_horizontal_wm2"),
        _double(F.least(F.lit(3600), ghi * 8), "sunshine_duration_s"),
    )


def air_quality(hourly: DataFrame, location: str = "toronto") -> DataFrame:
    """Hourly air quality, with some days missing."""
    d, h = F.col("d"), F.col("h")
    pm = F.when(d % 41 == 0, F.lit(None).cast("int")).when(d % 97 == 0, -1).otherwise((d * 7 + h * 3) % 180)
    uv = F.when(h.between(6, 20), d % 13).otherwise(0)
    index, other = (d * 5 + h) % 130, (d + h) % 100
    return (
        hourly
        .filter(d % 29 != 0)
        .select(
            F.lit(location).alias("location_name"),
            F.lit(43.65).alias("latitude"),
            F.lit(-79.38).alias("longitude"),
            F.lit("America/Toronto").alias("timezone"),
            "timestamp",
            _double(pm + 5, "pm10"),
            _double(pm, "pm2_5"),
            _double((d + h) % 40, "dust"),
            *[_double(other, c) for c in ("ozone", "nitrogen_dioxide", "sulphur_dioxide", "carbon_monoxide")],
            _double(uv, "uv_index"),
            _double(uv, "uv_index_clear_sky"),
            _double((d * 3 + h) % 60 / 64, "aerosol_optical_depth"),
            _double(index, "european_aqi"),
            *[
                _double(index, f"european_aqi_{c}")
                for c in ("pm2_5", "pm10", "nitrogen_dioxide", "ozone", "sulphur_dioxide")
            ],
        )
    )


def grid(hourly: DataFrame) -> DataFrame:
    """Hourly grid intensity and generation mix."""
    d, h = F.col("d"), F.col("h")
    total = 15000 + 100 * h
    shares = {"nuclear": 2, "gas": 16, "hydro": 4, "wind": 8, "solar": 32, "biofuel": 32}
    return hourly.select(
        F.col("timestamp").alias("hour"),
        _double(F.when(d % 67 != 0, 16 + (d * 3 + h * 5) % 90), "co2e_intensity_gco2_per_kwh"),
        _double((d + h) % 101, "clean_pct"),
        _double(total, "total_mw"),
        *[_double(total / part, f"{fuel}_mw") for fuel, part in shares.items()],
        (h % 2 == 0).alias("has_ieso"),
        (h % 3 == 0).alias("has_gridwatch"),
    )


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            _label("home-", F.col("o_custkey") % 3).alias("home_id"), F.last_day("o_orderdate").alias("month_end_date")
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).cast("double").alias("cost"))
    )


def bills_electricity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    return _monthly(spark, sf_dir).select(
        "home_id",
        "month_end_date",
        _double(n * 8, "total_kwh"),
        _double(n * 4, "off_peak_kwh"),
        _double(n * 2, "mid_peak_kwh"),
        _double(n * 2, "on_peak_kwh"),
        F.col("cost").alias("total_cost"),
        F.lit(0.0625).alias("off_peak_rate"),
        F.lit(0.125).alias("mid_peak_rate"),
        F.lit(0.1875).alias("on_peak_rate"),
    )


def bills_gas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gas bills; water amounts only where the month has an even number of orders."""
    n = F.col("n")
    even = n % 2 == 0
    return _monthly(spark, sf_dir).select(
        "home_id",
        "month_end_date",
        _double(n, "gas_m3"),
        F.col("cost").alias("gas_cost"),
        _double(F.when(even, n * 2), "water_m3"),
        _double(F.when(even, n * 4), "water_cost"),
    )


def marts(spark: SparkSession, sf_dir: str, folder: str, **options) -> Marts:
    """Marts over the test tables; ``folder`` takes the derived hourly feed."""
    hourly = hours(spark, sf_dir, folder)
    return Marts(
        readings=readings(spark, sf_dir),
        power=power(spark, sf_dir),
        weather=weather(hourly),
        air_quality=air_quality(hourly),
        grid=grid(hourly),
        **options,
    )
