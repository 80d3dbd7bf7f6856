"""Decoded and validated views of the raw tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode, units

READING_IDS = ["home_id", "usage_point_idx", "meter_reading_idx", "meter_id"]


#: Folders of stored readings: decoded commodity and month of the reading.
READING_FOLDERS = ["commodity_type", "ts_month"]


def month_folder(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


#: The names that codes usually have, at most 15 of a kind.
USUAL = {
    "quality_code": [*dict.fromkeys(f"QualityOfReading.{name}" for _, name in C.ESPI_QUALITY), "QualityOfReading.VALUE_14"],
    "tou_bucket": [bucket for bucket, _ in C.TOU_PERIODS],
    "commodity": [f"CommodityKindValue.{code}" for code, _ in C.COMMODITY_CODES],
    "uom": [f"UnitSymbolKindValue.{code}" for code, _ in C.WATER_UNIT_CODES],
}
#: Columns of packed readings: places of their codes in USUAL (from 1, 0 for others), and number of their folder.
CODES, FOLDER = "_codes", "_folder"


def packed(readings: DataFrame) -> DataFrame:
    """Raw readings with usual codes as places in one number, to be shuffled and sorted by FOLDER; `decoded` takes them.

    A code that is not among the usual ones stays as it is, others become null. Columns that differ from row to row stand
    side by side, as the blocks of a shuffle are smaller then.
    """
    places = {c: F.coalesce(F.array_position(F.array(*map(F.lit, usual)), F.col(c)), F.lit(0)) for c, usual in USUAL.items()}
    codes = F.lit(0).cast("bigint")
    for place in places.values():
        codes = codes * 16 + place
    rows = readings.withColumns({CODES: codes.cast("int"), **{c: F.when(place == 0, F.col(c)) for c, place in places.items()}})
    kind = decode.rank_of(_label(rows, "commodity", decode.commodity), [name for _, name in C.COMMODITY_CODES])
    rows = rows.withColumn(FOLDER, kind * 100_000_000 + F.coalesce(month_folder(F.col("timestamp")), F.lit(0)))
    return rows.select(
        *USUAL, "service_kind", "duration_seconds", "home_id", "meter_id", "cost", "usage_point_idx", "kwh", "raw_value", "meter_reading_idx", CODES, FOLDER, "timestamp"
    )


def _usual(name: str, values: list[Column]) -> Column:
    """The value for the code of packed readings, null if it is not a usual one."""
    place = F.shiftright(CODES, 4 * list(reversed(USUAL)).index(name)).bitwiseAND(F.lit(15))
    return F.get(F.array(*values), place - 1)


def _label(rows: DataFrame, name: str, label) -> Column:
    """The label of a code; for usual codes of packed readings it is made once and looked up."""
    if CODES not in rows.columns:
        return label(F.col(name))
    return F.coalesce(_usual(name, [label(F.lit(code)) for code in USUAL[name]]), label(F.col(name)))


def decoded(readings: DataFrame) -> DataFrame:
    """Readings of all commodities, every code decoded once; what the views below select from.

    Store it by READING_FOLDERS (see `plans.store`): a view then reads the folders of its commodity alone. Readings may
    come `packed`.
    """
    raw = {name: _label(readings, name, lambda code: code) for name in USUAL}
    label = lambda name, decoder: _label(readings, name, decoder)
    kind = label("commodity", decode.commodity)
    water, other = label("uom", lambda code: decode.unit(code, True)), label("uom", lambda code: decode.unit(code, False))
    return readings.select(
        *READING_IDS,
        F.col("timestamp").alias("ts"),
        "duration_seconds",
        "kwh",
        "raw_value",
        F.col("cost").alias("cost_cents"),
        label("quality_code", decode.quality).alias("quality"),
        label("quality_code", decode.is_estimated).alias("estimated"),
        label("tou_bucket", decode.tou_period).alias("tou_period"),
        raw["tou_bucket"].alias("tou_bucket_raw"),
        F.when(kind == "water", water).otherwise(other).alias("unit"),
        "service_kind",
        raw["quality_code"].alias("quality_code_raw"),
        raw["commodity"].alias("commodity_raw"),
        raw["uom"].alias("uom_raw"),
        kind.alias("commodity_type"),
        month_folder(F.col("timestamp")).alias("ts_month"),
    )


def _of(readings: DataFrame, commodity: str, amount: dict[str, Column], extra: tuple[str, ...] = ()) -> DataFrame:
    """One commodity of decoded readings; raw ones are decoded first."""
    every = readings if "commodity_type" in readings.columns else decoded(readings)
    return every.filter(F.col("commodity_type") == commodity).select(
        *READING_IDS,
        "ts",
        "duration_seconds",
        *[value.alias(name) for name, value in amount.items()],
        "raw_value",
        "cost_cents",
        "quality",
        "estimated",
        *extra,
        "commodity_type",
        "unit",
        "service_kind",
        "quality_code_raw",
        "commodity_raw",
        "uom_raw",
    )


def electricity(readings: DataFrame) -> DataFrame:
    """Electricity readings; the raw amount is in Wh."""
    return _of(readings, "electricity", {"kwh": units.wh_to_kwh(F.col("kwh"))}, ("tou_period", "tou_bucket_raw"))


def gas(readings: DataFrame) -> DataFrame:
    """Gas readings; the raw amount is in cubic metres."""
    return _of(readings, "natural_gas", {"m3": F.col("kwh")})


def water(readings: DataFrame) -> DataFrame:
    """Water readings; the raw amount is in cubic metres or gallons."""
    return _of(readings, "water", {"volume": F.col("kwh")})


def power_validated(power: DataFrame) -> DataFrame:
    """Every measurement with its quality label and the flag that excludes it from the rollup."""
    label = decode.power_quality(F.col("watts"), F.col("volts"))
    return power.withColumnRenamed("timestamp", "ts").withColumns(
        {"quality": label, "is_invalid": label != "valid"}
    )


def power_hourly(
    power: DataFrame,
    medium: int = C.MEDIUM_QUALITY_COUNT,
    high: int = C.HIGH_QUALITY_COUNT,
    estimated_below: int | None = None,
) -> DataFrame:
    """Hourly energy of each channel: mean watts over the hour, as kWh."""
    measured = power_validated(power).filter(~F.col("is_invalid"))
    hour = units.floor_to("hour", F.col("ts")).alias("timestamp")
    return power_labelled(measured.groupBy(*CHANNEL, hour).agg(*power_means()), medium, high, estimated_below)


CHANNEL = ["home_id", "device_id", "channel", "channel_name"]


def power_means() -> list[Column]:
    return [
        F.avg("watts").alias("avg_watts"),
        F.avg("volts").alias("avg_volts"),
        F.avg("amps").alias("avg_amps"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.count(F.lit(1)).alias("measurement_count"),
    ]


def power_labelled(hourly: DataFrame, medium: int, high: int, estimated_below: int | None = None) -> DataFrame:
    """Energy and quality label of hourly means."""
    limit = medium if estimated_below is None else estimated_below
    n = F.col("measurement_count")
    return hourly.select(
        "home_id",
        "device_id",
        "channel",
        "channel_name",
        "timestamp",
        units.wh_to_kwh(F.col("avg_watts")).alias("kwh"),
        "avg_watts",
        "avg_volts",
        "avg_amps",
        "avg_power_factor",
        "measurement_count",
        F.when(n >= high, "high_quality").when(n >= medium, "medium_quality").otherwise("low_quality").alias("quality"),
        (n < limit).alias("estimated"),
    )


def _dated(ts: Column) -> list[Column]:
    return [
        ts.alias("ts"),
        units.floor_to("hour", ts).alias("hour"),
        units.floor_to("day", ts).alias("date"),
        units.year(ts).alias("year"),
        units.month(ts).alias("month"),
        units.day(ts).alias("day"),
        units.hour(ts).alias("hour_of_day"),
        units.day_of_week(ts).alias("day_of_week"),
    ]


def _event_time(df: DataFrame, local_tz: str | None) -> Column:
    """Feed times are local wall-clock values; with a zone they are moved to UTC."""
    ts = F.col("timestamp")
    return ts if local_tz is None else F.convert_timezone(F.lit(local_tz), F.lit("UTC"), ts)


def weather(raw: DataFrame, local_tz: str | None = None) -> DataFrame:
    """Hourly weather with a usable temperature."""
    t = F.col("temperature_c")
    return (
        raw.select(
            "location_name",
            "latitude",
            "longitude",
            "elevation_m",
            "timezone",
            *_dated(_event_time(raw, local_tz)),
            *C.WEATHER_FIELDS.values(),
            decode.weather_quality(t).alias("quality"),
            decode.true_if(t.between(*C.PLAUSIBLE_TEMPERATURE)).alias("is_valid_temperature"),
            decode.band(t, C.TEMPERATURE_BANDS).alias("temperature_category"),
        ).filter(F.col("quality") == "valid")
    )


def air_quality(raw: DataFrame, local_tz: str | None = None) -> DataFrame:
    """Hourly air quality; hours without particulate data stay in."""
    pm, aqi = F.col("pm2_5"), F.col("european_aqi")
    return raw.select(
        "location_name",
        "latitude",
        "longitude",
        "timezone",
        *_dated(_event_time(raw, local_tz)),
        *C.AIR_QUALITY_FIELDS,
        decode.band(pm, C.PM25_BANDS, missing="unknown").alias("pm2_5_category"),
        decode.band(aqi, C.AQI_BANDS, missing="unknown", inclusive=True).alias("aqi_category"),
        decode.band(F.col("uv_index"), C.UV_BANDS, missing="unknown").alias("uv_category"),
        decode.air_quality_label(pm, F.col("pm10"), aqi).alias("quality"),
        decode.true_if((pm > C.HIGH_PM25) | (aqi > C.HIGH_AQI)).alias("is_high_pollution"),
        decode.true_if((F.col("aerosol_optical_depth") > C.HIGH_AOD) | (F.col("dust") > C.HIGH_DUST)).alias(
            "is_high_soiling_risk"
        ),
    ).filter(F.col("quality").isin("valid", "missing_pm"))


def grid_intensity(raw: DataFrame) -> DataFrame:
    """Hours with a known carbon intensity."""
    return raw.filter(F.col("co2e_intensity_gco2_per_kwh").isNotNull()).withColumnRenamed("hour", "timestamp_hour")


def homes(readings: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One row per home and meter."""
    return (
        readings.select("home_id", "meter_id")
        .distinct()
        .select(
            "home_id",
            "meter_id",
            F.md5("meter_id").alias("meter_id_hash"),
            F.lit(None).cast("string").alias("address_anonymized"),
            F.lit(None).cast("int").alias("vintage"),
            F.lit(None).cast("double").alias("sqft"),
            F.lit(None).cast("string").alias("heat_type"),
            (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        )
    )
