"""Fact tables.

Every fact exists in two forms. The *facts* functions keep one row per reading and carry the
number of dimension rows of its home in ``fan_out`` (see ``functions.weighted``); all analytics
run on them. The *fct* functions return the tables as users read them, with ``meter_id_hash``,
one row per reading and dimension row.

``dim_key`` selects the join to the home dimension: ``"home"`` matches every meter of the home,
``"home_meter"`` only the reading's own meter.
"""

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid import schemas
from hearthgrid.functions import decode, units
from hearthgrid.functions.weighted import FAN_OUT
from hearthgrid.plans import staging


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _date_parts(with_hour: bool = False) -> list[Column]:
    ts = F.col("timestamp")
    parts = [units.year(ts).alias("year"), units.month(ts).alias("month"), units.day(ts).alias("day")]
    if with_hour:
        parts += [units.hour(ts).alias("hour"), units.day_of_week(ts).alias("day_of_week")]
    return parts


def home_meters(homes: DataFrame) -> DataFrame:
    """Dimension rows per home."""
    return homes.groupBy("home_id").agg(F.count(F.lit(1)).alias(FAN_OUT))


def with_fan_out(facts: DataFrame, meters: DataFrame, dim_key: str = "home") -> DataFrame:
    """Add the number of dimension rows each fact matches; unmatched facts count once.

    The home side has one row per home, so the join never multiplies rows, and each reading of a
    hot home needs only that one row: AQE may split such a home over many tasks.
    """
    if dim_key == "home_meter":
        return facts.withColumn(FAN_OUT, F.lit(1).cast("bigint"))
    return facts.join(meters, "home_id", "left").withColumn(
        FAN_OUT, F.coalesce(F.col(FAN_OUT), F.lit(1).cast("bigint"))
    )


def with_meter_hash(facts: DataFrame, homes: DataFrame, dim_key: str = "home") -> DataFrame:
    """Left join to the home dimension."""
    dim = homes.select(
        F.col("home_id").alias("_home"), F.col("meter_id").alias("_meter"), "meter_id_hash"
    )
    match = F.col("home_id") == F.col("_home")
    if dim_key == "home_meter":
        match = match & F.col("meter_id").eqNullSafe(F.col("_meter"))
    return facts.join(dim, match, "left").drop("_home", "_meter")


# --- electricity


def electricity_sources(readings: DataFrame, power_hourly: DataFrame | None) -> DataFrame:
    """Utility readings and hourly power monitoring in one shape."""
    metered = staging.electricity(readings).select(
        F.lit("green_button").alias("source"),
        "home_id",
        F.col("usage_point_idx").cast("string").alias("device_id"),
        F.col("ts").alias("timestamp"),
        "kwh",
        F.col("cost_cents").alias("cost"),
        "quality",
        "estimated",
        "tou_period",
        "meter_id",
    )
    if power_hourly is None:
        return metered
    monitored = power_hourly.select(
        F.lit("power_monitoring").alias("source"),
        "home_id",
        F.concat("device_id", F.lit("_ch"), F.col("channel").cast("string")).alias("device_id"),
        "timestamp",
        "kwh",
        _null("double").alias("cost"),
        "quality",
        "estimated",
        _null("string").alias("tou_period"),
        _null("string").alias("meter_id"),
    )
    return metered.unionByName(monitored)


_ELECTRICITY = ["device_id", "timestamp", "kwh", "cost", "quality", "estimated", "tou_period"]


def electricity_columns(extra: str) -> list:
    return [
        "source",
        "home_id",
        extra,
        *_ELECTRICITY,
        _null("double").alias("co2_g_per_kwh"),
        _null("double").alias("rate_cents_per_kwh"),
        *_date_parts(with_hour=True),
    ]


# --- gas and water


def gas_sources(readings: DataFrame) -> DataFrame:
    return staging.gas(readings).select(
        F.lit("green_button").alias("source"),
        "home_id",
        F.col("usage_point_idx").alias("device_id"),
        F.col("ts").alias("timestamp"),
        "m3",
        F.col("cost_cents").alias("cost"),
        "quality",
        "estimated",
        "meter_id",
    )


def gas_columns(extra: str) -> list:
    return [
        "source",
        "home_id",
        extra,
        "device_id",
        "timestamp",
        "m3",
        "cost",
        "quality",
        "estimated",
        _null("double").alias("avg_outdoor_temp_c"),
        _null("double").alias("heating_degree_days"),
        _null("double").alias("rate_cents_per_m3"),
        *_date_parts(),
    ]


def water_sources(readings: DataFrame) -> DataFrame:
    volume = F.col("volume")
    return staging.water(readings).select(
        F.lit("green_button").alias("source"),
        "home_id",
        F.col("usage_point_idx").alias("device_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("unit") == "gal", units.gallons_to_m3(volume)).otherwise(volume).alias("m3"),
        volume.alias("raw_volume"),
        F.col("unit").alias("raw_unit"),
        F.col("cost_cents").alias("cost"),
        "quality",
        "estimated",
        "meter_id",
    )


def water_columns(extra: str) -> list:
    return [
        "source",
        "home_id",
        extra,
        "device_id",
        "timestamp",
        "m3",
        "raw_volume",
        "raw_unit",
        "cost",
        "quality",
        "estimated",
        _null("double").alias("rate_cents_per_m3"),
        _null("double").alias("rate_cents_per_gal"),
        *_date_parts(),
        units.m3_to_gallons(F.col("m3")).alias("gallons"),
        units.m3_to_liters(F.col("m3")).alias("liters"),
    ]


# --- carbon, weather


def with_carbon(electricity: DataFrame, grid: DataFrame) -> DataFrame:
    """Emissions of each reading from the grid intensity of its hour."""
    mix = staging.grid_intensity(grid)
    joined = electricity.join(
        mix, units.floor_to("hour", F.col("timestamp")) == F.col("timestamp_hour"), "left"
    )
    grams = F.col("kwh") * F.col("co2e_intensity_gco2_per_kwh")
    kept = [c for c in electricity.columns if c not in ("co2_g_per_kwh", "rate_cents_per_kwh")]
    return joined.select(
        *kept,
        "co2e_intensity_gco2_per_kwh",
        F.col("clean_pct").alias("grid_clean_pct"),
        (grams / 1000).alias("kg_co2e"),
        grams.alias("g_co2e"),
        *[F.col(c).alias(f"grid_{c}") for c in ["total_mw", *C.GRID_MIX]],
        F.col("has_ieso").alias("grid_has_ieso_data"),
        F.col("has_gridwatch").alias("grid_has_gridwatch_data"),
    )


_WEATHER = [c for c in C.WEATHER_FIELDS.values()]
_AIR = ["pm2_5", "pm10", "dust", "uv_index", "aerosol_optical_depth", "european_aqi"]
_AIR_LABELS = ["pm2_5_category", "aqi_category", "uv_category", "is_high_pollution", "is_high_soiling_risk"]


def climate(weather: DataFrame, air_quality: DataFrame, local_tz: str | None = None) -> DataFrame:
    """Hourly weather and, where present, the air quality of the same hour and place.

    Both series are small next to the facts, so they are joined to each other first and the
    facts are joined once.
    """
    air = staging.air_quality(air_quality, local_tz).select(
        F.col("location_name"), F.col("hour").alias("climate_hour"), *_AIR, *_AIR_LABELS
    )
    return (
        staging.weather(weather, local_tz)
        .select("location_name", F.col("hour").alias("climate_hour"), *_WEATHER, "temperature_category")
        .join(air, ["location_name", "climate_hour"], "left")
    )


def with_weather(
    electricity: DataFrame, hourly_climate: DataFrame, home_locations: DataFrame | None = None
) -> DataFrame:
    """Weather, degree hours and air quality of each reading.

    Without ``home_locations`` (home_id, location_name) the hour alone decides, which is right
    for one location; with several, pass the mapping so that each home takes its own.
    """
    hour = units.floor_to("hour", F.col("timestamp"))
    place = hourly_climate.withColumnRenamed("location_name", "_place")
    match = hour == F.col("climate_hour")
    facts = electricity
    if home_locations is not None:
        facts = facts.join(home_locations.withColumnRenamed("location_name", "_home_place"), "home_id", "left")
        match = match & (F.col("_home_place") == F.col("_place"))
    t = F.col("temperature_c")
    return facts.join(place, match, "left").select(
        *electricity.columns,
        F.col("_place").alias("location_name"),
        *_WEATHER[:4],
        "temperature_category",
        units.hvac_season(t).alias("hvac_season"),
        *_WEATHER[4:],
        units.heating_degree_hours(t).alias("hdh"),
        units.cooling_degree_hours(t).alias("cdh"),
        *_AIR,
        *_AIR_LABELS,
        t.isNull().alias("missing_weather_data"),
        F.col("pm2_5").isNull().alias("missing_air_quality_data"),
    )


def utility(electricity: DataFrame, gas: DataFrame, water: DataFrame) -> DataFrame:
    """All commodities in one shape; monitored power is left out, it repeats metered energy."""

    def shaped(df, name, amount, unit):
        extra = [FAN_OUT] if FAN_OUT in df.columns else []
        return df.select(
            "home_id",
            "timestamp",
            F.lit(name).alias("commodity"),
            F.col(amount).alias("quantity"),
            F.lit(unit).alias("unit"),
            "cost",
            "estimated",
            "year",
            "month",
            *extra,
        )

    everything = (
        shaped(electricity.filter(F.col("source") == "green_button"), "electricity", "kwh", "kWh")
        .unionByName(shaped(gas, "natural_gas", "m3", "m³"))
        .unionByName(shaped(water, "water", "m3", "m³"))
    )
    ts = F.col("timestamp")
    return everything.withColumns(
        {"month_start": units.floor_to("month", ts), "year_start": units.floor_to("year", ts)}
    )


@dataclass
class Marts:
    """All fact tables over one set of raw tables, built lazily."""

    readings: DataFrame
    power: DataFrame | None = None
    weather: DataFrame | None = None
    air_quality: DataFrame | None = None
    grid: DataFrame | None = None
    home_locations: DataFrame | None = None
    dim_key: str = "home"
    weather_tz: str | None = None

    def __post_init__(self):
        """Feeds that have not arrived are empty tables."""
        spark = self.readings.sparkSession
        absent = {"weather": "weather_hourly", "air_quality": "air_quality_hourly", "grid": "fct_co2_intensity"}
        for name, table in absent.items():
            if getattr(self, name) is None:
                setattr(self, name, schemas.empty(spark, table))

    def settle(self, path: str) -> "Marts":
        """Write the small dimension tables once and read them back.

        Their sizes are then known to the planner before the facts are read: below the broadcast
        limit the facts are joined in place, above it they are shuffled.
        """
        spark = self.readings.sparkSession
        settled = replace(self)
        # meters are counted over the stored homes, so readings are scanned once
        for name, attribute in [("homes", "homes"), ("home_meters", "meters"), ("climate", "climate"), ("grid", "grid")]:
            getattr(settled, attribute).write.mode("overwrite").parquet(f"{path}/{name}")
            settled.__dict__[attribute] = spark.read.parquet(f"{path}/{name}")
        return settled

    @cached_property
    def homes(self) -> DataFrame:
        return staging.homes(self.readings)

    @cached_property
    def meters(self) -> DataFrame:
        return home_meters(self.homes)

    @cached_property
    def power_hourly(self) -> DataFrame | None:
        return None if self.power is None else staging.power_hourly(self.power)

    @cached_property
    def climate(self) -> DataFrame:
        return climate(self.weather, self.air_quality, self.weather_tz)

    def _facts(self, sources, columns) -> DataFrame:
        # the meter stays, so that stored facts can be joined to their own
        return with_fan_out(sources, self.meters, self.dim_key).select(*columns(FAN_OUT), "meter_id")

    def _fct(self, sources, columns) -> DataFrame:
        return with_meter_hash(sources, self.homes, self.dim_key).select(*columns("meter_id_hash"))

    # one row per reading, weighted
    @cached_property
    def electricity_facts(self) -> DataFrame:
        return self._facts(electricity_sources(self.readings, self.power_hourly), electricity_columns)

    @cached_property
    def gas_facts(self) -> DataFrame:
        return self._facts(gas_sources(self.readings), gas_columns)

    @cached_property
    def water_facts(self) -> DataFrame:
        return self._facts(water_sources(self.readings), water_columns)

    @cached_property
    def carbon_facts(self) -> DataFrame:
        return with_carbon(self.electricity_facts, self.grid)

    @cached_property
    def weather_facts(self) -> DataFrame:
        return with_weather(self.electricity_facts, self.climate, self.home_locations)

    @cached_property
    def utility_facts(self) -> DataFrame:
        return utility(self.electricity_facts, self.gas_facts, self.water_facts)

    # tables as users read them
    @cached_property
    def fct_electricity(self) -> DataFrame:
        return self._fct(electricity_sources(self.readings, self.power_hourly), electricity_columns)

    @cached_property
    def fct_gas(self) -> DataFrame:
        return self._fct(gas_sources(self.readings), gas_columns)

    @cached_property
    def fct_water(self) -> DataFrame:
        return self._fct(water_sources(self.readings), water_columns)

    @cached_property
    def fct_carbon(self) -> DataFrame:
        return with_carbon(self.fct_electricity, self.grid)

    @cached_property
    def fct_weather(self) -> DataFrame:
        return with_weather(self.fct_electricity, self.climate, self.home_locations)

    @cached_property
    def fct_utility(self) -> DataFrame:
        return utility(self.fct_electricity, self.fct_gas, self.fct_water)

    @cached_property
    def hourly_weather(self) -> DataFrame:
        """Distinct weather rows seen by the facts.

        The result does not depend on how often an hour is read, so the facts are reduced to
        their distinct times before the join.
        """
        keys = ["timestamp"] if self.home_locations is None else ["home_id", "timestamp"]
        times = self.electricity_facts.select(*keys).distinct()
        with_parts = times.select("*", *_date_parts(with_hour=True))
        return hourly_weather_of(with_weather(with_parts, self.climate, self.home_locations))


HOURLY_WEATHER = [
    "timestamp",
    "location_name",
    *[c for c in _WEATHER if c != "direct_horizontal_wm2"],
    "temperature_category",
    *_AIR,
    "pm2_5_category",
    "aqi_category",
    "uv_category",
    "year",
    "month",
    "day",
    "hour",
    "day_of_week",
]


def hourly_weather_of(facts: DataFrame) -> DataFrame:
    """Distinct weather columns of the joined facts."""
    return facts.filter(F.col("temperature_c").isNotNull()).select(*HOURLY_WEATHER).distinct()


# Columns of the published extracts, in their order.
EXTRACTS = {
    "electricity": [
        "timestamp", "kwh", "cost", "tou_period", "quality", "meter_id_hash", "home_id", "source", "estimated",
        "co2_g_per_kwh", "rate_cents_per_kwh", "year", "month", "day", "hour", "day_of_week",
    ],
    "gas": [
        "timestamp", "m3", "cost", "quality", "home_id", "source", "meter_id_hash", "estimated",
        "avg_outdoor_temp_c", "heating_degree_days", "rate_cents_per_m3", "year", "month", "day",
    ],
    "water": [
        "timestamp", "m3", "raw_volume", "raw_unit", "cost", "quality", "home_id", "source", "meter_id_hash",
        "estimated", "gallons", "liters", "rate_cents_per_m3", "rate_cents_per_gal", "year", "month", "day",
    ],
    "carbon": [
        "timestamp", "kwh", "cost", "tou_period", "quality", "home_id", "source", "meter_id_hash", "estimated",
        "kg_co2e", "g_co2e", "co2e_intensity_gco2_per_kwh", "grid_clean_pct", "grid_total_mw",
        "grid_nuclear_mw", "grid_gas_mw", "grid_hydro_mw", "grid_wind_mw", "grid_solar_mw", "grid_biofuel_mw",
        "grid_has_ieso_data", "grid_has_gridwatch_data", "year", "month", "day", "hour", "day_of_week",
    ],
    "weather": [
        "timestamp", "kwh", "cost", "tou_period", "quality", "home_id", "source", "meter_id_hash", "estimated",
        "co2_g_per_kwh", "rate_cents_per_kwh", "location_name", "temperature_c", "humidity_pct",
        "precipitation_mm", "windspeed_kmh", "temperature_category", "hvac_season", "cloud_cover_pct",
        "cloud_cover_low_pct", "cloud_cover_mid_pct", "cloud_cover_high_pct", "ghi_wm2", "dni_wm2", "dhi_wm2",
        "direct_horizontal_wm2", "sunshine_duration_s", "hdh", "cdh", "pm2_5", "pm10", "dust", "uv_index",
        "aerosol_optical_depth", "european_aqi", "pm2_5_category", "aqi_category", "uv_category",
        "is_high_pollution", "is_high_soiling_risk", "missing_weather_data", "missing_air_quality_data", "year",
        "month", "day", "hour", "day_of_week",
    ],
}


def extract(marts: Marts, name: str, ordered: bool = False) -> DataFrame:
    """The narrow tables that dashboards load. Sorting is worth a range shuffle only when the
    result is written or shown, so it is off by default."""
    if name == "hourly_weather":
        out = marts.hourly_weather
    else:
        out = getattr(marts, f"fct_{name}").select(*EXTRACTS[name])
    return out.orderBy("timestamp") if ordered else out
