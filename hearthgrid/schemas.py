"""Raw table schemas and primary keys. Event times are UTC wall-clock values (timestamp_ntz)."""

from pyspark.sql import DataFrame, SparkSession

from hearthgrid.constants import AIR_QUALITY_FIELDS, GRID_MIX, WEATHER_FIELDS


def _doubles(names):
    return ", ".join(f"{n} double" for n in names)


READINGS = (
    "home_id string, usage_point_idx int, meter_reading_idx int, timestamp timestamp_ntz, "
    "duration_seconds int, kwh double, raw_value bigint, cost double, quality_code string, "
    "tou_bucket string, commodity string, uom string, service_kind string, meter_id string"
)
POWER = (
    "home_id string, device_id string, channel bigint, channel_name string, timestamp timestamp_ntz, "
    "watts double, volts double, amps double, power_factor double"
)
WEATHER = (
    "location_name string, latitude double, longitude double, elevation_m double, timezone string, "
    "timestamp timestamp_ntz, " + _doubles(WEATHER_FIELDS.values())
)
AIR_QUALITY = (
    "location_name string, latitude double, longitude double, timezone string, timestamp timestamp_ntz, "
    + _doubles(AIR_QUALITY_FIELDS)
)
BILLS_ELECTRICITY = "home_id string, month_end_date date, " + _doubles(
    [
        "total_kwh",
        "off_peak_kwh",
        "mid_peak_kwh",
        "on_peak_kwh",
        "total_cost",
        "off_peak_rate",
        "mid_peak_rate",
        "on_peak_rate",
    ]
)
BILLS_GAS = "home_id string, month_end_date date, " + _doubles(["gas_m3", "gas_cost", "water_m3", "water_cost"])
GRID = (
    "hour timestamp_ntz, "
    + _doubles(["co2e_intensity_gco2_per_kwh", "clean_pct", "total_mw", *GRID_MIX])
    + ", has_ieso boolean, has_gridwatch boolean"
)

# Table names, columns and keys as the feeds and users know them.
SCHEMAS = {
    "green_button_interval_readings": READINGS,
    "power_monitoring": POWER,
    "weather_hourly": WEATHER,
    "air_quality_hourly": AIR_QUALITY,
    "utility_bill_monthly_electricity": BILLS_ELECTRICITY,
    "utility_bill_monthly_gas": BILLS_GAS,
    "fct_co2_intensity": GRID,
}
PRIMARY_KEYS = {
    "green_button_interval_readings": ["home_id", "usage_point_idx", "meter_reading_idx", "timestamp"],
    "power_monitoring": ["home_id", "device_id", "channel", "timestamp"],
    "weather_hourly": ["location_name", "timestamp"],
    "air_quality_hourly": ["location_name", "timestamp"],
    "utility_bill_monthly_electricity": ["home_id", "month_end_date"],
    "utility_bill_monthly_gas": ["home_id", "month_end_date"],
}
# Keys that exported tables had, coarser than the grain of the facts; rows that share one are lost.
PARITY_EXPORT_KEYS = {
    "fct_electricity_consumption": ["home_id", "timestamp"],
    "fct_gas_consumption": ["home_id", "timestamp"],
    "fct_water_consumption": ["home_id", "timestamp"],
    "fct_utility_consumption": ["home_id", "commodity", "timestamp"],
}
# keys of the exported tables: the grain of the facts
EXPORT_KEYS = {
    "fct_electricity_consumption": ["home_id", "source", "device_id", "meter_id_hash", "timestamp"],
    "fct_gas_consumption": ["home_id", "device_id", "meter_id_hash", "timestamp"],
    "fct_water_consumption": ["home_id", "device_id", "meter_id_hash", "timestamp"],
}
# columns that must be present in every row
REQUIRED = {
    "green_button_interval_readings": ["home_id", "timestamp", "kwh"],
    "power_monitoring": ["home_id", "device_id", "channel", "timestamp", "watts"],
    "weather_hourly": ["location_name", "timestamp", "temperature_c"],
    "air_quality_hourly": ["location_name", "timestamp"],
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """Zero rows with the schema of a raw table, for a feed that has not arrived yet."""
    return spark.createDataFrame([], SCHEMAS[table])
