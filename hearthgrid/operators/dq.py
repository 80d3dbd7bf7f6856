"""Data quality counts, each in one pass over its table."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import weighted as W


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per required column, one output row each."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def _negative() -> Column:
    return F.col("watts") < 0


def _high() -> Column:
    return F.col("watts") > C.MAX_WATTS


def power_counts(power: DataFrame) -> DataFrame:
    return power.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_negative()).alias("negative_watts"),
        F.count_if(_high()).alias("above_limit"),
    )


def observe_power(power: DataFrame) -> tuple[DataFrame, Observation]:
    """The same counts as a by-product of whatever action reads the data."""
    watch = Observation("power_quality")
    return (
        power.observe(
            watch, F.count_if(_negative()).alias("negative_watts"), F.count_if(_high()).alias("above_limit")
        ),
        watch,
    )


def join_completeness(weather_facts: DataFrame) -> DataFrame:
    """How many readings found weather and air quality."""
    missing = F.col("missing_weather_data")
    found = W.rows_if(~missing)
    return weather_facts.agg(
        W.rows().alias("total_records"),
        found.alias("with_weather"),
        W.rows_if(missing).alias("missing_weather"),
        W.rows_if(~F.col("missing_air_quality_data")).alias("with_air_quality"),
        F.try_divide(F.lit(100.0) * found, W.rows()).alias("pct_with_weather"),
    )


def value_ranges(weather: DataFrame) -> DataFrame:
    """Physical limits of the weather feed: cloud cover, sunshine, direct against diffuse light."""
    cloud, sun = F.col("cloud_cover_pct"), F.col("sunshine_duration_s")
    dni, dhi = F.col("dni_wm2"), F.col("dhi_wm2")
    return weather.agg(
        F.count(F.lit(1)).alias("hours"),
        F.min(cloud).alias("min_cloud_pct"),
        F.max(cloud).alias("max_cloud_pct"),
        F.count_if(~cloud.between(0, 100)).alias("cloud_out_of_range"),
        F.max(sun).alias("max_sunshine_s"),
        F.count_if(sun > 3600).alias("sunshine_out_of_range"),
        F.max("ghi_wm2").alias("peak_ghi_wm2"),
        F.count_if((cloud < 20) & (dni < dhi)).alias("clear_hours_dni_below_dhi"),
        F.count_if((cloud >= 80) & (dni > dhi)).alias("cloudy_hours_dni_above_dhi"),
    )
