"""Landed weather and air quality payloads.

Each JSON document holds one place: scalars and, under ``hourly``, arrays of equal length. Files
lie in ``location_name=<name>/`` folders, which become the location column.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import constants as C


def _schema(fields, with_elevation: bool) -> str:
    arrays = ", ".join(["time array<string>", *[f"{f} array<double>" for f in fields]])
    elevation = "elevation double, " if with_elevation else ""
    return (
        f"latitude double, longitude double, {elevation}timezone string, hourly struct<{arrays}>, location_name string"
    )


def _rows(payloads: DataFrame, fields: dict[str, str], scalars: list, loaded_to: str | None) -> DataFrame:
    hours = payloads.withColumn(
        "h", F.explode(F.arrays_zip(*[F.col(f"hourly.{f}").alias(f) for f in ["time", *fields]]))
    )
    rows = hours.select(
        "location_name",
        *scalars,
        F.col("h.time").cast("timestamp_ntz").alias("timestamp"),
        *[F.col(f"h.{field}").alias(name) for field, name in fields.items()],
    )
    return rows if loaded_to is None else rows.filter(F.col("timestamp") > F.lit(loaded_to).cast("timestamp_ntz"))


def weather_rows(payloads: DataFrame, loaded_to: str | None = None) -> DataFrame:
    scalars = ["latitude", "longitude", F.col("elevation").alias("elevation_m"), "timezone"]
    return _rows(payloads, C.WEATHER_FIELDS, scalars, loaded_to)


def air_quality_rows(payloads: DataFrame, loaded_to: str | None = None) -> DataFrame:
    return _rows(payloads, {f: f for f in C.AIR_QUALITY_FIELDS}, ["latitude", "longitude", "timezone"], loaded_to)


def read_weather(spark: SparkSession, path, loaded_to: str | None = None, multi_line: bool = False) -> DataFrame:
    payloads = spark.read.schema(_schema(C.WEATHER_FIELDS, True)).option("multiLine", multi_line).json(path)
    return weather_rows(payloads, loaded_to)


def read_air_quality(spark: SparkSession, path, loaded_to: str | None = None, multi_line: bool = False) -> DataFrame:
    payloads = spark.read.schema(_schema(C.AIR_QUALITY_FIELDS, False)).option("multiLine", multi_line).json(path)
    return air_quality_rows(payloads, loaded_to)
