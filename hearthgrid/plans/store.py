"""Marts as tables: built once, read by many queries."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import schemas
from hearthgrid.plans import marts as plans
from hearthgrid.plans import staging
from hearthgrid.plans.marts import Marts
from hearthgrid.session import exists, setting

# tables that can be built side by side, step after step
STEPS = [
    ["homes", "climate", "power_hourly"],
    ["meters"],
    ["electricity_facts", "gas_facts", "water_facts"],
    ["carbon_facts", "weather_facts", "hourly_weather"],
]
READINGS = "readings"
RAW = ["weather", "air_quality"]  # small hourly series that some reports read themselves
TABLES = [name for step in STEPS for name in step]
#: Folders that a task of `stage` writes at a time: four commodities of ten years.
WRITERS = 512


def stage(readings: DataFrame, path: str) -> DataFrame:
    """Decode all readings in one pass into folders by commodity and month, and read them back.

    A commodity and a range of months are folders then: what filters name is listed and nothing else is scanned. Readings
    are shuffled and sorted as narrow rows, by the number of their folder, and decoded on their way to the file. The
    rebalance hint splits a folder that holds much of the table over tasks, so no task sorts more than its share. A task
    keeps the files of up to WRITERS folders open; were there more, Spark sorts the rest of its rows again.
    """
    narrow = staging.packed(readings).hint("rebalance", staging.FOLDER).sortWithinPartitions(staging.FOLDER)
    every = staging.decoded(narrow)
    writer = every.write.mode("overwrite").option("maxRecordsPerFile", 10_000_000).partitionBy(*staging.READING_FOLDERS)
    with setting(readings.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(WRITERS)):
        writer.parquet(path)
    return readings.sparkSession.read.schema(every.schema).parquet(path)


def save(marts: Marts, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write all tables; each is built from the stored ones of the steps before it.

    Readings are decoded and power is rolled up once. The jobs of a step are submitted together,
    so their tasks fill the cluster. With ``partition_by`` (for example year and month) facts are
    laid out in folders and filters on those columns skip the rest.
    """
    spark = marts.readings.sparkSession
    stored = replace(marts, readings=stage(marts.readings, f"{path}/{READINGS}"))

    def write(name: str) -> None:
        df = getattr(stored, name)
        if df is None:
            return
        if partition_by and name.endswith("_facts"):
            writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
        else:
            writer = df.write
        writer.mode("overwrite").parquet(f"{path}/{name}")

    settings = spark.createDataFrame([(marts.dim_key,)], "dim_key string")
    settings.write.mode("overwrite").parquet(f"{path}/settings")
    for name in RAW:
        getattr(marts, name).write.mode("overwrite").parquet(f"{path}/{name}")
    for step in STEPS:
        with ThreadPoolExecutor(len(step)) as pool:
            list(pool.map(write, step))
        for name in step:
            if getattr(stored, name) is not None:
                stored.__dict__[name] = spark.read.parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> Marts:
    """Marts over stored tables, decoded readings among them. Of the raw tables, weather and air quality are given
    too where the store has them.

    The tables with ``meter_id_hash`` are joined from facts and homes by the dimension key they were saved with.
    """
    dim_key = spark.read.parquet(f"{path}/settings").first()["dim_key"]
    raw = {name: spark.read.parquet(f"{path}/{name}") for name in RAW if exists(spark, f"{path}/{name}")}
    none = staging.decoded(schemas.empty(spark, "green_button_interval_readings"))
    readings = spark.read.schema(none.schema).parquet(f"{path}/{READINGS}") if exists(spark, f"{path}/{READINGS}") else none
    loaded = Marts(readings, dim_key=dim_key, **raw)
    for name in TABLES:
        if name != "power_hourly":
            loaded.__dict__[name] = spark.read.parquet(f"{path}/{name}")
    for name in ("electricity", "gas", "water", "carbon", "weather"):
        facts = loaded.__dict__[f"{name}_facts"].drop(plans.FAN_OUT)
        loaded.__dict__[f"fct_{name}"] = plans.with_meter_hash(facts, loaded.homes, dim_key).drop("meter_id")
    return loaded
