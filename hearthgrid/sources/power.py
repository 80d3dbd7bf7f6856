"""Power monitoring measurements."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import schemas
from hearthgrid.operators.dq import observe_power


def accept(power: DataFrame, loaded_to: str | None = None) -> DataFrame:
    """New measurements without negative power; very high power is only counted."""
    return _after(power, loaded_to).filter(F.col("watts") >= 0)


def _after(power: DataFrame, loaded_to: str | None) -> DataFrame:
    """Without a cursor nothing is left out; `constants.FIRST_CURSOR` is the start that first loads used to have."""
    return power if loaded_to is None else power.filter(F.col("timestamp") > F.lit(loaded_to).cast("timestamp_ntz"))


def read(spark: SparkSession, path, loaded_to: str | None = None):
    """Measurements and an observation that counts negative and very high readings while the
    result is used."""
    raw = spark.read.schema(schemas.POWER).parquet(path)
    watched, counts = observe_power(_after(raw, loaded_to))
    return accept(watched, loaded_to), counts
