"""Approximate distinct counts that merge: HyperLogLog sketches in stored rollups.

Distinct counts of hours do not add up to those of a day, sketches do. Hourly rollups keep a sketch beside their sums;
days are merged from stored hours, months from days and years from months, without a second look at the readings.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid.functions import units

#: 2**LG registers: a standard error of about 0.6 %, and nearly exact counts of some thousands.
LG = 15
GRAINS = ("hour", "day", "month", "year")


def hourly(df: DataFrame, time: str, counted: dict[str, str], per: list[str] = ()) -> DataFrame:
    """One row per hour and ``per``: rows and a sketch of each counted column (name -> column)."""
    return df.groupBy(*per, units.floor_to("hour", F.col(time)).alias("period_start")).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.hll_sketch_agg(c, LG).alias(f"{name}_sketch") for name, c in counted.items()]
    )


def coarser(rollup: DataFrame, grain: str, names: list[str], per: list[str] = ()) -> DataFrame:
    """The rollup of the next grain from the sketches of a finer one."""
    return rollup.groupBy(*per, units.floor_to(grain, F.col("period_start")).alias("period_start")).agg(
        F.sum("row_count").alias("row_count"), *[F.hll_union_agg(f"{name}_sketch").alias(f"{name}_sketch") for name in names]
    )


def estimate(name: str) -> Column:
    return F.hll_sketch_estimate(f"{name}_sketch")


def store_rollups(df: DataFrame, path: str, time: str, counted: dict[str, str], per: list[str] = ()) -> dict[str, DataFrame]:
    """Write the rollups of all grains, each from the stored one before it."""
    spark, out, rollup = df.sparkSession, {}, hourly(df, time, counted, per)
    for finer, grain in zip((None, *GRAINS), GRAINS, strict=False):
        if finer:
            rollup = coarser(out[finer], grain, list(counted), per)
        rollup.write.mode("overwrite").parquet(f"{path}/{grain}")
        out[grain] = spark.read.parquet(f"{path}/{grain}")
    return out
