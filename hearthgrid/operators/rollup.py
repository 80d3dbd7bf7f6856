"""Time rollups of a fact table."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthgrid.functions import units
from hearthgrid.functions import weighted as W

GRAINS = ["hour", "day", "week", "month", "year"]


def rollup(facts: DataFrame, grain: str, keys: list[str], amount: str) -> DataFrame:
    """Total amount, cost and reading count per key and period of one grain."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}, expected one of {GRAINS}")
    return facts.groupBy(*keys, units.floor_to(grain, F.col("timestamp")).alias("period_start")).agg(
        W.total(amount).alias("total"), W.total("cost").alias("total_cost"), W.rows().alias("reading_count")
    )


# each grain is added up from a finer one whose periods it contains
_FROM = {"day": "hour", "week": "day", "month": "day", "year": "month"}


def rollups(facts: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """All five grains in one table.

    Only the hours are added up from the facts. The other grains read the hourly totals, whose
    shuffle Spark runs once and reuses.
    """
    levels = {"hour": rollup(facts, "hour", keys, amount)}
    for grain, finer in _FROM.items():
        period = units.floor_to(grain, F.col("period_start")).alias("coarser")
        levels[grain] = (
            levels[finer]
            .groupBy(*keys, period)
            .agg(
                F.sum("total").alias("total"),
                F.sum("total_cost").alias("total_cost"),
                F.sum("reading_count").alias("reading_count"),
            )
            .withColumnRenamed("coarser", "period_start")
        )
    columns = [*keys, "period_start", "total", "total_cost", "reading_count"]
    labelled = [df.select(F.lit(grain).alias("grain"), *columns) for grain, df in levels.items()]
    return reduce(DataFrame.unionByName, labelled)
