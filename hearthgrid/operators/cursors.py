"""Incremental loads with stored cursors.

A load is numbered. Load n writes folder ``load=n`` of the table and then folder ``load=n`` of the marks, which hold the
latest loaded time of each key. What is new is found from the marks alone, so the table is never read by a load and a
load costs what has arrived. A load that failed before its marks were complete is done again whole, under the same
number, so nothing is loaded twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid.operators import merge
from hearthgrid.session import exists, folders


def last_load(spark: SparkSession, marks: str) -> int:
    """Number of the last load whose marks are complete; 0 if there was none."""
    numbers = [int(f.removeprefix("load=")) for f in folders(spark, marks) if f.startswith("load=")]
    return next((n for n in sorted(numbers, reverse=True) if exists(spark, f"{marks}/load={n}/_SUCCESS")), 0)


def read_marks(spark: SparkSession, marks: str) -> DataFrame | None:
    number = last_load(spark, marks)
    return spark.read.parquet(f"{marks}/load={number}") if number else None


def load_newer(batch: DataFrame, table: str, marks: str, time: str, per: list[str] = (), start: str | None = None) -> int:
    """Append the rows of the batch behind the stored marks and advance these; returns the number of the load.

    ``per`` keys have a mark each, a key without one is taken whole or from ``start`` on. Without ``per`` the one mark is
    a literal that reaches the scan of the batch.
    """
    spark = batch.sparkSession
    number, known = last_load(spark, marks) + 1, read_marks(spark, marks)
    columns = batch.columns
    if known is None:
        fresh = batch if start is None else batch.filter(F.col(time) > F.lit(start).cast("timestamp_ntz"))
    elif per:
        fresh = merge.newer_than(batch, known, time, list(per), start)
    else:
        mark = known.first()["_loaded_to"]
        fresh = batch if mark is None else batch.filter(F.col(time) > F.lit(mark).cast(batch.schema[time].dataType))
    fresh.select(*columns).write.mode("overwrite").parquet(f"{table}/load={number}")
    arrived = spark.read.schema(batch.schema).parquet(f"{table}/load={number}")
    before = merge.high_water(arrived.limit(0), time, list(per)) if known is None else known
    merge.advance(before, arrived, time, list(per)).write.mode("overwrite").parquet(f"{marks}/load={number}")
    return number


def loaded(spark: SparkSession, table: str, schema, number: int | None = None) -> DataFrame:
    """What all loads, or one, have brought."""
    return spark.read.schema(schema).parquet(table if number is None else f"{table}/load={number}")
