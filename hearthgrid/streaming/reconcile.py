"""A rollup stream that keeps the rows it cannot count any more.

A windowed aggregation drops rows that come after their hour was closed. Here each micro-batch is split by the mark of
the batches before it: an hour is closed once the latest time seen, less the delay, has passed its end. Rows of open hours
are accepted, the others go to a side table, and both leave partial sums of their hours, which merge: what was accepted
is the stream's answer, and with the late partial sums it is the answer of a batch over all rows, without reading them
again.

Everything a batch writes lies in folders of its number, so a batch that is replayed after a failure replaces its own
output, and the mark it goes by is that of earlier batches alone.
"""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import units
from hearthgrid.plans import staging
from hearthgrid.session import folders, scratch
from hearthgrid.streaming.power import DELAY

_MEANS = ["watts", "volts", "amps", "power_factor"]


def _sums() -> list:
    valid = ~F.col("is_invalid")
    out = [F.count(F.lit(1)).alias("row_count"), F.count_if(valid).alias("measurement_count")]
    for c in _MEANS:
        value = F.when(valid, F.col(c))
        out += [F.sum(value).alias(f"{c}_sum"), F.count(value).alias(f"{c}_n")]
    return out


@dataclass
class Reconciled:
    """What a run has left below its folder."""

    spark: SparkSession
    path: str
    schema: object

    def _read(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{kind}")

    def late(self) -> DataFrame:
        """Rows that came after their hour was closed, with the number of their batch."""
        return self._read("late")

    def counts(self) -> DataFrame:
        """Rows accepted and late by hour."""
        late = F.col("late")
        return self._read("hours").groupBy("hour").agg(
            F.sum(F.when(late, 0).otherwise(F.col("row_count"))).alias("accepted"), F.sum(F.when(late, F.col("row_count")).otherwise(0)).alias("late")
        )

    def hourly(self, with_late: bool = True, medium: int = C.MEDIUM_QUALITY_COUNT, high: int = C.HIGH_QUALITY_COUNT) -> DataFrame:
        """Hourly energy per channel of what was accepted, or of all rows, merged from partial sums."""
        parts = self._read("hours").filter(F.lit(with_late) | ~F.col("late"))
        means = [F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(f"avg_{c}") for c in _MEANS]
        hours = parts.groupBy(*staging.CHANNEL, F.col("hour").alias("timestamp")).agg(*means, F.sum("measurement_count").alias("measurement_count"))
        return staging.power_labelled(hours.filter("measurement_count > 0"), medium, high)


def _mark(spark: SparkSession, base: str, number: int):
    """Latest time of the batches before this one, None for the first."""
    known = [int(f.removeprefix("batch=")) for f in folders(spark, f"{base}/marks") if f.startswith("batch=")]
    before = [n for n in known if n < number]
    return spark.read.parquet(f"{base}/marks/batch={max(before)}").first()["latest"] if before else None


def run(power: DataFrame, name: str, delay: str = DELAY, path: str | None = None) -> Reconciled:
    """Process everything that has arrived and return what was accepted and what was late."""
    spark = power.sparkSession
    base = path or scratch(spark, name)

    def split(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        mark = _mark(session, base, number)
        hour = units.floor_to("hour", F.col("timestamp"))
        closed = F.lit(False) if mark is None else hour + F.expr("interval 1 hour") <= F.lit(mark).cast("timestamp_ntz") - F.expr(f"interval {delay}")
        rows = batch.withColumn("late", F.coalesce(closed, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows.filter("late").drop("late").write.mode("overwrite").parquet(f"{base}/late/batch={number}")
            validated = staging.power_validated(rows)
            sums = validated.groupBy(*staging.CHANNEL, units.floor_to("hour", F.col("ts")).alias("hour"), "late").agg(*_sums())
            sums.write.mode("overwrite").parquet(f"{base}/hours/batch={number}")
            latest = F.max("timestamp") if mark is None else F.greatest(F.max("timestamp"), F.lit(mark).cast("timestamp_ntz"))
            rows.agg(latest.alias("latest")).write.mode("overwrite").parquet(f"{base}/marks/batch={number}")
        finally:
            rows.unpersist()

    query = power.writeStream.foreachBatch(split).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return Reconciled(spark, base, power.schema)
