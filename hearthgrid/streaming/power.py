"""Structured Streaming forms of the incremental loads.

The functions take and return DataFrames and work on batch input too; ``run`` drives a streaming
one over everything that has arrived and returns what was written.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid import schemas
from hearthgrid.operators.merge import merge_partitions
from hearthgrid.plans import staging
from hearthgrid.session import scratch

DELAY = "10 minutes"
POWER_KEY = schemas.PRIMARY_KEYS["power_monitoring"]


def ingest(
    spark: SparkSession, folder: str, schema=schemas.POWER, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder; the checkpoint of the query takes the place of a cursor."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _marked(power: DataFrame, delay: str | None) -> DataFrame:
    """Event time with a watermark, which Spark keeps on instants rather than wall-clock values."""
    if delay is None:
        return power
    return power.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def dedupe(power: DataFrame, keys: list[str] = POWER_KEY, delay: str = DELAY) -> DataFrame:
    """First row of each key; a key is remembered for ``delay`` of event time."""
    return _wall_clock(_marked(power, delay).dropDuplicatesWithinWatermark(keys), "timestamp")


def hourly_power(
    power: DataFrame,
    delay: str | None = DELAY,
    medium: int = C.MEDIUM_QUALITY_COUNT,
    high: int = C.HIGH_QUALITY_COUNT,
) -> DataFrame:
    """Hourly energy per channel. In append mode an hour is emitted once the watermark passes its
    end; rows that arrive later than ``delay`` are dropped. Pass None if the input already has a
    watermark."""
    measured = staging.power_validated(_marked(power, delay)).filter(~F.col("is_invalid"))
    hours = measured.groupBy(*staging.CHANNEL, F.window("ts", "1 hour")).agg(*staging.power_means())
    started = hours.withColumn("timestamp", F.col("window.start"))
    return _wall_clock(staging.power_labelled(started, medium, high), "timestamp")


def charge_sessions(
    power: DataFrame,
    min_watts: float = 1000,
    min_minutes: float = 15,
    gap: str = "15 minutes",
    delay: str | None = DELAY,
) -> DataFrame:
    """Periods of at least ``min_minutes`` in which a channel keeps drawing ``min_watts``."""
    sessions = (
        _marked(power, delay).filter(F.col("watts") >= min_watts)
        .groupBy("home_id", "device_id", "channel", F.session_window("timestamp", gap))
        .agg(
            F.min("timestamp").alias("started"),
            F.max("timestamp").alias("ended"),
            F.avg("watts").alias("avg_watts"),
            F.count(F.lit(1)).alias("measurements"),
        )
    )
    minutes = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("ended")) / 60e6
    lasting = sessions.withColumn("minutes", minutes).filter(F.col("minutes") >= min_minutes)
    return _wall_clock(lasting, "started", "ended").select(
        "home_id", "device_id", "channel", "started", "ended", "minutes", "avg_watts", "measurements"
    )


def late_rows(power: DataFrame, delay: str = DELAY) -> DataFrame:
    """Event-time hours as the stream counts them: rows behind the watermark are missing."""
    hours = _marked(power, delay).groupBy(F.window("timestamp", "1 hour")).agg(F.count(F.lit(1)).alias("accepted"))
    return _wall_clock(hours.select(F.col("window.start").alias("hour"), "accepted"), "hour")


def run(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything available into Parquet in the shared folder, then read it back."""
    spark = stream.sparkSession
    base = scratch(spark, name)
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/data")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


#: An end marker: later than any measurement, so the watermark passes all open hours and sessions; its own stays open.
END = {"timestamp": "9999-12-31 00:00:00", "home_id": "end", "device_id": "end", "channel": 0, "watts": 1500.0}


def run_closed(plan, events: DataFrame, name: str) -> DataFrame:
    """Process everything available through `plan`, then close what is still open.

    Once the stream has nothing more to read, a row with a far event time (and a measurement that filters let through,
    as they may run before the watermark) is added by way of a second input folder, and the query goes on from its checkpoint: hours and sessions open until then are emitted, as a batch
    over the same rows would have them. Call it where a stream is known to have ended; rows that come after are late.
    """
    spark = events.sparkSession
    base = scratch(spark, name)
    schema = events.schema
    spark.createDataFrame([], schema).write.parquet(f"{base}/end")
    markers = spark.readStream.schema(schema).parquet(f"{base}/end")
    closing = plan(events.unionByName(markers))

    def drive() -> None:
        query = (
            closing.writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{base}/data")
        )
        query.awaitTermination()

    drive()
    end = spark.range(1).select(*[F.lit(END.get(f.name)).cast(f.dataType).alias(f.name) for f in schema])
    end.write.mode("append").parquet(f"{base}/end")
    drive()
    return spark.read.schema(closing.schema).parquet(f"{base}/data")


def run_upsert(stream: DataFrame, name: str, keys: list[str] = POWER_KEY, path: str | None = None) -> DataFrame:
    """Merge every micro-batch into a table partitioned by day. A batch that is replayed after a
    failure changes nothing, because the merge is idempotent."""
    spark = stream.sparkSession
    base = path or scratch(spark, name)
    daily = stream.withColumn("day", F.to_date("timestamp"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_partitions(batch.sparkSession, f"{base}/data", batch, keys, "day", f"{base}/staging/{batch_id}")

    query = (
        daily.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/data").select(*stream.columns)
