"""Inputs of the registered queries, derived from the test tables by Spark."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid import session
from hearthgrid.functions import units
from hearthgrid.plans import store
from hearthgrid.plans.marts import Marts
from hearthgrid.sinks import tables
from hearthgrid.sources import star_schema


def as_payloads(rows: DataFrame, fields: dict[str, str], scalars: dict[str, str]) -> DataFrame:
    """Documents as the weather and air quality services send them: one per location and day, hours in order.

    A day has at most 25 hours, so no document grows with the history.
    """
    day = rows.groupBy("location_name", F.to_date("timestamp").alias("day"), *scalars.values()).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("time"),
                    *[F.col(name).alias(field) for field, name in fields.items()],
                )
            )
        ).alias("h")
    )
    return day.select(
        "location_name",
        *[F.col(name).alias(field) for field, name in scalars.items()],
        F.struct(*[F.col(f"h.{f}").alias(f) for f in ["time", *fields]]).alias("hourly"),
    )


class Env:
    """Raw tables and marts of one test data folder in one session."""

    LAKE_BUCKETS = 2
    BUCKETS = 8

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.prepare(spark)
        self.sf_dir = sf_dir

    @cached_property
    def base(self) -> str:
        return session.scratch(self.spark, "workload")

    def folder(self, name: str) -> str:
        return f"{self.base}/{name}-{uuid.uuid4().hex[:12]}"

    def table(self, name: str) -> DataFrame:
        return star_schema.table(self.spark, self.sf_dir, name)

    @cached_property
    def _raw(self) -> Marts:
        return star_schema.marts(self.spark, self.sf_dir, self.folder("hours"))

    @cached_property
    def marts(self) -> Marts:
        """Marts over the decoded readings, whose small dimension tables are written once per session."""
        return replace(self._raw, readings=self.staged).settle(self.folder("dims"))

    @cached_property
    def own_marts(self) -> Marts:
        """The same with facts joined to their own meter, as tables for users are."""
        return replace(self._raw, readings=self.staged, dim_key="home_meter").settle(self.folder("dims"))

    @cached_property
    def staged(self) -> DataFrame:
        """Readings decoded once, in folders by commodity and month."""
        return store.stage(self.readings, self.folder("readings"))

    @property
    def readings(self) -> DataFrame:
        return self._raw.readings

    @property
    def power(self) -> DataFrame:
        return self._raw.power

    @cached_property
    def keyed_readings(self) -> DataFrame:
        """Readings with the columns that break ties between repeated keys."""
        return star_schema.readings(self.spark, self.sf_dir, keep=("l_orderkey", "l_partkey"))

    # --- arrivals

    #: Last of the five-day batches that events arrive in.
    LAST_BATCH = 5

    @cached_property
    def deliveries(self) -> DataFrame:
        """Events with the number of the batch that brings them: by time, every 17th two batches late, and every 13th
        delivered again in the next batch, corrected."""
        events = self.table("events")
        days = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
        number = F.greatest(F.lit(0), F.least(F.lit(self.LAST_BATCH), F.floor(days / 5).cast("int")))
        first = events.withColumn("batch", number + F.when(F.col("event_id") % 17 == 0, 2).otherwise(0))
        again = first.filter(F.col("event_id") % 13 == 0).withColumns({"batch": F.col("batch") + 1, "value": F.col("value") + 0.5})
        return first.unionByName(again)

    #: Bytes of all events, by the planner's estimate, for which a batch gets one more file.
    ARRIVAL_BYTES = 64 << 20

    @cached_property
    def arrival_files(self) -> int:
        """Files of each batch: a stream that takes as many at a time takes batch after batch."""
        return 1 + session.planned_bytes(self.table("events")) // self.ARRIVAL_BYTES

    @cached_property
    def arrivals(self) -> str:
        """The deliveries as they land: the same number of files for each batch, in their order.

        Events are read and dealt to batches and files once; a file is then written by a task that reads its share alone,
        an empty one where a batch has no rows for it.
        """
        dealt, path, schema = self.folder("dealt"), self.folder("arrivals"), self.table("events").schema
        share = F.pmod(F.xxhash64("event_id"), F.lit(self.arrival_files)).cast("int")
        tables.write_partitioned(self.deliveries.withColumn("share", share), dealt, ["batch", "share"])

        def land(number: int, part: int) -> None:
            found = f"{dealt}/batch={number}/share={part}"
            rows = self.spark.read.schema(schema).parquet(found) if session.exists(self.spark, found) else self.spark.createDataFrame([], schema)
            rows.coalesce(1).write.parquet(f"{path}/{number}-{part}")

        with ThreadPoolExecutor(8) as pool:
            for number in range(self.LAST_BATCH + 4):
                list(pool.map(lambda part, number=number: land(number, part), range(self.arrival_files)))
        return f"{path}/*"

    # --- files

    @cached_property
    def feeds(self) -> str:
        """Meter feeds in XML, one file for each home: usage points, meter readings and reading types of a month, one
        interval block per reading.

        Readings are shuffled and sorted as they are, and made into entries on their way to the file. The text of a feed
        is many times as long as its readings, so files are packed and written without indentation.
        """
        path = self.folder("espi")
        readings = self.readings.select(
            "home_id",
            # a subscription is one month, so its usage points are told apart from those of other months
            F.trunc("timestamp", "month").alias("slice"),
            "meter_id",
            "meter_reading_idx",
            F.regexp_extract("commodity", r"(\d+)$", 1).cast("int").alias("commodity"),
            F.regexp_extract("uom", r"(\d+)$", 1).cast("int").alias("uom"),
            F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("start"),
            "duration_seconds",
            "cost",
            self._quality_number().alias("quality"),
            "raw_value",
            F.col("tou_bucket").cast("int").alias("tou"),
        )
        # the first reading of a meter brings its usage point, the first of a series the meter reading and its type
        series = Window.partitionBy("home_id", "slice", "meter_id").orderBy("meter_reading_idx", "commodity", "uom")
        number, first = F.row_number().over(series), F.rank().over(series)
        none = F.array().cast("array<int>")
        kinds = F.concat(
            F.when(number == 1, F.array(F.lit(0))).otherwise(none), F.when(number == first, F.array(F.lit(1), F.lit(2))).otherwise(none), F.array(F.lit(3))
        )
        dealt = readings.repartition("home_id").withColumn("kinds", kinds).withColumn("kind", F.explode("kinds")).drop("kinds")
        # a feed holds all entries of a home, by month and meter
        place = F.when(F.col("kind") == 0, F.lit(0)).otherwise(F.col("meter_reading_idx"))
        ordered = dealt.withColumn("place", place).sortWithinPartitions("home_id", "slice", "meter_id", "kind", "place")
        (
            ordered.select("home_id", *self._entry())
            .write.partitionBy("home_id")
            .format("xml")
            .option("rootTag", "feed")
            .option("rowTag", "entry")
            .option("indent", "")
            .option("compression", "gzip")  # a home is written by one task and read by one
            .save(path)
        )
        return path

    @staticmethod
    def _quality_number() -> Column:
        quality = F.lit(14)
        for number, name in C.ESPI_QUALITY:
            quality = F.when(F.col("quality_code").endswith(name), number).otherwise(quality)
        return quality

    @staticmethod
    def _entry() -> list[Column]:
        """Links and content of an entry by its kind: usage point, meter reading, reading type, interval block."""
        root = F.concat(F.lit("/espi/1_1/resource/Subscription/"), F.col("slice").cast("string"))
        point = F.concat(root, F.lit("/UsagePoint/"), "meter_id")
        meter = F.concat(point, F.lit("/MeterReading/"), "meter_reading_idx")
        type_link = F.concat(root, F.lit("/ReadingType/"), "meter_id", F.lit("-"), "meter_reading_idx")
        collection, blocks = F.concat(point, F.lit("/MeterReading")), F.concat(meter, F.lit("/IntervalBlock"))

        def links(*rels):
            return F.array(*[F.struct(F.lit(r).alias("_rel"), href.alias("_href")) for r, href in rels])

        kind = F.col("kind")
        link = (
            F.when(kind == 0, links(("self", point), ("related", collection)))
            .when(kind == 1, links(("self", meter), ("up", collection), ("related", blocks), ("related", type_link)))
            .when(kind == 2, links(("self", type_link)))
            .otherwise(links(("self", F.concat(blocks, F.lit("/"), F.col("start").cast("string"))), ("up", blocks)))
        )
        reading = F.struct(
            F.col("cost"),
            F.struct("quality").alias("ReadingQuality"),
            F.struct(F.col("duration_seconds").alias("duration"), "start").alias("timePeriod"),
            F.col("raw_value").alias("value"),
            "tou",
        )
        content = F.struct(
            F.when(kind == 0, F.struct(F.struct(F.lit(0).alias("kind")).alias("ServiceCategory"))).alias("UsagePoint"),
            F.when(kind == 1, F.lit("")).alias("MeterReading"),
            F.when(kind == 2, F.struct("commodity", F.lit(0).alias("powerOfTenMultiplier"), "uom")).alias("ReadingType"),
            F.when(kind == 3, F.struct(reading.alias("IntervalReading"))).alias("IntervalBlock"),
        )
        return [link.alias("link"), content.alias("content")]

    @cached_property
    def lake(self) -> str:
        """The electricity mart in Hive layout, each reading with its own meter."""
        return self._lake(self.own_marts)

    @cached_property
    def home_lake(self) -> str:
        """The same with each reading repeated for every meter of its home."""
        return self._lake(self.marts)

    def _lake(self, marts: Marts) -> str:
        path = self.folder("lake")
        bucketed = tables.with_home_bucket(marts.fct_electricity, self.LAKE_BUCKETS)
        tables.write_partitioned(bucketed, path, ["home_bucket", "year", "month"])
        return path

    @cached_property
    def wide_csv(self) -> str:
        """Electricity of each meter as wide lines; V1 hours are taken as local standard time."""
        path = self.folder("wide")
        # hour 0 is the last column of the day before
        local = F.col("timestamp") - F.expr("interval 1 hour")
        slot = F.hour(local) + 1
        day = (
            self.readings.filter(F.col("commodity") == "CommodityKindValue.VALUE_1")
            .groupBy("meter_id", F.to_date(local).alias("Reading Date"))
            .agg(
                *[
                    F.sum(F.when(slot == i, units.wh_to_kwh(F.col("kwh")))).alias(f"hour {i}")
                    for i in range(1, 25)
                ]
            )
        )
        day.drop("meter_id").write.option("header", True).csv(path)
        return path

    def bills_csv(self, kind: str) -> str:
        """One bill export per home, in a folder that names it."""
        base = getattr(star_schema, f"bills_{kind}")(self.spark, self.sf_dir)
        headers = (
            C.ELECTRICITY_BILL_HEADERS
            if kind == "electricity"
            else {**C.GAS_BILL_HEADERS, **C.OPTIONAL_GAS_BILL_HEADERS}
        )
        named = base.select(
            "home_id",
            F.col("month_end_date").cast("string").alias("Date"),
            *[F.col(c).alias(h) for h, c in headers.items()],
        )
        path = self.folder(f"bills-{kind}")
        named.write.partitionBy("home_id").option("header", True).csv(path)
        return path

    def payloads(self, kind: str) -> str:
        path = self.folder(kind)
        if kind == "weather":
            scalars = {"latitude": "latitude", "longitude": "longitude", "elevation": "elevation_m", "timezone": "timezone"}
            rows = as_payloads(self.marts.weather, C.WEATHER_FIELDS, scalars)
        else:
            scalars = {c: c for c in ("latitude", "longitude", "timezone")}
            rows = as_payloads(self.marts.air_quality, {f: f for f in C.AIR_QUALITY_FIELDS}, scalars)
        rows.write.partitionBy("location_name").json(path)
        return path


_ENVS: dict = {}


def env(spark: SparkSession, sf_dir: str) -> Env:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ENVS:
        _ENVS[key] = Env(spark, sf_dir)
    else:
        session.prepare(spark)
    return _ENVS[key]
