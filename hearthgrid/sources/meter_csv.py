"""Wide meter exports: one line per day, 24 hour columns."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode
from hearthgrid.session import file_key

HOURS = [f"h{i}" for i in range(1, 25)]
# the header repeats a name, so columns are addressed by position
WIDE = "reading_date string, " + ", ".join(f"{h} string" for h in HOURS)


def meter_id(file_name: Column) -> Column:
    """Meter id in a file name SmartMeter<id>_<stamp>.csv, null for other names."""
    return F.nullif(F.regexp_extract(file_name, "^SmartMeter([^_]*)", 1), F.lit(""))


def lines(spark: SparkSession, path) -> DataFrame:
    """Text of the cells, with the meter id of the file."""
    raw = spark.read.schema(WIDE).option("header", True).csv(path)
    return raw.select(
        file_key(F.col("_metadata.file_path")).alias("file_path"),
        meter_id(F.col("_metadata.file_name")).alias("meter_id"),
        "reading_date",
        *HOURS,
    )


def to_readings(wide: DataFrame, homes: DataFrame | str, parity: bool = False) -> DataFrame:
    """Hourly readings from wide lines; footers, bad dates and non-numeric cells are skipped.

    The last column is midnight at the end of the day, and amounts become Wh like those of other
    meters. ``parity`` keeps the behaviour of reading by header name: the last column also fills
    noon, midnight falls on the start of the same date, and amounts stay in kWh.
    """
    date = F.try_to_date("reading_date", "yyyy-M-d")
    keep = F.col("reading_date").isNotNull() & ~F.col("reading_date").startswith("*")
    valid = wide.filter(keep).withColumn("date", date).filter(F.col("date").isNotNull())
    if parity:
        valid = valid.withColumn("h12", F.col("h24"))
    cells = valid.unpivot(["file_path", "meter_id", "date"], HOURS, "column", "cell").select(
        "file_path",
        "meter_id",
        "date",
        F.substring("column", 2, 2).cast("int").alias("hour"),
        F.trim("cell").try_cast("double").alias("amount"),
    )
    if parity:
        cells = cells.withColumn("hour", F.col("hour") % 24)
    local = F.expr("cast(date as timestamp_ntz) + make_dt_interval(0, hour)")
    hourly = cells.filter(F.col("amount").isNotNull()).withColumn("local", local)
    if isinstance(homes, str):
        hourly = hourly.withColumn("home_id", F.lit(homes))
    else:
        hourly = hourly.join(homes, "file_path")
    return hourly.select(
        "home_id",
        F.lit(0).alias("usage_point_idx"),
        F.lit(0).alias("meter_reading_idx"),
        # meter clocks stay on standard time all year
        F.expr(f"local + interval {C.METER_UTC_OFFSET_HOURS} hours").alias("timestamp"),
        F.lit(3600).alias("duration_seconds"),
        (F.col("amount") if parity else F.col("amount") * 1000).alias("kwh"),
        (F.col("amount") * 1000).cast("bigint").alias("raw_value"),
        F.lit(None).cast("double").alias("cost"),
        F.lit(C.WIDE_CSV_QUALITY).alias("quality_code"),
        decode.tou_bucket(F.col("local")).cast("string").alias("tou_bucket"),
        F.lit(C.WIDE_CSV_COMMODITY).alias("commodity"),
        F.lit(C.WIDE_CSV_UOM).alias("uom"),
        F.lit(C.WIDE_CSV_SERVICE).alias("service_kind"),
        "meter_id",
    )


def read(spark: SparkSession, path, homes: DataFrame | str, parity: bool = False) -> DataFrame:
    return to_readings(lines(spark, path), homes, parity)
