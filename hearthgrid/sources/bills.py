"""Monthly bill exports.

``home_id`` is the home of all files, or a column that tells it: for exports in ``home_id=<home>/`` folders the column of
that name, so one scan reads the bills of all homes.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthgrid import constants as C


def _text(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def _parsed(raw: DataFrame, home_id: str | Column, required: dict, optional: dict = None) -> DataFrame:
    """Typed columns plus ``_bad``: a required value or a filled optional one does not parse."""
    optional = optional or {}

    def text(header):
        return F.trim(F.col(f"`{header}`")) if header in raw.columns else F.lit(None).cast("string")

    date = F.try_to_date(text("Date"), "yyyy-M-d")
    bad = date.isNull()
    for header in required:
        bad = bad | text(header).try_cast("double").isNull()
    for header in optional:
        bad = bad | (F.coalesce(text(header), F.lit("")) != "") & text(header).try_cast("double").isNull()
    return raw.select(
        (home_id if isinstance(home_id, Column) else F.lit(home_id)).alias("home_id"),
        date.alias("month_end_date"),
        *[text(header).try_cast("double").alias(name) for header, name in {**required, **optional}.items()],
        bad.alias("_bad"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("_line"),
    )


def _split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = parsed.filter(~F.col("_bad")).drop("_bad", "_line")
    return good, parsed.filter("_bad").select("home_id", F.col("_line").alias("line"))


def electricity_from(raw: DataFrame, home_id: str | Column) -> tuple[DataFrame, DataFrame]:
    return _split(_parsed(raw, home_id, C.ELECTRICITY_BILL_HEADERS))


def gas_from(raw: DataFrame, home_id: str | Column) -> tuple[DataFrame, DataFrame]:
    return _split(_parsed(raw, home_id, C.GAS_BILL_HEADERS, C.OPTIONAL_GAS_BILL_HEADERS))


def read_electricity(spark: SparkSession, path, home_id: str | Column) -> tuple[DataFrame, DataFrame]:
    """Electricity bills and the lines that do not parse."""
    return electricity_from(_text(spark, path), home_id)


def read_gas(spark: SparkSession, path, home_id: str | Column) -> tuple[DataFrame, DataFrame]:
    """Gas bills, with water where billed together, and the lines that do not parse."""
    return gas_from(_text(spark, path), home_id)


def read(
    spark: SparkSession, electricity_csv=None, gas_csv=None, home_id: str | Column = "default-home"
) -> dict[str, DataFrame]:
    """Raw bill tables for whichever exports are given."""
    out = {}
    if electricity_csv:
        out["utility_bill_monthly_electricity"] = read_electricity(spark, electricity_csv, home_id)[0]
    if gas_csv:
        out["utility_bill_monthly_gas"] = read_gas(spark, gas_csv, home_id)[0]
    return out
