"""Summaries of the raw tables: readings, bills, power."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode
from hearthgrid.functions.units import half_up

def _count() -> Column:
    return F.count(F.lit(1))


def _span(first: str, last: str):
    return [F.min("timestamp").alias(first), F.max("timestamp").alias(last)]


def a_commodity_breakdown(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("commodity")
        .agg(
            _count().alias("intervals"),
            *_span("first_reading", "last_reading"),
            F.sum("kwh").alias("total_consumption"),
        )
        .orderBy("commodity")
    )


def a_by_home(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("home_id")
        .agg(_count().alias("intervals"), *_span("first_reading", "last_reading"))
        .orderBy("home_id")
    )


def a_by_home_commodity(readings: DataFrame) -> DataFrame:
    """Totals per home and series, with display names next to the codes."""
    return (
        readings.groupBy("home_id", "commodity", "service_kind", "uom")
        .agg(
            _count().alias("intervals"),
            *_span("first_reading", "last_reading"),
            F.sum("kwh").alias("total_consumption"),
            F.sum("cost").alias("total_cost"),
        )
        .withColumns(
            {
                "commodity_name": decode.display_commodity(F.col("commodity")),
                "unit_name": decode.display_unit(F.col("uom")),
            }
        )
        .orderBy("home_id", F.desc("last_reading"))
    )


def a_gas_count_range(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("commodity").like("%VALUE_7%")).agg(
        _count().alias("count"), *_span("min_date", "max_date")
    )


def a_gas_raw_summary(readings: DataFrame) -> DataFrame:
    return readings.groupBy("commodity", "uom").agg(
        _count().alias("total_records"), *_span("min_date", "max_date"), F.sum("kwh").alias("total_m3")
    )


def a_gas_sample_days(readings: DataFrame, n: int = 5) -> DataFrame:
    sample = readings.select(
        "timestamp",
        F.col("kwh").alias("m3"),
        "quality_code",
        (F.col("duration_seconds") / 86400.0).alias("duration_days"),
    )
    return sample.orderBy(*[F.col(c).asc_nulls_last() for c in sample.columns]).limit(n)


def a_gas_staged_summary(readings: DataFrame) -> DataFrame:
    return (
        readings.withColumn("commodity_type", decode.commodity(F.col("commodity")))
        .filter(F.col("commodity_type") == "natural_gas")
        .groupBy("commodity_type")
        .agg(_count().alias("total_records"), *_span("min_date", "max_date"), F.sum("kwh").alias("total_m3"))
    )


def a_gas_quality_breakdown(readings: DataFrame) -> DataFrame:
    return (
        readings.filter(F.col("commodity").like("%VALUE_7%"))
        .groupBy(decode.contains_first(F.col("quality_code"), C.GAS_CHECK_QUALITY_CODES, "unknown").alias("quality"))
        .agg(_count().alias("count"), F.sum("kwh").alias("total_m3"))
        .orderBy(F.desc("count"), "quality")
    )


def _bill_stats(bills: DataFrame, home_id: str, amount: str, amount_name: str, cost: str) -> DataFrame:
    return bills.filter(F.col("home_id") == home_id).agg(
        _count().alias("months"),
        F.min("month_end_date").alias("first_month"),
        F.max("month_end_date").alias("last_month"),
        half_up(F.sum(amount), 1).alias(amount_name),
        half_up(F.sum(cost), 2).alias("total_cost"),
    )


def a_bill_stats_electricity(bills: DataFrame, home_id: str) -> DataFrame:
    return _bill_stats(bills, home_id, "total_kwh", "total_kwh", "total_cost")


def a_bill_stats_gas(bills: DataFrame, home_id: str) -> DataFrame:
    return _bill_stats(bills, home_id, "gas_m3", "total_m3", "gas_cost")


def a_power_by_channel(power: DataFrame) -> DataFrame:
    return power.groupBy("device_id", "channel", "channel_name").agg(
        half_up(F.avg("watts"), 2).alias("mean_watts"),
        half_up(F.min("watts"), 2).alias("min_watts"),
        half_up(F.max("watts"), 2).alias("max_watts"),
        F.count("timestamp").alias("measurements"),
    )


def d_recent_since(readings: DataFrame, since: str) -> DataFrame:
    """Raw readings from a date on, oldest first."""
    return readings.filter(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz")).orderBy("timestamp")


def weather_request_range(readings: DataFrame, home_id: str) -> DataFrame:
    """The period for which a home needs weather: its first and last electricity reading."""
    of_home = (F.col("home_id") == home_id) & (F.col("commodity") == "CommodityKindValue.VALUE_1")
    return readings.filter(of_home).agg(
        F.date_format(F.min("timestamp"), "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("end_date"),
    )
