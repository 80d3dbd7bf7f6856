"""Unit conversions, degree hours and date parts as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthgrid import constants as C


def wh_to_kwh(wh: Column) -> Column:
    return wh / C.WH_PER_KWH


def gallons_to_m3(gallons: Column) -> Column:
    return gallons / C.GALLONS_PER_M3


def m3_to_gallons(m3: Column) -> Column:
    return m3 * C.GALLONS_PER_M3


def m3_to_liters(m3: Column) -> Column:
    return m3 * C.LITERS_PER_M3


def cents_to_dollars(cents: Column) -> Column:
    return cents / 100.0


def gas_to_thermal_kwh(m3: Column) -> Column:
    return m3 * C.GAS_KWH_PER_M3 * C.FURNACE_EFFICIENCY


def heating_degree_hours(t: Column) -> Column:
    return F.when(t < C.DEGREE_BASE_C, C.DEGREE_BASE_C - t).otherwise(F.lit(0.0))


def cooling_degree_hours(t: Column) -> Column:
    return F.when(t > C.DEGREE_BASE_C, t - C.DEGREE_BASE_C).otherwise(F.lit(0.0))


def hvac_season(t: Column) -> Column:
    return F.when(t < C.DEGREE_BASE_C, "heating").when(t > C.COOLING_ABOVE_C, "cooling").otherwise("shoulder")


def floor_to(grain: str, ts: Column) -> Column:
    """Start of the hour, day, week, month or year, as timestamp_ntz."""
    if grain == "day":
        return F.to_date(ts).cast("timestamp_ntz")
    if grain in ("week", "month", "year"):
        return F.trunc(ts, grain).cast("timestamp_ntz")
    return F.date_trunc(grain, ts).cast("timestamp_ntz")


def year(ts: Column) -> Column:
    return F.year(ts).cast("bigint")


def month(ts: Column) -> Column:
    return F.month(ts).cast("bigint")


def day(ts: Column) -> Column:
    return F.dayofmonth(ts).cast("bigint")


def hour(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def half_up(value: Column, digits: int) -> Column:
    """Decimal rounding of doubles by scaling: scale up, round half away from zero, scale down."""
    scale = 10.0**digits
    return F.round(value * scale) / scale
