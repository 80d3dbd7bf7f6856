"""Electricity bills under tiered and time-of-use plans, with delivery, regulatory charges and tax.

A tiered plan charges a reading by how much the home has used before it in the month, and a reading that crosses a tier
is split. The use before a reading is a running sum in two steps, days of a month and readings of a day, so that no
window holds more than the days of one month or the readings of one home and day.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import units

#: kWh of a month up to which a tier reaches, and cents per kWh; charges in cents per kWh; tax rate.
TIERS = ((600.0, 10.5), (None, 12.8))
DELIVERY, REGULATORY, TAX = 5.8, 1.2, 0.13


def tiered_cents(used: Column, tiers=TIERS) -> Column:
    """Cents for the first ``used`` kWh of a month; a negative use is a credit at the first rate."""
    out, low = F.lit(0.0), 0.0
    for i, (high, rate) in enumerate(tiers):
        upper = used if high is None else F.least(used, F.lit(high))
        part = upper - F.lit(low)
        out = out + (part if i == 0 else F.greatest(part, F.lit(0.0))) * F.lit(rate)
        low = high
    return out


def used_before(readings: DataFrame, ties: list[str] = ()) -> DataFrame:
    """Add kWh that the home has used in the month before each reading; rows have home_id, ts, kwh."""
    day, month = units.floor_to("day", F.col("ts")), units.floor_to("month", F.col("ts"))
    rows = readings.withColumns({"_day": day, "_month": month})
    before = (Window.unboundedPreceding, -1)
    days = rows.groupBy("home_id", "_month", "_day").agg(F.sum("kwh").alias("_kwh"))
    of_month = Window.partitionBy("home_id", "_month").orderBy("_day").rowsBetween(*before)
    days = days.select("home_id", "_day", F.coalesce(F.sum("_kwh").over(of_month), F.lit(0.0)).alias("_earlier"))
    of_day = Window.partitionBy("home_id", "_day").orderBy("ts", *ties).rowsBetween(*before)
    inside = rows.withColumn("_inside", F.coalesce(F.sum("kwh").over(of_day), F.lit(0.0)))
    joined = inside.join(days, ["home_id", "_day"])
    return joined.withColumn("used_before", F.col("_inside") + F.col("_earlier")).drop("_day", "_month", "_inside", "_earlier")


def tiered_readings(readings: DataFrame, ties: list[str] = (), tiers=TIERS) -> DataFrame:
    """Each reading with the kWh used before it and its energy charge in cents."""
    used = used_before(readings, ties)
    after = F.col("used_before") + F.coalesce("kwh", F.lit(0.0))
    return used.withColumn("tiered_cents", tiered_cents(after, tiers) - tiered_cents(F.col("used_before"), tiers))


def monthly_bills(readings: DataFrame, ties: list[str] = (), tiers=TIERS) -> DataFrame:
    """One row per home and month: both plans with all charges, and the cheaper one."""
    rate = F.lit(None).cast("double")
    for period, dollars in C.TOU_RATES:
        rate = F.when(F.col("tou_period") == period, F.lit(dollars * 100)).otherwise(rate)
    charges = F.sum("kwh") * F.lit(DELIVERY + REGULATORY)
    bills = (
        tiered_readings(readings, ties, tiers)
        .withColumn("tou_cents", F.col("kwh") * F.coalesce(rate, F.lit(C.TOU_RATES[-1][1] * 100)))
        .groupBy("home_id", units.floor_to("month", F.col("ts")).alias("month"))
        .agg(
            F.sum("kwh").alias("kwh"),
            ((F.sum("tiered_cents") + charges) * F.lit(1 + TAX)).alias("tiered_cents"),
            ((F.sum("tou_cents") + charges) * F.lit(1 + TAX)).alias("tou_cents"),
        )
    )
    cheaper = F.when(units.half_up(F.col("tiered_cents"), 2) <= units.half_up(F.col("tou_cents"), 2), "tiered").otherwise("tou")
    return bills.withColumn("cheaper", cheaper)
