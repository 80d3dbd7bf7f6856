"""Weather-normal use: a regression of daily kWh on degree days for each home, and days that depart from it.

Each home's days are regressed on the degrees below several balance temperatures in one aggregation, by the built-in
regression aggregates, whose partial results merge; the balance that explains most is the home's own. The intercept is
the use that does not depend on the weather, the slope the kWh per degree day.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthgrid.functions import units

BALANCES = (12.0, 15.0, 18.0, 21.0)
#: Days whose distance from the model exceeds so many standard errors are unusual.
SIGMAS = 3.0
_DIGITS = 9


def daily(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """(home_id, date, kwh, temperature) of the days with both; readings have home_id, ts, kwh."""
    day = lambda c: F.to_date(c).alias("date")
    use = readings.groupBy("home_id", day("ts")).agg(F.sum("kwh").alias("kwh"))
    mean = weather.groupBy(day("ts")).agg(F.avg("temperature_c").alias("temperature"))
    return use.join(mean.filter("temperature is not null"), "date").select("home_id", "date", "kwh", "temperature")


def models(days: DataFrame, balances=BALANCES) -> DataFrame:
    """One row per home: days, balance, baseline, kwh_per_degree_day, r2 and the standard error.

    Of balances that explain alike the lowest is taken. Homes with fewer than three days or without cold ones have none.
    """
    moments = []
    for i, balance in enumerate(balances):
        x = F.greatest(F.lit(balance) - F.col("temperature"), F.lit(0.0))
        slope, intercept, r2, rest = F.regr_slope("kwh", x), F.regr_intercept("kwh", x), F.regr_r2("kwh", x), F.regr_syy("kwh", x)
        moments.append(F.struct((-F.round(r2, _DIGITS)).alias("rank"), F.lit(i).alias("i"), F.lit(balance).alias("balance"), slope.alias("slope"), intercept.alias("intercept"), r2.alias("r2"), rest.alias("syy")))
    fitted = days.groupBy("home_id").agg(F.count(F.lit(1)).alias("days"), F.array(*moments).alias("fits"))
    best = F.array_min(F.filter("fits", lambda f: f["rank"].isNotNull()))
    error = F.sqrt(F.greatest(F.col("m.syy") * (1 - F.col("m.r2")), F.lit(0.0)) / (F.col("days") - 2))
    return (
        fitted.filter("days > 2")
        .withColumn("m", best)
        .filter("m is not null")
        .select("home_id", "days", "m.balance", F.col("m.intercept").alias("baseline"), F.col("m.slope").alias("kwh_per_degree_day"), F.col("m.r2").alias("r2"), error.alias("error"))
    )


def unusual_days(days: DataFrame, fitted: DataFrame, sigmas: float = SIGMAS) -> DataFrame:
    """Days off the model of their home, with what was expected and the distance in standard errors.

    One row of the model per home, so a home with very many days may be split by the planner.
    """
    expected = F.col("baseline") + F.col("kwh_per_degree_day") * F.greatest(F.col("balance") - F.col("temperature"), F.lit(0.0))
    rated = days.join(fitted, "home_id").withColumn("expected_kwh", expected)
    rated = rated.withColumn("sigmas", F.try_divide(F.col("kwh") - F.col("expected_kwh"), F.nullif("error", F.lit(0.0))))
    return rated.filter(F.abs("sigmas") > sigmas).select("home_id", "date", "kwh", "temperature", units.half_up(F.col("expected_kwh"), 6).alias("expected_kwh"), units.half_up(F.col("sigmas"), 6).alias("sigmas"))
