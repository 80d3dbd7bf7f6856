"""Documented queries: consumption, rates, solar, soiling, air filters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode, units
from hearthgrid.functions import weighted as W
from hearthgrid.functions.units import half_up
from hearthgrid.operators.percentile import percentile_cont
from hearthgrid.plans.climate_report import _summer_daytime, _tie, date, pm25, temp
from hearthgrid.plans.dashboard import grain, ts
from hearthgrid.plans.marts import Marts

def _dollars() -> Column:
    return units.cents_to_dollars(W.total("cost"))


# --- consumption


def d_daily_by_home(m: Marts) -> DataFrame:
    return (
        m.electricity_facts.groupBy("home_id", date())
        .agg(
            W.total("kwh").alias("daily_kwh"),
            _dollars().alias("daily_cost_dollars"),
            W.mean("kwh").alias("avg_hourly_kwh"),
            F.max("kwh").alias("peak_hourly_kwh"),
        )
        .orderBy(F.desc("date"), "home_id")
    )


def d_daily_metered(m: Marts, n: int = 30) -> DataFrame:
    """The newest home days of metered electricity."""
    return (
        m.electricity_facts.filter(F.col("source") == "green_button")
        .groupBy("home_id", date())
        .agg(W.total("kwh").alias("daily_kwh"), W.total("cost").alias("daily_cost_cents"))
        .orderBy(F.desc("date"), "home_id")
        .limit(n)
    )


def d_tou_analysis(m: Marts) -> DataFrame:
    return (
        m.electricity_facts.filter(F.col("tou_period").isNotNull())
        .groupBy("home_id", "tou_period")
        .agg(
            W.rows().alias("hours"),
            W.total("kwh").alias("total_kwh"),
            W.mean("kwh").alias("avg_kwh"),
            _dollars().alias("total_cost_dollars"),
        )
        .orderBy("tou_period", "home_id")
    )


def d_monthly_by_home(m: Marts) -> DataFrame:
    return (
        m.electricity_facts.groupBy("home_id", "year", "month")
        .agg(
            W.total("kwh").alias("monthly_kwh"),
            _dollars().alias("monthly_cost_dollars"),
            W.mean("kwh").alias("avg_hourly_kwh"),
        )
        .orderBy(F.desc("year"), F.desc("month"), "home_id")
    )


def d_quality_check(m: Marts) -> DataFrame:
    return (
        m.electricity_facts.groupBy("source", "quality", "estimated")
        .agg(W.rows().alias("record_count"), W.total("kwh").alias("total_kwh"))
        .orderBy("source", "quality")
    )


def peak_threshold(m: Marts, p: float = 0.95) -> float | None:
    return percentile_cont(m.electricity_facts, "kwh", p, F.col(W.FAN_OUT))


def d_peak_hours(m: Marts, n: int = 20) -> DataFrame:
    """The highest readings among those at or above the 95th percentile."""
    hour = F.col("hour")
    time_of_day = (
        F.when(hour.between(0, 6), "Night")
        .when(hour.between(7, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .otherwise("Evening")
    )
    peak = m.electricity_facts.filter(F.col("kwh") >= F.lit(peak_threshold(m)).cast("double")).select(
        "home_id", "timestamp", "kwh", "tou_period", time_of_day.alias("time_of_day"), W.FAN_OUT
    )
    order = [F.desc_nulls_last("kwh"), *_tie("home_id", "timestamp", "tou_period", "time_of_day")]
    return W.newest(peak, order, n)


def d_partition_daily(lake: DataFrame) -> DataFrame:
    """Daily energy over a table read from files."""
    return lake.groupBy(date()).agg(F.sum("kwh").alias("daily_kwh")).orderBy(F.desc("date"))


def d_heat_pump_cop(m: Marts, sensors: DataFrame, device: str = "%hvac%", repeat_by_sensor: bool = True) -> DataFrame:
    """Daily HVAC energy against the indoor and outdoor temperature of the same day.

    ``sensors`` has timestamp, outdoor_temp and indoor_temp. Both sides are reduced to days before
    the join. A join of all readings with all sensor rows of the day counts the energy once per
    sensor row; ``repeat_by_sensor`` keeps that amount, by multiplication.
    """
    energy = (
        m.electricity_facts.filter(F.col("device_id").like(device)).groupBy(date()).agg(W.total("kwh").alias("kwh"))
    )
    temperature = sensors.groupBy(date()).agg(
        F.avg("outdoor_temp").alias("avg_outdoor_temp"),
        F.avg("indoor_temp").alias("avg_indoor_temp"),
        F.count(F.lit(1)).alias("sensor_rows"),
    )
    times = F.col("sensor_rows") if repeat_by_sensor else F.lit(1)
    outdoor, indoor = F.col("avg_outdoor_temp"), F.col("avg_indoor_temp")
    return (
        energy.join(temperature, "date", "left")
        .filter(outdoor.isNotNull())
        .withColumn("hvac_kwh", F.col("kwh") * times)
        .select(
            "date",
            "hvac_kwh",
            "avg_outdoor_temp",
            "avg_indoor_temp",
            F.when(outdoor < 0, F.try_divide(F.col("hvac_kwh"), indoor - outdoor) * 100).alias("estimated_cop"),
        )
        .orderBy(F.desc("date"))
    )


def d_solar_load_shape(m: Marts) -> DataFrame:
    return (
        W.parts(
            m.electricity_facts.filter(F.col("hour").between(9, 17)),
            ["hour", "month"],
            "kwh",
            more=(F.min("kwh").alias("low"), F.max("kwh").alias("high")),
        )
        .groupBy("hour", "month")
        .agg(
            W.part_mean("kwh").alias("avg_kwh"),
            F.min("low").alias("min_kwh"),
            F.max("high").alias("max_kwh"),
            W.part_stddev("kwh").alias("stddev_kwh"),
        )
        .orderBy("month", "hour")
    )


def rate_table(spark) -> DataFrame:
    """Example time-of-use rates."""
    rows = ", ".join(f"('{period}', {rate}D)" for period, rate in C.TOU_RATES)
    return spark.sql(f"select * from values {rows} as rates(tou_period, rate_per_kwh)")


def d_tou_vs_flat(m: Marts, flat_rate: float = C.FLAT_RATE) -> DataFrame:
    """Daily cost under time-of-use rates and under a flat rate.

    Readings without a period have no time-of-use rate and add nothing to ``tou_cost``.
    """
    rates = rate_table(m.readings.sparkSession)  # three rows
    costs = (
        m.electricity_facts.join(F.broadcast(rates), "tou_period", "left")
        .groupBy(date())
        .agg(
            W.total("kwh").alias("daily_kwh"),
            W.total(F.col("kwh") * F.col("rate_per_kwh")).alias("tou_cost"),
            (W.total("kwh") * flat_rate).alias("flat_cost"),
        )
    )
    better = F.when(F.col("tou_cost") < F.col("flat_cost"), "TOU Better").otherwise("Flat Better")
    return costs.select(
        "*", (F.col("tou_cost") - F.col("flat_cost")).alias("tou_vs_flat_diff"), better.alias("recommendation")
    ).orderBy(F.desc("date"))


def d_daily_carbon(m: Marts) -> DataFrame:
    intensity = F.col("co2e_intensity_gco2_per_kwh")
    return (
        m.carbon_facts.filter(intensity.isNotNull())
        .groupBy(date())
        .agg(
            W.total("kwh").alias("daily_kwh"),
            (W.total("g_co2e") / 1000.0).alias("daily_co2_kg"),
            W.mean(intensity).alias("avg_grid_intensity"),
        )
        .orderBy(F.desc("date"))
    )


# --- weather


def d_daily_degree_days(m: Marts) -> DataFrame:
    return (
        m.weather_facts.groupBy(grain("day", "date"))
        .agg(
            (W.total("hdh") / 24.0).alias("hdd"),
            (W.total("cdh") / 24.0).alias("cdd"),
            W.total("kwh").alias("daily_kwh"),
            W.mean(temp()).alias("avg_temp_c"),
        )
        .orderBy("date")
    )


def d_kwh_by_category(m: Marts) -> DataFrame:
    return (
        m.weather_facts.filter(~F.col("missing_weather_data"))
        .groupBy("temperature_category")
        .agg(W.rows().alias("hours"), W.mean("kwh").alias("avg_kwh_per_hour"), W.total("kwh").alias("total_kwh"))
        .orderBy(F.desc("avg_kwh_per_hour"))
    )


def d_kwh_by_season(m: Marts) -> DataFrame:
    """Readings without weather count as shoulder season."""
    return m.weather_facts.groupBy("hvac_season").agg(
        W.rows().alias("hours"), W.mean("kwh").alias("avg_kwh"), W.total("kwh").alias("total_kwh")
    )


def _between_dates(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows of the days from first to last, as a range of times that reaches the file scan."""
    if first is not None:
        df = df.filter(ts() >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        df = df.filter(ts() < F.lit(last).cast("timestamp_ntz") + F.expr("interval 1 day"))
    return df


def d_solar_daily(m: Marts, first: str | None = None, last: str | None = None) -> DataFrame:
    ghi = F.col("ghi_wm2")
    return (
        _between_dates(m.weather_facts, first, last)
        .filter(F.col("hour").between(6, 20))
        .groupBy(date())
        .agg(
            half_up(W.mean("cloud_cover_pct"), 0).alias("avg_cloud_pct"),
            half_up(W.mean(ghi), 0).alias("avg_ghi_wm2"),
            half_up(F.max(ghi), 0).alias("peak_ghi_wm2"),
            half_up(W.total("sunshine_duration_s") / 3600.0, 1).alias("sunshine_hours"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh"),
        )
        .orderBy("date")
    )


def d_solar_hourly(m: Marts, day: str) -> DataFrame:
    one_day = _between_dates(m.weather_facts, day, day).select(
        "timestamp",
        F.col("kwh").alias("electricity_kwh"),
        "temperature_c",
        "cloud_cover_pct",
        "ghi_wm2",
        "dni_wm2",
        "dhi_wm2",
        (F.col("sunshine_duration_s") / 3600.0).alias("sunshine_hours"),
        "hvac_season",
        W.FAN_OUT,
    )
    return W.repeat(one_day).orderBy("timestamp")


def d_sky_condition(m: Marts) -> DataFrame:
    label = F.col("sky_condition")
    return (
        m.weather_facts.filter(F.col("hour").between(10, 16))
        .groupBy(decode.band(F.col("cloud_cover_pct"), C.SKY_BANDS).alias("sky_condition"))
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean("ghi_wm2"), 0).alias("avg_ghi_wm2"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh"),
        )
        .orderBy(decode.rank_of(label, [name for _, name in C.SKY_BANDS]))
    )


# --- soiling and air quality


def d_soiling_risk(m: Marts, first: str, last: str, above: float = 0.2, n: int = 10) -> DataFrame:
    return (
        _between_dates(m.weather_facts, first, last)
        .groupBy(date())
        .agg(
            half_up(W.mean("aerosol_optical_depth"), 3).alias("avg_aod"),
            half_up(W.mean("dust"), 1).alias("avg_dust_ugm3"),
            W.rows_if(F.col("is_high_soiling_risk")).alias("high_risk_hours"),
            half_up(W.mean("ghi_wm2"), 0).alias("avg_solar_wm2"),
        )
        .filter(F.col("avg_aod") > above)
        .orderBy(F.desc("avg_aod"), "date")
        .limit(n)
    )


def d_soiling_by_day(m: Marts) -> DataFrame:
    aod = F.col("aerosol_optical_depth")
    return (
        m.weather_facts.filter(aod > C.HIGH_AOD)
        .groupBy(date())
        .agg(
            half_up(W.mean(aod), 3).alias("avg_aod"),
            half_up(W.mean("dust"), 1).alias("avg_dust"),
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            W.rows().alias("hours"),
            half_up(W.mean("ghi_wm2"), 0).alias("avg_solar_wm2"),
        )
        .orderBy(F.desc("avg_aod"))
    )


def d_hvac_by_pm25_all(m: Marts) -> DataFrame:
    return (
        m.weather_facts.filter(temp().between(15, 25))
        .groupBy("pm2_5_category")
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh_per_hour"),
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
        )
        .orderBy(F.asc_nulls_last("avg_pm2_5"))
    )


def d_uv_by_category(m: Marts) -> DataFrame:
    return (
        _summer_daytime(m)
        .groupBy("uv_category")
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean(temp()), 1).alias("avg_temp_c"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh_per_hour"),
            half_up(W.mean("cdh"), 1).alias("avg_cooling_degree_hours"),
        )
        .orderBy(F.asc_nulls_last("avg_temp_c"))
    )


def d_uv_daily(m: Marts, n: int = 20) -> DataFrame:
    uv = F.col("uv_index")
    return (
        m.weather_facts.filter(F.col("month").isin(6, 7, 8))
        .groupBy(date())
        .agg(
            half_up(W.mean(uv), 1).alias("avg_uv"),
            half_up(F.max(uv), 1).alias("peak_uv"),
            half_up(W.mean(temp()), 1).alias("avg_temp"),
            half_up(W.total("kwh"), 0).alias("daily_kwh"),
            half_up(W.total("cdh") / 24.0, 1).alias("cooling_degree_days"),
        )
        .orderBy(F.desc_nulls_last("avg_uv"), "date")
        .limit(n)
    )


def d_filter_exposure(m: Marts) -> DataFrame:
    return (
        m.weather_facts.groupBy(grain("month"))
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(W.mean("pm10"), 1).alias("avg_pm10"),
            W.rows_if(F.col("pm2_5_category").isin(C.POOR_AIR)).alias("poor_air_hours"),
            half_up(W.total(pm25()) / 1000.0, 2).alias("cumulative_pm2_5_mg"),
        )
        .orderBy(F.desc("month"))
    )


def d_filter_exposure_hours(m: Marts) -> DataFrame:
    return (
        m.weather_facts.groupBy(grain("month"))
        .agg(
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(F.max(pm25()), 1).alias("peak_pm2_5"),
            W.rows_if(pm25() > C.HIGH_PM25).alias("unhealthy_hours"),
            half_up(W.total(pm25()) / 1000.0, 2).alias("cumulative_pm2_5_mg"),
        )
        .orderBy(F.desc("month"))
    )


def d_poor_air_days(m: Marts, n: int = 20) -> DataFrame:
    return (
        m.weather_facts.filter(F.col("pm2_5_category").isin(C.POOR_AIR))
        .groupBy(date(), "pm2_5_category")
        .agg(
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(F.max(pm25()), 1).alias("peak_pm2_5"),
            half_up(W.mean(temp()), 1).alias("avg_temp_c"),
            W.rows().alias("hours"),
        )
        .orderBy(F.desc("avg_pm2_5"), *_tie("date", "pm2_5_category"))
        .limit(n)
    )
