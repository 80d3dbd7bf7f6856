"""Weather correlation and air quality impact reports, and checks of the raw climate feeds."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode
from hearthgrid.functions import weighted as W
from hearthgrid.functions.units import half_up
from hearthgrid.plans.dashboard import grain, ts
from hearthgrid.plans.marts import Marts

def temp() -> Column:
    return F.col("temperature_c")


def pm25() -> Column:
    return F.col("pm2_5")


def date() -> Column:
    return F.to_date("timestamp").alias("date")


def _matched(m: Marts) -> DataFrame:
    return m.weather_facts.filter(~F.col("missing_weather_data"))


def _tie(*columns):
    return [F.col(c).asc_nulls_last() for c in columns]


# --- weather correlation


def a_weather_coverage(m: Marts) -> DataFrame:
    return _matched(m).agg(
        W.rows().alias("total"),
        F.min("timestamp").alias("start_date"),
        F.max("timestamp").alias("end_date"),
        F.count_distinct("home_id").alias("homes"),
    )


def a_by_temp_category(m: Marts) -> DataFrame:
    return (
        _matched(m)
        .groupBy("temperature_category")
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean("kwh"), 2).alias("avg_kwh_per_hour"),
            half_up(W.mean(temp()), 1).alias("avg_temp_c"),
            half_up(F.min(temp()), 1).alias("min_temp"),
            half_up(F.max(temp()), 1).alias("max_temp"),
        )
        .orderBy("avg_temp_c")
    )


def a_by_hvac_season(m: Marts) -> DataFrame:
    return (
        _matched(m)
        .groupBy("hvac_season")
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean("kwh"), 2).alias("avg_kwh_per_hour"),
            half_up(W.total("kwh"), 0).alias("total_kwh"),
            half_up(W.mean(temp()), 1).alias("avg_temp_c"),
        )
        .orderBy(decode.rank_of(F.col("hvac_season"), ["cooling", "shoulder", "heating"]))
    )


def a_monthly_degree_days(m: Marts) -> DataFrame:
    return (
        _matched(m)
        .groupBy("year", "month")
        .agg(
            half_up(W.total("hdh") / 24.0, 0).alias("total_hdd"),
            half_up(W.total("cdh") / 24.0, 0).alias("total_cdd"),
            half_up(W.total("kwh"), 0).alias("total_kwh"),
            half_up(W.mean(temp()), 1).alias("avg_temp_c"),
            W.rows().alias("hours"),
        )
        .orderBy("year", "month")
    )


def a_daily_patterns_30(m: Marts, n: int = 30) -> DataFrame:
    return (
        _matched(m)
        .groupBy(grain("day", "date"))
        .agg(
            half_up(W.total("hdh") / 24.0, 1).alias("hdd"),
            half_up(W.total("cdh") / 24.0, 1).alias("cdd"),
            half_up(W.total("kwh"), 0).alias("daily_kwh"),
            half_up(W.mean(temp()), 1).alias("avg_temp_c"),
            half_up(F.min(temp()), 1).alias("min_temp"),
            half_up(F.max(temp()), 1).alias("max_temp"),
        )
        .orderBy(F.desc("date"))
        .limit(n)
    )


def a_temp_bins_5c(m: Marts, width: int = 5) -> DataFrame:
    return (
        W.parts(_matched(m), [(F.floor(temp() / width) * width).cast("double").alias("temp_bin")], "kwh")
        .groupBy("temp_bin")
        .agg(
            W.part_rows().alias("hours"),
            half_up(W.part_mean("kwh"), 2).alias("avg_kwh"),
            half_up(W.part_stddev("kwh"), 2).alias("stddev_kwh"),
        )
        .orderBy("temp_bin")
    )


def a_correlations(m: Marts) -> DataFrame:
    pairs = tuple((c, "kwh") for c in ("temperature_c", "hdh", "cdh"))
    return W.parts(_matched(m), [], pairs=pairs).agg(
        half_up(W.part_corr("temperature_c", "kwh"), 3).alias("temp_kwh_corr"),
        half_up(W.part_corr("hdh", "kwh"), 3).alias("hdh_kwh_corr"),
        half_up(W.part_corr("cdh", "kwh"), 3).alias("cdh_kwh_corr"),
    )


# --- air quality impact


def a_soiling_days(m: Marts, n: int = 15) -> DataFrame:
    aod = F.col("aerosol_optical_depth")
    return (
        m.weather_facts.filter(aod > C.HIGH_AOD)
        .groupBy(date(), "pm2_5_category")
        .agg(
            half_up(W.mean(aod), 3).alias("avg_aod"),
            half_up(F.max(aod), 3).alias("peak_aod"),
            half_up(W.mean("dust"), 1).alias("avg_dust"),
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(W.mean("ghi_wm2"), 0).alias("avg_ghi"),
        )
        .orderBy(F.desc("avg_aod"), *_tie("date", "pm2_5_category"))
        .limit(n)
    )


def a_hvac_by_pm25(m: Marts) -> DataFrame:
    """Consumption at 15 to 25 °C by air quality, with each category's share of the hours."""
    by_category = (
        m.weather_facts.filter(temp().between(15, 25) & F.col("pm2_5_category").isNotNull())
        .groupBy("pm2_5_category")
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh"),
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(W.mean(temp()), 1).alias("avg_temp"),
        )
    )
    # the window spans one row per category
    share = by_category.selectExpr("*", "100.0D * hours / sum(hours) over () as share")
    return share.select(
        "pm2_5_category", "hours", "avg_kwh", "avg_pm2_5", "avg_temp", half_up(F.col("share"), 1).alias("pct_hours")
    ).orderBy(F.col("avg_pm2_5").asc_nulls_last())


def a_hvac_impact_pct(m: Marts) -> DataFrame:
    """Rise in consumption from good to unhealthy air; no row if one of them did not occur."""

    def average_of(category):
        return F.max(F.when(F.col("pm2_5_category") == category, F.col("avg_kwh")))

    return (
        a_hvac_by_pm25(m)
        .agg(average_of("good").alias("good_kwh"), average_of("unhealthy").alias("unhealthy_kwh"))
        .filter(F.col("good_kwh").isNotNull() & F.col("unhealthy_kwh").isNotNull())
        .select(
            "good_kwh",
            "unhealthy_kwh",
            (F.try_divide(F.col("unhealthy_kwh") - F.col("good_kwh"), F.col("good_kwh")) * 100).alias("impact_pct"),
        )
    )


def _summer_daytime(m: Marts) -> DataFrame:
    return m.weather_facts.filter(F.col("month").between(6, 8) & F.col("hour").between(10, 18))


def a_uv_cooling(m: Marts) -> DataFrame:
    return (
        _summer_daytime(m)
        .filter(F.col("uv_category").isNotNull())
        .groupBy("uv_category")
        .agg(
            W.rows().alias("hours"),
            half_up(W.mean("uv_index"), 1).alias("avg_uv"),
            half_up(W.mean(temp()), 1).alias("avg_temp"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh"),
            half_up(W.mean("cdh"), 1).alias("avg_cdh"),
        )
        .orderBy(F.desc("avg_uv"), "uv_category")
    )


def a_aq_monthly(m: Marts, n: int = 12) -> DataFrame:
    poor = F.col("pm2_5_category").isin("unhealthy_sensitive", "unhealthy")
    return (
        m.weather_facts.filter(pm25().isNotNull())
        .groupBy(grain("month"))
        .agg(
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(F.max(pm25()), 1).alias("peak_pm2_5"),
            W.rows_if(poor).alias("poor_air_hours"),
            half_up(W.mean("aerosol_optical_depth"), 3).alias("avg_aod"),
            half_up(W.mean("uv_index"), 1).alias("avg_uv"),
        )
        .orderBy(F.desc("month"))
        .limit(n)
    )


def a_worst_aq_days(m: Marts, n: int = 10) -> DataFrame:
    return (
        m.weather_facts.filter(pm25().isNotNull())
        .groupBy(date(), "pm2_5_category")
        .agg(
            half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
            half_up(F.max(pm25()), 1).alias("peak_pm2_5"),
            half_up(W.mean("european_aqi"), 0).alias("avg_aqi"),
            half_up(W.mean("kwh"), 0).alias("avg_kwh"),
            half_up(W.mean(temp()), 1).alias("avg_temp"),
        )
        .orderBy(F.desc("avg_pm2_5"), *_tie("date", "pm2_5_category"))
        .limit(n)
    )


def a_aq_summary(m: Marts) -> DataFrame:
    category = F.col("pm2_5_category")
    good = W.rows_if(category == "good")
    return m.weather_facts.filter(pm25().isNotNull()).agg(
        W.rows().alias("total_hours"),
        good.alias("good_hours"),
        W.rows_if(category == "moderate").alias("moderate_hours"),
        W.rows_if(category.isin(C.POOR_AIR)).alias("poor_hours"),
        half_up(F.try_divide(F.lit(100.0) * good, W.rows()), 1).alias("pct_good"),
        half_up(W.mean(pm25()), 1).alias("avg_pm2_5"),
        half_up(W.mean("aerosol_optical_depth"), 3).alias("avg_aod"),
        half_up(W.mean("uv_index"), 1).alias("avg_uv"),
    )


# --- raw feeds


def _range(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.min("timestamp").alias("min_date"),
        F.max("timestamp").alias("max_date"),
        F.count_distinct("location_name").alias("locations"),
    )


def a_weather_range(m: Marts) -> DataFrame:
    return _range(m.weather)


def a_aq_range(m: Marts) -> DataFrame:
    return _range(m.air_quality)


def a_weather_stats_by_location(m: Marts) -> DataFrame:
    return m.weather.groupBy("location_name").agg(
        F.count(F.lit(1)).alias("records"),
        half_up(F.min(temp()), 1).alias("min_temp"),
        half_up(F.max(temp()), 1).alias("max_temp"),
        half_up(F.avg(temp()), 1).alias("avg_temp"),
    )


def a_aq_stats_by_location(m: Marts) -> DataFrame:
    return (
        m.air_quality.filter(pm25().isNotNull())
        .groupBy("location_name")
        .agg(
            F.count(F.lit(1)).alias("records"),
            half_up(F.min(pm25()), 1).alias("min_pm2_5"),
            half_up(F.max(pm25()), 1).alias("max_pm2_5"),
            half_up(F.avg(pm25()), 1).alias("avg_pm2_5"),
            half_up(F.avg("european_aqi"), 0).alias("avg_aqi"),
        )
    )


def a_uv_stats_by_location(m: Marts) -> DataFrame:
    uv = F.col("uv_index")
    return (
        m.air_quality.filter(uv.isNotNull())
        .groupBy("location_name")
        .agg(
            half_up(F.avg(uv), 1).alias("avg_uv_index"),
            half_up(F.max(uv), 1).alias("max_uv_index"),
            half_up(F.avg("aerosol_optical_depth"), 3).alias("avg_aod"),
        )
    )


def a_aq_bands(m: Marts) -> DataFrame:
    return (
        m.air_quality.filter(pm25().isNotNull())
        .groupBy(decode.band(pm25(), C.PM25_THREE_BANDS).alias("air_quality_category"))
        .agg(F.count(F.lit(1)).alias("hours"), half_up(F.avg(pm25()), 1).alias("avg_pm2_5"))
        .orderBy("avg_pm2_5")
    )
