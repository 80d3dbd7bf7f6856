"""Dashboard queries, one function per query over the marts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthgrid import constants as C
from hearthgrid.functions import decode, units
from hearthgrid.functions import weighted as W
from hearthgrid.functions.units import half_up
from hearthgrid.plans.marts import Marts

def ts() -> Column:
    return F.col("timestamp")


def grain(name: str, alias: str | None = None) -> Column:
    return units.floor_to(name, ts()).alias(alias or name)


def newest_first(*ties: str) -> list[Column]:
    """Newest rows first; equal times are ordered by the remaining columns."""
    return [ts().desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]


# --- overview


def q_total_by_commodity(m: Marts) -> DataFrame:
    """Totals, cost and period per commodity; gas cost is scaled from dollars to cents."""

    def one(facts, commodity, unit, amount, cost_scale):
        # a commodity without readings has no line
        return (
            facts.agg(
                W.total(amount).alias("total_consumption"),
                (W.total("cost") * cost_scale).alias("total_cost_cents"),
                W.rows().alias("reading_count"),
                F.min("timestamp").alias("first_reading"),
                F.max("timestamp").alias("last_reading"),
            )
            .filter(F.col("reading_count") > 0)
            .select(F.lit(commodity).alias("commodity"), F.lit(unit).alias("unit"), "*")
        )

    return (
        one(m.electricity_facts, "electricity", "kWh", "kwh", 1)
        .unionByName(one(m.gas_facts, "natural_gas", "m³", "m3", 100))
        .unionByName(one(m.water_facts, "water", "m³", "m3", 1))
    )


def q_recent_readings(m: Marts, n: int = 50) -> DataFrame:
    """The newest electricity and the newest gas readings."""

    def one(facts, commodity, unit, amount):
        shaped = facts.select(
            F.lit(commodity).alias("commodity"),
            "timestamp",
            F.col(amount).alias("quantity"),
            F.lit(unit).alias("unit"),
            "cost",
            "estimated",
            W.FAN_OUT,
        )
        return W.newest(shaped, newest_first("quantity", "cost", "estimated"), n)

    both = one(m.electricity_facts, "electricity", "kWh", "kwh").unionByName(
        one(m.gas_facts, "natural_gas", "m³", "m3")
    )
    return both.orderBy(*newest_first("commodity", "quantity"))


# --- electricity


def q_elec_daily(m: Marts, n: int = 90) -> DataFrame:
    return (
        m.electricity_facts.groupBy(grain("day"), "source")
        .agg(
            W.total("kwh").alias("total_kwh"),
            W.total("cost").alias("total_cost_cents"),
            W.rows().alias("reading_count"),
        )
        .orderBy(F.desc("day"), "source")
        .limit(n)
    )


def q_elec_recent_168(m: Marts, n: int = 168) -> DataFrame:
    shaped = m.electricity_facts.select("timestamp", "source", "kwh", "cost", "estimated", W.FAN_OUT)
    return W.newest(shaped, newest_first("source", "kwh", "cost", "estimated"), n)


def q_elec_monthly(m: Marts) -> DataFrame:
    return (
        m.electricity_facts.groupBy("year", "month", "source")
        .agg(
            W.total("kwh").alias("total_kwh"),
            units.cents_to_dollars(W.total("cost")).alias("total_cost_dollars"),
            W.mean("kwh").alias("avg_kwh_per_reading"),
        )
        .orderBy(F.desc("year"), F.desc("month"), "source")
    )


# --- gas


def q_gas_monthly(m: Marts) -> DataFrame:
    return (
        m.gas_facts.groupBy("timestamp", "year", "month")
        .agg(
            W.total("m3").alias("total_m3"),
            W.total("cost").alias("total_cost_dollars"),
            W.rows().alias("reading_count"),
        )
        .orderBy(ts().desc())
    )


def q_gas_recent(m: Marts, n: int = 50) -> DataFrame:
    shaped = m.gas_facts.select(
        "timestamp", "m3", F.col("cost").alias("cost_dollars"), "estimated", "quality", W.FAN_OUT
    )
    return W.newest(shaped, newest_first("m3", "cost_dollars", "estimated", "quality"), n)


# --- water


def q_water_readings(m: Marts) -> DataFrame:
    shaped = m.water_facts.select(
        "timestamp",
        "year",
        "month",
        "m3",
        "gallons",
        "raw_volume",
        "raw_unit",
        units.cents_to_dollars(F.col("cost")).alias("cost_dollars"),
        "estimated",
        "quality",
        W.FAN_OUT,
    )
    return W.repeat(shaped).orderBy(ts().desc())


def _water_by(m: Marts, keys: list[str], extra: list[Column]) -> DataFrame:
    return (
        m.water_facts.groupBy(*keys)
        .agg(
            W.rows().alias("reading_count"),
            W.total("m3").alias("total_m3"),
            W.total("gallons").alias("total_gallons"),
            units.cents_to_dollars(W.total("cost")).alias("total_cost_dollars"),
            *extra,
        )
        .orderBy(*[F.desc(k) for k in keys])
    )


def q_water_monthly(m: Marts) -> DataFrame:
    return _water_by(m, ["year", "month"], [W.mean("m3").alias("avg_m3_per_reading")])


def q_water_yearly(m: Marts) -> DataFrame:
    return _water_by(m, ["year"], [])


# --- carbon


def _with_intensity(m: Marts) -> DataFrame:
    return m.carbon_facts.filter(F.col("co2e_intensity_gco2_per_kwh").isNotNull())


_INTENSITY = "co2e_intensity_gco2_per_kwh"


def _clean_nonzero() -> Column:
    return F.nullif(F.col("grid_clean_pct"), F.lit(0.0))


def q_carbon_summary(m: Marts) -> DataFrame:
    kg = W.total("kg_co2e")
    return _with_intensity(m).agg(
        (W.total("kwh") / 1000).alias("total_mwh"),
        kg.alias("total_kg_co2e"),
        (kg / 1000).alias("total_tonnes_co2e"),
        W.mean(_INTENSITY).alias("avg_grid_intensity"),
        W.mean(_clean_nonzero()).alias("avg_grid_clean_pct"),
        W.rows().alias("total_readings"),
        W.rows_of(_INTENSITY).alias("readings_with_carbon"),
    )


def q_carbon_daily(m: Marts, n: int = 90) -> DataFrame:
    return (
        _with_intensity(m)
        .groupBy(grain("day"))
        .agg(
            W.total("kwh").alias("kwh"),
            W.total("kg_co2e").alias("kg_co2e"),
            W.mean(_INTENSITY).alias("avg_intensity"),
            W.mean(_clean_nonzero()).alias("avg_clean_pct"),
        )
        .orderBy(F.desc("day"))
        .limit(n)
    )


def q_carbon_monthly(m: Marts) -> DataFrame:
    kg = W.total("kg_co2e")
    return (
        _with_intensity(m)
        .groupBy("year", "month")
        .agg(
            W.total("kwh").alias("kwh"),
            kg.alias("kg_co2e"),
            (kg / 1000).alias("tonnes_co2e"),
            W.mean(_INTENSITY).alias("avg_intensity"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


def q_carbon_hour_of_day(m: Marts) -> DataFrame:
    return (
        _with_intensity(m)
        .groupBy("hour")
        .agg(
            W.mean(_INTENSITY).alias("avg_intensity"),
            W.mean("grid_clean_pct").alias("avg_clean_pct"),
            W.total("kg_co2e").alias("total_kg_co2e"),
        )
        .orderBy("hour")
    )


# --- weather


def q_weather_summary(m: Marts) -> DataFrame:
    return m.hourly_weather.agg(
        F.count(F.lit(1)).alias("total_hours"),
        F.min("timestamp").alias("first_reading"),
        F.max("timestamp").alias("last_reading"),
        half_up(F.avg("temperature_c"), 1).alias("avg_temp_c"),
        half_up(F.min("temperature_c"), 1).alias("min_temp_c"),
        half_up(F.max("temperature_c"), 1).alias("max_temp_c"),
        half_up(F.avg("humidity_pct"), 0).alias("avg_humidity_pct"),
        half_up(F.sum("precipitation_mm"), 1).alias("total_precipitation_mm"),
    )


def q_weather_daily(m: Marts) -> DataFrame:
    t = "temperature_c"
    return (
        m.hourly_weather.groupBy(grain("day", "date"))
        .agg(
            half_up(F.avg(t), 1).alias("avg_temp"),
            half_up(F.min(t), 1).alias("min_temp"),
            half_up(F.max(t), 1).alias("max_temp"),
        )
        .orderBy("date")
    )


def q_weather_monthly(m: Marts) -> DataFrame:
    return (
        m.hourly_weather.groupBy(grain("month"))
        .agg(
            half_up(F.avg("temperature_c"), 1).alias("avg_temp"),
            half_up(F.avg("humidity_pct"), 0).alias("avg_humidity"),
            half_up(F.sum("precipitation_mm"), 1).alias("total_precipitation"),
            half_up(F.avg("windspeed_kmh"), 1).alias("avg_windspeed"),
        )
        .orderBy("month")
    )


def q_weather_recent(m: Marts, n: int = 168) -> DataFrame:
    columns = ["temperature_c", "humidity_pct", "precipitation_mm", "windspeed_kmh", "cloud_cover_pct"]
    return m.hourly_weather.select("timestamp", *columns).orderBy(*newest_first(*columns)).limit(n)


def q_aq_summary(m: Marts) -> DataFrame:
    return m.hourly_weather.agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count("pm2_5").alias("readings_with_pm25"),
        half_up(F.avg("pm2_5"), 1).alias("avg_pm25"),
        half_up(F.avg("pm10"), 1).alias("avg_pm10"),
        half_up(F.avg("uv_index"), 1).alias("avg_uv_index"),
        half_up(F.avg("aerosol_optical_depth"), 3).alias("avg_aod"),
    )


def q_aq_recent(m: Marts, n: int = 168) -> DataFrame:
    measured = m.hourly_weather.filter(F.col("pm2_5").isNotNull() | F.col("uv_index").isNotNull())
    return (
        measured.select("timestamp", "pm2_5", "pm10", "uv_index", F.col("aerosol_optical_depth").alias("aod"))
        .orderBy(*newest_first("pm2_5", "pm10", "uv_index", "aod"))
        .limit(n)
    )


def q_degree_days_monthly(m: Marts) -> DataFrame:
    t = F.col("temperature_c")
    below = F.greatest(C.DEGREE_BASE_C - t, F.lit(0.0))
    above = F.greatest(t - C.DEGREE_BASE_C, F.lit(0.0))
    return (
        m.hourly_weather.groupBy(grain("month"))
        .agg(
            half_up(F.sum(below) / 24, 1).alias("heating_degree_days"),
            half_up(F.sum(above) / 24, 1).alias("cooling_degree_days"),
        )
        .orderBy("month")
    )


# --- weather and energy


def q_combined_monthly_energy(m: Marts) -> DataFrame:
    """Electricity and gas heat by month: both sides are aggregated before they are joined."""
    electricity = m.weather_facts.groupBy(grain("month")).agg(
        W.total("kwh").alias("kwh"), half_up(W.mean("temperature_c"), 1).alias("avg_temp")
    )
    heat = m.gas_facts.groupBy(grain("month")).agg(
        half_up(W.total(units.gas_to_thermal_kwh(F.col("m3"))), 2).alias("gas_heating_kwh")
    )
    return (
        electricity.join(heat, "month", "left")
        .select(
            "month",
            half_up(F.col("kwh"), 2).alias("electricity_kwh"),
            "gas_heating_kwh",
            half_up(F.col("kwh") + F.coalesce("gas_heating_kwh", F.lit(0.0)), 2).alias("total_energy_kwh"),
            "avg_temp",
        )
        .orderBy("month")
    )


def q_daily_energy_vs_temp(m: Marts) -> DataFrame:
    return (
        m.weather_facts.groupBy(grain("day", "date"))
        .agg(
            # summed in decimals, so that a sum on the edge rounds alike whatever order rows arrive in
            half_up(W.total(F.col("kwh").cast("decimal(20,9)")).cast("double"), 2).alias("total_kwh"),
            half_up(W.mean("temperature_c"), 1).alias("avg_temp"),
        )
        .orderBy("date")
    )


def q_kwh_by_temp_range(m: Marts) -> DataFrame:
    label = F.col("temp_range")
    return (
        m.weather_facts.filter(F.col("temperature_c").isNotNull())
        .groupBy(decode.band(F.col("temperature_c"), C.TEMPERATURE_RANGES).alias("temp_range"))
        .agg(half_up(W.mean("kwh"), 2).alias("avg_kwh_per_hour"), W.rows().alias("hours"))
        .orderBy(decode.rank_of(label, [name for _, name in C.TEMPERATURE_RANGES]))
    )


def q_monthly_heating_energy(m: Marts) -> DataFrame:
    return (
        m.gas_facts.filter(F.col("m3") > 0)
        .groupBy(grain("month"))
        .agg(
            W.total("m3").alias("total_m3_gas"),
            half_up(W.total(units.gas_to_thermal_kwh(F.col("m3"))), 2).alias("gas_heating_kwh"),
            half_up(W.mean("avg_outdoor_temp_c"), 1).alias("avg_temp_c"),
            W.total("heating_degree_days").alias("total_hdd"),
            W.rows().alias("gas_reading_count"),
        )
        .orderBy("month")
    )


def q_temp_usage_stats(m: Marts) -> DataFrame:
    # the days of each weight are few, so they are merged as sets
    matched = m.weather_facts.filter(F.col("temperature_c").isNotNull())
    days = F.collect_set(grain("day")).alias("days")
    return W.parts(matched, [], "kwh", pairs=(("temperature_c", "kwh"),), more=(days,)).agg(
        half_up(W.part_corr("temperature_c", "kwh"), 3).alias("temperature_correlation"),
        F.size(F.array_distinct(F.flatten(F.collect_list("days")))).cast("bigint").alias("days_analyzed"),
        half_up(W.part_mean("kwh"), 2).alias("avg_hourly_kwh"),
    )
