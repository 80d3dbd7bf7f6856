"""One SQL statement per registered query, over the relations of ``base``."""

from oracle import literals as C
from oracle.base import (
    COMMODITY,
    ESTIMATED,
    QUALITY,
    TOU,
    band_case,
    equal_case,
    like_case,
    with_relations,
)

E, W, HW = "fct_electricity", "fct_weather", "hourly_weather"
DAY = "date_trunc('day', timestamp)::timestamp"
MONTH = "date_trunc('month', timestamp)::timestamp"
DATE = "timestamp::date"
POOR = "pm2_5_category in ('unhealthy_sensitive', 'unhealthy', 'very_unhealthy')"
SUMMER_DAYTIME = "month(timestamp) between 6 and 8 and hour(timestamp) between 10 and 18"
SHOULDER = "temperature_c between 15 and 25"


def avg(column, digits, name):
    return f"round(avg({column}), {digits}) as {name}"


def corr(a, b, name):
    return f"round(case when isnan(corr({a}, {b})) then null else corr({a}, {b}) end, 3) as {name}"


def latest(relation, keys, order, columns="*"):
    """Rows of a relation that come first within their key."""
    by = ", ".join(f"{c} desc nulls last" for c in order)
    return (
        f"select {columns} from {relation} "
        f"qualify row_number() over (partition by {', '.join(keys)} order by {by}) = 1"
    )


def heat(sensor_rows):
    return f"""
        select date, kwh * {sensor_rows} as hvac_kwh, outdoor as avg_outdoor_temp, indoor as avg_indoor_temp,
               case when outdoor < 0 then kwh * {sensor_rows} / nullif(indoor - outdoor, 0) * 100 end as estimated_cop
        from (select {DATE} as date, sum(kwh) as kwh from {E} where device_id like '%1%' group by 1)
        join (select {DATE} as date, avg(temperature_c) as outdoor, 21.0::double as indoor, count(*) as n
              from weather where temperature_c is not null group by 1) using (date)"""


def water_by(keys, extra=""):
    return f"""
        select {keys}, count(*) as reading_count, sum(m3) as total_m3, sum(gallons) as total_gallons,
               sum(cost) / 100.0 as total_cost_dollars{extra} from fct_water group by {keys}"""


def carbon(select, tail=""):
    return f"select {select} from fct_carbon where co2e_intensity_gco2_per_kwh is not null {tail}"


READ_COLUMNS = (
    "timestamp, duration_seconds, kwh, raw_value, cost, quality_code, tou_bucket, commodity, uom, meter_id"
)
#: Readings with the places of their usage point and meter reading in the feed of their home, by month and meter.
FEED = """
    (select *, (dense_rank() over (partition by home_id order by date_trunc('month', timestamp), meter_id) - 1)::int as point,
            (dense_rank() over (partition by home_id, date_trunc('month', timestamp), meter_id order by meter_reading_idx) - 1)::int
                as place
     from readings)"""
READING_KEY = C.READING_KEY
READING_REST = [
    "duration_seconds", "kwh", "raw_value", "cost", "quality_code", "tou_bucket", "commodity", "uom",
    "service_kind", "meter_id",
]
GAS_CODE = "'CommodityKindValue.VALUE_7'"
INTENSITY = "co2e_intensity_gco2_per_kwh"

WIDE = """
    (select meter_id, timestamp as local, sum(kwh) as kwh from readings
     where commodity = 'CommodityKindValue.VALUE_1' group by 1, 2)"""
TOU_BUCKET = """
    case when dayofweek(t) in (0, 6) or hour(t) < 7 or hour(t) >= 19 then 3
         when (hour(t) between 11 and 16) = (month(t) between 5 and 10) then 1 else 2 end"""
CHARGE = """
    (select *, sum(is_new) over (partition by home_id, device_id, channel order by timestamp) as session
     from (select home_id, device_id, channel, timestamp, watts,
                  case when timestamp <= lag(timestamp) over (partition by home_id, device_id, channel
                       order by timestamp) + interval 3 hours then 0 else 1 end as is_new
           from power where watts >= 1000))"""


def rollup(grain):
    return f"""
        select '{grain}' as grain, home_id, date_trunc('{grain}', timestamp)::timestamp as period_start,
               sum(kwh) as total, sum(cost) as total_cost, count(*) as reading_count
        from {E} where source = 'green_button' group by 2, 3"""


EXPORT_KEYS = {
    "fct_electricity_consumption": ["home_id", "source", "device_id", "meter_id_hash", "timestamp"],
    "fct_gas_consumption": ["home_id", "device_id", "meter_id_hash", "timestamp"],
    "fct_water_consumption": ["home_id", "device_id", "meter_id_hash", "timestamp"],
    "fct_utility_consumption": ["home_id", "commodity", "timestamp"],
}


def exported(relation, name, amount, rest):
    """Rows, costs and amounts of a table by home, of which the greatest row of a key is kept."""
    last_hash = "max(meter_id_hash)" if "meter_id_hash" in EXPORT_KEYS[name] else "null::varchar"
    return f"""
        select home_id, '{name}' as table_name, count(*) as n, sum(cost) as cost, count(distinct timestamp) as times,
               max({amount}) as largest, {last_hash} as last_hash
        from ({latest(relation, EXPORT_KEYS[name], rest)}) group by 1"""


def stage(relation, name):
    keys = ", ".join(READING_KEY)
    return f"""
        select '{name}' as stage, sum(copies)::bigint as row_count,
               count(*) filter (copies > 1) as duplicate_keys
        from (select count(*) as copies from {relation} group by {keys})"""


def nulls(table, relation):
    return " union all ".join(
        f"select '{table}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as null_count "
        f"from {relation}"
        for c in C.REQUIRED[table]
    )


_UNIFIED = f"({latest('keyed_readings', READING_KEY, ['l_orderkey', 'l_partkey', *READING_REST])})"

SQL = {
    # --- dashboard
    "q_total_by_commodity": f"""
        select 'electricity' as commodity, 'kWh' as unit, sum(kwh) as total_consumption, sum(cost) as total_cost_cents,
               count(*) as reading_count, min(timestamp) as first_reading, max(timestamp) as last_reading from {E}
        union all
        select 'natural_gas', 'm³', sum(m3), sum(cost) * 100, count(*), min(timestamp), max(timestamp) from fct_gas
        union all
        select 'water', 'm³', sum(m3), sum(cost), count(*), min(timestamp), max(timestamp) from fct_water""",
    "q_recent_readings": f"""
        (select 'electricity' as commodity, timestamp, kwh as quantity, 'kWh' as unit, cost, estimated from {E}
         order by timestamp desc, quantity, cost nulls last, estimated limit 50)
        union all
        (select 'natural_gas', timestamp, m3 as quantity, 'm³', cost, estimated from fct_gas
         order by timestamp desc, quantity, cost nulls last, estimated limit 50)""",
    "q_elec_daily": f"""
        select {DAY} as day, source, sum(kwh) as total_kwh, sum(cost) as total_cost_cents, count(*) as reading_count
        from {E} group by 1, 2 order by day desc, source limit 90""",
    "q_elec_recent_168": f"""
        select timestamp, source, kwh, cost, estimated from {E}
        order by timestamp desc, source, kwh, cost nulls last, estimated limit 168""",
    "q_elec_monthly": f"""
        select year, month, source, sum(kwh) as total_kwh, sum(cost) / 100.0 as total_cost_dollars,
               avg(kwh) as avg_kwh_per_reading from {E} group by 1, 2, 3""",
    "q_gas_monthly": """
        select timestamp, year, month, sum(m3) as total_m3, sum(cost) as total_cost_dollars, count(*) as reading_count
        from fct_gas group by 1, 2, 3""",
    "q_gas_recent": """
        select timestamp, m3, cost as cost_dollars, estimated, quality from fct_gas
        order by timestamp desc, m3, cost_dollars, estimated, quality limit 50""",
    "q_water_readings": """
        select timestamp, year, month, m3, gallons, raw_volume, raw_unit, cost / 100.0 as cost_dollars, estimated,
               quality from fct_water""",
    "q_water_monthly": water_by("year, month", ", avg(m3) as avg_m3_per_reading"),
    "q_water_yearly": water_by("year"),
    "q_carbon_summary": carbon(
        f"""sum(kwh) / 1000 as total_mwh, sum(kg_co2e) as total_kg_co2e, sum(kg_co2e) / 1000 as total_tonnes_co2e,
            avg({INTENSITY}) as avg_grid_intensity, avg(nullif(grid_clean_pct, 0)) as avg_grid_clean_pct,
            count(*) as total_readings, count({INTENSITY}) as readings_with_carbon"""
    ),
    "q_carbon_daily": carbon(
        f"""{DAY} as day, sum(kwh) as kwh, sum(kg_co2e) as kg_co2e, avg({INTENSITY}) as avg_intensity,
            avg(nullif(grid_clean_pct, 0)) as avg_clean_pct""",
        "group by 1 order by 1 desc limit 90",
    ),
    "q_carbon_monthly": carbon(
        f"""year, month, sum(kwh) as kwh, sum(kg_co2e) as kg_co2e, sum(kg_co2e) / 1000 as tonnes_co2e,
            avg({INTENSITY}) as avg_intensity""",
        "group by 1, 2",
    ),
    "q_carbon_hour_of_day": carbon(
        f"hour, avg({INTENSITY}) as avg_intensity, avg(grid_clean_pct) as avg_clean_pct, sum(kg_co2e) as total_kg_co2e",
        "group by 1",
    ),
    "q_weather_summary": f"""
        select count(*) as total_hours, min(timestamp) as first_reading, max(timestamp) as last_reading,
               {avg('temperature_c', 1, 'avg_temp_c')}, round(min(temperature_c), 1) as min_temp_c,
               round(max(temperature_c), 1) as max_temp_c, {avg('humidity_pct', 0, 'avg_humidity_pct')},
               round(sum(precipitation_mm), 1) as total_precipitation_mm from {HW}""",
    "q_weather_daily": f"""
        select {DAY} as date, {avg('temperature_c', 1, 'avg_temp')}, round(min(temperature_c), 1) as min_temp,
               round(max(temperature_c), 1) as max_temp from {HW} group by 1""",
    "q_weather_monthly": f"""
        select {MONTH} as month, {avg('temperature_c', 1, 'avg_temp')}, {avg('humidity_pct', 0, 'avg_humidity')},
               round(sum(precipitation_mm), 1) as total_precipitation, {avg('windspeed_kmh', 1, 'avg_windspeed')}
        from {HW} group by 1""",
    "q_weather_recent": f"""
        select timestamp, temperature_c, humidity_pct, precipitation_mm, windspeed_kmh, cloud_cover_pct from {HW}
        order by timestamp desc, 2, 3, 4, 5, 6 limit 168""",
    "q_aq_summary": f"""
        select count(*) as total_readings, count(pm2_5) as readings_with_pm25, {avg('pm2_5', 1, 'avg_pm25')},
               {avg('pm10', 1, 'avg_pm10')}, {avg('uv_index', 1, 'avg_uv_index')},
               {avg('aerosol_optical_depth', 3, 'avg_aod')} from {HW}""",
    "q_aq_recent": f"""
        select timestamp, pm2_5, pm10, uv_index, aerosol_optical_depth as aod from {HW}
        where pm2_5 is not null or uv_index is not null
        order by timestamp desc, 2 nulls last, 3 nulls last, 4 nulls last, 5 nulls last limit 168""",
    "q_combined_monthly_energy": f"""
        select month, round(kwh, 2) as electricity_kwh, heat as gas_heating_kwh,
               round(kwh + coalesce(heat, 0), 2) as total_energy_kwh, avg_temp
        from (select {MONTH} as month, sum(kwh) as kwh, {avg('temperature_c', 1, 'avg_temp')} from {W} group by 1)
        left join (select {MONTH} as month, round(sum(m3 * 10.55 * 0.95), 2) as heat from fct_gas group by 1)
            using (month)""",
    "q_daily_energy_vs_temp": f"""
        select {DAY} as date, round(sum(kwh::decimal(20, 9))::double, 2) as total_kwh, {avg('temperature_c', 1, 'avg_temp')}
        from {W} group by 1""",
    "q_kwh_by_temp_range": f"""
        select {band_case('temperature_c', C.TEMPERATURE_RANGES)} as temp_range, {avg('kwh', 2, 'avg_kwh_per_hour')},
               count(*) as hours from {W} where temperature_c is not null group by 1""",
    "q_monthly_heating_energy": f"""
        select {MONTH} as month, sum(m3) as total_m3_gas, round(sum(m3 * 10.55 * 0.95), 2) as gas_heating_kwh,
               {avg('avg_outdoor_temp_c', 1, 'avg_temp_c')}, sum(heating_degree_days) as total_hdd,
               count(*) as gas_reading_count from fct_gas where m3 > 0 group by 1""",
    "q_degree_days_monthly": f"""
        select {MONTH} as month, round(sum(greatest(18 - temperature_c, 0)) / 24, 1) as heating_degree_days,
               round(sum(greatest(temperature_c - 18, 0)) / 24, 1) as cooling_degree_days from {HW} group by 1""",
    "q_temp_usage_stats": f"""
        select {corr('temperature_c', 'kwh', 'temperature_correlation')}, count(distinct {DAY}) as days_analyzed,
               {avg('kwh', 2, 'avg_hourly_kwh')} from {W} where temperature_c is not null""",
    # --- weather correlation
    "a_weather_coverage": f"""
        select count(*) as total, min(timestamp) as start_date, max(timestamp) as end_date,
               count(distinct home_id) as homes from {W} where not missing_weather_data""",
    "a_by_temp_category": f"""
        select temperature_category, count(*) as hours, {avg('kwh', 2, 'avg_kwh_per_hour')},
               {avg('temperature_c', 1, 'avg_temp_c')}, round(min(temperature_c), 1) as min_temp,
               round(max(temperature_c), 1) as max_temp from {W} where not missing_weather_data group by 1""",
    "a_by_hvac_season": f"""
        select hvac_season, count(*) as hours, {avg('kwh', 2, 'avg_kwh_per_hour')}, round(sum(kwh), 0) as total_kwh,
               {avg('temperature_c', 1, 'avg_temp_c')} from {W} where not missing_weather_data group by 1""",
    "a_monthly_degree_days": f"""
        select year, month, round(sum(hdh) / 24.0, 0) as total_hdd, round(sum(cdh) / 24.0, 0) as total_cdd,
               round(sum(kwh), 0) as total_kwh, {avg('temperature_c', 1, 'avg_temp_c')}, count(*) as hours
        from {W} where not missing_weather_data group by 1, 2""",
    "a_daily_patterns_30": f"""
        select {DAY} as date, round(sum(hdh) / 24.0, 1) as hdd, round(sum(cdh) / 24.0, 1) as cdd,
               round(sum(kwh), 0) as daily_kwh, {avg('temperature_c', 1, 'avg_temp_c')},
               round(min(temperature_c), 1) as min_temp, round(max(temperature_c), 1) as max_temp
        from {W} where not missing_weather_data group by 1 order by 1 desc limit 30""",
    "a_temp_bins_5c": f"""
        select floor(temperature_c / 5) * 5 as temp_bin, count(*) as hours, {avg('kwh', 2, 'avg_kwh')},
               round(stddev(kwh), 2) as stddev_kwh from {W} where not missing_weather_data group by 1""",
    "a_correlations": f"""
        select {corr('temperature_c', 'kwh', 'temp_kwh_corr')}, {corr('hdh', 'kwh', 'hdh_kwh_corr')},
               {corr('cdh', 'kwh', 'cdh_kwh_corr')} from {W} where not missing_weather_data""",
    # --- air quality impact
    "a_soiling_days": f"""
        select {DATE} as date, {avg('aerosol_optical_depth', 3, 'avg_aod')},
               round(max(aerosol_optical_depth), 3) as peak_aod, {avg('dust', 1, 'avg_dust')},
               {avg('pm2_5', 1, 'avg_pm2_5')}, {avg('ghi_wm2', 0, 'avg_ghi')}, pm2_5_category
        from {W} where aerosol_optical_depth > 0.3 group by date, pm2_5_category
        order by avg_aod desc, date, pm2_5_category nulls last limit 15""",
    "a_hvac_by_pm25": f"""
        select pm2_5_category, count(*) as hours, {avg('kwh', 0, 'avg_kwh')}, {avg('pm2_5', 1, 'avg_pm2_5')},
               {avg('temperature_c', 1, 'avg_temp')},
               round(100.0 * count(*) / sum(count(*)) over (), 1) as pct_hours
        from {W} where {SHOULDER} and pm2_5_category is not null group by 1""",
    "a_hvac_impact_pct": f"""
        select good_kwh, unhealthy_kwh, (unhealthy_kwh - good_kwh) / nullif(good_kwh, 0) * 100 as impact_pct
        from (select round(avg(kwh) filter (pm2_5_category = 'good'), 0) as good_kwh,
                     round(avg(kwh) filter (pm2_5_category = 'unhealthy'), 0) as unhealthy_kwh
              from {W} where {SHOULDER})
        where good_kwh is not null and unhealthy_kwh is not null""",
    "a_uv_cooling": f"""
        select uv_category, count(*) as hours, {avg('uv_index', 1, 'avg_uv')}, {avg('temperature_c', 1, 'avg_temp')},
               {avg('kwh', 0, 'avg_kwh')}, {avg('cdh', 1, 'avg_cdh')}
        from {W} where {SUMMER_DAYTIME} and uv_category is not null group by 1""",
    "a_aq_monthly": f"""
        select {MONTH} as month, {avg('pm2_5', 1, 'avg_pm2_5')}, round(max(pm2_5), 1) as peak_pm2_5,
               count(*) filter (pm2_5_category in ('unhealthy_sensitive', 'unhealthy')) as poor_air_hours,
               {avg('aerosol_optical_depth', 3, 'avg_aod')}, {avg('uv_index', 1, 'avg_uv')}
        from {W} where pm2_5 is not null group by 1 order by 1 desc limit 12""",
    "a_worst_aq_days": f"""
        select {DATE} as date, {avg('pm2_5', 1, 'avg_pm2_5')}, round(max(pm2_5), 1) as peak_pm2_5,
               {avg('european_aqi', 0, 'avg_aqi')}, pm2_5_category, {avg('kwh', 0, 'avg_kwh')},
               {avg('temperature_c', 1, 'avg_temp')}
        from {W} where pm2_5 is not null group by date, pm2_5_category
        order by avg_pm2_5 desc, date, pm2_5_category limit 10""",
    "a_aq_summary": f"""
        select count(*) as total_hours, count(*) filter (pm2_5_category = 'good') as good_hours,
               count(*) filter (pm2_5_category = 'moderate') as moderate_hours, count(*) filter ({POOR}) as poor_hours,
               round(100.0 * count(*) filter (pm2_5_category = 'good') / count(*), 1) as pct_good,
               {avg('pm2_5', 1, 'avg_pm2_5')}, {avg('aerosol_optical_depth', 3, 'avg_aod')},
               {avg('uv_index', 1, 'avg_uv')} from {W} where pm2_5 is not null""",
    # --- raw tables
    "a_commodity_breakdown": """
        select commodity, count(*) as intervals, min(timestamp) as first_reading, max(timestamp) as last_reading,
               sum(kwh) as total_consumption from readings group by 1""",
    "a_by_home": """
        select home_id, count(*) as intervals, min(timestamp) as first_reading, max(timestamp) as last_reading
        from readings group by 1""",
    "a_by_home_commodity": f"""
        select *, {equal_case('commodity', C.DISPLAY_COMMODITIES, 'commodity')} as commodity_name,
               {equal_case('uom', C.DISPLAY_UNITS, 'uom')} as unit_name
        from (select home_id, commodity, service_kind, uom, count(*) as intervals, min(timestamp) as first_reading,
                     max(timestamp) as last_reading, sum(kwh) as total_consumption, sum(cost) as total_cost
              from readings group by 1, 2, 3, 4)""",
    "a_gas_count_range": """
        select count(*) as count, min(timestamp) as min_date, max(timestamp) as max_date
        from readings where commodity like '%VALUE_7%'""",
    "a_bill_stats_electricity": """
        select count(*) as months, min(month_end_date) as first_month, max(month_end_date) as last_month,
               round(sum(total_kwh), 1) as total_kwh, round(sum(total_cost), 2) as total_cost
        from bills_electricity where home_id = 'home-1'""",
    "a_bill_stats_gas": """
        select count(*) as months, min(month_end_date) as first_month, max(month_end_date) as last_month,
               round(sum(gas_m3), 1) as total_m3, round(sum(gas_cost), 2) as total_cost
        from bills_gas where home_id = 'home-1'""",
    "a_weather_range": """
        select min(timestamp) as min_date, max(timestamp) as max_date, count(distinct location_name) as locations
        from weather""",
    "a_aq_range": """
        select min(timestamp) as min_date, max(timestamp) as max_date, count(distinct location_name) as locations
        from air_quality""",
    "a_weather_stats_by_location": f"""
        select location_name, count(*) as records, round(min(temperature_c), 1) as min_temp,
               round(max(temperature_c), 1) as max_temp, {avg('temperature_c', 1, 'avg_temp')}
        from weather group by 1""",
    "a_aq_stats_by_location": f"""
        select location_name, count(*) as records, round(min(pm2_5), 1) as min_pm2_5,
               round(max(pm2_5), 1) as max_pm2_5, {avg('pm2_5', 1, 'avg_pm2_5')}, {avg('european_aqi', 0, 'avg_aqi')}
        from air_quality where pm2_5 is not null group by 1""",
    "a_uv_stats_by_location": f"""
        select location_name, {avg('uv_index', 1, 'avg_uv_index')}, round(max(uv_index), 1) as max_uv_index,
               {avg('aerosol_optical_depth', 3, 'avg_aod')} from air_quality where uv_index is not null group by 1""",
    "a_aq_bands": f"""
        select {band_case('pm2_5', C.PM25_THREE_BANDS)} as air_quality_category, count(*) as hours,
               {avg('pm2_5', 1, 'avg_pm2_5')} from air_quality where pm2_5 is not null group by 1""",
    "a_gas_raw_summary": """
        select commodity, uom, count(*) as total_records, min(timestamp) as min_date, max(timestamp) as max_date,
               sum(kwh) as total_m3 from readings group by 1, 2""",
    "a_gas_sample_days": """
        select timestamp, kwh as m3, quality_code, duration_seconds / 86400.0 as duration_days from readings
        order by 1, 2, 3, 4 limit 5""",
    "a_gas_staged_summary": f"""
        select {COMMODITY} as commodity_type, count(*) as total_records, min(timestamp) as min_date,
               max(timestamp) as max_date, sum(kwh) as total_m3
        from readings where {COMMODITY} = 'natural_gas' group by 1""",
    "a_gas_quality_breakdown": f"""
        select {like_case('quality_code', C.GAS_CHECK_QUALITY_CODES)} as quality, count(*) as count,
               sum(kwh) as total_m3 from readings where commodity like '%VALUE_7%' group by 1""",
    "a_power_by_channel": f"""
        select device_id, channel, channel_name, {avg('watts', 2, 'mean_watts')}, round(min(watts), 2) as min_watts,
               round(max(watts), 2) as max_watts, count(*) as measurements from power group by 1, 2, 3""",
    # --- documented
    "d_daily_by_home": f"""
        select home_id, {DATE} as date, sum(kwh) as daily_kwh, sum(cost) / 100.0 as daily_cost_dollars,
               avg(kwh) as avg_hourly_kwh, max(kwh) as peak_hourly_kwh from {E} group by home_id, date""",
    "d_daily_metered": f"""
        select home_id, {DATE} as date, sum(kwh) as daily_kwh, sum(cost) as daily_cost_cents
        from {E} where source = 'green_button' group by home_id, date order by date desc, home_id limit 30""",
    "d_tou_analysis": f"""
        select home_id, tou_period, count(*) as hours, sum(kwh) as total_kwh, avg(kwh) as avg_kwh,
               sum(cost) / 100.0 as total_cost_dollars from {E} where tou_period is not null group by 1, 2""",
    "d_monthly_by_home": f"""
        select home_id, year, month, sum(kwh) as monthly_kwh, sum(cost) / 100.0 as monthly_cost_dollars,
               avg(kwh) as avg_hourly_kwh from {E} group by 1, 2, 3""",
    "d_quality_check": f"""
        select source, quality, estimated, count(*) as record_count, sum(kwh) as total_kwh from {E} group by 1, 2, 3""",
    "d_peak_hours": f"""
        select home_id, timestamp, kwh, tou_period,
               case when hour <= 6 then 'Night' when hour <= 11 then 'Morning' when hour <= 17 then 'Afternoon'
                    else 'Evening' end as time_of_day
        from {E} where kwh >= (select percentile_cont(0.95) within group (order by kwh) from {E})
        order by kwh desc, home_id, timestamp, tou_period nulls last limit 20""",
    "d_partition_daily": f"select {DATE} as date, sum(kwh) as daily_kwh from own_electricity group by 1",
    "d_heat_pump_cop": heat("n"),
    "d_solar_load_shape": f"""
        select hour, month, avg(kwh) as avg_kwh, min(kwh) as min_kwh, max(kwh) as max_kwh, stddev(kwh) as stddev_kwh
        from {E} where hour between 9 and 17 group by 1, 2""",
    "d_tou_vs_flat": f"""
        select *, tou_cost - flat_cost as tou_vs_flat_diff,
               case when tou_cost < flat_cost then 'TOU Better' else 'Flat Better' end as recommendation
        from (select {DATE} as date, sum(kwh) as daily_kwh,
                     sum(kwh * case tou_period when 'on_peak' then 0.187 when 'mid_peak' then 0.132
                         when 'off_peak' then 0.092 end::double) as tou_cost, sum(kwh) * 0.125 as flat_cost
              from {E} group by 1)""",
    "d_daily_carbon": carbon(
        f"""{DATE} as date, sum(kwh) as daily_kwh, sum(kwh * {INTENSITY}) / 1000.0 as daily_co2_kg,
            avg({INTENSITY}) as avg_grid_intensity""",
        "group by 1",
    ),
    "d_recent_since": "select * from readings where timestamp >= '2001-01-01'::timestamp",
    "d_daily_degree_days": f"""
        select {DAY} as date, sum(hdh) / 24.0 as hdd, sum(cdh) / 24.0 as cdd, sum(kwh) as daily_kwh,
               avg(temperature_c) as avg_temp_c from {W} group by 1""",
    "d_kwh_by_category": f"""
        select temperature_category, count(*) as hours, avg(kwh) as avg_kwh_per_hour, sum(kwh) as total_kwh
        from {W} where not missing_weather_data group by 1""",
    "d_kwh_by_season": f"""
        select hvac_season, count(*) as hours, avg(kwh) as avg_kwh, sum(kwh) as total_kwh from {W} group by 1""",
    "d_solar_daily": f"""
        select {DATE} as date, {avg('cloud_cover_pct', 0, 'avg_cloud_pct')}, {avg('ghi_wm2', 0, 'avg_ghi_wm2')},
               round(max(ghi_wm2), 0) as peak_ghi_wm2, round(sum(sunshine_duration_s) / 3600.0, 1) as sunshine_hours,
               {avg('kwh', 0, 'avg_kwh')} from {W} where hour(timestamp) between 6 and 20 group by 1""",
    "d_solar_hourly": f"""
        select timestamp, kwh as electricity_kwh, temperature_c, cloud_cover_pct, ghi_wm2, dni_wm2, dhi_wm2,
               sunshine_duration_s / 3600.0 as sunshine_hours, hvac_season from {W} where {DATE} = '1998-07-15'""",
    "d_sky_condition": f"""
        select {band_case('cloud_cover_pct', C.SKY_BANDS)} as sky_condition, count(*) as hours,
               {avg('ghi_wm2', 0, 'avg_ghi_wm2')}, {avg('kwh', 0, 'avg_kwh')}
        from {W} where hour(timestamp) between 10 and 16 group by 1""",
    "d_soiling_risk": f"""
        select {DATE} as date, {avg('aerosol_optical_depth', 3, 'avg_aod')}, {avg('dust', 1, 'avg_dust_ugm3')},
               count(*) filter (is_high_soiling_risk) as high_risk_hours, {avg('ghi_wm2', 0, 'avg_solar_wm2')}
        from {W} where {DATE} between '1998-06-01' and '1998-08-31' group by 1
        having avg_aod > 0.2 order by avg_aod desc, date limit 10""",
    "d_soiling_by_day": f"""
        select {DATE} as date, {avg('aerosol_optical_depth', 3, 'avg_aod')}, {avg('dust', 1, 'avg_dust')},
               {avg('pm2_5', 1, 'avg_pm2_5')}, count(*) as hours, {avg('ghi_wm2', 0, 'avg_solar_wm2')}
        from {W} where aerosol_optical_depth > 0.3 group by 1""",
    "d_hvac_by_pm25_all": f"""
        select pm2_5_category, count(*) as hours, {avg('kwh', 0, 'avg_kwh_per_hour')}, {avg('pm2_5', 1, 'avg_pm2_5')}
        from {W} where {SHOULDER} group by 1""",
    "d_uv_by_category": f"""
        select uv_category, count(*) as hours, {avg('temperature_c', 1, 'avg_temp_c')},
               {avg('kwh', 0, 'avg_kwh_per_hour')}, {avg('cdh', 1, 'avg_cooling_degree_hours')}
        from {W} where {SUMMER_DAYTIME} group by 1""",
    "d_uv_daily": f"""
        select {DATE} as date, {avg('uv_index', 1, 'avg_uv')}, round(max(uv_index), 1) as peak_uv,
               {avg('temperature_c', 1, 'avg_temp')}, round(sum(kwh), 0) as daily_kwh,
               round(sum(cdh) / 24.0, 1) as cooling_degree_days
        from {W} where month(timestamp) in (6, 7, 8) group by 1 order by avg_uv desc nulls last, date limit 20""",
    "d_filter_exposure": f"""
        select {MONTH} as month, count(*) as hours, {avg('pm2_5', 1, 'avg_pm2_5')}, {avg('pm10', 1, 'avg_pm10')},
               count(*) filter ({POOR}) as poor_air_hours, round(sum(pm2_5) / 1000.0, 2) as cumulative_pm2_5_mg
        from {W} group by 1""",
    "d_filter_exposure_hours": f"""
        select {MONTH} as month, {avg('pm2_5', 1, 'avg_pm2_5')}, round(max(pm2_5), 1) as peak_pm2_5,
               count(*) filter (pm2_5 > 35) as unhealthy_hours, round(sum(pm2_5) / 1000.0, 2) as cumulative_pm2_5_mg
        from {W} group by 1""",
    "d_poor_air_days": f"""
        select {DATE} as date, {avg('pm2_5', 1, 'avg_pm2_5')}, round(max(pm2_5), 1) as peak_pm2_5, pm2_5_category,
               {avg('temperature_c', 1, 'avg_temp_c')}, count(*) as hours
        from {W} where {POOR} group by date, pm2_5_category
        order by avg_pm2_5 desc, date, pm2_5_category limit 20""",
    # --- sources
    "src_espi_xml": f"select 'co-op' as home_id, point as usage_point_idx, place as meter_reading_idx, {READ_COLUMNS} from {FEED}",
    "src_espi_many": f"""
        select home_id, commodity, uom, meter_id, count(*) as n, sum(kwh) as kwh, max(point)::bigint as last_point
        from {FEED} group by 1, 2, 3, 4""",
    "src_meter_csv_wide": f"""
        select 'co-op' as home_id, 0 as usage_point_idx, 0 as meter_reading_idx,
               local + interval 5 hours as timestamp, 3600 as duration_seconds, kwh, kwh::bigint as raw_value,
               null::double as cost, 'VALIDATED' as quality_code,
               ({TOU_BUCKET.replace('(t)', '(local)')})::varchar as tou_bucket,
               'CommodityKindValue.VALUE_1' as commodity, 'UnitSymbolKindValue.VALUE_72' as uom,
               'ServiceKind.ELECTRICITY' as service_kind from {WIDE}""",
    "src_meter_id_from_path": "select l_suppkey::varchar as meter_id, count(*) as n from lineitem group by 1",
    "src_bills_electricity": "select * from bills_electricity",
    "src_bills_gas_water": "select * from bills_gas",
    "src_bills_multi": """
        select home_id, 'utility_bill_monthly_electricity' as table_name, count(*) as n, sum(total_kwh) as amount
        from bills_electricity group by 1
        union all
        select home_id, 'utility_bill_monthly_gas', count(*), sum(gas_m3) from bills_gas group by 1""",
    "src_power_parquet": "select * from power where watts >= 0",
    "src_weather_json": "select * from weather",
    "src_air_quality_json": "select * from air_quality",
    "src_grid_intensity": f"select * rename (hour as timestamp_hour) from grid where {INTENSITY} is not null",
    "src_dispatch_format": f"""
        select 'xml-home' as home_id, count(*) as n, sum(kwh) as kwh from readings
        union all select 'csv-home', count(*), sum(kwh) from {WIDE}""",
    "src_partitioned_lake": """
        select device_id, timestamp, kwh, meter_id_hash from fct_electricity
        where home_id = 'home-1' and year(timestamp) = 1998""",
    "src_empty_typed": "select 'green_button' as source, count(*) as n, sum(kwh) as kwh from stg_electricity",
    "src_weather_range": """
        select strftime(min(timestamp), '%Y-%m-%d') as start_date, strftime(max(timestamp), '%Y-%m-%d') as end_date
        from readings where home_id = 'home-1' and commodity = 'CommodityKindValue.VALUE_1'""",
    # --- sinks
    "sink_keyed_table": latest(
        "fct_gas",
        ["home_id", "device_id", "meter_id_hash", "timestamp"],
        ["source", "m3", "cost", "quality", "estimated"],
    ),
    "sink_keyed_table_parity": latest(
        "fct_gas",
        ["home_id", "timestamp"],
        ["source", "meter_id_hash", "device_id", "m3", "cost", "quality", "estimated"],
    ),
    "sink_export_many": " union all ".join(
        exported(f"own_{name}", f"fct_{name}_consumption", amount, rest)
        for name, amount, rest in [
            ("electricity", "kwh", ["kwh", "cost", "quality", "estimated", "tou_period"]),
            ("gas", "m3", ["source", "m3", "cost", "quality", "estimated"]),
            ("water", "m3", ["source", "m3", "raw_volume", "raw_unit", "cost", "quality", "estimated"]),
            ("utility", "quantity", ["quantity", "unit", "cost", "estimated"]),
        ]
    ),
    "sink_partitioned": "select * from power",
    "sink_csv": "select * from fct_water where home_id = 'home-1'",
    "sink_view_over_lake": """
        select 'gas' as view_name, count(*) as n, sum(cost) as cost from fct_gas
        union all select 'water', count(*), sum(cost) from fct_water""",
    "sink_arrow_types": """
        select event_id, value::float::double as value, (event_id % 100)::tinyint as small,
               '{"event_id":' || event_id || ',"user_id":' || user_id || '}' as ids,
               '[' || user_id || ',' || event_id || ']' as pair from events""",
    "sink_retention": """
        select * from power where timestamp >= (select max(timestamp) from power) - interval 10 days""",
    # --- merge
    "merge_upsert": f"""
        select * exclude (batch) from (
            select *, 0 as batch from keyed_readings
            union all
            select * replace (kwh + 1 as kwh), 1 from keyed_readings where l_orderkey % 2 = 0)
        qualify row_number() over (partition by {', '.join(READING_KEY)} order by batch desc, l_orderkey desc,
            l_partkey desc, {', '.join(c + ' desc nulls last' for c in READING_REST)}) = 1""",
    "incremental_hwm": """
        select p.* from power p
        join (select device_id, max(timestamp) as mark from power where timestamp < '2024-01-20'::timestamp group by 1)
            using (device_id)
        where p.timestamp > mark""",
    "incremental_marks": "select device_id, max(timestamp) as loaded_to from power group by 1",
    "insert_if_absent": f"""
        select * from readings where commodity <> {GAS_CODE} or year(timestamp) < 1998
        union all
        select * replace (null as cost) from readings f
        where commodity = {GAS_CODE} and not exists (
            select 1 from readings t where t.commodity = {GAS_CODE} and year(t.timestamp) < 1998
            and t.home_id = f.home_id and t.timestamp = f.timestamp)""",
    "merge_idempotency_check": " union all ".join(
        [stage("keyed_readings", "raw"), stage(_UNIFIED, "once"), stage(_UNIFIED, "twice")]
    ),
    # --- staging
    "decode_quality": f"select quality_code, count(*) as n, {QUALITY} as quality from readings group by 1",
    "flag_estimated": f"select quality_code, count(*) as n, {ESTIMATED} as estimated from readings group by 1",
    "decode_tou": f"select tou_bucket, count(*) as n, {TOU} as tou_period from readings group by 1",
    "decode_commodity": f"select commodity, count(*) as n, {COMMODITY} as commodity_type from readings group by 1",
    "decode_uom": f"""
        select uom, count(*) as n, {like_case('uom', C.UNIT_CODES)} as unit,
               {like_case('uom', C.WATER_UNIT_CODES)} as water_unit from readings group by 1""",
    "decode_commodity_inspect": f"""
        select commodity, uom, count(*) as n,
               {equal_case('commodity', C.DISPLAY_COMMODITIES, 'commodity')} as commodity_name,
               {equal_case('uom', C.DISPLAY_UNITS, 'uom')} as unit_name from readings group by 1, 2""",
    "stg_electricity": "select * from stg_electricity",
    "stg_gas": "select * from stg_gas",
    "stg_water": "select * from stg_water",
    "power_validate": "select *, quality <> 'valid' as is_invalid from stg_power",
    "stg_weather": "select * from stg_weather",
    "stg_air_quality": "select * from stg_air_quality",
    "dim_homes": """
        select *, null::varchar as address_anonymized, null::int as vintage, null::double as sqft,
               null::varchar as heat_type from homes""",
    "tou_bucket_schedule": f"""
        select month(t) as month, dayofweek(t) as dow, hour(t) as hour, ({TOU_BUCKET})::bigint as bucket,
               count(*) as n from (select timestamp as t from readings) group by 1, 2, 3, 4""",
    "filter_not_null": """
        select meter_id, timestamp, tou_bucket, cost from readings where tou_bucket is not null and cost is not null""",
    "filter_range": """
        select home_id, meter_id, timestamp, kwh from readings
        where home_id = 'home-2' and kwh between 1000 and 5000 and month(timestamp) in (6, 7, 8)
          and commodity like '%VALUE_1%' and not (tou_bucket is null or tou_bucket = '3')""",
    "anonymize": """
        select distinct home_id, sha256('pepper' || meter_id) as meter_id, null::varchar as address from readings""",
    # --- joins
    "join_dim_left": "select home_id, device_id, timestamp, m3, meter_id_hash from fct_gas",
    "join_dim_left_own_meter": """
        select home_id, usage_point_idx as device_id, ts as timestamp, m3, md5(meter_id) as meter_id_hash
        from stg_gas""",
    "join_month_subquery": f"""
        select e.year, e.month, electricity_rows, gas_m3
        from (select year, month, count(*) as electricity_rows from {E} group by 1, 2) e
        left join (select year, month, sum(m3) as gas_m3 from fct_gas group by 1, 2) g using (year, month)""",
    "join_anti": """
        select home_id, ts, kwh from stg_electricity e
        where not exists (select 1 from stg_gas g where g.home_id = e.home_id and g.ts = e.ts)""",
    "join_cross_rates": """
        select tou_period, count(*) as n,
               sum(kwh * case tou_period when 'on_peak' then 0.187 when 'mid_peak' then 0.132
                   when 'off_peak' then 0.092 end::double) as tou_cost from stg_electricity group by 1""",
    "join_date_left": heat("1"),
    "join_semi_threshold": f"""
        select home_id, count(*) as peak_hours, min(kwh) as lowest_peak from {E}
        where kwh >= (select percentile_cont(0.95) within group (order by kwh) from {E}) group by 1""",
    # --- aggregates
    "agg_hourly_power": "select * from power_hourly",
    "agg_hourly_power_thresholds": """
        select * replace (case when measurement_count >= 4 then 'high_quality' when measurement_count >= 2
                              then 'medium_quality' else 'low_quality' end as quality,
                          measurement_count < 2 as estimated) from power_hourly""",
    "agg_count_distinct": f"select count(distinct home_id) as homes, count(distinct {DAY}) as days from {E}",
    "agg_conditional": f"""
        select home_id, count(*) filter (kwh > 4) as above_four, count(*) filter (estimated) as estimated_rows
        from {E} group by 1""",
    "agg_corr": f"""
        select home_id, {corr('temperature_c', 'kwh', 'r')} from {W} where not missing_weather_data group by 1""",
    "agg_stddev": f"select home_id, source, stddev(kwh) as stddev_kwh from {E} group by 1, 2",
    "agg_percentile": """
        select percentile_cont(0.95) within group (order by kwh) as p95_kwh, count(*) as n from stg_electricity""",
    "agg_nullif": "select avg(nullif(clean_pct, 0)) as avg_clean_pct, count(clean_pct) as hours from grid",
    "agg_distinct_rows": f"select * from {HW}",
    "agg_having_alias": f"""
        select {DATE} as date, avg(aerosol_optical_depth) as avg_aod from {W} group by 1 having avg_aod > 0.2""",
    "agg_rollups": " union all ".join(rollup(g) for g in ("hour", "day", "week", "month", "year")),
    "agg_global": """
        select count(*) as n, sum(raw_volume) as raw_volume, min(timestamp) as first, max(timestamp) as last
        from fct_water""",
    # --- windows, sorting, unions
    "win_share_of_total": """
        select quality, count(*) as n, 100.0 * count(*) / sum(count(*)) over () as pct
        from stg_electricity group by 1""",
    "topk_recent": """
        select timestamp, commodity, kwh, cost, quality_code, tou_bucket from readings
        order by timestamp desc, commodity, kwh, cost nulls last, quality_code, tou_bucket nulls last limit 10""",
    "topk_group": f"select {DATE} as date, sum(kwh) as kwh from {E} group by 1 order by kwh desc, date limit 10",
    "sort_custom_rank": f"""
        select quality, count(*) as n,
               list_position({[name for _, name in C.QUALITY_CODES] + ['unknown']}, quality)::bigint as rank
        from stg_electricity group by 1""",
    "topk_per_branch_union": f"""
        (select 'electricity' as commodity, timestamp, kwh as quantity, 'kWh' as unit, cost, estimated from {E}
         order by timestamp desc, quantity, cost nulls last, estimated limit 20)
        union all
        (select 'natural_gas', timestamp, m3 as quantity, 'm³', cost, estimated from fct_gas
         order by timestamp desc, quantity, cost nulls last, estimated limit 20)""",
    "union_sources": "select * from all_electricity",
    "union_commodities": """
        select commodity, unit, month_start, count(*) as n, sum(cost) as cost from fct_utility group by 1, 2, 3""",
    # --- scalar functions
    "convert_units": """
        select meter_id, timestamp, kwh, kwh / 1000.0 as as_kwh, kwh / 264.172 as as_m3, kwh * 264.172 as as_gallons,
               kwh * 1000 as as_liters, cost / 100.0 as dollars from readings""",
    "gas_to_thermal_kwh": "select meter_id, ts, m3 * 10.55 * 0.95 as thermal_kwh from stg_gas",
    "degree_hours": """
        select timestamp, greatest(18 - coalesce(temperature_c, 18), 0) as hdh,
               greatest(coalesce(temperature_c, 18) - 18, 0) as cdh,
               case when temperature_c < 18 then 'heating' when temperature_c > 22 then 'cooling' else 'shoulder' end
                   as hvac_season from weather""",
    # --- streaming
    "st_ingest": "select * from power",
    "st_dedupe": latest("power", ["home_id", "device_id", "timestamp"], ["watts"]),
    "st_upsert": "select * exclude (batch, event_id) from "
    f"({latest('deliveries', ['home_id', 'device_id', 'channel', 'timestamp'], ['batch', 'channel_name', 'watts', 'volts'])})",
    "st_hourly_power": "select * from power_hourly",
    "st_hour_join": f"""
        select e.home_id, e.usage_point_idx::varchar as device_id, e.ts as timestamp, e.kwh, w.temperature_c,
               case when temperature_c < 18 then 'heating' when temperature_c > 22 then 'cooling'
                    else 'shoulder' end as hvac_season, a.pm2_5
        from stg_electricity e left join stg_weather w on w.hour = date_trunc('hour', e.ts)
        left join stg_air_quality a on a.hour = w.hour and a.location_name = w.location_name""",
    "st_charge_sessions": f"""
        select home_id, device_id, channel, min(timestamp) as started, max(timestamp) as ended,
               (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 60e6 as minutes, avg(watts) as avg_watts,
               count(*) as measurements
        from {CHARGE} group by home_id, device_id, channel, session
        having max(timestamp) - min(timestamp) >= interval 15 minutes""",
    "st_late_data": """
        select date_trunc('hour', timestamp) as hour, count(*) filter (late is not true) as accepted,
               count(*) filter (late) as late from marked group by 1""",
    "st_late_kept": "select * exclude (event_id, late) from marked where late",
    "st_late_restored": """
        select home_id, device_id, channel, channel_name, date_trunc('hour', timestamp) as timestamp,
               avg(watts) / 1000.0 as kwh, avg(watts) as avg_watts, avg(volts) as avg_volts, avg(amps) as avg_amps,
               avg(power_factor) as avg_power_factor, count(*) as measurement_count,
               case when count(*) >= 360 then 'high_quality' when count(*) >= 60 then 'medium_quality'
                    else 'low_quality' end as quality, count(*) < 60 as estimated
        from deliveries where watts >= 0 and watts <= 50000 and (volts is null or volts between 100 and 140) group by 1, 2, 3, 4, 5""",
    "st_hours_dropped": "select date_trunc('hour', timestamp) as hour, count(*) as accepted from power group by 1",
    # --- tariffs and weather-normal use
    "d_tiered_cost": """
        select home_id, ts, meter_id, meter_reading_idx, sum(kwh) as kwh, round(sum(
                   least(used + kwh, 600) * 10.5 + greatest(used + kwh - 600, 0) * 12.8
                   - least(used, 600) * 10.5 - greatest(used - 600, 0) * 12.8), 4) as tiered_cents
        from tiers group by 1, 2, 3, 4""",
    "d_plan_comparison": """
        select *, case when tiered_cents <= tou_cents then 'tiered' else 'tou' end as cheaper from (
            select home_id, date_trunc('month', ts)::timestamp as month, sum(kwh) as kwh,
                   round((sum(least(used + kwh, 600) * 10.5 + greatest(used + kwh - 600, 0) * 12.8
                              - least(used, 600) * 10.5 - greatest(used - 600, 0) * 12.8) + sum(kwh) * 7.0::double) * 1.13::double, 2) as tiered_cents,
                   round((sum(kwh * case tou_period when 'on_peak' then 18.7::double when 'mid_peak' then 13.2 else 9.2 end)
                          + sum(kwh) * 7.0::double) * 1.13::double, 2) as tou_cents
            from tiers group by 1, 2)""",
    "d_weather_baseline": """
        select home_id, days, balance, round(baseline, 6) as baseline, round(kwh_per_degree_day, 6) as kwh_per_degree_day,
               round(r2, 6) as r2, round(error, 6) as error from models""",
    "d_unusual_days": """
        select home_id, date, kwh, temperature, round(expected, 6) as expected_kwh, round(sigmas, 6) as sigmas
        from (select *, (kwh - expected) / nullif(error, 0) as sigmas from (
                  select d.*, m.error, m.baseline + m.kwh_per_degree_day * greatest(m.balance - d.temperature, 0) as expected
                  from days d join models m on m.home_id = d.home_id))
        where abs(sigmas) > 2""",
    # --- data quality
    "dq_not_null": " union all ".join(
        [
            nulls("green_button_interval_readings", "readings"),
            nulls("power_monitoring", "power"),
            nulls("weather_hourly", "weather"),
            nulls("air_quality_hourly", "air_quality"),
        ]
    ),
    "dq_power_counts": """
        select count(*) as total, count(*) filter (watts < 0) as negative_watts,
               count(*) filter (watts > 50000) as above_limit from power""",
    "dq_join_completeness": f"""
        select count(*) as total_records, count(temperature_c) as with_weather,
               count(*) - count(temperature_c) as missing_weather, count(pm2_5) as with_air_quality,
               100.0 * count(temperature_c) / count(*) as pct_with_weather from {W}""",
    "dq_value_ranges": """
        select count(*) as hours, min(cloud_cover_pct) as min_cloud_pct, max(cloud_cover_pct) as max_cloud_pct,
               count(*) filter (cloud_cover_pct < 0 or cloud_cover_pct > 100) as cloud_out_of_range,
               max(sunshine_duration_s) as max_sunshine_s,
               count(*) filter (sunshine_duration_s > 3600) as sunshine_out_of_range, max(ghi_wm2) as peak_ghi_wm2,
               count(*) filter (cloud_cover_pct < 20 and dni_wm2 < dhi_wm2) as clear_hours_dni_below_dhi,
               count(*) filter (cloud_cover_pct >= 80 and dni_wm2 > dhi_wm2) as cloudy_hours_dni_above_dhi
        from weather""",
}
_METERS = "(select home_id, count(*) as fan_out from homes group by 1) k"
SQL["join_hour_location_left"] = f"""
    select u.home_id, u.device_id, u.timestamp, w.location_name, w.temperature_c, a.pm2_5, a.aqi_category, k.fan_out
    from all_electricity u
    left join stg_weather w on w.hour = date_trunc('hour', u.timestamp)
    left join stg_air_quality a on a.hour = w.hour and a.location_name = w.location_name
    left join {_METERS} on k.home_id = u.home_id"""
SQL["join_hour_left"] = f"""
    select u.home_id, u.device_id, u.timestamp, g.{INTENSITY}, g.total_mw as grid_total_mw, k.fan_out
    from all_electricity u
    left join grid g on g.hour = date_trunc('hour', u.timestamp) and g.{INTENSITY} is not null
    left join {_METERS} on k.home_id = u.home_id"""
SQL["merge_bucketed"] = SQL["merge_upsert"]
SQL["agg_sketch_rollups"] = " union all ".join(
    f"""select '{grain}' as grain, date_trunc('{grain}', timestamp)::timestamp as period_start, count(*) as row_count,
               count(distinct meter_id) as meters, count(distinct home_id) as homes, true as meters_close, true as homes_close
        from readings group by 2"""
    for grain in ("day", "month", "year")
)
SQL["union_summaries"] = SQL["q_total_by_commodity"]
for _name in ("electricity", "gas", "water", "utility", "carbon", "weather"):
    SQL[f"fct_{_name}"] = f"select * from fct_{_name}"

_META = "quality, home_id, source, meter_id_hash, estimated"
_ALWAYS_NULL = "co2_g_per_kwh, rate_cents_per_kwh"
_H = "year, month, day, hour, day_of_week"
SQL["extract_electricity"] = f"select timestamp, kwh, cost, tou_period, {_META}, {_ALWAYS_NULL}, {_H} from {E}"
SQL["extract_gas"] = "select * exclude (device_id) from fct_gas"
SQL["extract_water"] = "select * exclude (device_id) from fct_water"
SQL["extract_carbon"] = "select * exclude (device_id) from fct_carbon"
SQL["extract_weather"] = "select * exclude (device_id) from fct_weather"
SQL["extract_hourly_weather"] = f"select * from {HW}"

# Sums of amounts that are not exact binary fractions depend on the order of the rows in their
# last bits. Both sides round these columns to the given digits.
ROUNDED = {
    "q_total_by_commodity": {"total_consumption": 4},
    "union_summaries": {"total_consumption": 4},
    "q_recent_readings": {"quantity": 6},
    "topk_per_branch_union": {"quantity": 6},
    "q_elec_daily": {"total_kwh": 4},
    "q_elec_recent_168": {"kwh": 6},
    "q_elec_monthly": {"total_kwh": 4, "avg_kwh_per_reading": 6},
    "q_water_monthly": {"total_m3": 4, "total_gallons": 3, "avg_m3_per_reading": 6},
    "q_water_yearly": {"total_m3": 4, "total_gallons": 3},
    "q_carbon_summary": {"total_kg_co2e": 7, "total_tonnes_co2e": 8, "total_mwh": 6},
    "q_carbon_daily": {"kg_co2e": 7},
    "q_carbon_monthly": {"kg_co2e": 7, "tonnes_co2e": 8},
    "q_carbon_hour_of_day": {"total_kg_co2e": 7},
    "d_daily_by_home": {"daily_kwh": 5, "avg_hourly_kwh": 6, "peak_hourly_kwh": 6},
    "d_monthly_by_home": {"monthly_kwh": 4, "avg_hourly_kwh": 6},
    "d_quality_check": {"total_kwh": 4},
    "d_peak_hours": {"kwh": 6},
    "d_partition_daily": {"daily_kwh": 5},
    "d_heat_pump_cop": {"hvac_kwh": 4, "estimated_cop": 8},
    "join_date_left": {"hvac_kwh": 4, "estimated_cop": 8},
    "d_solar_load_shape": {"avg_kwh": 6, "min_kwh": 6, "max_kwh": 6, "stddev_kwh": 6},
    "d_tou_vs_flat": {"daily_kwh": 4, "tou_cost": 7, "flat_cost": 7, "tou_vs_flat_diff": 7},
    "d_daily_degree_days": {"daily_kwh": 4},
    "d_kwh_by_category": {"avg_kwh_per_hour": 6},
    "d_kwh_by_season": {"avg_kwh": 6, "total_kwh": 4},
    "join_cross_rates": {"tou_cost": 7},
    "join_semi_threshold": {"lowest_peak": 6},
    "agg_hourly_power": {"kwh": 6, "avg_watts": 4},
    "agg_hourly_power_thresholds": {"kwh": 6, "avg_watts": 4},
    "agg_stddev": {"stddev_kwh": 6},
    "topk_group": {"kwh": 4},
    "union_sources": {"kwh": 6},
    "fct_electricity": {"kwh": 6},
    "fct_carbon": {"kwh": 6},
    "fct_weather": {"kwh": 6},
    "extract_electricity": {"kwh": 6},
    "extract_carbon": {"kwh": 6},
    "extract_weather": {"kwh": 6},
    "st_hourly_power": {"kwh": 6, "avg_watts": 4},
    "st_charge_sessions": {"avg_watts": 4},
    "st_late_restored": {"kwh": 6, "avg_watts": 4},
    "d_daily_carbon": {"daily_kwh": 4, "daily_co2_kg": 7},
}


def statement(key: str) -> str:
    sql = SQL[key]
    digits = ROUNDED.get(key)
    if digits:
        parts = ", ".join(f"round({c}, {d}) as {c}" for c, d in digits.items())
        sql = f"select * replace ({parts}) from ({sql.strip()})"
    return with_relations(sql)
