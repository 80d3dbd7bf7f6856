"""Shared relations as SQL, and the WITH clause that a query needs.

The facts are spelled out with repeated rows (one per reading and meter of the home), unlike the
weighted facts of the library.
"""

import re

from oracle import literals as C


def like_case(column, codes, default="'unknown'"):
    whens = " ".join(f"when {column} like '%{code}%' then '{name}'" for code, name in codes)
    return f"case {whens} else {default} end"


def equal_case(column, codes, default):
    whens = " ".join(f"when '{code}' then '{name}'" for code, name in codes)
    return f"case {column} {whens} else {default} end"


def band_case(column, bands, op="<", missing=None):
    first = f"when {column} is null then '{missing}' " if missing else ""
    whens = " ".join(f"when {column} {op} {bound} then '{name}'" for bound, name in bands[:-1])
    return f"case {first}{whens} else '{bands[-1][1]}' end"


def names(columns, prefix=""):
    return ", ".join(prefix + c for c in columns)


def dated(ts):
    return (
        f"date_trunc('hour', {ts}) as hour, date_trunc('day', {ts})::timestamp as date, "
        f"year({ts}) as year, month({ts}) as month, day({ts}) as day, "
        f"hour({ts}) as hour_of_day, dayofweek({ts}) as day_of_week"
    )


PARTS = "year(timestamp) as year, month(timestamp) as month, day(timestamp) as day"
HOUR_PARTS = PARTS + ", hour(timestamp) as hour, dayofweek(timestamp) as day_of_week"
WEATHER = list(C.WEATHER_FIELDS.values())
AIR = ["pm2_5", "pm10", "dust", "uv_index", "aerosol_optical_depth", "european_aqi"]
AIR_LABELS = ["pm2_5_category", "aqi_category", "uv_category", "is_high_pollution", "is_high_soiling_risk"]
QUALITY = like_case("quality_code", C.QUALITY_CODES)
ESTIMATED = "coalesce(regexp_matches(quality_code, 'ESTIMATED|DERIVED|PROJECTED'), false)"
COMMODITY = like_case("commodity", C.COMMODITY_CODES)
TOU = equal_case("tou_bucket", C.TOU_PERIODS, "null")

_ghi = "greatest(0, 600 - abs(h - 12) * 100)"


def _staged(kind, amount, water=False, tou=False):
    units = C.WATER_UNIT_CODES if water else C.UNIT_CODES
    extra = f"{TOU} as tou_period, tou_bucket as tou_bucket_raw, " if tou else ""
    return (
        "select home_id, usage_point_idx, meter_reading_idx, meter_id, timestamp as ts, duration_seconds, "
        f"{amount}, raw_value, cost as cost_cents, {QUALITY} as quality, {ESTIMATED} as estimated, {extra}"
        f"{COMMODITY} as commodity_type, {like_case('uom', units)} as unit, service_kind, "
        "quality_code as quality_code_raw, commodity as commodity_raw, uom as uom_raw "
        f"from readings where {COMMODITY} = '{kind}'"
    )


def _metered(staging, amount, extra=""):
    return (
        "select 'green_button' as source, s.home_id, h.meter_id_hash, s.usage_point_idx as device_id, "
        f"s.ts as timestamp, {amount}, s.cost_cents as cost, s.quality, s.estimated{extra} "
        f"from {staging} s left join homes h on s.home_id = h.home_id"
    )


#: Number of the batch that brings an event.
_ARRIVAL = """greatest(0, least(5, floor(date_diff('day', date '2024-01-01', timestamp::date) / 5)::int))
                   + case when event_id % 17 = 0 then 2 else 0 end"""

RELATIONS = {
    # --- raw tables
    "keyed_readings": """
        select concat('home-', cast(floor(l_suppkey / 4) as bigint)) as home_id,
               l_suppkey::int as usage_point_idx, l_linenumber::int as meter_reading_idx,
               l_shipdate + (l_orderkey % 24) * interval '1' hour as timestamp, 3600 as duration_seconds,
               (cast(l_quantity as bigint) * 125)::double as kwh, cast(l_quantity as bigint) * 125 as raw_value,
               floor(l_extendedprice)::double as cost,
               'QualityOfReading.' || case l_returnflag || l_linestatus when 'AF' then 'VALIDATED'
                   when 'AO' then 'MANUAL' when 'NF' then 'ESTIMATED' when 'NO' then 'DERIVED'
                   when 'RF' then 'PROJECTED' when 'RO' then 'VALUE_14' end as quality_code,
               case when l_partkey % 4 <> 0 then cast(l_partkey % 4 as varchar) end as tou_bucket,
               'CommodityKindValue.' || case l_suppkey % 4 when 2 then 'VALUE_7' when 3 then 'VALUE_2'
                   else 'VALUE_1' end as commodity,
               'UnitSymbolKindValue.' || case when l_suppkey % 4 < 2 then 'VALUE_72'
                   when l_suppkey % 4 = 3 and l_linenumber % 2 = 1 then 'VALUE_119' else 'VALUE_42' end as uom,
               null::varchar as service_kind, concat('meter-', l_suppkey) as meter_id, l_orderkey, l_partkey
        from lineitem""",
    "readings": "select * exclude (l_orderkey, l_partkey) from keyed_readings",
    "keyed_power": """
        select concat('home-', user_id % 3) as home_id, event_type as device_id, user_id % 2 as channel,
               concat('ch', user_id % 2) as channel_name, ts as timestamp, value * 150 - 500 as watts,
               case when event_id % 17 <> 0 then (95 + event_id % 50)::double end as volts,
               1.0::double as amps, 0.875::double as power_factor, event_id
        from events""",
    "power": "select * exclude (event_id) from keyed_power",
    "deliveries": f"""
        select *, {_ARRIVAL} as batch from keyed_power
        union all select *, {_ARRIVAL} + 1 as batch from corrected_power where event_id % 13 = 0""",
    "marked": """
        select d.*, date_trunc('hour', timestamp) + interval 1 hour <= m.latest - interval 10 minutes as late
        from deliveries d
        left join (select b.batch, max(e.timestamp) as latest from (select distinct batch from deliveries) b
                   join deliveries e on e.batch < b.batch group by 1) m on m.batch = d.batch""",
    "days": """
        select home_id, s.date, kwh, temperature from
            (select home_id, ts::date as date, sum(kwh) as kwh from stg_electricity group by 1, 2) s
            join (select ts::date as date, avg(temperature_c) as temperature from stg_weather group by 1) w on s.date = w.date""",
    "fits": """
        select home_id, balance, count(*) as days, regr_slope(kwh, x) as slope, regr_intercept(kwh, x) as intercept,
               regr_r2(kwh, x) as r2, regr_syy(kwh, x) as syy
        from (select *, greatest(balance - temperature, 0.0::double) as x from days, (values (12.0::double), (15.0), (18.0), (21.0)) b(balance))
        group by 1, 2""",
    "models": """
        select home_id, days, balance, intercept as baseline, slope as kwh_per_degree_day, r2,
               sqrt(greatest(syy * (1 - r2), 0) / (days - 2)) as error
        from fits where days > 2 and r2 is not null and not isnan(r2)
        qualify row_number() over (partition by home_id order by round(r2, 9) desc, balance) = 1""",
    "tiers": """
        select *, coalesce(sum(kwh) over (partition by home_id, date_trunc('month', ts)
                      order by ts, meter_id, meter_reading_idx, kwh rows between unbounded preceding and 1 preceding), 0) as used
        from stg_electricity""",
    "hours": """
        select distinct date_trunc('hour', timestamp) as timestamp, dayofyear(timestamp) as d, hour(timestamp) as h
        from readings""",
    "weather": f"""
        select 'toronto' as location_name, 43.65::double as latitude, -79.38::double as longitude,
               76.0::double as elevation_m, 'America/Toronto' as timezone, timestamp,
               case when d % 53 = 0 then null when d % 61 = 0 then 99.0
                    else 22 - abs(d - 200) / 4.0 + h % 5 end::double as temperature_c,
               (40 + (d + h) % 60)::double as humidity_pct, ((d * h) % 8 / 4.0)::double as precipitation_mm,
               ((d + 3 * h) % 50)::double as windspeed_kmh,
               ((d * 7 + h) % 101)::double as cloud_cover_pct, ((d * 7 + h) % 101)::double as cloud_cover_low_pct,
               ((d * 7 + h) % 101)::double as cloud_cover_mid_pct, ((d * 7 + h) % 101)::double as cloud_cover_high_pct,
               ({_ghi})::double as ghi_wm2, ({_ghi} / 2.0)::double as dni_wm2, ({_ghi} / 2.0)::double as dhi_wm2,
               ({_ghi} / 2.0)::double as direct_horizontal_wm2,
               least(3600, {_ghi} * 8)::double as sunshine_duration_s
        from hours""",
    "air_quality": """
        select location_name, 43.65::double as latitude, -79.38::double as longitude, timezone, timestamp,
               (pm + 5)::double as pm10, pm::double as pm2_5, ((d + h) % 40)::double as dust,
               other as ozone, other as nitrogen_dioxide, other as sulphur_dioxide, other as carbon_monoxide,
               uv as uv_index, uv as uv_index_clear_sky, ((d * 3 + h) % 60 / 64.0)::double as aerosol_optical_depth,
               aqi as european_aqi, aqi as european_aqi_pm2_5, aqi as european_aqi_pm10,
               aqi as european_aqi_nitrogen_dioxide, aqi as european_aqi_ozone, aqi as european_aqi_sulphur_dioxide
        from (select *, 'toronto' as location_name, 'America/Toronto' as timezone,
                     case when d % 41 = 0 then null when d % 97 = 0 then -1 else (d * 7 + h * 3) % 180 end as pm,
                     (case when h between 6 and 20 then d % 13 else 0 end)::double as uv,
                     ((d * 5 + h) % 130)::double as aqi, ((d + h) % 100)::double as other
              from hours where d % 29 <> 0)""",
    "grid": """
        select timestamp as hour,
               case when d % 67 <> 0 then 16 + (d * 3 + h * 5) % 90 end::double as co2e_intensity_gco2_per_kwh,
               ((d + h) % 101)::double as clean_pct, t::double as total_mw, t / 2.0::double as nuclear_mw,
               t / 16.0::double as gas_mw, t / 4.0::double as hydro_mw, t / 8.0::double as wind_mw,
               t / 32.0::double as solar_mw, t / 32.0::double as biofuel_mw,
               h % 2 = 0 as has_ieso, h % 3 = 0 as has_gridwatch
        from (select *, 15000 + 100 * h as t from hours)""",
    "months": """
        select concat('home-', o_custkey % 3) as home_id, last_day(o_orderdate) as month_end_date, count(*) as n,
               sum(floor(o_totalprice))::double as cost
        from orders group by all""",
    "bills_electricity": """
        select home_id, month_end_date, (n * 8)::double as total_kwh, (n * 4)::double as off_peak_kwh,
               (n * 2)::double as mid_peak_kwh, (n * 2)::double as on_peak_kwh, cost as total_cost,
               0.0625::double as off_peak_rate, 0.125::double as mid_peak_rate, 0.1875::double as on_peak_rate
        from months""",
    "bills_gas": """
        select home_id, month_end_date, n::double as gas_m3, cost as gas_cost,
               case when n % 2 = 0 then n * 2 end::double as water_m3,
               case when n % 2 = 0 then n * 4 end::double as water_cost
        from months""",
    # --- staging
    "stg_electricity": _staged("electricity", "kwh / 1000.0 as kwh", tou=True),
    "stg_gas": _staged("natural_gas", "kwh as m3"),
    "stg_water": _staged("water", "kwh as volume", water=True),
    "stg_power": f"""
        select * rename (timestamp as ts),
               case when watts < 0 then 'invalid_negative' when watts > 50000 then 'invalid_high'
                    when volts < 100 or volts > 140 then 'voltage_out_of_range' else 'valid' end as quality
        from power""",
    "power_hourly": """
        select home_id, device_id, channel, channel_name, date_trunc('hour', ts) as timestamp,
               avg(watts) / 1000.0 as kwh, avg(watts) as avg_watts, avg(volts) as avg_volts, avg(amps) as avg_amps,
               avg(power_factor) as avg_power_factor, count(*) as measurement_count,
               case when count(*) >= 360 then 'high_quality' when count(*) >= 60 then 'medium_quality'
                    else 'low_quality' end as quality,
               count(*) < 60 as estimated
        from stg_power where quality = 'valid' group by 1, 2, 3, 4, 5""",
    "stg_weather": f"""
        select location_name, latitude, longitude, elevation_m, timezone, timestamp as ts, {dated('timestamp')},
               {names(WEATHER)}, 'valid' as quality,
               temperature_c >= -40 and temperature_c <= 40 as is_valid_temperature,
               {band_case('temperature_c', C.TEMPERATURE_BANDS)} as temperature_category
        from weather where temperature_c between -50 and 60""",
    "stg_air_quality": f"""
        select * from (
            select location_name, latitude, longitude, timezone, timestamp as ts, {dated('timestamp')},
                   {names(C.AIR_QUALITY_FIELDS)},
                   {band_case('pm2_5', C.PM25_BANDS, missing='unknown')} as pm2_5_category,
                   {band_case('european_aqi', C.AQI_BANDS, '<=', 'unknown')} as aqi_category,
                   {band_case('uv_index', C.UV_BANDS, missing='unknown')} as uv_category,
                   case when pm2_5 is null and pm10 is null then 'missing_pm'
                        when pm2_5 < 0 or pm10 < 0 then 'invalid_pm' when european_aqi < 0 then 'invalid_aqi'
                        else 'valid' end as quality,
                   coalesce(pm2_5 > 35 or european_aqi > 60, false) as is_high_pollution,
                   coalesce(aerosol_optical_depth > 0.3 or dust > 20, false) as is_high_soiling_risk
            from air_quality)
        where quality <> 'invalid_pm' and quality <> 'invalid_aqi'""",
    "homes": "select distinct home_id, meter_id, md5(meter_id) as meter_id_hash from readings",
    # --- marts
    "all_electricity": """
        select 'green_button' as source, home_id, usage_point_idx::varchar as device_id, ts as timestamp, kwh,
               cost_cents as cost, quality, estimated, tou_period
        from stg_electricity
        union all
        select 'power_monitoring', home_id, device_id || '_ch' || channel, timestamp, kwh, null, quality, estimated,
               null
        from power_hourly""",
    "fct_electricity": f"""
        select source, u.home_id, h.meter_id_hash, device_id, timestamp, kwh, cost, quality, estimated, tou_period,
               null::double as co2_g_per_kwh, null::double as rate_cents_per_kwh, {HOUR_PARTS}
        from all_electricity u
        left join homes h on u.home_id = h.home_id""",
    "fct_gas": f"""
        select *, null::double as avg_outdoor_temp_c, null::double as heating_degree_days,
               null::double as rate_cents_per_m3, {PARTS}
        from ({_metered('stg_gas', 's.m3')})""",
    "own_electricity": f"""
        select 'green_button' as source, home_id, md5(meter_id) as meter_id_hash, usage_point_idx::varchar as device_id,
               ts as timestamp, kwh, cost_cents as cost, quality, estimated, tou_period,
               null::double as co2_g_per_kwh, null::double as rate_cents_per_kwh, {HOUR_PARTS}
        from stg_electricity
        union all
        select 'power_monitoring', home_id, null, device_id || '_ch' || channel, timestamp, kwh, null, quality, estimated,
               null, null, null, {HOUR_PARTS}
        from power_hourly""",
    "own_gas": f"""
        select *, null::double as avg_outdoor_temp_c, null::double as heating_degree_days,
               null::double as rate_cents_per_m3, {PARTS}
        from (select 'green_button' as source, home_id, md5(meter_id) as meter_id_hash, usage_point_idx as device_id,
                     ts as timestamp, m3, cost_cents as cost, quality, estimated from stg_gas)""",
    "own_water": f"""
        select *, null::double as rate_cents_per_m3, null::double as rate_cents_per_gal, {PARTS},
               m3 * 264.172 as gallons, m3 * 1000 as liters
        from (select 'green_button' as source, home_id, md5(meter_id) as meter_id_hash, usage_point_idx as device_id,
                     ts as timestamp, case unit when 'gal' then volume / 264.172 else volume end as m3,
                     volume as raw_volume, unit as raw_unit, cost_cents as cost, quality, estimated from stg_water)""",
    "own_utility": """
        select home_id, timestamp, 'electricity' as commodity, kwh as quantity, 'kWh' as unit, cost, estimated, year, month
        from own_electricity where source = 'green_button'
        union all
        select home_id, timestamp, 'natural_gas', m3, 'm³', cost, estimated, year, month from own_gas
        union all
        select home_id, timestamp, 'water', m3, 'm³', cost, estimated, year, month from own_water""",
    "fct_water": f"""
        select *, null::double as rate_cents_per_m3, null::double as rate_cents_per_gal, {PARTS},
               m3 * 264.172 as gallons, m3 * 1000 as liters
        from ({_metered('stg_water', "case s.unit when 'gal' then s.volume / 264.172 else s.volume end as m3, "
                        "s.volume as raw_volume, s.unit as raw_unit")})""",
    "fct_carbon": f"""
        select e.* exclude (co2_g_per_kwh, rate_cents_per_kwh), g.co2e_intensity_gco2_per_kwh,
               g.clean_pct as grid_clean_pct, e.kwh * g.co2e_intensity_gco2_per_kwh / 1000 as kg_co2e,
               e.kwh * g.co2e_intensity_gco2_per_kwh as g_co2e,
               {", ".join(f"g.{c} as grid_{c}" for c in ["total_mw", *C.GRID_MIX])},
               g.has_ieso as grid_has_ieso_data, g.has_gridwatch as grid_has_gridwatch_data
        from fct_electricity e
        left join grid g on g.hour = date_trunc('hour', e.timestamp) and g.co2e_intensity_gco2_per_kwh is not null""",
    "fct_weather": f"""
        select e.*, w.location_name, {names(WEATHER, 'w.')}, w.temperature_category,
               case when temperature_c < 18 then 'heating' when temperature_c > 22 then 'cooling'
                    else 'shoulder' end as hvac_season,
               case when temperature_c < 18 then 18 - temperature_c else 0 end as hdh,
               case when temperature_c > 18 then temperature_c - 18 else 0 end as cdh,
               {names(AIR + AIR_LABELS, 'a.')},
               w.temperature_c is null as missing_weather_data, a.pm2_5 is null as missing_air_quality_data
        from fct_electricity e
        left join stg_weather w on w.hour = date_trunc('hour', e.timestamp)
        left join stg_air_quality a
            on a.hour = date_trunc('hour', e.timestamp) and a.location_name = w.location_name""",
    "fct_utility": """
        select *, date_trunc('month', timestamp)::timestamp as month_start,
               date_trunc('year', timestamp)::timestamp as year_start
        from (select home_id, timestamp, 'electricity' as commodity, kwh as quantity, 'kWh' as unit, cost, estimated,
                     year, month from fct_electricity where source = 'green_button'
              union all
              select home_id, timestamp, 'natural_gas', m3, 'm³', cost, estimated, year, month from fct_gas
              union all
              select home_id, timestamp, 'water', m3, 'm³', cost, estimated, year, month from fct_water)""",
    "hourly_weather": f"""
        select distinct timestamp, location_name,
               {names([c for c in WEATHER if c != 'direct_horizontal_wm2'])}, temperature_category,
               {names(AIR)}, pm2_5_category, aqi_category, uv_category, year, month, day, hour, day_of_week
        from fct_weather where temperature_c is not null""",
}

RELATIONS["corrected_power"] = RELATIONS["keyed_power"].replace("value * 150", "(value + 0.5::double) * 150")

_WORD = re.compile(r"\b[a-z_]\w*\b")


def _needs(sql):
    return [name for name in dict.fromkeys(_WORD.findall(sql)) if name in RELATIONS]


def with_relations(sql):
    """The query with the definitions of all shared relations it mentions, directly or not.

    A relation is referred to by name; a column of the same name only adds an unused definition.
    """
    ordered = []

    def visit(text, inside):
        for name in _needs(text):
            if name not in inside and name not in ordered:
                visit(RELATIONS[name], inside | {name})
                ordered.append(name)

    visit(sql, frozenset())
    clauses = [f"{name} as ({RELATIONS[name].strip()})" for name in ordered]
    return (f"with {', '.join(clauses)} " if clauses else "") + sql.strip()
