"""Fixed values of the SQL side, written out on their own: codes, names, bands and column lists."""

AIR_QUALITY_FIELDS = ["pm10",
 "pm2_5",
 "dust",
 "ozone",
 "nitrogen_dioxide",
 "sulphur_dioxide",
 "carbon_monoxide",
 "uv_index",
 "uv_index_clear_sky",
 "aerosol_optical_depth",
 "european_aqi",
 "european_aqi_pm2_5",
 "european_aqi_pm10",
 "european_aqi_nitrogen_dioxide",
 "european_aqi_ozone",
 "european_aqi_sulphur_dioxide"]
AQI_BANDS = [(20, "good"), (40, "fair"), (60, "moderate"), (80, "poor"), (100, "very_poor"), (None, "extremely_poor")]
COMMODITY_CODES = [("VALUE_1", "electricity"), ("VALUE_7", "natural_gas"), ("VALUE_2", "water")]
DISPLAY_COMMODITIES = [("CommodityKindValue.VALUE_0", "not-applicable"),
 ("CommodityKindValue.VALUE_1", "electricity"),
 ("CommodityKindValue.VALUE_2", "natural-gas"),
 ("CommodityKindValue.VALUE_7", "natural-gas"),
 ("CommodityKindValue.VALUE_9", "water")]
DISPLAY_UNITS = [("UnitSymbolKindValue.VALUE_42", "m³"), ("UnitSymbolKindValue.VALUE_72", "Wh")]
GAS_CHECK_QUALITY_CODES = [("VALIDATED", "validated"), ("ESTIMATED", "estimated"), ("MISSING", "missing")]
GRID_MIX = ["nuclear_mw", "gas_mw", "hydro_mw", "wind_mw", "solar_mw", "biofuel_mw"]
PM25_BANDS = [(12, "good"), (35, "moderate"), (55, "unhealthy_sensitive"), (150, "unhealthy"), (None, "very_unhealthy")]
PM25_THREE_BANDS = [(12, "good"), (35, "moderate"), (None, "unhealthy")]
QUALITY_CODES = [("VALIDATED", "validated"),
 ("ESTIMATED", "estimated"),
 ("DERIVED", "derived"),
 ("PROJECTED", "projected"),
 ("MANUAL", "manual")]
SKY_BANDS = [(20, "Clear"), (50, "Partly Cloudy"), (80, "Mostly Cloudy"), (None, "Overcast")]
TEMPERATURE_BANDS = [(-10, "very_cold"), (0, "cold"), (10, "cool"), (20, "mild"), (25, "warm"), (None, "hot")]
TEMPERATURE_RANGES = [(-10, "Very Cold (< -10°C)"),
 (0, "Cold (-10 to 0°C)"),
 (10, "Cool (0 to 10°C)"),
 (20, "Mild (10 to 20°C)"),
 (25, "Warm (20 to 25°C)"),
 (None, "Hot (> 25°C)")]
TOU_PERIODS = [("1", "on_peak"), ("2", "mid_peak"), ("3", "off_peak")]
UNIT_CODES = [("VALUE_72", "Wh"), ("VALUE_42", "m3"), ("VALUE_38", "W")]
UV_BANDS = [(3, "low"), (6, "moderate"), (8, "high"), (11, "very_high"), (None, "extreme")]
WATER_UNIT_CODES = [("VALUE_72", "Wh"), ("VALUE_42", "m3"), ("VALUE_119", "gal"), ("VALUE_38", "W")]
WEATHER_FIELDS = {"temperature_2m": "temperature_c",
 "relative_humidity_2m": "humidity_pct",
 "precipitation": "precipitation_mm",
 "windspeed_10m": "windspeed_kmh",
 "cloud_cover": "cloud_cover_pct",
 "cloud_cover_low": "cloud_cover_low_pct",
 "cloud_cover_mid": "cloud_cover_mid_pct",
 "cloud_cover_high": "cloud_cover_high_pct",
 "shortwave_radiation": "ghi_wm2",
 "direct_normal_irradiance": "dni_wm2",
 "diffuse_radiation": "dhi_wm2",
 "direct_radiation": "direct_horizontal_wm2",
 "sunshine_duration": "sunshine_duration_s"}
READING_KEY = ["home_id", "usage_point_idx", "meter_reading_idx", "timestamp"]
REQUIRED = {
    "green_button_interval_readings": ["home_id", "timestamp", "kwh"],
    "power_monitoring": ["home_id", "device_id", "channel", "timestamp", "watts"],
    "weather_hourly": ["location_name", "timestamp", "temperature_c"],
    "air_quality_hourly": ["location_name", "timestamp"],
}
