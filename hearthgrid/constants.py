"""Code tables, thresholds, rates and unit factors that results depend on."""

# --- fixed values: reading quality codes, matched as substrings in this order
QUALITY_CODES = [
    ("VALIDATED", "validated"),
    ("ESTIMATED", "estimated"),
    ("DERIVED", "derived"),
    ("PROJECTED", "projected"),
    ("MANUAL", "manual"),
]
ESTIMATED_QUALITIES = ["estimated", "derived", "projected"]
GAS_CHECK_QUALITY_CODES = [
    ("VALIDATED", "validated"),
    ("ESTIMATED", "estimated"),
    ("MISSING", "missing"),
]

# --- fixed values: commodity codes. The order matters, and "_" is a LIKE wildcard, so
# VALUE_1 also takes VALUE_10 to VALUE_19.
COMMODITY_CODES = [
    ("VALUE_1", "electricity"),
    ("VALUE_7", "natural_gas"),
    ("VALUE_2", "water"),
]

# --- fixed values: units of measure
UNIT_CODES = [("VALUE_72", "Wh"), ("VALUE_42", "m3"), ("VALUE_38", "W")]
WATER_UNIT_CODES = [("VALUE_72", "Wh"), ("VALUE_42", "m3"), ("VALUE_119", "gal"), ("VALUE_38", "W")]

# --- fixed values: time-of-use buckets and example rates in dollars per kWh
TOU_PERIODS = [("1", "on_peak"), ("2", "mid_peak"), ("3", "off_peak")]
TOU_RATES = [("on_peak", 0.187), ("mid_peak", 0.132), ("off_peak", 0.092)]
FLAT_RATE = 0.125

# --- fixed values: names shown when browsing raw readings (exact match, else the code itself)
DISPLAY_COMMODITIES = [
    ("CommodityKindValue.VALUE_0", "not-applicable"),
    ("CommodityKindValue.VALUE_1", "electricity"),
    ("CommodityKindValue.VALUE_2", "natural-gas"),
    ("CommodityKindValue.VALUE_7", "natural-gas"),
    ("CommodityKindValue.VALUE_9", "water"),
]
DISPLAY_UNITS = [
    ("UnitSymbolKindValue.VALUE_42", "m³"),
    ("UnitSymbolKindValue.VALUE_72", "Wh"),
]

# --- fixed values: upper bounds (exclusive) of the labelled bands; the last label has no bound
TEMPERATURE_BANDS = [(-10, "very_cold"), (0, "cold"), (10, "cool"), (20, "mild"), (25, "warm"), (None, "hot")]
TEMPERATURE_RANGES = [
    (-10, "Very Cold (< -10°C)"),
    (0, "Cold (-10 to 0°C)"),
    (10, "Cool (0 to 10°C)"),
    (20, "Mild (10 to 20°C)"),
    (25, "Warm (20 to 25°C)"),
    (None, "Hot (> 25°C)"),
]
PM25_BANDS = [
    (12, "good"),
    (35, "moderate"),
    (55, "unhealthy_sensitive"),
    (150, "unhealthy"),
    (None, "very_unhealthy"),
]
PM25_THREE_BANDS = [(12, "good"), (35, "moderate"), (None, "unhealthy")]
UV_BANDS = [(3, "low"), (6, "moderate"), (8, "high"), (11, "very_high"), (None, "extreme")]
SKY_BANDS = [(20, "Clear"), (50, "Partly Cloudy"), (80, "Mostly Cloudy"), (None, "Overcast")]
# bounds of the air quality index are inclusive
AQI_BANDS = [
    (20, "good"),
    (40, "fair"),
    (60, "moderate"),
    (80, "poor"),
    (100, "very_poor"),
    (None, "extremely_poor"),
]
POOR_AIR = ["unhealthy_sensitive", "unhealthy", "very_unhealthy"]

# --- fixed values: validation limits
MAX_WATTS = 50_000
VOLTS_RANGE = (100, 140)
TEMPERATURE_LIMITS = (-50, 60)
PLAUSIBLE_TEMPERATURE = (-40, 40)
HIGH_PM25, HIGH_AQI = 35, 60
HIGH_AOD, HIGH_DUST = 0.3, 20

# --- fixed values: measurements per hour for the power rollup
MEDIUM_QUALITY_COUNT = 60
HIGH_QUALITY_COUNT = 360

# --- fixed values: degree-hour base, cooling limit, unit factors
DEGREE_BASE_C = 18
COOLING_ABOVE_C = 22
WH_PER_KWH = 1000.0
GALLONS_PER_M3 = 264.172
LITERS_PER_M3 = 1000
GAS_KWH_PER_M3 = 10.55
FURNACE_EFFICIENCY = 0.95
METER_UTC_OFFSET_HOURS = 5

# --- fixed values: first cursor position of an incremental feed
FIRST_CURSOR = "2020-01-01 00:00:00"

# --- fixed values: payload field -> column, weather
WEATHER_FIELDS = {
    "temperature_2m": "temperature_c",
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
    "sunshine_duration": "sunshine_duration_s",
}
# --- fixed values: payload fields, air quality (column names are the same)
AIR_QUALITY_FIELDS = [
    "pm10",
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
    "european_aqi_sulphur_dioxide",
]
GRID_MIX = ["nuclear_mw", "gas_mw", "hydro_mw", "wind_mw", "solar_mw", "biofuel_mw"]

# --- fixed values: reading quality numbers of the public ESPI standard
ESPI_QUALITY = [
    (7, "MANUAL"),
    (8, "ESTIMATED"),
    (9, "ESTIMATED"),
    (11, "DERIVED"),
    (12, "PROJECTED"),
    (17, "VALIDATED"),
]

# --- fixed values: constants of the wide meter export
WIDE_CSV_QUALITY = "VALIDATED"
WIDE_CSV_COMMODITY = "CommodityKindValue.VALUE_1"
WIDE_CSV_UOM = "UnitSymbolKindValue.VALUE_72"
WIDE_CSV_SERVICE = "ServiceKind.ELECTRICITY"

# --- fixed values: CSV headers of the monthly bills -> column
ELECTRICITY_BILL_HEADERS = {
    "Total Consumption": "total_kwh",
    "Off Peak Consumption": "off_peak_kwh",
    "Mid Peak Consumption": "mid_peak_kwh",
    "On Peak Consumption": "on_peak_kwh",
    "Total": "total_cost",
    "Off Peak Rate": "off_peak_rate",
    "Mid Peak Rate": "mid_peak_rate",
    "On Peak Rate": "on_peak_rate",
}
GAS_BILL_HEADERS = {"Gas Consumption": "gas_m3", "Gas Charges": "gas_cost"}
OPTIONAL_GAS_BILL_HEADERS = {"Water Consumption": "water_m3", "Water Charges": "water_cost"}
