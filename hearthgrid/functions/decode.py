"""Code decoding, banding and validation as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthgrid import constants as C


def holds(value: Column, code: str) -> Column:
    """Whether the value is LIKE %code%. A code with "_", which takes any sign, is matched as a pattern only where the code
    itself does not occur but all of its parts do, as patterns cost much more than a search."""
    pattern = value.like(f"%{code}%")
    parts = code.split("_")
    if len(parts) == 1:
        return pattern
    for part in parts:
        pattern = value.contains(part) & pattern
    return value.contains(code) | pattern


def contains_first(value: Column, codes, default: str) -> Column:
    """Label of the first code that occurs in the value, with LIKE matching."""
    label = F.lit(default)
    for code, name in reversed(codes):
        label = F.when(holds(value, code), name).otherwise(label)
    return label


def exact(value: Column, codes, default: Column) -> Column:
    """Label of the equal code."""
    label = default
    for code, name in reversed(codes):
        label = F.when(value == code, F.lit(name)).otherwise(label)
    return label


def band(value: Column, bands, missing: str | None = None, inclusive: bool = False) -> Column:
    """Label of the first band whose upper bound lies above the value.

    A null value takes the last label, unless ``missing`` names another one.
    """
    label = F.lit(bands[-1][1])
    for bound, name in reversed(bands[:-1]):
        below = value <= bound if inclusive else value < bound
        label = F.when(below, name).otherwise(label)
    return label if missing is None else F.when(value.isNull(), missing).otherwise(label)


def rank_of(label: Column, names) -> Column:
    """Position of a label in a list of names, for sorting."""
    position = F.lit(len(names) + 1)
    for i, name in reversed(list(enumerate(names, 1))):
        position = F.when(label == name, i).otherwise(position)
    return position


def quality(code: Column) -> Column:
    return contains_first(code, C.QUALITY_CODES, "unknown")


def is_estimated(code: Column) -> Column:
    tokens = [token for token, name in C.QUALITY_CODES if name in C.ESTIMATED_QUALITIES]
    hit = F.lit(False)
    for token in tokens:
        hit = hit | code.like(f"%{token}%")
    return F.coalesce(hit, F.lit(False))


def tou_period(bucket: Column) -> Column:
    return exact(bucket, C.TOU_PERIODS, F.lit(None).cast("string"))


def commodity(code: Column) -> Column:
    return contains_first(code, C.COMMODITY_CODES, "unknown")


def unit(code: Column, water: bool = False) -> Column:
    return contains_first(code, C.WATER_UNIT_CODES if water else C.UNIT_CODES, "unknown")


def display_commodity(code: Column) -> Column:
    return exact(code, C.DISPLAY_COMMODITIES, code)


def display_unit(code: Column) -> Column:
    return exact(code, C.DISPLAY_UNITS, code)


def tou_bucket(local: Column) -> Column:
    """Ontario time-of-use bucket 1 (on), 2 (mid) or 3 (off peak) of a local standard time.

    Weekday hours 11-17 are on-peak from May to October, when cooling drives demand, and
    mid-peak in the other months; the morning and evening shoulders are the reverse.
    """
    hour, month = F.hour(local), F.month(local)
    midday = (hour >= 11) & (hour < 17)
    shoulder = ((hour >= 7) & (hour < 11)) | ((hour >= 17) & (hour < 19))
    summer = month.between(5, 10)
    return (
        F.when(F.weekday(local) >= 5, 3)
        .when(~(midday | shoulder), 3)
        .when(midday == summer, 1)
        .otherwise(2)
    )


def power_quality(watts: Column, volts: Column) -> Column:
    low, high = C.VOLTS_RANGE
    return (
        F.when(watts < 0, "invalid_negative")
        .when(watts > C.MAX_WATTS, "invalid_high")
        .when((volts < low) | (volts > high), "voltage_out_of_range")
        .otherwise("valid")
    )


def weather_quality(temperature: Column) -> Column:
    return (
        F.when(temperature.isNull(), "missing")
        .when(temperature.between(*C.TEMPERATURE_LIMITS), "valid")
        .otherwise("out_of_range")
    )


def air_quality_label(pm2_5: Column, pm10: Column, aqi: Column) -> Column:
    return (
        F.when(pm2_5.isNull() & pm10.isNull(), "missing_pm")
        .when((pm2_5 < 0) | (pm10 < 0), "invalid_pm")
        .when(aqi < 0, "invalid_aqi")
        .otherwise("valid")
    )


def true_if(condition: Column) -> Column:
    """A condition with null counted as false."""
    return F.coalesce(condition, F.lit(False))


def anonymize(df, hash_fields, redact_fields, salt: str):
    """Replace chosen columns by a salted SHA-256, blank out others."""
    hashed = {c: F.sha2(F.concat(F.lit(salt), F.col(c)), 256) for c in hash_fields}
    blank = {c: F.lit(None).cast(df.schema[c].dataType) for c in redact_fields}
    return df.withColumns({**hashed, **blank})
