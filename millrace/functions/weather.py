"""Weather indices, labels and alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.cleaning import bounded, ladder, lookup
from millrace.functions.numbers import round_half_away

# Rain steps (mm), risk steps, category and colour by risk code.
CONDITION_STEPS = (
    (1.0, "DRIZZLE"),
    (5.0, "LIGHT_RAIN"),
    (20.0, "MODERATE_RAIN"),
    (50.0, "HEAVY_RAIN"),
    (100.0, "VERY_HEAVY"),
    (150.0, "EXTREME_RAIN"),
)
DRY_CONDITION = "CLEAR"
RISK_STEPS = (  # code, rain in mm, drought or fire index
    ("R_EXTREME", 150.0, 0.75),
    ("R_HIGH", 100.0, 0.55),
    ("R_MODERATE", 50.0, 0.35),
)
LOWEST_RISK = "R_LOW"
RISK_CATEGORY = {"R_EXTREME": "EKSTREM", "R_HIGH": "TINGGI", "R_MODERATE": "SEDANG", "R_LOW": "RENDAH"}
RISK_COLOUR = {"R_EXTREME": "RED", "R_HIGH": "ORANGE", "R_MODERATE": "YELLOW", "R_LOW": "GREEN"}
CATEGORY_ORDER = {"EKSTREM": 1, "TINGGI": 2, "SEDANG": 3}
WET_DAY_MM = 1.0
DEFAULT_TEMP = 30.0
DEFAULT_HUMIDITY = 70.0


def drought_index(precip: Column, temp_max: Column, humidity: Column) -> Column:
    """Half lack of rain, three tenths heat above 28 degrees, two tenths dry air; within 0..1."""
    lack_of_rain = F.greatest(F.lit(0.0), F.lit(1.0) - bounded(precip, default=0.0) / F.lit(20.0))
    heat = F.least(
        F.lit(1.0), F.greatest(F.lit(0.0), (bounded(temp_max, default=DEFAULT_TEMP) - F.lit(28.0)) / F.lit(12.0))
    )
    dry_air = F.greatest(F.lit(0.0), F.lit(1.0) - bounded(humidity, default=DEFAULT_HUMIDITY) / F.lit(100.0))
    return round_half_away(lack_of_rain * F.lit(0.50) + heat * F.lit(0.30) + dry_air * F.lit(0.20), 4)


def fire_index(temp_max: Column, humidity: Column, wind: Column) -> Column:
    """Weighted heat, dry air and wind; not limited to 1."""
    heat = bounded(temp_max, default=DEFAULT_TEMP) / F.lit(40.0)
    dry_air = (F.lit(100.0) - bounded(humidity, default=DEFAULT_HUMIDITY)) / F.lit(100.0)
    gusts = bounded(wind, default=0.0) / F.lit(80.0)
    return round_half_away(heat * F.lit(0.35) + dry_air * F.lit(0.40) + gusts * F.lit(0.25), 4)


def heat_index(apparent: Column, temp_max: Column) -> Column:
    return round_half_away(F.coalesce(apparent, temp_max, F.lit(DEFAULT_TEMP)), 2)


def crop_stress(drought: Column, temp_avg: Column) -> Column:
    """Zero until the drought index passes 0.3."""
    heat = F.greatest(F.lit(0.0), (temp_avg - F.lit(30.0)) / F.lit(10.0))
    score = round_half_away(F.greatest(F.lit(0.0), drought * F.lit(0.6) + heat * F.lit(0.4)), 4)
    return F.when(drought > 0.3, score).otherwise(F.lit(0.0))


def condition_label(precip: Column) -> Column:
    return ladder(precip, CONDITION_STEPS, DRY_CONDITION)


def risk_code(precip: Column, drought: Column, fire: Column) -> Column:
    """The worst step that rain, drought or fire reaches."""
    rain = bounded(precip, default=0.0)
    out = F
    for code, rain_step, index_step in RISK_STEPS:
        out = out.when((rain >= rain_step) | (drought >= index_step) | (fire >= index_step), F.lit(code))
    return out.otherwise(F.lit(LOWEST_RISK))


def risk_category(code: Column) -> Column:
    return lookup(code, RISK_CATEGORY, RISK_CATEGORY[LOWEST_RISK])


def alert_colour(code: Column) -> Column:
    return lookup(code, RISK_COLOUR, RISK_COLOUR[LOWEST_RISK])


def category_rank(category: Column) -> Column:
    """Sort position of a risk category, worst first."""
    return lookup(category, CATEGORY_ORDER, len(CATEGORY_ORDER) + 1)


def alert_flags(precip: Column, temp_max: Column, drought: Column, fire: Column) -> dict[str, Column]:
    heavy_rain = bounded(precip, default=0.0) >= 100.0
    return {
        "is_extreme_weather": heavy_rain | (bounded(temp_max, default=0.0) > 38.0) | (fire > 0.7),
        "is_drought_alert": drought >= 0.55,
        "is_flood_alert": heavy_rain,
        "is_fire_alert": fire >= 0.55,
    }
