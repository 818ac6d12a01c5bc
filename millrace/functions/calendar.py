"""Calendar features of an observation date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Indonesian season and monsoon names by month, El Nino start.
DRY_SEASON = "Kemarau"
WET_SEASON = "Hujan"
DRY_MONTHS = (4, 5, 6, 7, 8, 9, 10)
PEAK_WET_MONTHS = (12, 1, 2)
LATE_WET_MONTHS = (3, 4)
EARLY_DRY_MONTHS = (5, 6)
PEAK_DRY_MONTHS = (7, 8, 9)
EARLY_WET_MONTHS = (10, 11)
MONSOON_PHASES = {
    "Puncak Hujan": PEAK_WET_MONTHS,
    "Akhir Hujan": LATE_WET_MONTHS,
    "Awal Kemarau": EARLY_DRY_MONTHS,
    "Puncak Kemarau": PEAK_DRY_MONTHS,
    "Awal Hujan": EARLY_WET_MONTHS,
}
EL_NINO_FROM = dt.date(2026, 4, 1)


def date_key(day: Column) -> Column:
    """yyyyMMdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def monsoon_phase(day: Column) -> Column:
    month = F.month(day)
    phase = F
    for name, months in MONSOON_PHASES.items():
        phase = phase.when(month.isin(*months), F.lit(name))
    return phase


def calendar_columns(day: Column, el_nino_from: dt.date = EL_NINO_FROM) -> dict[str, Column]:
    """Column name to expression, ready for ``withColumns``.

    ``quarter`` is the calendar quarter. ``quarter_rounded`` is what a float
    division stored in an integer column gives: one too many in the last month
    of each quarter (December becomes 5). Both are kept so that tables loaded
    either way can be compared.
    """
    month = F.month(day)
    return {
        "year": F.year(day),
        "month": month,
        "quarter": F.quarter(day),
        "quarter_rounded": F.round((month - 1) / F.lit(3.0) + 1).cast("int"),
        "day_of_week": F.dayofweek(day) - 1,  # Sunday is 0
        "week_of_year": F.weekofyear(day),
        "season": F.when(month.isin(*DRY_MONTHS), F.lit(DRY_SEASON)).otherwise(F.lit(WET_SEASON)),
        "monsoon_phase": monsoon_phase(day),
        "is_el_nino_period": day >= F.lit(el_nino_from),
        "is_peak_dry": month.isin(*PEAK_DRY_MONTHS),
        "is_peak_wet": month.isin(*PEAK_WET_MONTHS),
    }
