"""Cleaning rules for measured values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_outside(value: Column, low: float, high: float) -> Column:
    """Keep the value inside [low, high]; anything else is treated as a broken sensor."""
    return F.when(value.between(F.lit(float(low)), F.lit(float(high))), value)


def bounded(value: Column, *, default: float, low: float | None = None, high: float | None = None) -> Column:
    """Replace NULL by the default, then pull the value into [low, high]."""
    out = F.coalesce(value, F.lit(float(default)))
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return out


def ladder(value: Column, steps: Iterable[tuple[float, str]], below: str) -> Column:
    """Label of the highest step the value reaches, or ``below``."""
    rungs = sorted(steps, reverse=True)
    floor, label = rungs[0]
    out = F.when(value >= F.lit(floor), F.lit(label))
    for floor, label in rungs[1:]:
        out = out.when(value >= F.lit(floor), F.lit(label))
    return out.otherwise(F.lit(below))


def lookup(value: Column, mapping: dict, default=None) -> Column:
    """Map a few known values; NULL or unknown gives the default."""
    out = F
    for key, result in mapping.items():
        out = out.when(value == F.lit(key), F.lit(result))
    return out.otherwise(F.lit(default))


def falling(name: str) -> Column:
    """Descending sort key with NULLs last."""
    return F.col(name).desc_nulls_last()


def rising(name: str) -> Column:
    """Ascending sort key with NULLs last."""
    return F.col(name).asc_nulls_last()
