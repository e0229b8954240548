"""Feature formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def heat_humidity(t: Column, h: Column) -> Column:
    return F.round(t * h / F.lit(100.0), 4)


def gas_level(ch4: Column, co2: Column) -> Column:
    """Unrounded gas score in [0, 1]."""
    return F.least(F.lit(1.0), (ch4 / F.lit(175.0) + co2 / F.lit(2400.0)) / F.lit(2.0))


def gas_score(ch4: Column, co2: Column) -> Column:
    return F.round(gas_level(ch4, co2), 4)


def gas_ratio(ch4: Column, co2: Column) -> Column:
    return F.round(F.when(co2 > 0, ch4 / co2).otherwise(F.lit(0.0)), 6)


def excess_heat(t: Column, safe: Column) -> Column:
    return F.greatest(F.lit(0.0), t - safe)


def deviation(t: Column, safe: Column) -> Column:
    return F.round(excess_heat(t, safe), 2)


def risk_score(dev: Column, gas: Column, days: Column) -> Column:
    heat = F.least(F.lit(1.0), dev / F.lit(25.0))
    age = F.least(F.lit(1.0), days / F.lit(15.0))
    return F.round(F.lit(0.40) * heat + F.lit(0.35) * gas + F.lit(0.25) * age, 4)


def breach(t: Column, safe: Column) -> Column:
    """1 when strictly above the safe temperature, else 0 (also for a null reading)."""
    return F.when(t > safe, F.lit(1)).otherwise(F.lit(0))


def share(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)), 4)


def heat_gas_stress(thi: Column, gas: Column) -> Column:
    return F.round((thi / F.lit(30.0) + gas) / F.lit(2.0), 4)


def breach_hours(rate: Column, days: Column) -> Column:
    return F.round(rate * days * F.lit(24.0), 2)


def remaining_hours(max_hours: Column, risk: Column, days: Column) -> Column:
    left = max_hours * (F.lit(1.0) - risk) - days * F.lit(24.0)
    return F.when(left.isNotNull(), F.greatest(F.lit(0.0), left))
