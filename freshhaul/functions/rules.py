"""Threshold rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (lower bound of the risk score, class, P(fresh), P(at risk), P(spoiled)).
SCORE_TIERS = [
    (0.65, 2, 0.05, 0.15, 0.80),
    (0.40, 1, 0.15, 0.65, 0.20),
    (0.20, 1, 0.40, 0.45, 0.15),
]
SCORE_FLOOR = (0, 0.85, 0.10, 0.05)


def _tier(cls: int, fresh: float, at_risk: float, spoiled: float) -> Column:
    return F.struct(
        F.lit(cls).alias("cls"),
        F.lit(fresh).alias("p_fresh"),
        F.lit(at_risk).alias("p_at_risk"),
        F.lit(spoiled).alias("p_spoiled"),
    )


def rule_prediction(risk: Column) -> Column:
    """Struct of class and three probabilities; a null risk counts as 0."""
    known = F.coalesce(risk, F.lit(0.0))
    out = None
    for bound, *tier in SCORE_TIERS:
        hit = known >= F.lit(bound)
        out = F.when(hit, _tier(*tier)) if out is None else out.when(hit, _tier(*tier))
    return out.otherwise(_tier(*SCORE_FLOOR))


def hour_label(spoiled: Column, risk: Column, ch4: Column, co2: Column, rate: Column) -> Column:
    """A valid given label wins; otherwise thresholds on the hour's averages."""
    bad = (risk >= 0.65) | (ch4 >= 80.0) | (co2 >= 1200.0)
    doubtful = (risk >= 0.35) | (rate > 0.2) | (ch4 > 20.0)
    return (
        F.when(spoiled.isin(0, 1, 2), spoiled)
        .when(bad, F.lit(2))
        .when(doubtful, F.lit(1))
        .otherwise(F.lit(0))
    )


def class_name(cls: Column) -> Column:
    return F.when(cls == 0, "Fresh").when(cls == 1, "At Risk").otherwise("Spoiled")


def four_level(risk: Column) -> Column:
    return (
        F.when(risk >= 0.65, "CRITICAL")
        .when(risk >= 0.40, "WARNING")
        .when(risk >= 0.20, "WATCH")
        .otherwise("SAFE")
    )


def three_level(cls: Column) -> Column:
    return F.when(cls == 2, "CRITICAL").when(cls == 1, "WARNING").otherwise("SAFE")


def level_to_class(level: Column) -> Column:
    return F.when(level == "CRITICAL", 2).when(level == "WARNING", 1).otherwise(0)


def band(value: Column, high: Column | float, low: Column | float) -> Column:
    """'high' above the upper bound, 'raised' above the lower one, else 'normal'."""
    return F.when(value > high, "high").when(value > low, "raised").otherwise("normal")


def urgency(hours: Column) -> Column:
    return (
        F.when(hours.isNull(), F.lit(None).cast("string"))
        .when(hours < 12, "critical")
        .when(hours < 48, "low")
        .otherwise("ok")
    )
