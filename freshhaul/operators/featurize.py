"""Features, labels and scores as frame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshhaul.functions import rules, scores
from freshhaul.operators.enrich import with_food_ref
from freshhaul.reference import FOOD_NAMES
from freshhaul.schemas import CORE_FEATURES


def core_features(
    df: DataFrame,
    t: str = "temperature",
    h: str = "humidity",
    ch4: str = "methane",
    co2: str = "co2",
    days: str = "storage_days",
    t_peak: str | None = None,
    dim: DataFrame | None = None,
) -> DataFrame:
    """The five core features; batch passes hourly averages and ``t_peak="temp_max"``."""
    rated = with_food_ref(df, "safe_max_c", dim=dim).withColumns(
        {
            "temp_humidity_index": scores.heat_humidity(F.col(t), F.col(h)),
            "gas_spoilage_score": scores.gas_score(F.col(ch4), F.col(co2)),
            "methane_co2_ratio": scores.gas_ratio(F.col(ch4), F.col(co2)),
            "temp_deviation": scores.deviation(F.col(t_peak or t), F.col("safe_max_c")),
        }
    )
    rated = rated.withColumn(
        "storage_risk_score",
        scores.risk_score(F.col("temp_deviation"), F.col("gas_spoilage_score"), F.col(days)),
    )
    kept = [name for name in df.columns if name not in CORE_FEATURES]
    return rated.select(*kept, *CORE_FEATURES)


def breach_flag(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    flag = scores.breach(F.col("temperature"), F.col("safe_max_c"))
    rated = with_food_ref(df, "safe_max_c", dim=dim)
    return rated.withColumn("temp_breach_flag", flag).select(*df.columns, "temp_breach_flag")


def derived_features(df: DataFrame) -> DataFrame:
    """Breach rate, volatility, combined stress and cumulative breach hours of an hour."""
    first = df.withColumns(
        {
            "breach_rate": scores.share(F.col("breach_count"), F.col("readings_count")),
            "temp_volatility": F.round("temp_std", 4),
            "heat_gas_stress": scores.heat_gas_stress(
                F.col("temp_humidity_index"), F.col("gas_spoilage_score")
            ),
        }
    )
    return first.withColumn(
        "cumulative_breach_hours",
        scores.breach_hours(F.col("breach_rate"), F.col("storage_days")),
    )


def label_hours(df: DataFrame) -> DataFrame:
    label = rules.hour_label(
        *[F.col(n) for n in ("spoiled", "storage_risk_score", "methane_avg", "co2_avg", "breach_rate")]
    )
    return df.withColumn("spoilage_label", label)


def label_names(df: DataFrame, label: str = "spoilage_label") -> DataFrame:
    return df.withColumn(f"{label}_name", rules.class_name(F.col(label)))


def risk_tiers(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_level", rules.four_level(F.col("storage_risk_score")))


def rule_score(df: DataFrame) -> DataFrame:
    """Struct column ``prediction``: class and the three probabilities."""
    return df.withColumn("prediction", rules.rule_prediction(F.col("storage_risk_score")))


def stream_level(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_level", rules.three_level(F.col("ml_predicted_class")))


def scored(df: DataFrame) -> DataFrame:
    """Class, probability of spoilage and 3-tier level of each reading, by rule."""
    out = rule_score(df).withColumns(
        {
            "ml_predicted_class": F.col("prediction.cls"),
            "prob_spoiled": F.col("prediction.p_spoiled"),
        }
    )
    return stream_level(out.drop("prediction"))


def one_hot(
    df: DataFrame, column: str = "food_name", values: list[str] | None = None, prefix: str = "food"
) -> DataFrame:
    """One 0/1 column per value, in one projection; an unknown value gives all zeros."""
    flags = [
        F.when(F.col(column) == value, 1).otherwise(0).alias(f"{prefix}_{value.lower()}")
        for value in values or FOOD_NAMES
    ]
    return df.select("*", *flags)


def fill_model_inputs(df: DataFrame) -> DataFrame:
    """Defaults before a model: null **or zero** is replaced, as ``x or default`` does."""

    def either(name: str, default: float) -> Column:
        value = F.col(name)
        return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)

    defaults = {"humidity": 63.0, "co2": 400.0}
    numeric = ["temperature", "humidity", "methane", "co2", "storage_days", *CORE_FEATURES]
    filled = {name: either(name, defaults.get(name, 0.0)) for name in numeric}
    food = F.when(F.col("food_name") == "", None).otherwise(F.col("food_name"))
    filled["food_key"] = F.lower(F.coalesce(food, F.lit("chicken")))
    return df.withColumns(filled)


def shelf_life(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    left = scores.remaining_hours(
        F.col("max_shelf_h"), F.col("storage_risk_score"), F.col("storage_days")
    )
    rated = with_food_ref(df, "max_shelf_h", dim=dim)
    return rated.withColumn("remaining_hours", left).select(*df.columns, "remaining_hours")


def urgency(df: DataFrame, hours: str = "remaining_hours") -> DataFrame:
    return df.withColumns(
        {"days_left": F.col(hours) / F.lit(24.0), "urgency": rules.urgency(F.col(hours))}
    )


def what_if(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Score of the what-if form: other weights than the risk score, with guard rails."""
    t, ch4, co2, days, safe = (
        F.col(n) for n in ("temperature", "methane", "co2", "storage_days", "safe_max_c")
    )
    heat = F.least(F.lit(1.0), scores.excess_heat(t, safe) / F.lit(22.0))
    age = F.least(F.lit(1.0), days / F.lit(15.0))
    base = F.lit(0.38) * heat + F.lit(0.35) * scores.gas_level(ch4, co2) + F.lit(0.27) * age
    calm = (t <= safe) & (ch4 < 10) & (co2 < 500) & (days < 3)
    severe = (t > safe + F.lit(8.0)) | (ch4 > 80) | (co2 > 1400)
    raw = F.col("_raw")
    steps = (
        with_food_ref(df, "safe_max_c", dim=dim)
        .withColumn("_raw", base)
        .withColumn("_raw", F.when(calm, F.least(raw, F.lit(0.18))).otherwise(raw))
        .withColumn("_raw", F.when(severe, F.greatest(raw, F.lit(0.72))).otherwise(raw))
        .withColumns(
            {
                "_p0": F.greatest(F.lit(0.0), F.lit(1.0) - raw * F.lit(2.2)),
                "_p2": F.when(
                    raw > 0.5, F.greatest(F.lit(0.0), raw * F.lit(1.8) - F.lit(0.3))
                ).otherwise(F.lit(0.0)),
            }
        )
        .withColumn("_p1", F.greatest(F.lit(0.0), F.lit(1.0) - F.col("_p0") - F.col("_p2")))
        .withColumn("_sum", F.col("_p0") + F.col("_p1") + F.col("_p2"))
        .withColumn("_sum", F.when(F.col("_sum") == 0, F.lit(1.0)).otherwise(F.col("_sum")))
        .withColumns({name: F.col(name) / F.col("_sum") for name in ("_p0", "_p1", "_p2")})
    )
    p0, p1, p2 = F.col("_p0"), F.col("_p1"), F.col("_p2")
    cls = F.when((p0 >= p1) & (p0 >= p2), 0).when(p1 >= p2, 1).otherwise(2)
    return steps.select(
        *df.columns,
        cls.alias("what_if_class"),
        F.round(p0, 3).alias("p_fresh"),
        F.round(p1, 3).alias("p_at_risk"),
        F.round(p2, 3).alias("p_spoiled"),
    )


def contributions(df: DataFrame, key: str = "event_id", dim: DataFrame | None = None) -> DataFrame:
    """Long form: one row per reading and factor, with the largest flagged."""
    rated = with_food_ref(df, "safe_max_c", dim=dim)
    t, ch4, co2, days = (F.col(n) for n in ("temperature", "methane", "co2", "storage_days"))
    parts = rated.select(
        key,
        F.round(
            scores.excess_heat(t, F.col("safe_max_c")) / F.lit(22.0) * F.lit(0.38), 4
        ).alias("heat"),
        F.round(scores.gas_level(ch4, co2) * F.lit(0.35), 4).alias("gas"),
        F.round(days / F.lit(15.0) * F.lit(0.27), 4).alias("age"),
    ).withColumn("top", F.greatest("heat", "gas", "age"))
    return parts.selectExpr(
        key,
        "top",
        "stack(3, 'Temperature deviation', heat, 'Gas spoilage score', gas, 'Storage days', age)"
        " AS (factor, contribution)",
    ).select(
        key,
        "factor",
        "contribution",
        F.when(F.col("contribution") == F.col("top"), 1).otherwise(0).alias("is_largest"),
    )


def severity_bands(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Colour bands of the dashboard as words: high, raised, normal."""
    safe = F.col("safe_max_c")
    t, ch4, co2, risk = (F.col(n) for n in ("temperature", "methane", "co2", "storage_risk_score"))
    rated = with_food_ref(df, "safe_max_c", dim=dim)
    return rated.select(
        *df.columns,
        rules.band(t, 15, 8).alias("temp_band"),
        rules.band(t, safe + F.lit(5.0), safe).alias("temp_vs_safe_band"),
        rules.band(ch4, 80, 20).alias("methane_band"),
        rules.band(co2, 1400, 700).alias("co2_band"),
        rules.band(risk, 0.65, 0.35).alias("risk_band"),
    )
