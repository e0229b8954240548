"""Model metrics, class weights and standardisation as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.operators.enrich import settled


def _cells(df: DataFrame, y: str, p: str) -> DataFrame:
    """Counts per (label, prediction): the only pass over the data."""
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, y: str, p: str, classes: list[int] | None = None) -> DataFrame:
    """One row per true class, one column ``pred_<class>`` per predicted class."""
    classes = [0, 1, 2] if classes is None else classes
    return (
        df.groupBy(F.col(y).alias("label"))
        .agg(*[F.count_if(F.col(p) == c).alias(f"pred_{c}") for c in classes])
        .orderBy("label")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_scores(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision, recall, F1 (0 when undefined) and support per class."""
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    per_class = (
        _cells(df, y, p)
        .select(
            F.explode(
                F.array(
                    F.struct(
                        F.col("y").alias("class"), hit.alias("tp"),
                        F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                    ),
                    F.struct(
                        F.col("p").alias("class"), F.lit(0).cast("long").alias("tp"),
                        F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                    ),
                )
            ).alias("c")
        )
        .groupBy("c.class")
        .agg(*[F.sum(f"c.{n}").alias(n) for n in ("tp", "actual", "predicted")])
    )
    tp, actual, predicted = F.col("tp"), F.col("actual"), F.col("predicted")
    return per_class.select(
        "class",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, actual).alias("recall"),
        _ratio(F.lit(2.0) * tp, actual + predicted).alias("f1"),
        actual.alias("support"),
        "tp",
    )


def macro_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    return class_scores(df, y, p).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Rows per class, then accuracy, macro and weighted averages.

    Everything after the first aggregate works on one row per class.
    """
    per_class = class_scores(df, y, p)
    names = ("precision", "recall", "f1")
    weight = F.col("support")
    averages = per_class.agg(
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[_ratio(F.sum(F.col(n) * weight), F.sum(weight)).alias(f"weighted_{n}") for n in names],
        _ratio(F.sum("tp"), F.sum(weight)).alias("accuracy"),
        F.sum(weight).alias("support"),
    ).selectExpr(
        "stack(3, 'accuracy', accuracy, accuracy, accuracy,"
        " 'macro avg', macro_precision, macro_recall, macro_f1,"
        " 'weighted avg', weighted_precision, weighted_recall, weighted_f1)"
        " AS (class, precision, recall, f1)",
        "support",
    )
    rows = per_class.select(F.col("class").cast("string"), *names, "support")
    return rows.unionByName(averages)


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    error = F.col(p) - F.col(y)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def apply_scaler(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """Standardise in place. The one-row statistics become literals; a zero deviation divides by 1."""
    row = stats.first()

    def scaled(name: str) -> Column:
        spread = row[f"{name}_std"] or 1.0
        return (F.col(name) - F.lit(row[f"{name}_mean"])) / F.lit(spread)

    return df.withColumns({name: scaled(name) for name in columns})


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(1))  # one row per class
    weight = F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))
    return counts.select(y, "n", weight.alias("class_weight"))


def with_class_weights(df: DataFrame, y: str) -> DataFrame:
    weights = class_weights(df, y).drop("n")
    return df.join(settled(weights), y)


def dataset_shape(df: DataFrame, key: str = "truck_id") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("key_count")
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per frame: name and number of rows."""
    out = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out
