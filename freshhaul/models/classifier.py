"""Spoilage classifier on Spark ML."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.functions import rules
from freshhaul.models.forest import StoredForest, grow
from freshhaul.operators.featurize import fill_model_inputs, stream_level
from freshhaul.operators.metrics import with_class_weights
from freshhaul.operators.sampling import seeded_sample, spread
from freshhaul.operators.windows import ranked
from freshhaul.reference import FOOD_NAMES
from freshhaul.schemas import CORE_FEATURES, ONE_HOT_COLUMNS, SENSORS

NUMERIC = [*SENSORS, *CORE_FEATURES]
INPUTS = [*NUMERIC, *ONE_HOT_COLUMNS]  # one list for training, batch and stream

# Forest settings. With the rows' nodes cached, a level does not walk the trees again from the root.
FOREST = {"numTrees": 300, "maxDepth": 15, "minInstancesPerNode": 5, "seed": 42, "cacheNodeIds": True}

SCORED = 1_000  # rows at least for a task of scoring: a row takes about a millisecond


def with_inputs(df: DataFrame) -> DataFrame:
    """Model inputs: filled numerics and the one-hot food (unknown food: all zeros)."""
    filled = fill_model_inputs(df)
    flags = {
        f"food_{name.lower()}": F.when(F.col("food_key") == name.lower(), 1.0).otherwise(0.0)
        for name in FOOD_NAMES
    }
    return filled.withColumns(flags)


def train_classifier(
    df: DataFrame, label: str = "spoiled", **params: object
) -> PipelineModel | StoredForest:
    """Random forest with balanced class weights; ``params`` override the settings.

    Every level of the trees reads all rows, so they are dealt over all tasks first. The order
    inside a task decides which rows a tree draws; rows alike in it are alike to the trees.
    """
    labelled = df.filter(F.col(label).isNotNull())
    count = labelled.count()
    rows = spread(
        with_class_weights(with_inputs(labelled), label).select(*INPUTS, label, "class_weight"),
        count,
        [*INPUTS, label],
    )
    assembler = VectorAssembler(inputCols=INPUTS, outputCol="features")
    forest = RandomForestClassifier(
        labelCol=label, weightCol="class_weight", **{**FOREST, **params}
    )
    return grow(rows, count, assembler, forest)


def _through(df: DataFrame, model: PipelineModel | StoredForest, x: Column) -> DataFrame:
    """``_cls`` and ``_p`` (probabilities) of the array of inputs ``x``, next to the columns."""
    if isinstance(model, StoredForest):
        scored = df.withColumn("_scored", model.scored(x))
        return scored.select(*df.columns, F.col("_scored.cls").alias("_cls"), F.col("_scored.p").alias("_p"))
    out = model.stages[-1].transform(df.withColumn("features", array_to_vector(x)))
    return out.select(
        *df.columns,
        F.col("prediction").cast("int").alias("_cls"),
        vector_to_array("probability").alias("_p"),
    )


def _predicted(df: DataFrame, model: PipelineModel | StoredForest) -> DataFrame:
    """``_cls`` and ``_p`` (probabilities) next to the untouched input columns."""
    packed = df.select("*", F.struct(*df.columns).alias("_row"))
    values = F.array(*[F.col(c).cast("double") for c in INPUTS]).alias("_x")
    out = _through(with_inputs(packed).select("_row", values), model, F.col("_x"))
    return out.select("_row.*", "_cls", "_p")


def _probability(index: int) -> Column:
    return F.coalesce(F.get("_p", F.lit(index)), F.lit(0.0))


def model_score(df: DataFrame, model: PipelineModel | StoredForest) -> DataFrame:
    """Class, P(spoiled) and level from a model; the stream's form of scoring."""
    out = _predicted(df, model).withColumns(
        {"ml_predicted_class": F.col("_cls"), "prob_spoiled": _probability(2)}
    )
    return stream_level(out.drop("_cls", "_p"))


def score(df: DataFrame, model: PipelineModel | StoredForest) -> DataFrame:
    """Batch scoring: class, its name and the three probabilities to four digits.

    A row goes through all trees, so the rows are dealt over all tasks.
    """
    return _predicted(spread(df, df.count(), least=SCORED), model).select(
        *df.columns,
        F.col("_cls").alias("predicted_class"),
        rules.class_name(F.col("_cls")).alias("predicted_label"),
        F.round(_probability(0), 4).alias("p_fresh"),
        F.round(_probability(1), 4).alias("p_at_risk"),
        F.round(_probability(2), 4).alias("p_spoiled"),
    )


def split_importance(spark: SparkSession, model: PipelineModel | StoredForest) -> DataFrame:
    """Importance of each input in the forest's splits."""
    stored = isinstance(model, StoredForest)
    values = model.importances() if stored else model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(INPUTS, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def permutation_importance(
    df: DataFrame, model: PipelineModel | StoredForest, label: str = "spoiled", n: int | None = None, seed: int = 42
) -> DataFrame:
    """Loss of accuracy when one input is swapped with another row's.

    All labelled rows are tested, or a seeded sample of ``n``. All inputs are tested in one
    scoring pass: each row appears once per input, plus once unchanged. The other row is
    the next one in hash order; rows are numbered slice by slice, so no task orders all.
    Where the other row has the same value, the score of the unchanged row counts.
    """
    labelled = df.filter(F.col(label).isNotNull())
    rows = labelled if n is None else seeded_sample(labelled, n, seed=seed)
    values = F.array(*[F.col(c).cast("double") for c in INPUTS])
    place = F.md5(F.concat_ws(":", F.col("event_id").cast("string"), F.lit(str(seed))))
    drawn = with_inputs(rows).select(
        "event_id",
        F.col(label).cast("int").alias("y"),
        values.alias("x"),
        F.lit(1).alias("all"),
        place.alias("place"),
    )
    numbered = ranked(
        drawn, "all", F.substring("place", 1, 4), [F.col("place"), F.col("event_id")]
    ).withColumnsRenamed({"_rank": "i", "_total": "m"})
    partner = numbered.select(F.col("i").alias("j"), F.col("x").alias("z"))
    paired = numbered.join(partner, F.col("j") == F.col("i") % F.col("m") + 1)

    def right(tested: DataFrame, name: str, x: str, *kept: str) -> DataFrame:
        hit = (F.col("_cls") == F.col("y")).cast("int")
        return _through(tested, model, F.col(x)).select(*kept, hit.alias(name))

    dealt = spread(paired, labelled.count() if n is None else n, least=SCORED)
    plain = right(dealt, "plain", "x", "y", "x", "z")
    which = F.filter(
        F.sequence(F.lit(0), F.lit(len(INPUTS) - 1)),
        lambda k: ~F.get("x", k).eqNullSafe(F.get("z", k)),
    )
    swapped = F.transform(
        "x", lambda v, pos: F.when(pos == F.col("k"), F.get("z", pos)).otherwise(v)
    )
    tested = plain.withColumn("k", F.explode(which)).select(
        "y", "k", "plain", swapped.alias("swapped")
    )
    found = right(tested, "now", "swapped", "k", "plain")
    lost = found.groupBy("k").agg(F.sum(F.col("plain") - F.col("now")).alias("lost"))
    total = numbered.agg(F.count(F.lit(1)).alias("m"))
    named = df.sparkSession.createDataFrame(list(enumerate(INPUTS)), "k int, feature string")
    return (
        named.crossJoin(total)
        .filter(F.col("m") > 0)
        .join(lost, "k", "left")
        .select("feature", (F.coalesce("lost", F.lit(0)) / F.col("m")).alias("accuracy_loss"))
    )


def importance(
    model: PipelineModel | StoredForest, df: DataFrame, label: str = "spoiled", n: int | None = None
) -> DataFrame:
    """Both importances of each input, side by side."""
    in_splits = split_importance(df.sparkSession, model)
    return in_splits.join(permutation_importance(df, model, label, n), "feature")
