"""Labels, splits, training, batch scoring on the executors, and curated predictions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from goldseam.functions.fixed_point import percent, share
from goldseam.functions.scores import MIDDLE_FROM, argmax, confidence_tier, label_at, softmax
from goldseam.operators.aggregates import count_by
from goldseam.operators.joins import enrich
from goldseam.operators.shaping import not_null, other_columns
from goldseam.session import checkpointed

SIDES = ("train", "validation")


def label_index(df: DataFrame, column: str, index_as: str = "label_id") -> DataFrame:
    """(label, index): the distinct labels in sorted order, numbered from 0 without gaps.

    The distinct labels are range-sorted and written once; the position within a partition
    plus the sizes of the partitions before it gives the index. No task sees all labels.
    """
    labels = df.select(column).filter(F.col(column).isNotNull()).distinct()
    # Upper 31 bits: partition, in label order; lower 33 bits: place within it.
    placed = checkpointed(labels.orderBy(column).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg((F.max("_at") - F.shiftleft(F.col("_part"), 33) + 1).alias("size"))
    # One row per partition, so this window stays as small as the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.col("_at") - F.shiftleft(F.col("_part"), 33) + F.col("start")
    return placed.join(starts, "_part").select(column, place.cast("int").alias(index_as))


def split_mark(key: Column | str, fraction: float = 0.2, seed: int = 42) -> Column:
    """True for the validation share of the keys.

    A hash of the key decides, so a row keeps its side under any partitioning or retry.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key) if isinstance(key, str) else key)
    slot = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 10_000
    return slot < F.lit(round(fraction * 10_000))


def hash_split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, split_as: str = "split") -> DataFrame:
    """Adds ``train`` or ``validation``."""
    train, validation = SIDES
    return df.withColumn(split_as, F.when(split_mark(key, fraction, seed), validation).otherwise(train))


def split_distribution(df: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """(split, label, n, pct): rows per class on both sides, as a percentage of the side."""
    counts = count_by(hash_split(df.select(key, label), key, fraction, seed), ["split", label])
    sizes = counts.agg(
        F.struct(*(F.sum(F.when(F.col("split") == side, F.col("n"))).alias(side) for side in SIDES)).alias("s")
    ).scalar()
    size = F.when(F.col("split") == SIDES[0], sizes[SIDES[0]]).otherwise(sizes[SIDES[1]])
    return counts.withColumn("pct", percent(F.col("n"), size))


def class_accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(label, n, correct, accuracy, overall_accuracy) per true label, 4 decimals."""
    right = F.count(F.when(F.col(label) == F.col(predicted), 1))
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), right.alias("correct"))
    whole = counts.agg(F.struct(F.sum("n").alias("n"), F.sum("correct").alias("correct")).alias("s")).scalar()

    return counts.select(
        label,
        "n",
        "correct",
        share(F.col("correct"), F.col("n")).alias("accuracy"),
        share(whole["correct"], whole["n"]).alias("overall_accuracy"),
    )


def train_classifier(
    df: DataFrame, features: str, label: str, max_iter: int = 20, reg_param: float = 0.01
) -> LogisticRegressionModel:
    """A multinomial logistic regression on an array of numbers and a 0-based label index.

    Gradients are summed over the executors; rows never reach the driver.
    """
    ready = not_null(df, [features, label]).select(
        array_to_vector(F.col(features)).alias("features"), F.col(label).cast("double").alias("label")
    )
    return LogisticRegression(maxIter=max_iter, regParam=reg_param, family="multinomial").fit(ready)


#: Classes that a centroid model may have: it travels with every row's task as one value.
MOST_CLASSES = 10_000


def class_centroids(df: DataFrame, features: str, label: str, scale: int = 1 << 20) -> DataFrame:
    """(label, n, centroid, spread): per class its size, mean vector and mean squared distance from that.

    One aggregate of vector sums, which combine in the map tasks: a task sends one row per class and dimension. Components
    are summed as whole multiples of 1 / ``scale``, so the model does not depend on the order of rows. Rows without label or
    features, and with a component that is NULL or not finite, are left out.
    """
    usable = F.forall(features, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(features, lambda x: F.round(x.cast("double") * scale).cast("bigint"))
    rows = df.where(F.col(label).isNotNull() & usable).select(F.col(label).alias("label"), F.posexplode(whole).alias("dim", "x"))
    number = F.col("x").cast("double")
    sums = rows.groupBy("label", "dim").agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.floor(number * number / scale)).alias("q"))
    parts = sums.select("label", "n", "dim", (F.col("s") / F.col("n") / scale).alias("c"), (F.col("q") / F.col("n") / scale).alias("m"))
    # At most one row per dimension and class.
    made = parts.groupBy("label").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("dim", "c", "m"))).alias("d"))
    spread = F.aggregate("d", F.lit(0.0), lambda total, d: total + d["m"] - d["c"] * d["c"])
    return made.select("label", "n", F.transform("d", lambda d: d["c"]).alias("centroid"), spread.alias("spread"))


def nearest_centroid(df: DataFrame, centroids: DataFrame, features: str, predicted_as: str = "predicted", margin_as: str = "margin") -> DataFrame:
    """Adds the label of the nearest centroid (the smaller label of equally near ones) and how much farther the next one is.

    Rows whose features cannot be compared (NULL, or with NULL components) get NULL.
    """
    classes = centroids.limit(MOST_CLASSES + 1).count()
    if classes > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    model = centroids.agg(F.sort_array(F.collect_list(F.struct("label", "centroid"))).alias("m")).scalar()

    def distance(centroid: Column) -> Column:
        gaps = F.zip_with(F.col(features), centroid, lambda x, c: (x.cast("double") - c) * (x.cast("double") - c))
        return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g)

    measured = F.sort_array(F.transform(F.filter("_model", lambda c: F.col(features).isNotNull()), lambda c: F.struct(distance(c["centroid"]).alias("far"), c["label"].alias("label"))))
    ranked = df.withColumn("_model", model).withColumn("_ranked", F.filter(measured, lambda c: c["far"].isNotNull()))
    first, second = F.try_element_at("_ranked", F.lit(1)), F.try_element_at("_ranked", F.lit(2))
    return ranked.withColumns({predicted_as: first["label"], margin_as: second["far"] - first["far"]}).drop("_ranked", "_model")


def classify(model: Model, df: DataFrame, features: str, predicted_as: str = "predicted") -> DataFrame:
    """Adds the label index the model predicts."""
    vectors = df.withColumn("features", array_to_vector(F.col(features)))
    scored = model.transform(vectors).withColumn(predicted_as, F.col("prediction").cast("int"))
    return scored.select(*df.columns, predicted_as)


def save_model(model: LogisticRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


def score_batches(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[np.ndarray], np.ndarray]],
    input_col: str,
    labels: Sequence[str],
    n_features: int | None = None,
    batch_size: int = 256,
) -> DataFrame:
    """Adds label, score and all_scores (4 decimals) for every row with an input.

    ``make_scorer`` runs once per Python worker and returns a function from a batch of
    inputs to logits [rows, classes]. ``n_features`` is the length of an array input;
    leave it out for binary content. Only the logits come back from Python.
    """
    logits = predict_batch_udf(
        make_scorer,
        return_type=ArrayType(DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=[[n_features]] if n_features else None,
    )
    given = df.filter(F.col(input_col).isNotNull())
    scored = given.withColumn("_logits", logits(F.col(input_col))).withColumn("_shares", softmax("_logits"))
    return scored.withColumns(prediction_columns(F.col("_shares"), labels)).drop("_logits", "_shares")


def prediction_columns(shares: Column, labels: Sequence[str]) -> dict[str, Column]:
    """label, score and all_scores of an array of class probabilities."""
    names = F.array(*(F.lit(label) for label in labels))
    return {
        "label": label_at(labels, argmax(shares)),
        "score": F.round(F.array_max(shares), 4),
        "all_scores": F.map_from_arrays(names, F.transform(shares, lambda x: F.round(x, 4))),
    }


def with_confidence(df: DataFrame, label: str, score: str) -> DataFrame:
    """Adds confidence_level, is_reliable and is_null_prediction."""
    return df.withColumns(
        {
            "confidence_level": confidence_tier(score),
            "is_reliable": F.col(score) >= MIDDLE_FROM,
            "is_null_prediction": F.col(label).isNull(),
        }
    )


def enrich_predictions(predictions: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Predictions with every other column of the metadata, kept also without metadata."""
    return enrich(predictions, metadata, {key: key}, other_columns(metadata, [key]))


def contract_rules(label: str, score: str, labels: Sequence[str]) -> Mapping[str, Column]:
    """Quality rules of a prediction: a score from 0 to 1 and a known label."""
    return {
        "score_out_of_range": ~F.col(score).between(0.0, 1.0),
        "unknown_label": ~F.col(label).isin(*labels),
        "reliable_without_label": (F.col(score) >= MIDDLE_FROM) & F.col(label).isNull(),
    }
