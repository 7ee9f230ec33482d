"""Classification metrics.

Everything is derived from counts per (keys, truth, prediction): one map-side-combined
aggregation over the predictions, then arithmetic on a table of at most classes squared rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SIX_METRICS = ["accuracy", "f1_weighted", "f1_macro", "uar", "precision_weighted", "recall_weighted"]


def ratio(top: Column, bottom: Column) -> Column:
    """Division with the convention that a zero denominator gives 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def counts(pred: DataFrame, keys: Sequence[str] = (), truth: str = "y_true", guess: str = "y_pred") -> DataFrame:
    return pred.groupBy(*keys, F.col(truth).alias("y_true"), F.col(guess).alias("y_pred")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(cells: DataFrame, classes: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long matrix over all known classes, zero cells kept.  ``cells`` comes from :func:`counts`."""
    known = F.array(*[F.lit(c) for c in classes])
    groups = cells.select(*keys).distinct() if keys else cells.sparkSession.range(1).select()
    frame = groups.select(*keys, F.explode(known).alias("y_true")).select(
        *keys, "y_true", F.explode(known).alias("y_pred")
    )
    return frame.join(cells, [*keys, "y_true", "y_pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def confusion_matrix_wide(cells: DataFrame, classes: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per true class (all known ones), one column per predicted class."""
    full = confusion_matrix(cells, classes, keys)
    return full.groupBy(*keys, "y_true").pivot("y_pred", list(classes)).agg(F.sum("n"))


def accuracy(pred: DataFrame, keys: Sequence[str] = (), truth: str = "y_true", guess: str = "y_pred") -> DataFrame:
    hit = (F.col(truth) == F.col(guess)).cast("double")
    return pred.groupBy(*keys).agg(F.avg(hit).alias("accuracy"))


def per_class(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, support for each class seen in truth or prediction."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    sides = cells.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("hits")),
                F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")),
            )
        ).alias("s"),
    ).select(*keys, "s.*")
    sums = sides.groupBy(*keys, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    return sums.select(
        *keys, "label", "support", "predicted", "hits",
        precision.alias("precision"), recall.alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def _weighted(column: str) -> Column:
    return ratio(F.sum(F.col(column) * F.col("support")), F.sum("support"))


def weighted_prf(classes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return classes.groupBy(*keys).agg(
        _weighted("precision").alias("precision_weighted"),
        _weighted("recall").alias("recall_weighted"),
        _weighted("f1").alias("f1_weighted"),
    )


def macro_scores(classes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Unweighted means over the classes seen in truth or prediction."""
    return classes.groupBy(*keys).agg(F.avg("f1").alias("f1_macro"), F.avg("recall").alias("uar"))


def report(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The six scalars, one row per key."""
    return per_class(cells, keys).groupBy(*keys).agg(
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("f1").alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        F.avg("recall").alias("uar"),
        _weighted("precision").alias("precision_weighted"),
        _weighted("recall").alias("recall_weighted"),
    )


def evaluate(pred: DataFrame, keys: Sequence[str] = (), truth: str = "y_true", guess: str = "y_pred") -> DataFrame:
    """Predictions to the six scalars."""
    return report(counts(pred, keys, truth, guess), keys)


def to_long(reports: DataFrame, keys: Sequence[str], metrics: Sequence[str] = SIX_METRICS) -> DataFrame:
    return reports.unpivot(list(keys), list(metrics), "metric", "value")


# ---- folds -------------------------------------------------------------------------

def model_fold_grid(reports: DataFrame, first_fold: str | int | None = None) -> DataFrame:
    """Model x fold x metric grid; models are those of the first fold, gaps are NULL.

    ``reports`` is long: (model, fold, metric, value).
    """
    first = reports.agg(F.min("fold")).scalar() if first_fold is None else F.lit(first_fold)
    folds = reports.select("fold").distinct().agg(F.array_sort(F.collect_list("fold")))
    frame = (
        reports.where(F.col("fold") == first).select("model", "metric").distinct()
        .withColumn("_folds", folds.scalar())
        .select("model", "metric", F.explode("_folds").alias("fold"))
    )
    return frame.join(reports, ["model", "fold", "metric"], "left")


def fold_summary(grid: DataFrame) -> DataFrame:
    """Mean and *sample* deviation per (model, metric); NULL unless every fold has a value."""
    stats = grid.groupBy("model", "metric").agg(
        F.count("*").alias("_folds"),
        F.count("value").alias("_filled"),
        F.avg("value").alias("_mean"),
        F.stddev_samp("value").alias("_std"),
    )
    whole = F.col("_folds") == F.col("_filled")
    mean = F.when(whole, F.col("_mean"))
    std = F.when(whole, F.when(F.col("_folds") == 1, 0.0).otherwise(F.col("_std")))
    return stats.select(
        "model",
        "metric",
        mean.alias("mean"),
        std.alias("std"),
        F.when(whole, F.format_string("%.4f ± %.4f", mean, std)).otherwise("N/A").alias("text"),
    )

