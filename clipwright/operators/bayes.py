"""Gaussian naive Bayes as aggregation and row-local scoring.

A fitted model is one array of class structs per key, so scoring is a projection: the
single model arrives as a scalar subquery, models per fold through a checked small join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clipwright.functions import vectors as V
from clipwright.operators import moments as M
from clipwright.session import settle

SMOOTHING = 1e-9


def rescale_moments(stats: DataFrame, mean: Column, std: Column) -> DataFrame:
    """Class moments in scaled space, without touching the rows again."""
    return stats.withColumn("mean", M.scaled(F.col("mean"), mean, std)).withColumn(
        "var", F.zip_with("var", std, lambda v, s: v / (s * s))
    )


def assemble(stats: DataFrame, by: Sequence[str], smoothing: Column, label: str = "label") -> DataFrame:
    """Class moments -> one model row per key with ``classes`` sorted by label.

    ``smoothing`` times the largest feature variance of the training rows is added to all variances.
    """
    grouped = stats.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "n", "mean", "var"))).alias("_c")
    )
    rows = F.aggregate("_c", F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    zeros = F.transform(F.get(F.col("_c"), F.lit(0))["mean"], lambda v: v * 0.0)

    def overall(n: Column) -> Column:
        """Feature variances over all classes together."""
        mean = F.aggregate(
            "_c", zeros, lambda acc, c: F.zip_with(acc, c["mean"], lambda a, m: a + m * c["n"] / n)
        )
        return V.bind(
            mean,
            lambda whole: F.aggregate(
                "_c",
                zeros,
                lambda acc, c: V.add(
                    acc,
                    F.zip_with(
                        c["var"],
                        F.zip_with(c["mean"], whole, lambda a, g: (a - g) * (a - g)),
                        lambda v, d: (v + d) * c["n"] / n,
                    ),
                ),
            ),
        )

    def finish(q: Column) -> Column:
        def one(c: Column) -> Column:
            return V.bind(
                F.transform(c["var"], lambda v: v + q["epsilon"]),
                lambda var: F.struct(
                    c["label"].alias("label"),
                    F.log(c["n"] / q["n"]).alias("log_prior"),
                    c["mean"].alias("mean"),
                    var.alias("var"),
                    F.aggregate(
                        var, F.lit(0.0), lambda acc, v: acc - 0.5 * F.log(2.0 * math.pi * v)
                    ).alias("log_norm"),
                ),
            )

        return F.transform("_c", one)

    epsilon = smoothing * F.array_max(V.bind(rows, overall))
    sized = grouped.select(*by, "_c", F.struct(rows.alias("n"), epsilon.alias("epsilon")).alias("_q"))
    return sized.select(
        *by, F.col("_q.n").alias("n"), F.col("_q.epsilon").alias("epsilon"), V.bind(F.col("_q"), finish).alias("classes")
    )


def fit(
    train: DataFrame, by: Sequence[str] = (), smoothing: float = SMOOTHING,
    label: str = "label", features: str = "features",
) -> DataFrame:
    stats = M.population_moments(train, [*by, label], features)
    return assemble(stats, list(by), F.lit(smoothing), label)


def parameter_table(model: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., label, feature, mean, var)`` with the class prior."""
    return (
        model.select(*by, F.explode_outer("classes").alias("c"))
        .select(*by, "c.label", F.exp("c.log_prior").alias("prior"), F.posexplode_outer(
            F.arrays_zip(F.col("c.mean").alias("mean"), F.col("c.var").alias("var"))
        ).alias("feature", "p"))
        .select(*by, "label", "prior", "feature", "p.mean", "p.var")
    )


def joint_scores(features: Column, classes: Column) -> Column:
    """Array of struct(label, score): log prior plus log likelihood."""

    def score(c: Column) -> Column:
        distance = F.aggregate(
            F.zip_with(V.subtract(features, c["mean"]), c["var"], lambda d, v: d * d / v),
            F.lit(0.0),
            lambda acc, t: acc + t,
        )
        return F.struct(
            c["label"].alias("label"), (c["log_prior"] + c["log_norm"] - 0.5 * distance).alias("score")
        )

    return F.transform(classes, score)


def best_label(scores: Column) -> Column:
    """Label of the highest score; the first class in order wins a tie."""
    return F.array_max(
        F.transform(scores, lambda s, i: F.struct(s["score"].alias("s"), (-i).alias("i"), s["label"].alias("l")))
    )["l"]


def posterior(scores: Column) -> Column:
    """Array of struct(label, proba) by log-sum-exp."""

    def shares(top: Column) -> Column:
        mass = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s["score"] - top))
        return V.bind(
            mass,
            lambda whole: F.transform(
                scores,
                lambda s: F.struct(s["label"].alias("label"), (F.exp(s["score"] - top) / whole).alias("proba")),
            ),
        )

    return V.bind(F.array_max(F.transform(scores, lambda s: s["score"])), shares)


def _scored(df: DataFrame, classes: Column, features: str, proba: bool) -> DataFrame:
    out = df.withColumn("_scores", joint_scores(F.col(features), classes))
    out = out.withColumn("pred_label", best_label(F.col("_scores")))
    if proba:
        out = out.withColumn("proba", posterior(F.col("_scores")))
    return out.drop("_scores")


def predict(df: DataFrame, model: DataFrame, features: str = "features", proba: bool = True) -> DataFrame:
    """Add ``pred_label`` (and ``proba``) from a one-row model."""
    held = df.withColumn("_classes", model.select("classes").scalar())
    return _scored(held, F.col("_classes"), features, proba).drop("_classes")


def predict_by(
    df: DataFrame, models: DataFrame, by: Sequence[str], features: str = "features", proba: bool = True
) -> DataFrame:
    """Score each row with the model of its key."""
    joined = df.join(models.select(*by, "classes"), list(by))
    return _scored(joined, F.col("classes"), features, proba).drop("classes")


# ---- many fits from one pass -------------------------------------------------------

def leave_one_out_models(
    df: DataFrame, fold: str, smoothing: Sequence[float] = (SMOOTHING,),
    label: str = "label", features: str = "features",
) -> tuple[DataFrame, DataFrame]:
    """Scalers ``(fold, mean, std)`` and models ``(fold, candidate, smoothing, classes)``.

    Each model is fitted on the rows outside its fold, in the space scaled by those rows.
    One pass over the data serves all folds and all candidates.
    """
    centre = settle(M.centre_of(df, features))
    outside = settle(M.leave_one_out(M.moment_sums(df, [fold, label], centre, features), fold, label))
    scalers = M.fold_scalers(outside, fold, centre)
    stats = M.moments_of_sums(outside, [fold, label], centre).join(
        scalers.select(fold, F.col("mean").alias("_mu"), F.col("std").alias("_sd")), fold
    )
    stats = rescale_moments(stats, F.col("_mu"), F.col("_sd")).drop("_mu", "_sd")
    grid = F.posexplode(V.literal(smoothing)).alias("candidate", "smoothing")
    models = assemble(stats.select("*", grid), [fold, "candidate", "smoothing"], F.col("smoothing"), label)
    return scalers, models


def score_folds(
    df: DataFrame, scalers: DataFrame, models: DataFrame, fold: str, features: str = "features",
    proba: bool = True,
) -> DataFrame:
    """Score every row with each candidate of the fold in which it is held out."""
    both = models.groupBy(fold).agg(
        F.collect_list(F.struct("candidate", "smoothing", "classes")).alias("_models")
    ).join(scalers.select(fold, "mean", "std"), fold)
    joined = df.join(both, fold)
    local = joined.withColumn(features, M.scaled(F.col(features), F.col("mean"), F.col("std"))).drop("mean", "std")
    local = local.select(*[c for c in local.columns if c != "_models"], F.explode("_models").alias("_model"))
    local = local.select("*", "_model.candidate", "_model.smoothing")
    return _scored(local, F.col("_model.classes"), features, proba).drop("_model")
