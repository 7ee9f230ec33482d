"""Scaling parameters and additive moment sums.

Parameters are fitted in one map-side-combined aggregation and travel as arrays, one
element per feature.  Standard deviations here are population ones throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from clipwright.functions import vectors as V


def safe_std(variance: Column, mean: Column) -> Column:
    """Square root of a variance; a constant feature gets 1 so that scaling only centres it."""
    return F.when(variance <= F.pow(mean * 1e-12, F.lit(2.0)), F.lit(1.0)).otherwise(
        F.sqrt(F.greatest(variance, F.lit(0.0)))
    )


def population_moments(df: DataFrame, by: Sequence[str], features: str = "features") -> DataFrame:
    """Rows ``(by..., n, mean[], var[])`` with population variances."""
    summed = df.groupBy(*by).agg(V.mean_variance(F.col(features)).alias("_s"))
    shrink = (F.col("_s.count") - 1) / F.col("_s.count")
    return summed.select(
        *by,
        F.col("_s.count").alias("n"),
        vector_to_array("_s.mean").alias("mean"),
        V.scale(vector_to_array("_s.variance"), shrink).alias("var"),
    )


def with_std(moments: DataFrame) -> DataFrame:
    return moments.withColumn("std", F.zip_with("var", "mean", safe_std))


def fit_scaler(train: DataFrame, features: str = "features") -> DataFrame:
    """One row ``(n, mean[], std[])`` of the training rows."""
    return with_std(population_moments(train, [], features)).select("n", "mean", "std")


def scaled(values: Column, mean: Column, std: Column) -> Column:
    return V.divide(V.subtract(values, mean), std)


def apply_scaler(df: DataFrame, scaler: DataFrame, features: str = "features") -> DataFrame:
    """Scale with stored parameters.  The one-row table is a scalar subquery: no join, no shuffle."""
    held = df.withColumn("_scaler", scaler.select(F.struct("mean", "std")).scalar())
    return held.withColumn(features, scaled(F.col(features), F.col("_scaler.mean"), F.col("_scaler.std"))).drop("_scaler")


def long_parameters(table: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Array parameters as rows ``(by..., feature, columns...)``."""
    zipped = F.arrays_zip(*columns)
    return table.select(*by, F.posexplode(zipped).alias("feature", "_p")).select(
        *by, "feature", *[F.col(f"_p.{c}").alias(c) for c in columns]
    )


# ---- additive sums -----------------------------------------------------------------

def centre_of(df: DataFrame, features: str = "features") -> DataFrame:
    """One row ``(centre[])``: values are centred with it before sums are subtracted."""
    return population_moments(df, [], features).select(F.col("mean").alias("centre"))


def moment_sums(df: DataFrame, by: Sequence[str], centre: DataFrame, features: str = "features") -> DataFrame:
    """Rows ``(by..., n, s1[], s2[])``: count, sum and sum of squares of centred features.

    These add up and subtract, so every fold of a cross-validation comes from one pass.
    """
    moved = V.subtract(F.col(features), F.col("_centre"))
    return (
        df.withColumn("_centre", centre.scalar())
        .select(*by, moved.alias("_z"))
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            V.sum_vectors(F.col("_z")).alias("s1"),
            V.sum_vectors(V.squares(F.col("_z"))).alias("s2"),
        )
    )


def add_up(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    return sums.groupBy(*by).agg(
        F.sum("n").alias("n"), V.sum_vectors(F.col("s1")).alias("s1"), V.sum_vectors(F.col("s2")).alias("s2")
    )


def leave_one_out(sums: DataFrame, fold: str, label: str) -> DataFrame:
    """Sums of all rows *outside* each fold, per class: totals minus the fold's own sums.

    Input and output have at most folds x classes rows; no row of data is repeated.
    """
    totals = add_up(sums, [label])
    everything = totals.agg(F.collect_list(F.struct(label, "n", "s1", "s2")).alias("t"))
    grid = (
        sums.select(fold).distinct()
        .withColumn("_all", everything.scalar())
        .select(fold, F.explode("_all").alias("t"))
        .select(fold, f"t.{label}", "t.n", "t.s1", "t.s2")
    )
    own = sums.select(
        fold, label, F.col("n").alias("_n"), F.col("s1").alias("_s1"), F.col("s2").alias("_s2")
    )
    joined = grid.join(own, [fold, label], "left")
    present = F.col("_n").isNotNull()
    return joined.select(
        fold,
        label,
        (F.col("n") - F.coalesce("_n", F.lit(0))).alias("n"),
        F.when(present, V.subtract(F.col("s1"), F.col("_s1"))).otherwise(F.col("s1")).alias("s1"),
        F.when(present, V.subtract(F.col("s2"), F.col("_s2"))).otherwise(F.col("s2")).alias("s2"),
    ).where(F.col("n") > 0)


def moments_of_sums(sums: DataFrame, by: Sequence[str], centre: DataFrame) -> DataFrame:
    """Turn sums into ``(by..., n, mean[], var[])``."""
    mean = V.scale(F.col("s1"), 1.0 / F.col("n"))
    raw = V.scale(F.col("s2"), 1.0 / F.col("n"))
    return sums.withColumn("_centre", centre.scalar()).withColumn("_m", mean).select(
        *by,
        "n",
        V.add(F.col("_m"), F.col("_centre")).alias("mean"),
        F.zip_with(raw, "_m", lambda q, m: F.greatest(q - m * m, F.lit(0.0))).alias("var"),
    )


def fold_scalers(outside: DataFrame, fold: str, centre: DataFrame) -> DataFrame:
    """Scaler ``(fold, n, mean[], std[])`` of the rows outside each fold."""
    return with_std(moments_of_sums(add_up(outside, [fold]), [fold], centre)).select(fold, "n", "mean", "std")
