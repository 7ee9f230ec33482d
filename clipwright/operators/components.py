"""Second moments and principal components of scaled training features.

Both shrink each partition to one features x features matrix before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from clipwright.functions import vectors as V
from clipwright.operators import moments as M

VARIANCE_THRESHOLD = 0.99
PREFIX = "pca_"


def covariance(df: DataFrame, features: str = "features") -> DataFrame:
    """Rows (i, j, cov) of the population covariance of features that are already centred.

    Each partition adds up its own product matrix; only those matrices are shuffled.
    """
    schema = T.StructType([
        T.StructField("i", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("row", T.ArrayType(T.DoubleType())),
    ])

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, rows = None, 0
        for batch in batches:
            if len(batch):
                block = np.stack(batch[features].to_numpy())
                part = block.T @ block
                gram = part if gram is None else gram + part
                rows += len(block)
        if gram is not None:
            yield pd.DataFrame({"i": range(len(gram)), "n": rows, "row": list(gram)})

    sums = df.select(features).mapInPandas(products, schema).groupBy("i").agg(
        F.sum("n").alias("n"), V.sum_vectors(F.col("row")).alias("row")
    )
    return sums.select("i", "n", F.posexplode("row").alias("j", "s")).select(
        "i", "j", (F.col("s") / F.col("n")).alias("cov")
    )


@dataclass
class Components:
    """A fitted projection: scaler, MLlib model, signs, and the variance shares kept."""

    scaler: DataFrame
    model: PCAModel
    signs: list[float]
    shares: list[float]

    @property
    def k(self) -> int:
        return len(self.signs)

    @property
    def names(self) -> list[str]:
        return [f"{PREFIX}{i}" for i in range(self.k)]


def _signs(model: PCAModel) -> list[float]:
    """Turn each component so that its largest loading is positive."""
    loadings = model.pc.toArray()
    return [float(np.sign(column[np.abs(column).argmax()]) or 1.0) for column in loadings.T]


def fit(
    train: DataFrame, k: int | None = None, threshold: float = VARIANCE_THRESHOLD,
    features: str = "features", scaler: DataFrame | None = None,
) -> Components:
    """Fit on scaled training rows: ``k`` components, or the fewest whose share passes ``threshold``.

    The matrix that reaches the driver is features x features.
    """
    scaler = scaler or M.fit_scaler(train, features)
    ready = M.apply_scaler(train, scaler, features).select(V.to_vector(F.col(features)).alias("_vector"))
    width = k or len(scaler.first()["mean"])
    model = PCA(k=width, inputCol="_vector", outputCol="_projected").fit(ready)
    shares = model.explainedVariance.toArray().tolist()
    if k is None:
        passed = np.cumsum(shares) > threshold
        width = int(passed.argmax()) + 1 if passed.any() else len(shares)
    return Components(scaler, model, _signs(model)[:width], shares[:width])


def transform(df: DataFrame, fitted: Components, features: str = "features") -> DataFrame:
    """Replace ``features`` by the components; the other columns are carried along."""
    ready = M.apply_scaler(df, fitted.scaler, features).withColumn("_vector", V.to_vector(F.col(features)))
    projected = fitted.model.transform(ready)
    kept = F.slice(vector_to_array("_projected"), 1, fitted.k)
    return projected.withColumn(features, V.multiply(kept, V.literal(fitted.signs))).drop("_vector", "_projected")


def wide(df: DataFrame, names: list[str], features: str = "features") -> DataFrame:
    """Array to one column per name, for sinks."""
    rest = [c for c in df.columns if c != features]
    return df.select(*[F.get(features, F.lit(i)).alias(n) for i, n in enumerate(names)], *rest)


def variance_table(spark: SparkSession, fitted: Components) -> DataFrame:
    """Rows (component from 1, ratio, cumulative)."""
    table = spark.range(1).select(
        F.posexplode(V.literal(fitted.shares)).alias("_i", "explained_variance_ratio")
    ).select((F.col("_i") + 1).alias("component"), "explained_variance_ratio")
    return cumulative_variance(table)


def cumulative_variance(table: DataFrame) -> DataFrame:
    """Running sum over components: a table with one row per feature at most."""
    so_far = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return table.withColumn("cumulative_explained_variance", F.sum("explained_variance_ratio").over(so_far))


def loadings(spark: SparkSession, fitted: Components) -> DataFrame:
    """Rows (component from 1, feature, weight)."""
    matrix = fitted.model.pc.toArray()[:, : fitted.k] * np.array(fitted.signs)
    return spark.range(1).select(F.posexplode(V.literal_matrix(matrix.T)).alias("_c", "_w")).select(
        (F.col("_c") + 1).alias("component"), F.posexplode("_w").alias("feature", "weight")
    )


def residuals(train: DataFrame, table: DataFrame, shares: DataFrame, features: str = "features") -> DataFrame:
    """(component, residual, length): how far each component is from an eigenvector of the training covariance, and its length.

    ``train`` is scaled as the fit saw it, ``table`` comes from :func:`loadings`, ``shares`` from :func:`variance_table`.
    The residual is the largest entry of C v - lambda v; everything joined is features x components at most.
    """
    cells = covariance(train, features)
    trace = cells.where("i = j").agg(F.sum("cov"))
    turned = cells.join(table.withColumnRenamed("feature", "j"), "j").groupBy("component", "i").agg(
        F.sum(F.col("cov") * F.col("weight")).alias("turned"))
    both = turned.join(table.withColumnRenamed("feature", "i"), ["component", "i"]).join(shares, "component")
    gap = F.abs(F.col("turned") - F.col("explained_variance_ratio") * trace.scalar() * F.col("weight"))
    return both.groupBy("component").agg(F.max(gap).alias("residual"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))


def top_loadings(table: DataFrame, components: int = 5, per_component: int = 5) -> DataFrame:
    """The strongest features of the first components."""
    place = Window.partitionBy("component").orderBy(F.desc(F.abs("weight")), "feature")
    return (
        table.where(F.col("component") <= components)
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= per_component)
    )
