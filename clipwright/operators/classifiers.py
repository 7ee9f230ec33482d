"""The seven classifier families behind one interface.

Trees, boosting, logistic regression and the margin classifier are MLlib estimators; naive
Bayes and nearest neighbours are relational.  A fitted model turns rows with a ``features``
array into ``pred_label`` and, where the family has probabilities, a ``proba`` array of
struct(label, proba) in encoder order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from clipwright.functions import vectors as V
from clipwright.operators import bayes, labels, moments, neighbours

MODEL_NAMES = ["rf", "xgb", "svm", "knn", "dtr", "logistic", "nb"]

# Published default settings.
SETTINGS: dict[str, dict[str, object]] = {
    "rf": {"n_estimators": 100, "max_depth": 15, "min_samples_leaf": 5},
    "xgb": {"n_estimators": 100, "max_depth": 4, "learning_rate": 0.1},
    "svm": {"C": 0.5, "gamma": "scale"},
    "knn": {"n_neighbors": 15, "weights": "distance"},
    "dtr": {"max_depth": 12, "min_samples_leaf": 5},
    "logistic": {"C": 1.0, "max_iter": 3000},
    "nb": {"var_smoothing": 1e-9},
}
FOURIER_FEATURES = 256


@dataclass
class Fitted:
    """A fitted classifier; ``apply`` adds ``pred_label`` and perhaps ``proba``."""

    name: str
    classes: list[str]
    settings: dict[str, object]
    has_proba: bool
    apply: Callable[[DataFrame], DataFrame]
    model: Model | DataFrame | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """Metadata plus ``pred_label``, ``pred_label_enc`` and ``proba`` where available."""
        out = self.apply(df)
        return out.withColumn("pred_label_enc", labels.class_index(F.col("pred_label"), self.classes))


def vectorized(df: DataFrame, classes: Sequence[str], features: str = "features", label: str = "label") -> DataFrame:
    """Add MLlib's ``vector`` and ``label_enc`` columns."""
    return df.withColumn("vector", V.to_vector(F.col(features))).withColumn(
        "label_enc", labels.class_index(F.col(label), classes).cast("double")
    )


def estimator(name: str, settings: Mapping[str, object], rows: int, seed: int = 42, parallelism: int = 4):
    """The MLlib estimator of a family, from settings in their published names."""
    columns = {"featuresCol": "vector", "labelCol": "label_enc"}
    if name == "dtr":
        return DecisionTreeClassifier(
            maxDepth=settings["max_depth"], minInstancesPerNode=settings["min_samples_leaf"], seed=seed, **columns
        )
    if name == "rf":
        return RandomForestClassifier(
            numTrees=settings["n_estimators"], maxDepth=settings["max_depth"],
            minInstancesPerNode=settings["min_samples_leaf"], featureSubsetStrategy="sqrt", seed=seed, **columns
        )
    if name == "xgb":
        base = GBTClassifier(
            maxIter=settings["n_estimators"], maxDepth=settings["max_depth"],
            stepSize=settings["learning_rate"], seed=seed, **columns
        )
        return OneVsRest(classifier=base, parallelism=parallelism, **columns)
    if name == "logistic":
        return LogisticRegression(
            family="multinomial", regParam=1.0 / (settings["C"] * rows), elasticNetParam=0.0,
            standardization=False, maxIter=settings["max_iter"], **columns
        )
    if name == "svm":
        base = LinearSVC(regParam=1.0 / (settings["C"] * rows), standardization=False, **columns)
        return OneVsRest(classifier=base, parallelism=parallelism, **columns)
    raise ValueError(f"no estimator for {name}")


def kernel_width(train: DataFrame, gamma: str, features: str = "features") -> float:
    """``auto``: 1 / features; ``scale``: 1 / (features x variance of all entries)."""
    row = moments.population_moments(train, [], features).first()
    width = len(row["mean"])
    if gamma == "auto":
        return 1.0 / width
    means, spread = np.array(row["mean"]), np.array(row["var"])
    overall = float((spread + means**2).mean() - means.mean() ** 2)
    return 1.0 / (width * overall) if overall > 0 else 1.0


def fourier_features(width: int, gamma: float, seed: int, size: int = FOURIER_FEATURES):
    """Pandas UDF: random features whose dot product approximates the RBF kernel (Rahimi and Recht 2007)."""
    draw = np.random.default_rng(seed)
    weights = draw.normal(0.0, np.sqrt(2.0 * gamma), size=(width, size))
    phases = draw.uniform(0.0, 2.0 * np.pi, size)

    @F.pandas_udf("array<double>")
    def expand(values: pd.Series) -> pd.Series:
        mapped = np.sqrt(2.0 / size) * np.cos(np.stack(values.to_numpy()) @ weights + phases)
        return pd.Series(list(mapped))

    return expand


def kernel_space(df: DataFrame, gamma: str, seed: int, features: str = "features") -> DataFrame:
    """The rows with their features expanded for one kernel width."""
    width = len(df.select(features).first()[0])
    expand = fourier_features(width, kernel_width(df, gamma, features), seed)
    return V.fenced(df, features, F.col(features)).withColumn(features, expand(F.col(features)))


def kernel_projection(df: DataFrame, gamma: str, seed: int, features: str = "features") -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``_space``, the features expanded for the kernel width that ``df`` gives."""
    width = len(df.select(features).first()[0])
    expand = fourier_features(width, kernel_width(df, gamma, features), seed)
    return lambda rows: V.fenced(rows, "_space", expand(F.col(features)))


def _scores(vector: str, classes: Sequence[str]) -> Column:
    table = F.array(*[F.lit(c) for c in classes])
    return F.zip_with(
        table, vector_to_array(vector), lambda c, p: F.struct(c.alias("label"), p.alias("proba"))
    )


def _binary_shares(model, classes: Sequence[str], calibration: Sequence[tuple[float, float]] | None):
    """Apply the one-vs-rest models one by one; each class's share of their probabilities.

    Models without probabilities need ``calibration``: slope and intercept of the log-odds per class.
    """
    def apply(df: DataFrame) -> DataFrame:
        kept, shares = df.columns, []
        for i, binary in enumerate(model.models):
            one = binary.copy()
            one.setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_guess{i}")
            if calibration is None:
                one.setProbabilityCol(f"_share{i}")
            df = one.transform(df)
            margin = F.get(vector_to_array(f"_raw{i}"), F.lit(1))
            if calibration is None:
                shares.append(F.get(vector_to_array(f"_share{i}"), F.lit(1)))
            else:
                slope, intercept = calibration[i]
                shares.append(1.0 / (1.0 + F.exp(-(slope * margin + intercept))))
        total = sum(shares[1:], shares[0])
        pairs = [F.struct(F.lit(c).alias("label"), (p / total).alias("proba")) for c, p in zip(classes, shares)]
        return df.select(*kept, F.array(*pairs).alias("proba"))

    return apply


def _calibrate(model, ready: DataFrame) -> list[tuple[float, float]]:
    """Slope and intercept per class: a logistic curve from margin to membership on the training rows (Platt 1999)."""
    out = []
    for i, binary in enumerate(model.models):
        scored = binary.transform(ready.select("vector", "label_enc")).select(
            array_to_vector(F.array(F.get(vector_to_array("rawPrediction"), F.lit(1)))).alias("margin"),
            (F.col("label_enc") == i).cast("double").alias("hit"))
        curve = LogisticRegression(featuresCol="margin", labelCol="hit", regParam=1e-6, standardization=False).fit(scored)
        out.append((float(curve.coefficients[0]), float(curve.intercept)))
    return out


def fit(
    name: str, train: DataFrame, classes: Sequence[str], settings: Mapping[str, object] | None = None,
    seed: int = 42, id_column: str = "clip_id", features: str = "features", label: str = "label",
    tasks: int | None = None,
) -> Fitted:
    """Fit one family on training rows that are already scaled.

    ``tasks`` bounds the tasks of families that run a short job per round or step, for small tables on few
    cores; left out, the rows stay partitioned as they are.  The kernel family has probabilities if its settings
    say ``probability``, as they take a calibration per class.
    """
    chosen = {**SETTINGS[name], **(settings or {})}
    classes = list(classes)

    if name == "nb":
        model = bayes.fit(train, (), chosen["var_smoothing"], label, features)
        return Fitted(name, classes, chosen, True, lambda df: bayes.predict(df, model, features), model)

    if name == "knn":

        def by_neighbours(df: DataFrame) -> DataFrame:
            found = neighbours.nearest(train, df, chosen["n_neighbors"], id_column, features, label)
            shares = neighbours.vote(found, chosen["weights"], label)
            winner = neighbours.elect(shares, label).drop("pred_share")
            proba = shares.groupBy("query_id").agg(
                F.map_from_entries(F.collect_list(F.struct(label, "share"))).alias("_m")
            )
            aligned = F.transform(
                F.array(*[F.lit(c) for c in classes]),
                lambda c: F.struct(
                    c.alias("label"), F.coalesce(F.try_element_at(F.col("_m"), c), F.lit(0.0)).alias("proba")
                ),
            )
            votes = winner.join(proba, "query_id").select(
                F.col("query_id").alias(id_column), "pred_label", aligned.alias("proba")
            )
            return df.join(votes, id_column)

        return Fitted(name, classes, chosen, True, by_neighbours, train)

    prepare = lambda df: df.withColumn("vector", V.to_vector(F.col(features)))
    if name == "svm":
        width = len(train.select(features).first()[0])
        expand = fourier_features(width, kernel_width(train, chosen["gamma"], features), seed)
        prepare = lambda df: V.fenced(df, features, F.col(features)).withColumn(
            "vector", V.to_vector(expand(F.col(features)))
        )

    ready = (
        prepare(train)
        .select("vector", labels.class_index(F.col(label), classes).cast("double").alias("label_enc"))
        .persist()
    )
    try:
        rows = ready.count()
        held = ready.coalesce(tasks) if tasks and name in ("xgb", "svm", "logistic") else ready
        model = estimator(name, chosen, rows, seed).fit(held)
        has_proba = name != "svm" or bool(chosen.get("probability"))
        calibration = _calibrate(model, held) if name == "svm" and has_proba else None
    finally:
        ready.unpersist()
    one_by_one = _binary_shares(model, classes, calibration) if name in ("xgb", "svm") and has_proba else None

    def by_model(df: DataFrame) -> DataFrame:
        if one_by_one:
            # the class whose binary model is surest, the first one if several are
            best = F.array_position(F.transform("proba", lambda p: p["proba"]), F.array_max(F.transform("proba", lambda p: p["proba"])))
            return one_by_one(prepare(df)).withColumn(
                "pred_label", labels.class_at(best.cast("int") - 1, classes)).drop("vector")
        out = model.transform(prepare(df))
        out = out.withColumn("pred_label", labels.class_at(F.col("prediction").cast("int"), classes))
        if has_proba:
            out = out.withColumn("proba", _scores("probability", classes))
        else:
            out = out.withColumn("raw_scores", _scores("rawPrediction", classes))
        return out.drop("vector", "rawPrediction", "probability", "prediction")

    return Fitted(name, classes, chosen, has_proba, by_model, model)


def proba_wide(pred: DataFrame, classes: Sequence[str], proba: str = "proba") -> DataFrame:
    """One ``proba_<class>`` column per class in encoder order; unchanged if the model has none."""
    if proba not in pred.columns:
        return pred
    known = F.map_from_entries(F.col(proba))
    return pred.withColumns({
        f"proba_{c}": F.coalesce(F.try_element_at(known, F.lit(c)), F.lit(0.0)) for c in classes
    }).drop(proba)
