"""Many linear classifiers fitted in the same passes over the rows.

A search fits every candidate on every training part.  Here all of them advance together: a pass multiplies each block of
rows with the weights of all models at once, adds up losses and gradients per task as one matrix, and hands one row per
task and model on to a map-side-combined sum.  What reaches the driver is models x classes x features numbers.

Training parts are "all rows but one fold", told apart by the row's fold, so no row is copied.  Steps are quasi-Newton
steps on each model's own objective, started from a bound of its curvature: the second moments of its training rows,
which come from one pass for all folds.  A model that has converged, or whose trial point was rejected, does not hold up
the others; passes go on until none is left.

Objectives are a mean loss plus half the penalty times the squared weights, intercepts free: ``softmax`` is multinomial
logistic regression, ``margin`` one squared-hinge classifier per class.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from clipwright.functions import vectors as V
from clipwright.operators import classifiers, labels, metrics, tuning

#: Entries of one block of rows times all models' classes: 32 MB.
BLOCK_ENTRIES = 1 << 22
HISTORY = 60
#: Largest entry of a gradient at which a model of each loss is done, unless the caller asks for less.
TOLERANCE = {"softmax": 1e-4, "margin": 1e-3}
#: Largest second derivative of each loss by the score.
CURVATURE = {"softmax": 0.5, "margin": 1.0}
ALL_ROWS = -1


@dataclass(frozen=True)
class Part:
    """One model: the fold it leaves out (``ALL_ROWS``: none) and its ``C``; the penalty is 1 / (C x training rows)."""

    left_out: int
    c: float


@dataclass
class Models:
    """Weights (models, classes, features + 1) of fitted parts, and what the optimiser did."""

    parts: list[Part]
    loss: str
    classes: list[str]
    weights: np.ndarray
    passes: int
    largest_gradient: float


def prepared(df: DataFrame, classes: Sequence[str], fold: str | None = "fold", features: str = "features", label: str = "label") -> DataFrame:
    """(x, y, fold) of the rows that have a class."""
    own = F.col(fold).cast("int") if fold else F.lit(0)
    return df.where(F.col(label).isNotNull()).select(
        F.col(features).alias("x"), labels.class_index(F.col(label), classes).cast("int").alias("y"), own.alias("fold"))


def _blocks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features with a one behind them, class, fold) of so many rows at a time."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            part = batch.iloc[at: at + rows]
            x = np.stack(part["x"].to_numpy())
            yield np.hstack([x, np.ones((len(x), 1))]), part["y"].to_numpy(), part["fold"].to_numpy()


def second_moments(ready: DataFrame) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Product sums and rows of each fold, the constant one included: folds x features squared numbers."""
    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[int, np.ndarray] = {}
        for x, _, folds in _blocks(batches, 1 << 14):
            for fold in np.unique(folds).tolist():
                own = x[folds == fold]
                grams[fold] = grams.get(fold, 0) + own.T @ own
        for fold, gram in grams.items():
            yield pd.DataFrame({"fold": fold, "i": range(len(gram)), "row": list(gram)})

    sums = ready.mapInPandas(products, "fold int, i int, row array<double>").groupBy("fold", "i").agg(
        V.sum_vectors(F.col("row")).alias("row")).collect()
    found: dict[int, np.ndarray] = {}
    for r in sums:
        found.setdefault(r["fold"], np.zeros((len(r["row"]),) * 2))[r["i"]] = r["row"]
    return found, {fold: int(round(gram[-1, -1])) for fold, gram in found.items()}


def _losses(scores: np.ndarray, y: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """Loss and its derivative by the scores (rows, models, classes) of each row and model."""
    rows = np.arange(len(y))
    if loss == "softmax":
        scores -= scores.max(2, keepdims=True)
        own = scores[rows, :, y].copy()
        np.exp(scores, out=scores)
        total = scores.sum(2)
        scores /= total[:, :, None]
        scores[rows, :, y] -= 1
        return np.log(total) - own, scores
    sign = np.full((len(y), 1, scores.shape[2]), -1.0)
    sign[rows, 0, y] = 1.0
    missing = np.maximum(1 - sign * scores, 0)
    return 0.5 * (missing ** 2).sum(2), -sign * missing


def summed_gradients(ready: DataFrame, weights: np.ndarray, left_out: Sequence[int], loss: str) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient sums of all models over their rows, in one pass."""
    spark = ready.sparkSession
    models, classes, width = weights.shape
    state = spark.sparkContext.broadcast((weights, np.array(left_out)))    # of the models' own size
    rows = max(1, BLOCK_ENTRIES // (models * classes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, skipped = state.value
        losses, gradient = np.zeros(models), np.zeros((models * classes, width))
        for x, y, folds in _blocks(batches, rows):
            scores = (x @ held.reshape(-1, width).T).reshape(len(x), models, classes)
            values, slopes = _losses(scores, y, loss)
            outside = folds[:, None] != skipped[None, :]
            losses += (values * outside).sum(0)
            gradient += (slopes * outside[:, :, None]).reshape(len(x), -1).T @ x
        sums = np.hstack([losses[:, None], gradient.reshape(models, -1)])
        yield pd.DataFrame({"model": range(models), "sums": list(sums)})

    found = ready.mapInPandas(run, "model int, sums array<double>").groupBy("model").agg(
        V.sum_vectors(F.col("sums")).alias("sums")).collect()
    state.unpersist()
    sums = np.zeros((models, 1 + classes * width))
    for r in found:
        sums[r["model"]] = r["sums"]
    return sums[:, 0], sums[:, 1:].reshape(models, classes, width)


class _Descent:
    """Limited-memory quasi-Newton steps of one model."""

    def __init__(self, shape: tuple[int, int], preconditioner: np.ndarray, tolerance: float):
        self.tolerance = tolerance
        self.inverse = preconditioner               # approximate inverse curvature, alike for every class
        self.weights = np.zeros(shape)
        self.trial, self.step, self.direction = self.weights, 1.0, None
        self.value, self.gradient = None, None
        self.pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
        self.done = False

    def _aim(self) -> None:
        aim, used = self.gradient.copy(), []
        for s, y, inner in reversed(self.pairs):
            share = (s * aim).sum() / inner
            aim -= share * y
            used.append(share)
        aim = aim @ self.inverse
        for (s, y, inner), share in zip(self.pairs, reversed(used)):
            aim += s * (share - (y * aim).sum() / inner)
        self.direction, self.step = -aim, 1.0
        if (self.direction * self.gradient).sum() >= 0:
            self.pairs, self.direction = [], -(self.gradient @ self.inverse)

    def tell(self, value: float, gradient: np.ndarray) -> None:
        """Value and gradient at the trial point: take it, or try half the step."""
        if self.value is not None:
            promised = self.step * (self.direction * self.gradient).sum()
            if value > self.value + 1e-4 * promised + 1e-13 * abs(self.value):
                self.step /= 2
                self.done = self.step < 1e-10
                self.trial = self.weights + self.step * self.direction
                return
            s, y = self.trial - self.weights, gradient - self.gradient
            inner = (s * y).sum()
            if inner > 1e-300:
                self.pairs = [*self.pairs[-HISTORY + 1:], (s, y, inner)]
        self.weights, self.value, self.gradient = self.trial, value, gradient
        if np.abs(gradient).max() <= self.tolerance:
            self.done = True
            return
        self._aim()
        self.trial = self.weights + self.step * self.direction


def fit_parts(ready: DataFrame, parts: Sequence[Part], loss: str, classes: Sequence[str], max_passes: int = 500,
              tolerance: float | None = None) -> Models:
    """Fit all parts over ``ready`` (see :func:`prepared`), which should be persisted: it is read once per pass."""
    tolerance = tolerance or TOLERANCE[loss]
    grams, rows = second_moments(ready)
    whole, total = sum(grams.values()), sum(rows.values())
    width = len(whole)
    free = np.r_[np.ones(width - 1), 0.0]            # the intercept has no penalty
    descents, sizes, penalties = [], [], []
    for part in parts:
        own = whole - grams.get(part.left_out, 0)
        size = max(1, total - rows.get(part.left_out, 0))
        penalty = 1.0 / (part.c * size)
        bound = CURVATURE[loss] * own / size + np.diag(penalty * free)
        descents.append(_Descent((len(classes), width), np.linalg.inv(bound + 1e-9 * np.trace(bound) / width * np.eye(width)), tolerance))
        sizes.append(size)
        penalties.append(penalty)
    passes = 0
    while passes < max_passes:
        open_ = [i for i, d in enumerate(descents) if not d.done]
        if not open_:
            break
        trials = np.stack([descents[i].trial for i in open_])
        values, gradients = summed_gradients(ready, trials, [parts[i].left_out for i in open_], loss)
        for at, i in enumerate(open_):
            shrunk = descents[i].trial * free
            descents[i].tell(values[at] / sizes[i] + penalties[i] / 2 * (shrunk ** 2).sum(), gradients[at] / sizes[i] + penalties[i] * shrunk)
        passes += 1
    largest = max((float(np.abs(d.gradient).max()) for d in descents if d.gradient is not None), default=0.0)
    return Models(list(parts), loss, list(classes), np.stack([d.weights for d in descents]), passes, largest)


def confusion_cells(ready: DataFrame, models: Models) -> DataFrame:
    """(model, y_true, y_pred, n): every model on the rows of the fold it left out, in one pass."""
    state = ready.sparkSession.sparkContext.broadcast((models.weights, np.array([p.left_out for p in models.parts])))
    count, classes, width = models.weights.shape
    rows = max(1, BLOCK_ENTRIES // (count * classes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, left_out = state.value
        cells = np.zeros((count, classes, classes), np.int64)
        for x, y, folds in _blocks(batches, rows):
            best = (x @ weights.reshape(-1, width).T).reshape(len(x), count, classes).argmax(2)
            row, model = np.nonzero(folds[:, None] == left_out[None, :])
            np.add.at(cells, (model, y[row], best[row, model]), 1)
        model, true, guess = np.nonzero(cells)
        yield pd.DataFrame({"model": model, "y_true": true, "y_pred": guess, "n": cells[model, true, guess]})

    return ready.mapInPandas(run, "model int, y_true int, y_pred int, n long").groupBy("model", "y_true", "y_pred").agg(F.sum("n").alias("n"))


def class_scores(models: Models, at: int, features: str = "features"):
    """Column of one model's scores per class, in encoder order."""
    weights = models.weights[at]

    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(values.to_numpy()) @ weights[:, :-1].T + weights[:, -1]))

    return run(F.col(features))


def as_fitted(name: str, models: Models, at: int, settings: Mapping[str, object], prepare=None, features: str = "features") -> classifiers.Fitted:
    """One model behind the interface of the families.  Softmax models have probabilities."""
    classes = models.classes

    def apply(df: DataFrame) -> DataFrame:
        ready = prepare(df) if prepare else df.withColumn("_space", F.col(features))
        ready = V.fenced(ready, "_scores", class_scores(models, at, "_space"))
        top = F.array_max("_scores")
        out = ready.withColumn("pred_label", labels.class_at(F.array_position("_scores", top).cast("int") - 1, classes))
        table = F.array(*[F.lit(c) for c in classes])
        if models.loss == "softmax":
            raised = F.transform("_scores", lambda s: F.exp(s - top))
            out = V.fenced(out, "_raised", raised)
            pair = lambda c, p: F.struct(c.alias("label"), (p / V.total(F.col("_raised"))).alias("proba"))
            return out.withColumn("proba", F.zip_with(table, "_raised", pair)).drop("_space", "_scores", "_raised")
        return out.withColumn("raw_scores", F.zip_with(table, "_scores", lambda c, s: F.struct(c.alias("label"), s.alias("proba")))).drop(
            "_space", "_scores")

    return classifiers.Fitted(name, list(classes), dict(settings), models.loss == "softmax", apply)


# ---- searches ----------------------------------------------------------------------

LOSSES = {"logistic": "softmax", "svm": "margin"}


@dataclass
class LinearSearch:
    """Scores of all candidates, the winner fitted on every row, and the winner's models of each fold."""

    name: str
    scores: DataFrame
    points: dict[int, dict]
    best: int
    model: classifiers.Fitted
    fold_models: Models
    space: DataFrame


def search(
    name: str, df: DataFrame, points: Mapping[int, Mapping], classes: Sequence[str], folds: int = tuning.FOLDS, seed: int = 42,
    features: str = "features", label: str = "label", fold: str = "fold", max_passes: int = 500,
    tolerance: float | None = None,
) -> LinearSearch:
    """All ``points`` (candidate -> settings) of ``logistic`` or ``svm`` over the given folds, by weighted F1.

    Candidates that differ in nothing the objective knows share their models.  Each penalty is fitted on all rows beside
    its folds, so the winner needs no second search.  Kernel widths have features of their own and a batch each.
    """
    loss = LOSSES[name]
    widths = {i: p.get("gamma") if name == "svm" else None for i, p in points.items()}
    parts_scores, held = [], {}
    for width in dict.fromkeys(widths.values()):
        own = [i for i in points if widths[i] == width]
        prepare = None if width is None else classifiers.kernel_projection(df, width, seed, features)
        space = prepare(df) if prepare else df.withColumn("_space", F.col(features))
        ready = prepared(space, classes, fold, "_space", label).persist()
        constants = sorted({float(points[i]["C"]) for i in own})
        parts = [Part(left, c) for c in constants for left in [*range(folds), ALL_ROWS]]
        models = fit_parts(ready, parts, loss, classes, max_passes, tolerance)
        reports = metrics.report(confusion_cells(ready, models), ["model"]).select("model", "f1_weighted").collect()
        ready.unpersist()
        found = {parts[r["model"]]: r["f1_weighted"] for r in reports}       # a row per model
        for i in own:
            c = float(points[i]["C"])
            parts_scores += [(name, i, f, float(found[Part(f, c)])) for f in range(folds) if Part(f, c) in found]
            held[i] = (models, parts.index(Part(ALL_ROWS, c)), prepare, space)
    scores = df.sparkSession.createDataFrame(parts_scores, "model string, candidate int, fold int, score double")
    best = tuning.best_candidate(tuning.mean_scores(scores)).first()["candidate"]
    models, at, prepare, space = held[best]
    c = float(points[best]["C"])
    by_fold = [models.parts.index(Part(f, c)) for f in range(folds)]
    fold_models = Models([models.parts[i] for i in by_fold], loss, models.classes, models.weights[by_fold], models.passes, models.largest_gradient)
    fitted = as_fitted(name, models, at, {**classifiers.SETTINGS[name], **points[best]}, prepare, features)
    return LinearSearch(name, scores, {i: dict(p) for i, p in points.items()}, best, fitted, fold_models, space)


def drawn_points(candidates: DataFrame, name: str) -> dict[int, dict]:
    """Settings of one family's candidates of :func:`tuning.random_candidates`, with their types of the grid."""
    kinds = {k: type(v[0]) for k, v in tuning.GRIDS[name].items()}
    rows = candidates.where(F.col("model") == name).orderBy("candidate").collect()    # a grid's size at most
    return {r["candidate"]: {k: kinds[k](v) for k, v in r["params"].items()} for r in rows}


def intercept_gaps(ready: DataFrame, models: Models) -> DataFrame:
    """(left_out, label, n, gap): slope of each model's objective by its intercepts over its training rows, and their count.

    At an optimum all are zero: softmax probabilities add up to the class's rows, margins missing on both sides are equal.
    """
    state = ready.sparkSession.sparkContext.broadcast((models.weights, np.array([p.left_out for p in models.parts])))
    count, classes, width = models.weights.shape
    loss, names, left_out = models.loss, models.classes, [p.left_out for p in models.parts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, skipped = state.value
        slopes, held = np.zeros((count, classes)), np.zeros((count, classes), np.int64)
        for x, y, folds in _blocks(batches, max(1, BLOCK_ENTRIES // (count * classes))):
            _, slope = _losses((x @ weights.reshape(-1, width).T).reshape(len(x), count, classes), y, loss)
            outside = folds[:, None] != skipped[None, :]
            slopes += (slope * outside[:, :, None]).sum(0)
            row, model = np.nonzero(outside)
            np.add.at(held, (model, y[row]), 1)
        model, at = np.divmod(np.arange(count * classes), classes)
        yield pd.DataFrame({"left_out": np.array(left_out)[model], "label": np.array(names)[at], "n": held.ravel(), "slope": slopes.ravel()})

    sums = ready.mapInPandas(run, "left_out int, label string, n long, slope double").groupBy("left_out", "label").agg(
        F.sum("n").alias("n"), F.sum("slope").alias("slope"))
    return sums.select("left_out", "label", "n", (F.col("slope") / F.sum("n").over(Window.partitionBy("left_out"))).alias("gap"))
