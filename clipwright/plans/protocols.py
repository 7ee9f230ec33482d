"""The three evaluation protocols, zero-shot scoring and their comparison.

Each function takes a feature table (id, ``features``, ``label``, ``file_path``, ``dataset``) and
returns DataFrames.  The scaled table that all models read is written once to the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, functions as F

from clipwright.operators import classifiers, components, metrics, moments as M, roc, splits
from clipwright.operators.labels import unseen_labels, with_subject
from clipwright.operators.sizing import class_names
from clipwright.session import settle
from clipwright.sources.readers import ContractError, require_columns, require_rows

SUBMITTERS = 4


@dataclass
class Outcome:
    """What a protocol produced; ``space`` maps raw rows into the space the models were fitted in.

    ``fits`` goes by model name, or by (fold, model name) where each fold has its own; then ``scaler`` has a row
    per fold.
    """

    classes: list[str]
    fits: dict
    predictions: dict[str, DataFrame]
    reports: DataFrame
    areas: DataFrame
    scaler: DataFrame | None = None
    projection: components.Components | None = None
    options: dict[str, object] = field(default_factory=dict)

    def space(self, raw: DataFrame, already_scaled: bool = False) -> DataFrame:
        """Scale once, with the training parameters, then project if the models want components."""
        if isinstance(next(iter(self.fits), None), tuple) and not already_scaled:
            raise ValueError("every fold has a space of its own: use fold_space")
        if self.projection is not None:
            return components.transform(raw, self.projection)
        if already_scaled or self.scaler is None:
            return raw
        return M.apply_scaler(raw, self.scaler)


    def fold_space(self, fold: int, raw: DataFrame) -> DataFrame:
        """Scale with the parameters of one fold's training rows."""
        return M.apply_scaler(raw, self.scaler.where(F.col("fold") == fold).select("n", "mean", "std"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _areas(name: str, pred: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Macro area of one model; NULL for a family without probabilities."""
    if "proba" not in pred.columns:
        blank = pred.select(*keys).distinct() if keys else pred.sparkSession.range(1).select()
        return blank.select(F.lit(name).alias("model"), *keys, F.lit(None).cast("double").alias("auc"))
    scores = F.transform("proba", lambda p: F.struct(p["label"].alias("label"), p["proba"].alias("score")))
    long = roc.one_vs_rest(pred, keys, "label", scores)
    macro = roc.macro_auc(roc.class_auc(long, keys), keys)
    return macro.select(F.lit(name).alias("model"), *keys, F.col("macro_auc").alias("auc"))


def _reports(name: str, pred: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return metrics.evaluate(pred, keys, "label", "pred_label").select(
        F.lit(name).alias("model"), *keys, *metrics.SIX_METRICS
    )


def _fit_all(train: DataFrame, test: DataFrame, models: Sequence[str], classes, settings, seed, id_column):
    def one(name: str):
        fitted = classifiers.fit(name, train, classes, (settings or {}).get(name), seed, id_column)
        return name, fitted, settle(fitted.predict(test))

    with ThreadPool(SUBMITTERS) as pool:
        done = pool.map(one, models)
    return {n: f for n, f, _ in done}, {n: p for n, _, p in done}


def hold_out(
    table: DataFrame, models: Sequence[str] = classifiers.MODEL_NAMES, settings: dict | None = None,
    test_size: float = 0.2, seed: int = 42, project: bool = False, threshold: float = 0.99,
    id_column: str = "clip_id", min_rows: int = 500,
) -> Outcome:
    """Stratified hold-out; with ``project`` the models see principal components."""
    require_columns(table, [id_column, "features", "label", "file_path"])
    split = splits.stratified_split(table, id_column, test_size, seed)
    train = require_rows(split.where("role = 'train'"), min_rows)
    scaler = M.fit_scaler(train)
    projection = components.fit(train, threshold=threshold, scaler=scaler) if project else None
    ready = settle(components.transform(split, projection) if project else M.apply_scaler(split, scaler))
    classes = class_names(ready.where("role = 'train'"))
    fits, predictions = _fit_all(
        ready.where("role = 'train'"), ready.where("role = 'test'"), models, classes, settings, seed, id_column
    )
    return Outcome(
        classes, fits, predictions,
        _union([_reports(n, p) for n, p in predictions.items()]),
        _union([_areas(n, p) for n, p in predictions.items()]),
        scaler, projection,
    )


def leave_group_out(
    table: DataFrame, models: Sequence[str] = classifiers.MODEL_NAMES, settings: dict | None = None,
    seed: int = 42, id_column: str = "clip_id", min_rows: int = 500, tasks: int | None = None,
) -> Outcome:
    """Leave-one-group-out: per fold, scale and fit on all other groups, score the group.

    Rows are never multiplied: a fold's training set is a filter over one written table.  The
    scalers of all folds come from one pass.  Models and scalers of every fold are kept.
    """
    grouped = settle(splits.with_fold(with_subject(table)))
    folds = [r[0] for r in grouped.select("fold").distinct().orderBy("fold").collect()]
    if not folds:
        raise ContractError("no group could be derived from any path")
    centre = settle(M.centre_of(grouped))
    outside = M.leave_one_out(M.moment_sums(grouped, ["fold", "label"], centre), "fold", "label")
    scalers = settle(M.fold_scalers(outside, "fold", centre))
    outcome = Outcome([], {}, {}, None, None, scalers)
    known = {}
    for fold in folds:
        train = grouped.where(F.col("fold") != fold)
        if fold == folds[0]:
            require_rows(train, min_rows)
        known[fold] = class_names(train)          # a class that only the held-out group has is not known

    def one(job):
        fold, name = job
        ready = outcome.fold_space(fold, grouped.where(F.col("fold") != fold))
        held = outcome.fold_space(fold, grouped.where(F.col("fold") == fold))
        fitted = classifiers.fit(name, ready, known[fold], (settings or {}).get(name), seed, id_column, tasks=tasks)
        return fold, name, fitted, settle(fitted.predict(held))

    with ThreadPool(SUBMITTERS) as pool:
        done = pool.map(one, [(f, n) for f in folds for n in models], chunksize=1)
    outcome.classes = sorted(set().union(*known.values()))
    outcome.fits = {(f, n): fitted for f, n, fitted, _ in done}
    outcome.predictions = {n: _union([p for _, name, _, p in done if name == n]) for n in models}
    outcome.reports = _union([_reports(n, p, ["fold"]) for n, p in outcome.predictions.items()])
    per_fold = _union([_areas(n, p, ["fold"]) for n, p in outcome.predictions.items()])
    outcome.areas = roc.fold_nanmean(per_fold, ["model"], "auc")
    outcome.options["fold_areas"] = per_fold
    return outcome


def fold_summary(outcome: Outcome) -> DataFrame:
    """Mean and sample deviation over folds of a leave-group-out outcome."""
    return metrics.fold_summary(metrics.model_fold_grid(metrics.to_long(outcome.reports, ["model", "fold"])))


def zero_shot(outcome: Outcome, external: DataFrame, already_scaled: bool = False):
    """Score another corpus with stored parameters: (predictions, reports or None).

    Predictions go by the keys of ``outcome.fits``: by model, or by fold and model, each fold with its own scaler.
    """
    if "label" in external.columns:
        known = external.sparkSession.createDataFrame([(c,) for c in outcome.classes], "label string")
        stranger = unseen_labels(external, known).head()
        if stranger is not None:
            raise ContractError(f"label unknown to the models: {stranger['label']}")
    folds = sorted({k[0] for k in outcome.fits if isinstance(k, tuple)})
    if folds:
        ready = {f: external if already_scaled else settle(outcome.fold_space(f, external)) for f in folds}
        predictions = {(f, n): fitted.predict(ready[f]).withColumn("fold", F.lit(f)) for (f, n), fitted in outcome.fits.items()}
        reports = lambda: [_reports(n, p, ["fold"]) for (_, n), p in predictions.items()]
    else:
        ready = settle(outcome.space(external, already_scaled))
        predictions = {n: fitted.predict(ready) for n, fitted in outcome.fits.items()}
        reports = lambda: [_reports(n, p) for n, p in predictions.items()]
    if "label" not in external.columns:
        return predictions, None
    return predictions, _union(reports()).orderBy("model")


def compare(outcomes: dict[str, Outcome]) -> DataFrame:
    """Rows (model, workflow, auc) of several protocols, ready for the comparison operators."""
    return _union([
        o.areas.select("model", F.lit(workflow).alias("workflow"), "auc") for workflow, o in outcomes.items()
    ])
