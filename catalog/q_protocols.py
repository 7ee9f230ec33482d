"""Whole protocols: models fitted, scored and compared by their own scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as T
from catalog.q_models import KNN_VOTES
from catalog.registry import query, view
from clipwright.operators import metrics
from clipwright.plans import protocols

MODELS = ["nb", "knn"]
#: The smallest tables hold 400 training rows.
MIN_ROWS = 100

view("po_scores", f"""
    SELECT 'nb' AS model, clip_id, y_true, class, proba AS score FROM nb_proba
    UNION ALL SELECT 'knn', q.clip_id, q.label, c.label, coalesce(v.share, 0)
    FROM (SELECT clip_id, label FROM split WHERE role = 'test') q CROSS JOIN (SELECT DISTINCT label FROM clips) c
    LEFT JOIN ({KNN_VOTES}) v ON v.query_id = q.clip_id AND v.label = c.label""", "nb_proba", "split", "clips", "scaled")
view("po_pred", """
    SELECT model, clip_id, y_true, class AS y_pred
    FROM (SELECT *, row_number() OVER (PARTITION BY model, clip_id ORDER BY round(score, 12) DESC, class) AS place FROM po_scores)
    WHERE place = 1""", "po_scores")
view("zg_rows", """
    SELECT f, clip_id, label, feature, (x * 1.5::DOUBLE + 0.1::DOUBLE - mean) / std AS z
    FROM feat JOIN lo_scaler USING (feature)""", "feat", "lo_scaler")
view("zg_pred", """
    SELECT f AS fold, clip_id, y_true, arg_max(class, score) AS y_pred
    FROM (SELECT s.f, clip_id, s.label AS y_true, p.label AS class,
                 ln(max(prior)) + sum(-0.5::DOUBLE * ln(2 * pi() * var) - 0.5::DOUBLE * power(z - mean, 2) / var) AS score
          FROM zg_rows s JOIN lo_params p ON s.f = p.f AND s.feature = p.feature GROUP BY s.f, clip_id, s.label, p.label)
    GROUP BY f, clip_id, y_true""", "zg_rows", "lo_params")


def _report(pred: str, key: str) -> str:
    """The six metrics of predictions (key, y_true, y_pred)."""
    return f"""
    SELECT {key}, round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy, round(sum(f * support) / sum(support), 6) AS f1_weighted,
           round(avg(f), 6) AS f1_macro, round(avg(r), 6) AS uar, round(sum(p * support) / sum(support), 6) AS precision_weighted,
           round(sum(r * support) / sum(support), 6) AS recall_weighted
    FROM (SELECT {key}, label, sum(support) AS support, sum(hits) AS hits,
                 CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(hits) / sum(predicted)::DOUBLE END AS p,
                 CASE WHEN sum(support) = 0 THEN 0 ELSE sum(hits) / sum(support)::DOUBLE END AS r,
                 2.0::DOUBLE * sum(hits) / (sum(support) + sum(predicted)) AS f
          FROM (SELECT {key}, y_true AS label, 1 AS support, 0 AS predicted, (y_true = y_pred)::INTEGER AS hits FROM {pred}
                UNION ALL SELECT {key}, y_pred, 0, 1, 0 FROM {pred}) GROUP BY {key}, label)
    GROUP BY {key}"""


def _hold_out(spark, d):
    return protocols.hold_out(T.features(spark, d), MODELS, min_rows=MIN_ROWS)


def _groups(spark, d):
    return protocols.leave_group_out(T.features(spark, d), ["nb"], min_rows=MIN_ROWS)


@query("protocol_hold_out", _report("po_pred", "model"), "po_pred")
def protocol_hold_out(spark, d):
    """Split, scale, fit, predict and score, for naive Bayes and nearest neighbours."""
    return _hold_out(spark, d).reports.select("model", *T.r6(*metrics.SIX_METRICS))


@query("protocol_areas", """
    SELECT model, round(avg(area), 6) AS auc
    FROM (SELECT a.model, a.class, sum(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5::DOUBLE ELSE 0 END)
                 / count(*) AS area
          FROM po_scores a JOIN po_scores b ON a.model = b.model AND a.class = b.class AND a.y_true = a.class AND b.y_true <> b.class
          GROUP BY a.model, a.class)
    GROUP BY model""", "po_scores")
def protocol_areas(spark, d):
    """Macro one-vs-rest areas from the models' own scores."""
    return _hold_out(spark, d).areas.select("model", *T.r6("auc"))


@query("protocol_groups", "SELECT 'nb' AS model, * FROM (" + _report("lo_pred", "fold") + ")", "lo_pred")
def protocol_groups(spark, d):
    """Leave-one-group-out: every fold with a scaler and a model of its own."""
    return _groups(spark, d).reports.select("model", F.col("fold").cast("long").alias("fold"), *T.r6(*metrics.SIX_METRICS))


@query("zero_shot_groups", "SELECT 'nb' AS model, * FROM (" + _report("zg_pred", "fold") + ")", "zg_pred")
def zero_shot_groups(spark, d):
    """Another corpus, the whole table shifted, scored by the model of every fold and scaled by that fold's parameters."""
    _, reports = protocols.zero_shot(_groups(spark, d), T.shifted(T.features(spark, d)))
    return reports.select("model", F.col("fold").cast("long").alias("fold"), *T.r6(*metrics.SIX_METRICS))


def _components(spark, d):
    return protocols.hold_out(T.features(spark, d), MODELS, project=True, min_rows=MIN_ROWS)


@query("protocol_components")
def protocol_components(spark, d):
    """The hold-out protocol on principal components fitted on its training rows."""
    return _components(spark, d).reports.select("model", *T.r6(*metrics.SIX_METRICS))


@query("protocol_comparison")
def protocol_comparison(spark, d):
    """Macro areas of the three protocols by their models' own scores; a protocol without a model has none."""
    runs = {"80_20": _hold_out(spark, d), "loso": _groups(spark, d), "pca": _components(spark, d)}
    areas = protocols.compare(runs)
    return areas.select("model", "workflow", *T.r6("auc"))
