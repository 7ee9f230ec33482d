"""ROC curves, areas and curve averages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as T
from catalog.registry import query, view
from clipwright.operators import roc

KEYS = ["workflow", "model"]


def _curve_views(prefix: str, keys: str) -> None:
    view(f"{prefix}_cells", f"""
        SELECT {keys}, class, score, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg
        FROM scores WHERE score IS NOT NULL GROUP BY {keys}, class, score""", "scores")
    view(f"{prefix}_points", f"""
        SELECT {keys}, class, score,
               sum(neg) OVER w / sum(neg) OVER g::DOUBLE AS fpr, sum(pos) OVER w / sum(pos) OVER g::DOUBLE AS tpr
        FROM {prefix}_cells
        WINDOW w AS (PARTITION BY {keys}, class ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
               g AS (PARTITION BY {keys}, class)
        UNION ALL SELECT DISTINCT {keys}, class, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM {prefix}_cells""",
         f"{prefix}_cells")
    view(f"{prefix}_steps", f"""
        SELECT {keys}, class, fpr, min(tpr) AS lo, max(tpr) AS hi FROM {prefix}_points GROUP BY {keys}, class, fpr""",
         f"{prefix}_points")
    joined = " AND ".join(f"w.{k.strip()} = s.{k.strip()}" for k in [*keys.split(","), "class"])
    view(f"{prefix}_wanted", f"""
        SELECT g.*, c.class FROM (SELECT DISTINCT {keys}, fpr AS x FROM {prefix}_points) g
        JOIN (SELECT DISTINCT {keys}, class FROM {prefix}_points) c USING ({keys})""", f"{prefix}_points")
    columns = ", ".join(f"w.{k.strip()}" for k in keys.split(","))
    view(f"{prefix}_before", f"""
        SELECT {columns}, w.class, w.x, s.fpr AS ax, s.hi AS ay
        FROM {prefix}_wanted w ASOF LEFT JOIN {prefix}_steps s ON {joined} AND w.x >= s.fpr""",
         f"{prefix}_wanted", f"{prefix}_steps")
    view(f"{prefix}_curve", f"""
        SELECT {keys}, x AS fpr, avg(CASE WHEN x = ax OR bx IS NULL THEN ay
                                          ELSE ay + (by_ - ay) * (x - ax) / (bx - ax) END) AS tpr
        FROM (SELECT {columns}, w.class, w.x, w.ax, w.ay, s.fpr AS bx, s.lo AS by_
              FROM {prefix}_before w ASOF LEFT JOIN {prefix}_steps s ON {joined} AND w.x < s.fpr)
        GROUP BY {keys}, x""", f"{prefix}_before", f"{prefix}_steps")


_curve_views("flat", "workflow, model")
_curve_views("deep", "workflow, model, fold")

view("flat_areas", """
    SELECT workflow, model, class,
           CASE WHEN max(p) * max(m) = 0 OR max(score) IS NULL THEN NULL
                ELSE sum(pos * (below + neg / 2.0::DOUBLE)) / (max(p) * max(m)) END AS auc
    FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY workflow, model, class ORDER BY score
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
                 sum(pos) OVER (PARTITION BY workflow, model, class) AS p,
                 sum(neg) OVER (PARTITION BY workflow, model, class) AS m
          FROM (SELECT workflow, model, class, score, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg
                FROM scores GROUP BY workflow, model, class, score))
    GROUP BY workflow, model, class""", "scores")


@query("ovr_auc", "SELECT workflow, model, class, round(auc, 6) AS auc FROM flat_areas", "flat_areas")
def ovr_auc(spark, d):
    return roc.class_auc(T.scores(spark, d), KEYS).select(*KEYS, "class", F.round("auc", 6).alias("auc"))


@query("macro_auc", """
    SELECT workflow, model, round(CASE WHEN count(auc) = count(*) THEN avg(auc) END, 6) AS macro_auc
    FROM flat_areas GROUP BY workflow, model""", "flat_areas")
def macro_auc(spark, d):
    out = roc.macro_auc(roc.class_auc(T.scores(spark, d), KEYS), KEYS)
    return out.select(*KEYS, F.round("macro_auc", 6).alias("macro_auc"))


@query("roc_points", """
    SELECT workflow, model, class, round(score, 6) AS score, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM flat_points""",
       "flat_points")
def roc_points(spark, d):
    return roc.roc_points(T.scores(spark, d), KEYS).select(*KEYS, "class", *T.r6("score", "fpr", "tpr"))


@query("fpr_grid_union", "SELECT DISTINCT workflow, model, round(fpr, 9) AS fpr FROM flat_points", "flat_points")
def fpr_grid_union(spark, d):
    grid = roc.fpr_grid(roc.roc_points(T.scores(spark, d), KEYS), KEYS)
    return grid.select(*KEYS, F.round("fpr", 9).alias("fpr")).distinct()


@query("macro_roc_curve", "SELECT workflow, model, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM flat_curve", "flat_curve")
def macro_roc_curve(spark, d):
    return roc.macro_curve(roc.roc_points(T.scores(spark, d), KEYS), KEYS).select(*KEYS, *T.r6("fpr", "tpr"))


@query("fold_roc_average", """
    SELECT workflow, model, round(x, 6) AS x,
           round(avg(CASE WHEN j = 0 THEN 0 WHEN j = 100 THEN 1 WHEN x = ax OR bx IS NULL THEN ay
                          ELSE ay + (by_ - ay) * (x - ax) / (bx - ax) END), 6) AS tpr
    FROM (SELECT w.workflow, w.model, w.fold, w.j, w.x, w.ax, w.ay, s.fpr AS bx, s.tpr AS by_
          FROM (SELECT w.workflow, w.model, w.fold, w.j, w.x, s.fpr AS ax, s.tpr AS ay
                FROM (SELECT k.*, j, j / 100.0::DOUBLE AS x FROM (SELECT DISTINCT workflow, model, fold FROM deep_curve) k,
                             range(0, 101) t(j)) w
                ASOF LEFT JOIN deep_curve s
                  ON w.workflow = s.workflow AND w.model = s.model AND w.fold = s.fold AND w.x >= s.fpr) w
          ASOF LEFT JOIN deep_curve s
            ON w.workflow = s.workflow AND w.model = s.model AND w.fold = s.fold AND w.x < s.fpr)
    GROUP BY workflow, model, x""", "deep_curve")
def fold_roc_average(spark, d):
    keys = [*KEYS, "fold"]
    return roc.average_class_curves(roc.roc_points(T.scores(spark, d), keys), KEYS, "fold").select(*KEYS, *T.r6("x", "tpr"))


@query("proba_align", """
    SELECT event_id, class,
           CASE WHEN class IN ('click', 'error', 'signup') THEN round(floor(10.0::DOUBLE / (1.0::DOUBLE
                + abs(value / 20.0::DOUBLE - place))) / 10.0::DOUBLE, 6) ELSE 0.0::DOUBLE END AS score
    FROM events, types""", "types")
def proba_align(spark, d):
    """A model that knows three of the five classes, brought into encoder order."""
    known = F.array(*[
        F.struct(
            F.lit(t).alias("label"),
            (F.floor(10.0 / (1.0 + F.abs(F.col("value") / 20.0 - float(T.TYPES.index(t))))) / 10.0).alias("score"),
        )
        for t in ("signup", "click", "error")
    ])
    aligned = T.events(spark, d).select("event_id", F.explode(roc.align_scores(known, T.TYPES)).alias("s"))
    return aligned.select("event_id", F.col("s.label").alias("class"), F.round("s.score", 6).alias("score"))
