"""Components, classifiers, tuning and zero-shot scoring."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from catalog import views as T
from catalog.q_join_split import KNN_SQL
from catalog.registry import query, view
from clipwright.functions import vectors as V
from clipwright.operators import batched, bayes, classifiers, components, metrics, moments as M, neighbours, splits, trees, tuning
from clipwright.operators import labels as L
from clipwright.operators.sizing import class_names
from clipwright.session import settle

# ---- naive Bayes in SQL ------------------------------------------------------------

view("nb_params", """
    SELECT label, feature, mean, var + 1e-9 * max(whole) OVER () AS var, prior
    FROM (SELECT label, feature, avg(z) AS mean, var_pop(z) AS var FROM scaled WHERE role = 'train' GROUP BY label, feature)
    JOIN (SELECT feature, var_pop(z) AS whole FROM scaled WHERE role = 'train' GROUP BY feature) USING (feature)
    JOIN (SELECT label, count(*) / sum(count(*)) OVER ()::DOUBLE AS prior FROM split WHERE role = 'train' GROUP BY label)
      USING (label)""", "scaled", "split")
view("nb_joint", """
    SELECT clip_id, s.label AS y_true, p.label AS class,
           ln(max(prior)) + sum(-0.5::DOUBLE * ln(2 * pi() * var) - 0.5::DOUBLE * power(z - mean, 2) / var) AS score
    FROM scaled s JOIN nb_params p USING (feature) WHERE role = 'test' GROUP BY clip_id, s.label, p.label""",
     "scaled", "nb_params")
view("nb_proba", """
    SELECT clip_id, y_true, class, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY clip_id) AS proba,
           row_number() OVER (PARTITION BY clip_id ORDER BY score DESC, class) AS place
    FROM (SELECT *, max(score) OVER (PARTITION BY clip_id) AS top FROM nb_joint)""", "nb_joint")
view("nb_pred", "SELECT clip_id, y_true, class AS y_pred, proba FROM nb_proba WHERE place = 1", "nb_proba")


def _f1_view(name: str, source: str, keys: str) -> None:
    view(name, f"""
        SELECT {keys}, sum(support * f) / sum(support) AS score
        FROM (SELECT {keys}, label, sum(support) AS support, 2.0::DOUBLE * sum(hits) / (sum(support) + sum(predicted)) AS f
              FROM (SELECT {keys}, y_true AS label, 1 AS support, 0 AS predicted, (y_true = y_pred)::INTEGER AS hits FROM {source}
                    UNION ALL SELECT {keys}, y_pred, 0, 1, 0 FROM {source})
              GROUP BY {keys}, label) GROUP BY {keys}""", source)


view("smoothing", """
    SELECT * FROM (VALUES (0, 1e-10), (1, 1e-9), (2, 1e-8), (3, 1e-7), (4, 1e-6)) t(candidate, smoothing)""")
view("cv_scaler", """
    SELECT f, feature, avg(x) AS mean, stddev_pop(x) AS std
    FROM feat JOIN kfold USING (clip_id), range(0, 5) t(f) WHERE fold <> f GROUP BY f, feature""", "feat", "kfold")
view("cv_scaled", """
    SELECT f, clip_id, x.label, fold, feature, (x - mean) / std AS z
    FROM feat x JOIN kfold USING (clip_id) JOIN cv_scaler USING (feature)""", "feat", "kfold", "cv_scaler")
view("cv_params", """
    SELECT f, label, feature, candidate, smoothing, mean, var + smoothing * max(whole) OVER (PARTITION BY f) AS var, prior
    FROM (SELECT f, label, feature, avg(z) AS mean, var_pop(z) AS var FROM cv_scaled WHERE fold <> f GROUP BY f, label, feature)
    JOIN (SELECT f, feature, var_pop(z) AS whole FROM cv_scaled WHERE fold <> f GROUP BY f, feature) USING (f, feature)
    JOIN (SELECT f, label, count(*) / sum(count(*)) OVER (PARTITION BY f)::DOUBLE AS prior
          FROM kfold, range(0, 5) t(f) WHERE fold <> f GROUP BY f, label) USING (f, label), smoothing""",
     "cv_scaled", "kfold", "smoothing")
view("cv_pred", """
    SELECT fold, candidate, smoothing, clip_id, y_true, arg_max(class, score) AS y_pred
    FROM (SELECT fold, candidate, smoothing, clip_id, s.label AS y_true, p.label AS class,
                 ln(max(prior)) + sum(-0.5::DOUBLE * ln(2 * pi() * var) - 0.5::DOUBLE * power(z - mean, 2) / var) AS score
          FROM cv_scaled s JOIN cv_params p ON s.f = p.f AND s.feature = p.feature WHERE s.fold = s.f
          GROUP BY fold, candidate, smoothing, clip_id, s.label, p.label)
    GROUP BY fold, candidate, smoothing, clip_id, y_true""", "cv_scaled", "cv_params")
_f1_view("nb_scores", "cv_pred", "fold, candidate, smoothing")
view("nb_means", """
    SELECT 'nb' AS model, candidate, smoothing, round(avg(score), 12) AS score FROM nb_scores GROUP BY candidate, smoothing""",
     "nb_scores")

# ---- second moments and components -------------------------------------------------


def _train(spark, d):
    return T.scaled(spark, d).where("role = 'train'")


@query("covariance_matrix", """
    SELECT CAST(a.feature AS INTEGER) AS i, CAST(b.feature AS INTEGER) AS j, round(avg(a.z * b.z), 6) + 0.0 AS cov
    FROM scaled a JOIN scaled b USING (clip_id) WHERE a.role = 'train' GROUP BY a.feature, b.feature""", "scaled")
def covariance_matrix(spark, d):
    return components.covariance(_train(spark, d)).select("i", "j", *T.r6("cov"))


def _fitted(spark, d, **how):
    return components.fit(T.split(spark, d).where("role = 'train'"), **how)


@query("pca_fit_variance")
def pca_fit_variance(spark, d):
    """Loadings of the fewest components that pass 99 % of the variance."""
    return components.loadings(spark, _fitted(spark, d)).select("component", "feature", *T.r6("weight"))


@query("pca_fit_k")
def pca_fit_k(spark, d):
    return components.loadings(spark, _fitted(spark, d, k=8)).select("component", "feature", *T.r6("weight"))


@query("pca_transform")
def pca_transform(spark, d):
    rows = T.split(spark, d)
    fitted = components.fit(rows.where("role = 'train'"))
    out = components.wide(components.transform(rows, fitted), fitted.names)
    return out.select("clip_id", "label", "role", *T.r6(*fitted.names))


@query("explained_variance_table")
def explained_variance_table(spark, d):
    return components.variance_table(spark, _fitted(spark, d)).select(
        "component", *T.r6("explained_variance_ratio", "cumulative_explained_variance")
    )


@query("cumulative_variance", """
    SELECT component, round(share, 6) AS explained_variance_ratio,
           round(sum(share) OVER (ORDER BY component ROWS UNBOUNDED PRECEDING), 6) AS cumulative_explained_variance
    FROM (SELECT CAST(feature + 1 AS INTEGER) AS component, var_pop(x) / sum(var_pop(x)) OVER () AS share FROM feat GROUP BY feature)""",
       "feat")
def cumulative_variance(spark, d):
    """The running sum over the variance shares of the raw features."""
    moments = M.population_moments(T.features(spark, d), [])
    shares = moments.select(F.posexplode(V.scale(F.col("var"), 1.0 / V.total(F.col("var")))).alias("i", "explained_variance_ratio"))
    table = shares.select((F.col("i") + 1).alias("component"), "explained_variance_ratio")
    return components.cumulative_variance(table).select(
        "component", *T.r6("explained_variance_ratio", "cumulative_explained_variance")
    )


@query("top_k_loadings")
def top_k_loadings(spark, d):
    table = components.loadings(spark, _fitted(spark, d))
    return components.top_loadings(table).select("component", "place", "feature", *T.r6("weight"))


# ---- naive Bayes and neighbours ----------------------------------------------------

@query("gaussian_nb_fit", """
    SELECT label, CAST(feature AS INTEGER) AS feature, round(prior, 6) AS prior, round(mean, 6) + 0.0 AS mean, round(var, 6) AS var
    FROM nb_params""", "nb_params")
def gaussian_nb_fit(spark, d):
    table = bayes.parameter_table(bayes.fit(_train(spark, d)))
    return table.select("label", "feature", *T.r6("prior", "mean", "var"))


def _nb(spark, d):
    rows = T.scaled(spark, d)
    return bayes.predict(rows.where("role = 'test'"), bayes.fit(rows.where("role = 'train'")))


@query("gaussian_nb_predict", "SELECT clip_id, y_true AS label, y_pred AS pred_label, round(proba, 6) AS proba FROM nb_pred", "nb_pred")
def gaussian_nb_predict(spark, d):
    top = F.array_max(F.transform("proba", lambda p: p["proba"]))
    return _nb(spark, d).select("clip_id", "label", "pred_label", F.round(top, 6).alias("proba"))


@query("predict_proba_wide", """
    SELECT clip_id, y_pred AS pred_label, """ + ", ".join(
        f"round(max(p.proba) FILTER (class = 'c{i}'), 6) AS proba_c{i}" for i in range(10)
    ) + " FROM nb_proba p JOIN nb_pred USING (clip_id) GROUP BY clip_id, y_pred", "nb_proba", "nb_pred")
def predict_proba_wide(spark, d):
    classes = class_names(T.clips(spark, d))
    out = classifiers.proba_wide(_nb(spark, d), classes)
    return out.select("clip_id", "pred_label", *T.r6(*[f"proba_{c}" for c in classes]))


view("nb_class", """
    SELECT label, sum(support) AS support, CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(hits) / sum(predicted)::DOUBLE END AS p,
           CASE WHEN sum(support) = 0 THEN 0 ELSE sum(hits) / sum(support)::DOUBLE END AS r,
           2.0::DOUBLE * sum(hits) / (sum(support) + sum(predicted)) AS f, sum(hits) AS hits
    FROM (SELECT y_true AS label, 1 AS support, 0 AS predicted, (y_true = y_pred)::INTEGER AS hits FROM nb_pred
          UNION ALL SELECT y_pred, 0, 1, 0 FROM nb_pred) GROUP BY label""", "nb_pred")


@query("holdout_report", """
    SELECT round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy, round(sum(f * support) / sum(support), 6) AS f1_weighted,
           round(avg(f), 6) AS f1_macro, round(avg(r), 6) AS uar, round(sum(p * support) / sum(support), 6) AS precision_weighted,
           round(sum(r * support) / sum(support), 6) AS recall_weighted FROM nb_class""", "nb_class")
def holdout_report(spark, d):
    """Split, scale, fit, predict and score: the hold-out protocol in one lazy plan."""
    return metrics.evaluate(_nb(spark, d), (), "label", "pred_label").select(*T.r6(*metrics.SIX_METRICS))


KNN_VOTES = f"""
    SELECT query_id, label, sum(w) / sum(sum(w)) OVER (PARTITION BY query_id) AS share
    FROM (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0 THEN (distance = 0)::INTEGER
                         ELSE 1 / distance END AS w FROM ({KNN_SQL}))
    GROUP BY query_id, label"""


@query("knn_predict", f"""
    SELECT query_id, pred_label, round(share, 6) AS pred_share
    FROM (SELECT query_id, label AS pred_label, share,
                 row_number() OVER (PARTITION BY query_id ORDER BY round(share, 12) DESC, label) AS place FROM ({KNN_VOTES}))
    WHERE place = 1""", "scaled")
def knn_predict(spark, d):
    rows = T.scaled(spark, d)
    out = neighbours.predict(rows.where("role = 'train'"), rows.where("role = 'test'"))
    return out.select("query_id", "pred_label", *T.r6("pred_share"))


# ---- MLlib families ----------------------------------------------------------------

def _family(name, spark, d):
    rows = settle(T.scaled(spark, d))
    fitted = classifiers.fit(name, rows.where("role = 'train'"), class_names(rows), tasks=T.fit_tasks(spark))
    return fitted.predict(rows.where("role = 'test'")).select(
        "clip_id", "file_path", "dataset", "label", "pred_label", "pred_label_enc"
    )


@query("decision_tree")
def decision_tree(spark, d):
    return _family("dtr", spark, d)


@query("random_forest")
def random_forest(spark, d):
    return _family("rf", spark, d)


@query("boosted_trees")
def boosted_trees(spark, d):
    return _family("xgb", spark, d)


@query("logistic_regression")
def logistic_regression(spark, d):
    return _family("logistic", spark, d)


@query("margin_classifier")
def margin_classifier(spark, d):
    return _family("svm", spark, d)


@query("predict_label", """
    SELECT clip_id, file_path, dataset, label, y_pred AS pred_label,
           CAST((SELECT count(DISTINCT label) FROM clips WHERE label < y_pred) AS INTEGER) AS pred_label_enc
    FROM nb_pred JOIN clips USING (clip_id)""", "nb_pred", "clips")
def predict_label(spark, d):
    return _family("nb", spark, d)


TREE_SETTINGS = {"dtr": {}, "rf": {"n_estimators": 20, "max_depth": 8}}


@query("tree_tables", """
    SELECT model, clip_id, 0 AS other_label, 0.0::DOUBLE AS proba_gap
    FROM split, (VALUES ('dtr'), ('rf')) m(model) WHERE role = 'test'""", "split")
def tree_tables(spark, d):
    """Test rows scored from node tables beside the models they come from: same label, same probabilities."""
    rows = settle(T.scaled(spark, d))
    train, test, out = rows.where("role = 'train'"), rows.where("role = 'test'"), []
    for name, settings in TREE_SETTINGS.items():
        fitted = classifiers.fit(name, train, class_names(rows), settings, tasks=T.fit_tasks(spark))
        theirs = fitted.predict(test).withColumnsRenamed({"pred_label": "their_label", "proba": "their_proba"})
        depth = fitted.settings["max_depth"]
        both = trees.score(theirs, trees.node_table(fitted), fitted.classes, depth)
        gaps = F.zip_with("proba", "their_proba", lambda a, b: F.abs(a["proba"] - b["proba"]))
        out.append(both.select(F.lit(name).alias("model"), "clip_id", (F.col("pred_label") != F.col("their_label")).cast("int").alias("other_label"),
                               V.rounded(F.array_max(gaps)).alias("proba_gap")))
    return out[0].unionByName(out[1])


@query("tree_leaves", """
    SELECT label, count(*) AS n FROM split WHERE role = 'train' GROUP BY label""", "split")
def tree_leaves(spark, d):
    """The leaves of the tree's node table hold every training row once, class by class."""
    rows = settle(T.scaled(spark, d).where("role = 'train'"))
    fitted = classifiers.fit("dtr", rows, class_names(rows))
    leaves = trees.node_table(fitted).where("left IS NULL")
    pairs = F.arrays_zip(F.array(*[F.lit(c) for c in fitted.classes]).alias("label"), V.scale(F.col("shares"), F.col("rows")).alias("n"))
    return leaves.select(F.explode(pairs).alias("p")).groupBy(F.col("p.label").alias("label")).agg(
        F.round(F.sum("p.n")).cast("long").alias("n"))


def _boosted(spark, d):
    """Short boosting of every class over the training split, with the rows it was fitted on."""
    rows = settle(T.scaled(spark, d))
    settings = {"n_estimators": 5, "max_depth": 3}
    return rows, classifiers.fit("xgb", rows.where("role = 'train'"), class_names(rows), settings, tasks=T.fit_tasks(spark))


@query("boosted_tables", """
    SELECT clip_id, 0 AS other_label, 0.0::DOUBLE AS proba_gap FROM split WHERE role = 'test'""", "split")
def boosted_tables(spark, d):
    """Test rows scored from the boosted model's node table beside the model itself: same label, same probabilities."""
    rows, fitted = _boosted(spark, d)
    theirs = fitted.predict(rows.where("role = 'test'")).withColumnsRenamed({"pred_label": "their_label", "proba": "their_proba"})
    both = trees.score_boosted(theirs, trees.boosted_table(fitted), fitted.classes, fitted.settings["max_depth"])
    gaps = F.zip_with("proba", "their_proba", lambda a, b: F.abs(a["proba"] - b["proba"]))
    return both.select("clip_id", (F.col("pred_label") != F.col("their_label")).cast("int").alias("other_label"),
                       V.rounded(F.array_max(gaps)).alias("proba_gap"))


@query("boosted_leaves", """
    SELECT label, CAST(tree AS INTEGER) AS tree, n
    FROM (SELECT DISTINCT label FROM split), range(0, 5) t(tree), (SELECT count(*) AS n FROM split WHERE role = 'train')""", "split")
def boosted_leaves(spark, d):
    """The leaves of every boosted tree of every class hold each training row once."""
    leaves = trees.boosted_table(_boosted(spark, d)[1]).where("left IS NULL")
    return leaves.groupBy("label", "tree").agg(F.round(F.sum("rows")).cast("long").alias("n"))


# ---- tuning ------------------------------------------------------------------------

GRID_SIZES = """VALUES ('rf', 36), ('xgb', 27), ('svm', 6), ('knn', 8), ('dtr', 9), ('logistic', 16), ('nb', 5)"""


@query("grid_size", f"""
    SELECT model, grid_size, least(20, grid_size) AS iterations, least(20, grid_size) * 5 AS total_fits,
           least(20, grid_size) * 4 * n AS rows_fitted
    FROM (SELECT model, CAST(s AS BIGINT) AS grid_size FROM ({GRID_SIZES}) t(model, s)), (SELECT count(*) AS n FROM clips)""", "clips")
def grid_size(spark, d):
    """Fits of a whole search and the training rows they read over the given folds."""
    per_fold = T.folded(spark, d).groupBy("fold").agg(F.count("*").alias("n"))
    per_pass = per_fold.agg(((tuning.FOLDS - 1) * F.sum("n")).alias("rows"))
    sizes = tuning.grid_sizes(tuning.candidate_table(spark))
    return sizes.withColumn("rows_fitted", F.col("iterations") * per_pass.scalar())


@query("random_candidates", f"""
    SELECT model, CAST(candidate AS INTEGER) AS candidate, CAST(fold AS INTEGER) AS fold, total - n AS train_rows, n AS held_rows
    FROM (SELECT model, candidate, row_number() OVER (PARTITION BY model ORDER BY md5('42-' || model || '-' || candidate), candidate) AS place
          FROM (SELECT model, unnest(range(0, s)) AS candidate FROM ({GRID_SIZES}) t(model, s))),
         (SELECT fold, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM kfold GROUP BY fold)
    WHERE place <= 20""", "kfold")
def random_candidates(spark, d):
    """The drawn candidates with the folds they are to be fitted on."""
    drawn = tuning.random_candidates(tuning.candidate_table(spark))
    sizes = T.folded(spark, d).groupBy("fold").agg(F.count("*").alias("held_rows"))
    folds = sizes.withColumn("train_rows", F.sum("held_rows").over(Window.partitionBy()) - F.col("held_rows"))
    packed = folds.agg(F.collect_list(F.struct("fold", "train_rows", "held_rows")))
    return drawn.withColumn("_f", packed.scalar()).select("model", "candidate", F.explode("_f").alias("f")).select(
        "model", "candidate", "f.fold", "f.train_rows", "f.held_rows"
    )


def _nb_means(spark, d):
    return tuning.mean_scores(tuning.tune_bayes(T.folded(spark, d)))


@query("cv_score_table", "SELECT model, candidate, round(score, 6) AS mean_score FROM nb_means", "nb_means")
def cv_score_table(spark, d):
    return _nb_means(spark, d).select("model", "candidate", *T.r6("mean_score"))


@query("best_candidate", """
    SELECT model, candidate, round(score, 6) AS mean_score
    FROM (SELECT *, row_number() OVER (ORDER BY score DESC, candidate) AS place FROM nb_means) WHERE place = 1""", "nb_means")
def best_candidate(spark, d):
    return tuning.best_candidate(_nb_means(spark, d)).select("model", "candidate", *T.r6("mean_score"))


def _search(spark, d):
    """The whole grid of the tree family over folds of the training split; the test split stays out."""
    rows = settle(T.scaled(spark, d))
    train = splits.stratified_folds(rows.where("role = 'train'"), "clip_id")
    points = tuning.grid_points(tuning.GRIDS["dtr"])
    return rows, tuning.cross_validate("dtr", train, points, class_names(train), tasks=T.fit_tasks(spark))


@query("cv_tuning")
def cv_tuning(spark, d):
    _, found = _search(spark, d)
    return tuning.score_table(spark, "dtr", found).select("model", "candidate", *T.r6("mean_score", "std_score"))


@query("refit_best")
def refit_best(spark, d):
    """Test rows scored by the best candidate, refitted on the whole training split."""
    rows, found = _search(spark, d)
    return found.model.predict(rows.where("role = 'test'")).select("clip_id", "label", "pred_label")


def _linear_search(name, spark, d):
    """The drawn candidates of a linear family over folds of the training split, all models in the same passes."""
    rows = settle(T.scaled(spark, d))
    train = settle(splits.stratified_folds(rows.where("role = 'train'"), "clip_id"))
    points = batched.drawn_points(tuning.random_candidates(tuning.candidate_table(spark)), name)
    return rows, train, batched.search(name, train, points, class_names(train))


@query("linear_search")
def linear_search(spark, d):
    """Every drawn candidate of the logistic family with its mean score and deviation over the folds."""
    scores = _linear_search("logistic", spark, d)[2].scores
    means = scores.groupBy("model", "candidate").agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    return means.select("model", "candidate", *T.r6("mean_score", "std_score"))


@query("linear_search_optimum", """
    SELECT CAST(f AS INTEGER) AS left_out, label, count(*) AS n, 0.0::DOUBLE AS gap
    FROM train_kfold, range(0, 5) t(f) WHERE fold <> f GROUP BY f, label""", "train_kfold")
def linear_search_optimum(spark, d):
    """The logistic winner's model of every fold is at its optimum over that fold's training rows: no slope is left by intercepts."""
    _, train, found = _linear_search("logistic", spark, d)
    ready = batched.prepared(found.space, found.fold_models.classes, features="_space")
    gaps = batched.intercept_gaps(ready, found.fold_models)
    return gaps.select("left_out", "label", "n", V.rounded(F.col("gap"), 3).alias("gap"))


@query("linear_refit")
def linear_refit(spark, d):
    """Test rows scored by the logistic family's best candidate, fitted on the whole training split in the search itself."""
    rows, _, found = _linear_search("logistic", spark, d)
    return found.model.predict(rows.where("role = 'test'")).select("clip_id", "label", "pred_label")


view("lc_fold", """
    SELECT clip_id, label, (r > n // 5)::INT + (r > 2 * n // 5)::INT + (r > 3 * n // 5)::INT + (r > 4 * n // 5)::INT AS fold
    FROM (SELECT clip_id, label, count(*) OVER (PARTITION BY label) AS n,
                 row_number() OVER (PARTITION BY label ORDER BY clip_id) AS r FROM clips)""", "clips")
view("lc_member", """
    SELECT fit, size, clip_id, label, 'train' AS role
    FROM (SELECT fit, clip_id, label, row_number() OVER (PARTITION BY fit ORDER BY clip_id) AS place
          FROM lc_fold, range(0, 5) t(fit) WHERE fold <> fit) JOIN lc_sizes ON place <= train_rows
    UNION ALL
    SELECT fold, size, clip_id, label, 'validation' FROM lc_fold, lc_sizes""", "lc_fold", "lc_sizes")
view("lc_sizes", """
    SELECT size, CAST(floor((size + 1) * (SELECT count(*) FROM lc_fold WHERE fold <> 0) / 10) AS BIGINT) AS train_rows
    FROM range(0, 10) t(size)""", "lc_fold")
view("lc_rows", "SELECT m.*, feature, x FROM lc_member m JOIN feat USING (clip_id)", "lc_member", "feat")
view("lc_params", """
    SELECT fit, size, label, feature, mean, var + 1e-9 * max(whole) OVER (PARTITION BY fit, size) AS var, prior
    FROM (SELECT fit, size, label, feature, avg(x) AS mean, var_pop(x) AS var FROM lc_rows WHERE role = 'train' GROUP BY ALL)
    JOIN (SELECT fit, size, feature, var_pop(x) AS whole FROM lc_rows WHERE role = 'train' GROUP BY ALL) USING (fit, size, feature)
    JOIN (SELECT fit, size, label, count(*) / sum(count(*)) OVER (PARTITION BY fit, size)::DOUBLE AS prior
          FROM lc_member WHERE role = 'train' GROUP BY fit, size, label) USING (fit, size, label)""", "lc_rows", "lc_member")
view("lc_scores", """
    SELECT fit, size, role, avg((y_true = y_pred)::INTEGER) AS score
    FROM (SELECT fit, size, role, clip_id, y_true, arg_max(class, score) AS y_pred
          FROM (SELECT r.fit, r.size, role, clip_id, r.label AS y_true, p.label AS class,
                       ln(max(prior)) + sum(-0.5::DOUBLE * ln(2 * pi() * var) - 0.5::DOUBLE * power(x - mean, 2) / var) AS score
                FROM lc_rows r JOIN lc_params p USING (fit, size, feature) GROUP BY r.fit, r.size, role, clip_id, r.label, p.label)
          GROUP BY fit, size, role, clip_id, y_true)
    GROUP BY fit, size, role""", "lc_rows", "lc_params")


@query("learning_curve", """
    SELECT train_rows, role, round(avg(score), 6) AS score_mean, round(stddev_pop(score), 6) AS score_std,
           round(1 - avg(score), 6) AS loss_mean, round(stddev_pop(score), 6) AS loss_std
    FROM lc_scores JOIN lc_sizes USING (size) GROUP BY train_rows, role""", "lc_scores", "lc_sizes")
def learning_curve(spark, d):
    out = tuning.learning_curve_bayes(T.features(spark, d))
    return out.select("train_rows", "role", *T.r6("score_mean", "score_std", "loss_mean", "loss_std"))


# ---- leave-one-group-out -----------------------------------------------------------

view("lo_scaler", """
    SELECT f, feature, avg(x) AS mean, stddev_pop(x) AS std
    FROM feat JOIN subjects USING (clip_id) JOIN (SELECT DISTINCT fold AS f FROM subjects) ON f <> fold GROUP BY f, feature""",
     "feat", "subjects")
view("lo_scaled", """
    SELECT f, clip_id, x.label, fold, feature, (x - mean) / std AS z
    FROM feat x JOIN subjects USING (clip_id) JOIN lo_scaler USING (feature)""", "feat", "subjects", "lo_scaler")
view("lo_params", """
    SELECT f, label, feature, mean, var + 1e-9 * max(whole) OVER (PARTITION BY f) AS var, prior
    FROM (SELECT f, label, feature, avg(z) AS mean, var_pop(z) AS var FROM lo_scaled WHERE fold <> f GROUP BY f, label, feature)
    JOIN (SELECT f, feature, var_pop(z) AS whole FROM lo_scaled WHERE fold <> f GROUP BY f, feature) USING (f, feature)
    JOIN (SELECT f, label, count(*) / sum(count(*)) OVER (PARTITION BY f)::DOUBLE AS prior
          FROM subjects JOIN (SELECT DISTINCT fold AS f FROM subjects) ON fold <> f GROUP BY f, label) USING (f, label)""",
     "lo_scaled", "subjects")
view("lo_pred", """
    SELECT fold, clip_id, y_true, arg_max(class, score) AS y_pred
    FROM (SELECT fold, clip_id, s.label AS y_true, p.label AS class,
                 ln(max(prior)) + sum(-0.5::DOUBLE * ln(2 * pi() * var) - 0.5::DOUBLE * power(z - mean, 2) / var) AS score
          FROM lo_scaled s JOIN lo_params p ON s.f = p.f AND s.feature = p.feature WHERE s.fold = s.f
          GROUP BY fold, clip_id, s.label, p.label)
    GROUP BY fold, clip_id, y_true""", "lo_scaled", "lo_params")
_f1_view("lo_f1", "lo_pred", "fold")


@query("loso_report", """
    SELECT CAST(fold AS INTEGER) AS fold, round(accuracy, 6) AS accuracy, round(score, 6) AS f1_weighted
    FROM (SELECT fold, avg((y_true = y_pred)::INTEGER) AS accuracy FROM lo_pred GROUP BY fold) JOIN lo_f1 USING (fold)""",
       "lo_pred", "lo_f1")
def loso_report(spark, d):
    """Leave-one-group-out with naive Bayes: all folds fitted in one pass over the rows."""
    rows = T.grouped(spark, d)
    scalers, models = bayes.leave_one_out_models(rows, "fold")
    pred = bayes.score_folds(rows, scalers, models, "fold", proba=False)
    return metrics.evaluate(pred, ["fold"], "label", "pred_label").select("fold", *T.r6("accuracy", "f1_weighted"))


# ---- zero-shot ---------------------------------------------------------------------

view("zs_scaler", """
    SELECT feature, avg(x) AS mean, stddev_pop(x) AS std FROM feat WHERE clip_id % 7 <> 0 GROUP BY feature""", "feat")
view("zs_rows", """
    SELECT clip_id, label, clip_id % 7 = 0 AS external, feature,
           (CASE WHEN clip_id % 7 = 0 THEN x * 1.5::DOUBLE + 0.1::DOUBLE ELSE x END - mean) / std AS z
    FROM feat JOIN zs_scaler USING (feature)""", "feat", "zs_scaler")
view("zs_params", """
    SELECT label, feature, mean, var + 1e-9 * max(whole) OVER () AS var, prior
    FROM (SELECT label, feature, avg(z) AS mean, var_pop(z) AS var FROM zs_rows WHERE NOT external GROUP BY label, feature)
    JOIN (SELECT feature, var_pop(z) AS whole FROM zs_rows WHERE NOT external GROUP BY feature) USING (feature)
    JOIN (SELECT label, count(*) / sum(count(*)) OVER ()::DOUBLE AS prior FROM clips WHERE clip_id % 7 <> 0 GROUP BY label)
      USING (label)""", "zs_rows", "clips")
view("zs_pred", """
    SELECT clip_id, y_true, arg_max(class, score) AS y_pred
    FROM (SELECT clip_id, s.label AS y_true, p.label AS class,
                 ln(max(prior)) + sum(-0.5::DOUBLE * ln(2 * pi() * var) - 0.5::DOUBLE * power(z - mean, 2) / var) AS score
          FROM zs_rows s JOIN zs_params p USING (feature) WHERE external GROUP BY clip_id, s.label, p.label)
    GROUP BY clip_id, y_true""", "zs_rows", "zs_params")
view("zs_class", """
    SELECT label, sum(support) AS support, CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(hits) / sum(predicted)::DOUBLE END AS p,
           CASE WHEN sum(support) = 0 THEN 0 ELSE sum(hits) / sum(support)::DOUBLE END AS r,
           2.0::DOUBLE * sum(hits) / (sum(support) + sum(predicted)) AS f, sum(hits) AS hits
    FROM (SELECT y_true AS label, 1 AS support, 0 AS predicted, (y_true = y_pred)::INTEGER AS hits FROM zs_pred
          UNION ALL SELECT y_pred, 0, 1, 0 FROM zs_pred) GROUP BY label""", "zs_pred")


def _zero_shot(spark, d):
    source, external = T.corpora(spark, d)
    scaler = M.fit_scaler(source)
    model = bayes.fit(M.apply_scaler(source, scaler))
    return bayes.predict(M.apply_scaler(external, scaler), model)


@query("zero_shot_score", "SELECT clip_id, 'ext' AS dataset, y_true AS label, y_pred AS pred_label FROM zs_pred", "zs_pred")
def zero_shot_score(spark, d):
    return _zero_shot(spark, d).select("clip_id", "dataset", "label", "pred_label")


@query("zero_shot_eval", """
    SELECT 'nb' AS model, round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy, round(sum(f * support) / sum(support), 6) AS f1_weighted,
           round(avg(f), 6) AS f1_macro, round(avg(r), 6) AS uar, round(sum(p * support) / sum(support), 6) AS precision_weighted,
           round(sum(r * support) / sum(support), 6) AS recall_weighted FROM zs_class""", "zs_class")
def zero_shot_eval(spark, d):
    pred = _zero_shot(spark, d).withColumn("model", F.lit("nb"))
    return metrics.evaluate(pred, ["model"], "label", "pred_label").select("model", *T.r6(*metrics.SIX_METRICS))


@query("zero_shot_pca")
def zero_shot_pca(spark, d):
    """Models want components, the external rows are raw: scale, project, score."""
    source, external = T.corpora(spark, d)
    fitted = components.fit(source)
    model = bayes.fit(components.transform(source, fitted))
    out = bayes.predict(components.transform(external, fitted), model)
    return out.select("clip_id", "dataset", "label", "pred_label")


# ---- identities of fitted models ---------------------------------------------------

def _gap(pred):
    """Mean probability less share, per class."""
    long = pred.select("label", F.explode("proba").alias("p"))
    return long.groupBy(F.col("p.label").alias("label")).agg(
        V.rounded(F.avg("p.proba") - F.avg((F.col("label") == F.col("p.label")).cast("double")), 3).alias("gap"))


GAP_SQL = "SELECT DISTINCT label, 0.0::DOUBLE AS gap FROM clips"


def _train_gap(name, spark, d):
    rows = settle(T.scaled(spark, d).where("role = 'train'"))
    fitted = classifiers.fit(name, rows, class_names(rows), tasks=T.fit_tasks(spark))
    return _gap(fitted.predict(rows))


@query("logistic_regression_optimum", GAP_SQL, "clips")
def logistic_regression_optimum(spark, d):
    """At the optimum of free intercepts the mean probability of a class is its share."""
    return _train_gap("logistic", spark, d)


@query("decision_tree_shares", GAP_SQL, "clips")
def decision_tree_shares(spark, d):
    """A leaf's probabilities are the shares of its training rows, so over all rows they are the classes' shares."""
    return _train_gap("dtr", spark, d)


@query("pca_lengths", "SELECT clip_id, round(sum(z * z), 6) AS squared FROM scaled GROUP BY clip_id", "scaled")
def pca_lengths(spark, d):
    """All components together only turn the scaled rows: lengths stay."""
    rows = T.split(spark, d)
    fitted = components.fit(rows.where("role = 'train'"), k=T.WIDTH)
    return components.transform(rows, fitted).select("clip_id", V.rounded(
        F.aggregate("features", F.lit(0.0), lambda a, v: a + v * v)).alias("squared"))


@query("pca_shares", """
    WITH m AS (SELECT clip_id, feature, z - avg(z) OVER (PARTITION BY feature) AS z FROM scaled WHERE role = 'train'),
    c AS (SELECT a.feature AS i, b.feature AS j, avg(a.z * b.z) AS v FROM m a JOIN m b USING (clip_id) GROUP BY ALL)
    SELECT 64::BIGINT AS n, 1.0::DOUBLE AS total,
           round(sum(v * v) / power(sum(CASE WHEN i = j THEN v END), 2), 6) AS squares FROM c""".replace("WITH m AS", "SELECT * FROM (WITH m AS") + ")",
       "scaled")
def pca_shares(spark, d):
    """Variance shares sum to 1, their squares to the covariance's squared norm over its squared trace."""
    fitted = components.fit(T.split(spark, d).where("role = 'train'"), k=T.WIDTH)
    table = components.variance_table(spark, fitted)
    share = F.col("explained_variance_ratio")
    return table.agg(F.count("*").alias("n"), V.rounded(F.sum(share)).alias("total"), V.rounded(F.sum(share * share)).alias("squares"))


@query("pca_residuals", """
    SELECT CAST(feature + 1 AS INTEGER) AS component, 0.0::DOUBLE AS residual, 1.0::DOUBLE AS length
    FROM (SELECT DISTINCT feature FROM feat)""", "feat")
def pca_residuals(spark, d):
    """Every component is an eigenvector of the training covariance: C v = lambda v, of length 1."""
    rows = T.split(spark, d).where("role = 'train'")
    fitted = components.fit(rows, k=T.WIDTH)
    train = M.apply_scaler(rows, fitted.scaler)
    found = components.residuals(train, components.loadings(spark, fitted), components.variance_table(spark, fitted))
    return found.select(F.col("component").cast("int").alias("component"), *T.r6("residual", "length"))
