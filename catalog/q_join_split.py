"""Encoding, joins, scaling, splits and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as T
from catalog.registry import query
from clipwright.functions import vectors as V
from clipwright.operators import hashed, labels as L, metrics, moments as M, neighbours, splits
from clipwright.session import settle


@query("label_encode", """
    SELECT clip_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_enc FROM clips""", "clips")
def label_encode(spark, d):
    rows = T.clips(spark, d).select("clip_id", "label")
    return L.encode(rows, L.class_table(rows)).select("clip_id", "label", "label_enc")


@query("label_decode", "SELECT clip_id, label AS decoded FROM clips", "clips")
def label_decode(spark, d):
    rows = T.clips(spark, d).select("clip_id", "label")
    classes = L.class_table(rows)
    coded = L.encode(rows, classes).select("clip_id", "label_enc")
    return L.decode(coded, classes, "label_enc", "decoded").select("clip_id", "decoded")


@query("unseen_label_check", """
    SELECT label, count(*) AS n FROM clips
    WHERE label NOT IN (SELECT label FROM clips WHERE label < 'c7') GROUP BY label""", "clips")
def unseen_label_check(spark, d):
    rows = T.clips(spark, d)
    return L.unseen_labels(rows, rows.where("label < 'c7'"))


@query("scaler_fit", """
    SELECT CAST(feature AS INTEGER) AS feature, round(mean, 6) + 0.0 AS mean, round(std, 6) AS std FROM scaler""", "scaler")
def scaler_fit(spark, d):
    scaler = M.fit_scaler(T.split(spark, d).where("role = 'train'"))
    return M.long_parameters(scaler, [], ["mean", "std"]).select("feature", *T.r6("mean", "std"))


@query("scaler_apply", """
    SELECT clip_id, role, CAST(feature AS INTEGER) AS feature, round(z, 6) + 0.0 AS z FROM scaled""", "scaled")
def scaler_apply(spark, d):
    return T.scaled(spark, d).select("clip_id", "role", F.posexplode("features").alias("feature", "z")).select(
        "clip_id", "role", "feature", *T.r6("z")
    )


@query("positional_concat", """
    SELECT clip_id, s.role, c.label, round(samples[1], 6) + 0.0 AS raw, round(z, 6) + 0.0 AS derived
    FROM clips c JOIN scaled s USING (clip_id) WHERE feature = 0""", "clips", "scaled")
def positional_concat(spark, d):
    """Derived columns meet their rows by id; row position means nothing in a distributed table."""
    derived = T.scaled(spark, d).select("clip_id", "role", F.col("features")[0].alias("derived"))
    return T.features(spark, d).select("clip_id", "label", F.col("features")[0].alias("raw")).join(derived, "clip_id").select(
        "clip_id", "role", "label", *T.r6("raw", "derived")
    )


@query("model_fold_matrix", """
    SELECT model, metric, fold, round(value, 6) AS value
    FROM (SELECT DISTINCT model, metric FROM long_reports WHERE fold = 0 AND model <> 'gamma')
    CROSS JOIN (SELECT DISTINCT fold FROM long_reports)
    LEFT JOIN (SELECT * FROM long_reports WHERE NOT (model = 'beta' AND fold = 3)) USING (model, metric, fold)""",
       "long_reports")
def model_fold_matrix(spark, d):
    """One model lacks the first fold (so it is left out), one lacks a later fold (so it has gaps)."""
    long = metrics.to_long(metrics.evaluate(T.predictions(spark, d), ["model", "fold"]), ["model", "fold"])
    gone = ((F.col("model") == "gamma") & (F.col("fold") == 0)) | ((F.col("model") == "beta") & (F.col("fold") == 3))
    return metrics.model_fold_grid(long.where(~gone)).select("model", "metric", "fold", F.round("value", 6).alias("value"))


KNN_SQL = """
    SELECT query_id, reference_id, label, distance, CAST(rank AS INTEGER) AS rank FROM (
      SELECT q.clip_id AS query_id, r.clip_id AS reference_id, r.label,
             sqrt(list_sum(list_transform(list_zip(q.v, r.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance,
             row_number() OVER (PARTITION BY q.clip_id ORDER BY distance, r.clip_id) AS rank
      FROM (SELECT clip_id, list(z ORDER BY feature) AS v FROM scaled WHERE role = 'test' GROUP BY clip_id) q,
           (SELECT clip_id, label, list(z ORDER BY feature) AS v FROM scaled WHERE role = 'train' GROUP BY clip_id, label) r)
    WHERE rank <= 15"""


@query("knn_join", f"SELECT query_id, reference_id, label, rank, round(distance, 6) AS distance FROM ({KNN_SQL})", "scaled")
def knn_join(spark, d):
    rows = T.scaled(spark, d)
    found = neighbours.nearest(rows.where("role = 'train'"), rows.where("role = 'test'"), 15)
    return found.select("query_id", "reference_id", "label", "rank", F.round("distance", 6).alias("distance"))


@query("knn_hashed", f"""
    SELECT query_id, count(*) AS n, 0 AS too_near, true AS recall_reached FROM ({KNN_SQL}) GROUP BY query_id""", "scaled")
def knn_hashed(spark, d):
    """Approximate neighbours beside the exact ones: as many, none nearer than possible, recall of all at least 0.9."""
    rows = T.scaled(spark, d)
    train, test = settle(rows.where("role = 'train'")), settle(rows.where("role = 'test'"))
    found, exact = settle(hashed.nearest(train, test, 15)), settle(neighbours.nearest(train, test, 15))
    both = found.join(exact.select("query_id", "rank", F.col("distance").alias("least")), ["query_id", "rank"])
    below = (F.col("distance") < F.col("least") * (1 - neighbours.SLACK)).cast("int")
    return both.groupBy("query_id").agg(F.count("*").alias("n"), F.sum(below).cast("int").alias("too_near")).withColumn(
        "recall_reached", F.lit(hashed.recall(found, exact) >= 0.9))


# ---- distributions -----------------------------------------------------------------

@query("label_distribution", """
    SELECT role, label, n, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY role), 1) AS pct
    FROM (SELECT role, label, count(*) AS n FROM split GROUP BY role, label
          UNION ALL SELECT 'overall', label, count(*) FROM split GROUP BY label)""", "split")
def label_distribution(spark, d):
    return L.label_distribution(T.split(spark, d))


@query("label_counts_arrival", """
    SELECT event_type AS label, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY event_type""")
def label_counts_arrival(spark, d):
    return L.arrival_counts(T.events(spark, d).withColumnRenamed("event_type", "label"), "event_id")


@query("ingest_audit", """
    SELECT count(*) AS total, count(*) FILTER (event_type <> 'error') AS processed,
           count(*) FILTER (event_type = 'error') AS dropped, 272 AS vector_size FROM events""")
def ingest_audit(spark, d):
    rows = T.events(spark, d).withColumn("label", L.map_label(F.col("event_type"), T.EVENT_LABELS))
    return L.ingest_audit(rows, 272)


@query("distinct_subjects", "SELECT DISTINCT subject FROM subjects", "subjects")
def distinct_subjects(spark, d):
    return L.with_subject(T.clips(spark, d)).select("subject").distinct().orderBy("subject")


# ---- splits ------------------------------------------------------------------------

@query("stratified_split", "SELECT clip_id, label, role FROM split", "split")
def stratified_split(spark, d):
    return T.split(spark, d).select("clip_id", "label", "role")


@query("fold_index", "SELECT DISTINCT subject, CAST(fold AS INTEGER) AS fold FROM subjects", "subjects")
def fold_index(spark, d):
    return splits.fold_index(L.with_subject(T.clips(spark, d)))


@query("loso_folds", """
    SELECT clip_id, subject, label, CAST(f AS INTEGER) AS fold, CASE WHEN f = fold THEN 'test' ELSE 'train' END AS role
    FROM subjects, (SELECT DISTINCT fold AS f FROM subjects)""", "subjects")
def loso_folds(spark, d):
    return splits.leave_one_group_out(L.with_subject(T.clips(spark, d)).select("clip_id", "subject", "label"))


@query("stratified_kfold", "SELECT clip_id, label, CAST(fold AS INTEGER) AS fold FROM kfold", "kfold")
def stratified_kfold(spark, d):
    return splits.stratified_folds(T.clips(spark, d).select("clip_id", "label"), "clip_id")


@query("loso_scalers", """
    SELECT CAST(f AS INTEGER) AS fold, CAST(feature AS INTEGER) AS feature, round(avg(x), 6) + 0.0 AS mean,
           round(stddev_pop(x), 6) AS std
    FROM feat JOIN subjects USING (clip_id) JOIN (SELECT DISTINCT fold AS f FROM subjects) ON f <> fold
    GROUP BY f, feature""", "feat", "subjects")
def loso_scalers(spark, d):
    """Scaler of every leave-one-group-out fold from one pass, by subtracting sums."""
    rows = T.grouped(spark, d)
    centre = M.centre_of(rows)
    outside = M.leave_one_out(M.moment_sums(rows, ["fold", "label"], centre), "fold", "label")
    scalers = M.fold_scalers(outside, "fold", centre)
    return M.long_parameters(scalers, ["fold"], ["mean", "std"]).select("fold", "feature", *T.r6("mean", "std"))
