"""Sources, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as T
from catalog.registry import query
from clipwright.functions import vectors as V
from clipwright.operators import components, labels as L, metrics, moments as M, splits, tuning
from clipwright.session import scratch_path
from clipwright.sources import readers as R, sinks as W

ROOT = "corpus"


def _metadata(spark, d):
    """Metadata rows in the published column order, from events."""
    return T.events(spark, d).select(
        (F.col("user_id") % 5 + 1).cast("int").alias("session"),
        F.when(F.col("event_id") % 2 == 0, "script").otherwise("impro").alias("method"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("event_type").alias("emotion"),
        (F.col("event_id") % 3 + 2).cast("int").alias("n_annotators"),
        (F.col("event_id") % 4).cast("int").alias("agreement"),
        F.concat_ws("_", F.col("user_id").cast("string"), F.col("event_id").cast("string"),
                    F.concat(F.upper(F.substring("event_type", 1, 3)), F.lit("_XX.wav"))).alias("path"),
    )


METADATA_SQL = """
    SELECT CAST(user_id % 5 + 1 AS INTEGER) AS session, CASE WHEN event_id % 2 = 0 THEN 'script' ELSE 'impro' END AS method,
           CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, event_type AS emotion,
           CAST(event_id % 3 + 2 AS INTEGER) AS n_annotators, CAST(event_id % 4 AS INTEGER) AS agreement,
           user_id || '_' || event_id || '_' || upper(substr(event_type, 1, 3)) || '_XX.wav' AS path
    FROM events"""


@query("metadata_scan", METADATA_SQL)
def metadata_scan(spark, d):
    path = W.write_table(_metadata(spark, d), scratch_path(spark, "metadata"), file_format="csv")
    return R.metadata(spark, path)


@query("feature_scan", """
    SELECT file_path, label, dataset, 'f' || feature AS name, round(x, 6) + 0.0 AS value
    FROM feat JOIN clips USING (clip_id, label)""", "feat", "clips")
def feature_scan(spark, d):
    path = W.write_table(T.wide_features(spark, d), scratch_path(spark, "features"), file_format="csv")
    rows = R.features(spark, path, "csv")
    names = L.feature_columns(rows.columns)
    table = F.array(*[F.lit(n) for n in names])
    return R.as_array(rows, names).select(
        "file_path", "label", "dataset", F.posexplode("features").alias("i", "x")
    ).select("file_path", "label", "dataset", F.get(table, F.col("i")).alias("name"), V.rounded(F.col("x")).alias("value"))


@query("schema_probe", """
    SELECT 'f' || feature AS name, CAST(feature AS INTEGER) AS place, count(x) AS filled FROM feat GROUP BY feature""",
       "feat")
def schema_probe(spark, d):
    """Names and places come from the schema alone; the counts show how far each column is filled."""
    rows = T.wide_features(spark, d)
    names = L.feature_columns(rows.schema.names)
    counts = rows.agg(*[F.count(n).alias(n) for n in names])
    places = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return counts.unpivot([], names, "name", "filled").select("name", F.element_at(places, F.col("name")).alias("place"), "filled")


@query("report_scan", """
    SELECT fold, model, round(accuracy, 4) AS accuracy, round(f1_weighted, 4) AS f1_weighted,
           round(f1_macro, 4) AS f1_macro, round(uar, 4) AS uar,
           round(precision_weighted, 4) AS precision_weighted, round(recall_weighted, 4) AS recall_weighted
    FROM fold_reports""", "fold_reports")
def report_scan(spark, d):
    reports = metrics.evaluate(T.predictions(spark, d), ["model", "fold"])
    return R.reports(spark, W.write_reports(reports, scratch_path(spark, "reports")))


@query("schema_contract", "SELECT label, count(*) AS n FROM clips GROUP BY label", "clips")
def schema_contract(spark, d):
    rows = R.require_columns(T.wide_features(spark, d), ["label", "file_path", *[f"f{i}" for i in range(T.WIDTH)]])
    return rows.groupBy("label").agg(F.count("*").alias("n"))


@query("min_rows_guard", "SELECT count(*) AS n FROM clips", "clips")
def min_rows_guard(spark, d):
    return R.require_rows(T.features(spark, d), 500).agg(F.count("*").alias("n"))


@query("feature_sink", """
    SELECT role, CAST(fold AS INTEGER) AS fold, count(*) AS n, round(sum(samples[1]), 6) + 0.0 AS total
    FROM clips JOIN split USING (clip_id) JOIN kfold USING (clip_id) GROUP BY role, fold""", "clips", "split", "kfold")
def feature_sink(spark, d):
    rows = T.split(spark, d).join(T.folded(spark, d).select("clip_id", "fold"), "clip_id")
    path = W.write_table(rows, scratch_path(spark, "split"), ["fold", "role"])
    return R.features(spark, path).groupBy("role", "fold").agg(
        F.count("*").alias("n"), V.rounded(F.sum(F.col("features")[0])).alias("total")
    )


@query("params_sink", """
    SELECT model, round(score, 6) AS best_cv_f1_weighted, smoothing AS var_smoothing
    FROM (SELECT *, row_number() OVER (ORDER BY score DESC, candidate) AS place FROM nb_means) WHERE place = 1""",
       "nb_means")
def params_sink(spark, d):
    best = tuning.best_candidate(tuning.mean_scores(tuning.tune_bayes(T.folded(spark, d))))
    table = tuning.candidate_table(spark, {"nb": tuning.GRIDS["nb"]})
    won = best.join(table, ["model", "candidate"]).withColumn("score", F.round("mean_score", 6))
    path = W.write_params(won, scratch_path(spark, "params"))
    schema = "best_params map<string,string>, best_cv_f1_weighted double"
    texts = spark.read.schema("value string, model string").text(path, wholetext=True)
    return texts.select("model", F.from_json("value", schema).alias("j")).select(
        "model", "j.best_cv_f1_weighted", F.col("j.best_params")["var_smoothing"].cast("double").alias("var_smoothing")
    )


@query("versioned_overwrite", """
    SELECT version, role, count(*) AS n, version = 'pca' AS projected
    FROM split, (VALUES ('raw'), ('pca')) t(version) GROUP BY version, role""", "split")
def versioned_overwrite(spark, d):
    rows = T.split(spark, d)
    fitted = components.fit(rows.where("role = 'train'"))
    wide = [f"f{i}" for i in range(T.WIDTH)]
    paths = W.write_split_versions(
        {W.RAW: components.wide(rows, wide), W.PROJECTED: components.wide(components.transform(rows, fitted), fitted.names)},
        scratch_path(spark, "versions"),
    )
    parts = []
    for version, path in paths.items():
        back = R.features(spark, path)
        projected = R.is_projected(back.columns)
        parts.append(back.groupBy("role").agg(F.count("*").alias("n")).select(
            F.lit(version).alias("version"), "role", "n", F.lit(projected).alias("projected")))
    return parts[0].unionByName(parts[1])


# ---- projections and filters -------------------------------------------------------

CODES = "VALUES ('click', 'c_click'), ('purchase', 'c_buy'), ('signup', 'c_new'), ('view', 'c_click'), ('error', 'drop')"


@query("label_map", f"""
    SELECT event_id, event_type AS code, coalesce(label, 'drop') AS label
    FROM events LEFT JOIN ({CODES}) t(code, label) ON event_type = code""")
def label_map(spark, d):
    code = F.col("event_type")
    return T.events(spark, d).select("event_id", code.alias("code"), L.map_label(code, T.EVENT_LABELS).alias("label"))


def _file_names(spark, d):
    short = F.concat_ws("_", F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    return _metadata_with_id(spark, d).withColumn(
        "path", F.when(F.col("event_id") % 10 == 0, short).otherwise(F.col("path"))
    )


def _metadata_with_id(spark, d):
    kind = F.concat(F.upper(F.substring("event_type", 1, 3)), F.lit("_XX.wav"))
    return T.events(spark, d).withColumn(
        "path", F.concat_ws("_", F.col("user_id").cast("string"), F.col("event_id").cast("string"), kind)
    )


@query("label_from_path", """
    SELECT event_id, upper(substr(event_type, 1, 3)) AS code FROM events WHERE event_id % 10 <> 0""")
def label_from_path(spark, d):
    coded = _file_names(spark, d).select("event_id", L.code_from_path(F.col("path")).alias("code"))
    return coded.where(F.col("code").isNotNull())


@query("drop_filter", f"""
    SELECT event_id, label FROM events JOIN ({CODES}) t(code, label) ON event_type = code WHERE label <> 'drop'""")
def drop_filter(spark, d):
    rows = T.events(spark, d).withColumn("label", L.map_label(F.col("event_type"), T.EVENT_LABELS))
    return L.keep_labelled(rows).select("event_id", "label")


@query("path_prefix", f"""
    SELECT event_id, '{ROOT}/' || user_id || '_' || event_id || '_' || upper(substr(event_type, 1, 3)) || '_XX.wav'
           AS file_path FROM events""")
def path_prefix(spark, d):
    return _metadata_with_id(spark, d).select("event_id", L.prefixed(F.col("path"), ROOT).alias("file_path"))


@query("add_constant", "SELECT clip_id, label, 'ext' AS dataset FROM clips", "clips")
def add_constant(spark, d):
    return T.clips(spark, d).withColumn("dataset", F.lit("ext")).select("clip_id", "label", "dataset")


@query("feature_columns", """
    SELECT 'f' || feature AS name, round(sum(x), 6) + 0.0 AS total FROM feat GROUP BY feature""", "feat")
def feature_columns(spark, d):
    rows = T.wide_features(spark, d)
    names = L.feature_columns(rows.columns)
    sums = R.as_array(rows, names).agg(V.sum_vectors(F.col("features")).alias("s"))
    table = F.array(*[F.lit(n) for n in names])
    return sums.select(F.posexplode("s").alias("i", "x")).select(
        F.get(table, F.col("i")).alias("name"), V.rounded(F.col("x")).alias("total")
    )


@query("null_subject_filter", "SELECT clip_id, subject FROM subjects", "subjects")
def null_subject_filter(spark, d):
    return L.require_subjects(L.with_subject(T.clips(spark, d))).select("clip_id", "subject")


@query("sample_limit", "SELECT clip_id, file_path FROM clips ORDER BY file_path LIMIT 100", "clips")
def sample_limit(spark, d):
    return L.first_clips(T.clips(spark, d).select("clip_id", "file_path"), 100)


@query("projected_feature_guard", """
    SELECT version, count(*) AS n, version = 'pca' AS any_projected, version = 'pca' AS all_projected
    FROM clips, (VALUES ('raw'), ('pca')) t(version) GROUP BY version""", "clips")
def projected_feature_guard(spark, d):
    rows = T.features(spark, d)
    fitted = components.fit(rows, k=4)
    versions = {"raw": T.wide_features(spark, d), "pca": components.wide(components.transform(rows, fitted), fitted.names).drop("clip_id")}
    parts = [
        df.agg(F.count("*").alias("n")).select(
            F.lit(v).alias("version"), "n", F.lit(R.is_projected(df.columns)).alias("any_projected"),
            F.lit(R.all_projected(df.columns)).alias("all_projected"))
        for v, df in versions.items()
    ]
    return parts[0].unionByName(parts[1])


@query("row_carry", """
    SELECT clip_id, c.label, file_path, dataset, round(max(z) FILTER (feature = 0), 6) + 0.0 AS first_feature,
           round(max(z) FILTER (feature = 63), 6) + 0.0 AS last_feature
    FROM scaled s JOIN clips c USING (clip_id) GROUP BY clip_id, c.label, file_path, dataset""", "scaled", "clips")
def row_carry(spark, d):
    return T.scaled(spark, d).select(
        "clip_id", "label", "file_path", "dataset",
        V.rounded(F.col("features")[0]).alias("first_feature"),
        V.rounded(F.element_at("features", -1)).alias("last_feature"),
    )


@query("scalar_kit", """
    SELECT event_id, lower(event_type || 'X') AS lowered, split_part(user_id || '_' || event_id, '_', 2) AS second,
           nullif(regexp_extract('run' || (event_id % 7) || '/x', '(run[0-4])', 1), '') AS run,
           starts_with(event_type, 'cl') AS is_cl, user_id || '/' || event_id AS joined,
           printf('%.4f', floor(value * 16) / 16) AS text, round(abs(value - 50), 6) AS away, CAST(ceil(value) AS BIGINT) AS up,
           round(sqrt(value), 6) AS root, round(log2(value), 6) + 0.0 AS bits,
           round((event_id % 11) / 10.0::DOUBLE, 6) AS step,
           CAST(len(flatten([[value, 1.0], [2.0]])) AS INTEGER) AS flat,
           round(list_sum(list_transform([value, 2.0], lambda v: v * 2))::DOUBLE, 6) AS doubled
    FROM events""")
def scalar_kit(spark, d):
    v, e = F.col("value"), F.col("event_id")
    linspace = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: i / F.lit(10.0))
    return T.events(spark, d).select(
        "event_id",
        F.lower(F.concat("event_type", F.lit("X"))).alias("lowered"),
        F.get(F.split(F.concat_ws("_", "user_id", "event_id"), "_"), F.lit(1)).alias("second"),
        L.subject_of(F.concat(F.lit("run"), (e % 7).cast("string"), F.lit("/x")), r"(run[0-4])").alias("run"),
        F.startswith("event_type", F.lit("cl")).alias("is_cl"),
        F.concat_ws("/", "user_id", "event_id").alias("joined"),
        F.format_string("%.4f", F.floor(v * 16) / 16).alias("text"),
        F.round(F.abs(v - 50), 6).alias("away"),
        F.ceil(v).alias("up"),
        F.round(F.sqrt(v), 6).alias("root"),
        V.rounded(F.log2(v)).alias("bits"),
        F.round(F.get(linspace, (e % 11).cast("int")), 6).alias("step"),
        F.size(F.flatten(F.array(F.array(v, F.lit(1.0)), F.array(F.lit(2.0))))).alias("flat"),
        F.round(V.total(V.scale(F.array(v, F.lit(2.0)), F.lit(2))), 6).alias("doubled"),
    )
