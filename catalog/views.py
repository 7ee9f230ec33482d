"""The given tables seen as clips, metadata and predictions, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.registry import view
from clipwright.functions import vectors as V
from clipwright.operators import moments as M, splits
from clipwright.operators.labels import with_subject
from clipwright.operators.signals import Geometry

WIDTH = 64
TOY = Geometry(rate=400, frame=10, hop=4, trim_frame=16, trim_hop=4)

EVENT_LABELS = {"click": "c_click", "purchase": "c_buy", "signup": "c_new", "view": "c_click", "error": "drop"}
TYPES = ["click", "error", "purchase", "signup", "view"]
TOY_MODELS = ["alpha", "beta", "gamma"]
SHARPNESS = {"alpha": 20.0, "beta": 35.0, "gamma": 50.0}
SHIFTS = {"80_20": 0.0, "loso": 0.5, "pca": 1.0}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt over ``spark.clipwright.partitions`` tasks if the session sets it: for tables of one small file."""
    tasks = rows.sparkSession.conf.get("spark.clipwright.partitions", None)
    return rows.repartition(int(tasks)) if tasks else rows


def fit_tasks(spark: SparkSession) -> int | None:
    """``spark.clipwright.fit.tasks``: tasks for iterative fits on small tables; unset, rows stay as they are."""
    tasks = spark.conf.get("spark.clipwright.fit.tasks", None)
    return int(tasks) if tasks else None


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = F.col("vec_id")
    plain = F.concat(F.lit("data/Session"), (vec % 5 + 1).cast("string"), F.lit("/wav/clip_"), vec.cast("string"), F.lit(".wav"))
    other = F.concat(F.lit("data/other/clip_"), vec.cast("string"), F.lit(".wav"))
    return table(spark, sf_dir, "embeddings").select(
        vec.alias("clip_id"),
        F.col("embedding").cast("array<double>").alias("samples"),
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("label"),
        F.when(vec % 50 == 49, other).otherwise(plain).alias("file_path"),
        F.lit("src").alias("dataset"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips(spark, sf_dir).withColumnRenamed("samples", "features")


def wide_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per feature, as a feature file has them."""
    return clips(spark, sf_dir).select(
        *[F.col("samples")[i].alias(f"f{i}") for i in range(WIDTH)], "label", "file_path", "dataset"
    )


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_split(features(spark, sf_dir), "clip_id")


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split, scaled with training parameters."""
    rows = split(spark, sf_dir)
    return M.apply_scaler(rows, M.fit_scaler(rows.where("role = 'train'")))


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.with_fold(with_subject(features(spark, sf_dir)))


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_folds(features(spark, sf_dir), "clip_id")


def shifted(rows: DataFrame) -> DataFrame:
    """The rows as another corpus whose features lie elsewhere."""
    moved = F.transform("features", lambda v: v * 1.5 + 0.1)
    return rows.withColumn("features", moved).withColumn("dataset", F.lit("ext"))


def corpora(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source corpus and a shifted external one."""
    rows = features(spark, sf_dir)
    return rows.where("clip_id % 7 <> 0"), shifted(rows.where("clip_id % 7 = 0"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toy predictions of three models; one event type is never predicted."""
    rows = events(spark, sf_dir).withColumn(
        "m", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("sharp")) for m, s in SHARPNESS.items()]))
    )
    guess = F.get(
        F.array(*[F.lit(t) for t in TYPES]),
        F.least(F.lit(3), F.floor(F.col("value") / F.col("m.sharp"))).cast("int"),
    )
    lucky = (F.col("event_id") % 3 == 0) & (F.col("event_type") != "view")
    return rows.select(
        "event_id",
        (F.col("user_id") % 5).cast("int").alias("fold"),
        F.col("m.model").alias("model"),
        F.col("event_type").alias("y_true"),
        F.when(lucky, F.col("event_type")).otherwise(guess).alias("y_pred"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toy scores, long: (workflow, model, fold, class, hit, score), many of them tied.

    ``alpha`` has fine scores; ``gamma`` has none under ``loso``.
    """
    kinds = [
        F.struct(F.lit(m).alias("model"), F.lit(s).alias("sharp"), F.lit(w).alias("workflow"), F.lit(h).alias("shift"))
        for m, s in SHARPNESS.items() for w, h in SHIFTS.items()
    ]
    ranked = [F.struct(F.lit(t).alias("class"), F.lit(float(i)).alias("place")) for i, t in enumerate(TYPES)]
    rows = dealt(events(spark, sf_dir)).select("*", F.explode(F.array(*kinds)).alias("k")).select(
        "*", F.explode(F.array(*ranked)).alias("c")
    )
    raw = 1.0 / (1.0 + F.abs(F.col("value") / F.col("k.sharp") - F.col("c.place") - F.col("k.shift")))
    coarse = F.when(F.col("k.model") == "alpha", raw).otherwise(F.floor(raw * 10.0) / 10.0)
    hit = F.col("event_type") == F.col("c.class")
    lift = F.when(hit & (F.col("event_id") % 4 == 0), 0.25).otherwise(0.0)
    absent = (F.col("k.model") == "gamma") & (F.col("k.workflow") == "loso")
    return rows.select(
        F.col("k.workflow").alias("workflow"),
        F.col("k.model").alias("model"),
        (F.col("user_id") % 5).cast("int").alias("fold"),
        F.col("c.class").alias("class"),
        hit.alias("hit"),
        F.when(~absent, coarse + lift).alias("score"),
    )


# ---- the same in SQL ---------------------------------------------------------------

view("clips", """
    SELECT vec_id AS clip_id, embedding::DOUBLE[] AS samples, 'c' || label AS label,
           CASE WHEN vec_id % 50 = 49 THEN 'data/other/clip_' || vec_id || '.wav'
                ELSE 'data/Session' || (1 + vec_id % 5) || '/wav/clip_' || vec_id || '.wav' END AS file_path,
           'src' AS dataset
    FROM embeddings""")
view("feat", f"""
    SELECT clip_id, label, i - 1 AS feature, samples[i] AS x
    FROM clips, (SELECT unnest(range(1, {WIDTH + 1})) AS i)""", "clips")
view("quotas", """
    SELECT label, n, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= n_train - sum(base) OVER ()
                                 THEN 1 ELSE 0 END AS quota
    FROM (SELECT label, n, n_train, (n * n_train) // total AS base, (n * n_train) % total AS rest
          FROM (SELECT label, n, total, total - CAST(ceil(total * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_train
                FROM (SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
                      FROM clips GROUP BY label)))""", "clips")
view("split", """
    SELECT clip_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42-' || clip_id), clip_id)
                                     <= quota THEN 'train' ELSE 'test' END AS role
    FROM clips JOIN quotas USING (label)""", "clips", "quotas")
view("scaler", """
    SELECT feature, avg(x) AS mean, stddev_pop(x) AS std
    FROM feat JOIN split USING (clip_id) WHERE role = 'train' GROUP BY feature""", "feat", "split")
view("scaled", """
    SELECT f.clip_id, f.label, s.role, f.feature, (f.x - p.mean) / p.std AS z
    FROM feat f JOIN split s USING (clip_id) JOIN scaler p USING (feature)""", "feat", "split", "scaler")
view("subjects", """
    SELECT clip_id, label, subject, dense_rank() OVER (ORDER BY subject) - 1 AS fold
    FROM (SELECT clip_id, label, nullif(regexp_extract(file_path, '(Session\\d+)', 1), '') AS subject FROM clips)
    WHERE subject IS NOT NULL""", "clips")
view("kfold", """
    SELECT clip_id, label, (r > n // 5)::INT + (r > 2 * n // 5)::INT + (r > 3 * n // 5)::INT + (r > 4 * n // 5)::INT AS fold
    FROM (SELECT clip_id, label, count(*) OVER (PARTITION BY label) AS n,
                 row_number() OVER (PARTITION BY label ORDER BY md5('42-' || clip_id), clip_id) AS r FROM clips)""", "clips")
view("train_kfold", """
    SELECT clip_id, label, (r > n // 5)::INT + (r > 2 * n // 5)::INT + (r > 3 * n // 5)::INT + (r > 4 * n // 5)::INT AS fold
    FROM (SELECT clip_id, label, count(*) OVER (PARTITION BY label) AS n,
                 row_number() OVER (PARTITION BY label ORDER BY md5('42-' || clip_id), clip_id) AS r FROM split WHERE role = 'train')""",
     "split")
view("sharp", "SELECT * FROM (VALUES ('alpha', 20.0::DOUBLE), ('beta', 35.0), ('gamma', 50.0)) t(model, sharp)")
view("shifts", "SELECT * FROM (VALUES ('80_20', 0.0::DOUBLE), ('loso', 0.5), ('pca', 1.0)) t(workflow, shift)")
view("types", """
    SELECT * FROM (VALUES ('click', 0.0::DOUBLE), ('error', 1.0), ('purchase', 2.0), ('signup', 3.0), ('view', 4.0))
    t(class, place)""")
view("preds", """
    SELECT event_id, CAST(user_id % 5 AS INTEGER) AS fold, model, event_type AS y_true,
           CASE WHEN event_id % 3 = 0 AND event_type <> 'view' THEN event_type
                ELSE (['click', 'error', 'purchase', 'signup', 'view'])[1 + CAST(least(3, floor(value / sharp)) AS INTEGER)]
           END AS y_pred
    FROM events, sharp""", "sharp")
view("scores", """
    SELECT workflow, model, CAST(user_id % 5 AS INTEGER) AS fold, class, event_type = class AS hit,
           CASE WHEN model = 'gamma' AND workflow = 'loso' THEN NULL
                ELSE CASE WHEN model = 'alpha' THEN raw ELSE floor(raw * 10.0::DOUBLE) / 10.0::DOUBLE END
                     + CASE WHEN event_type = class AND event_id % 4 = 0 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END END AS score
    FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + abs(value / sharp - place - shift)) AS raw
          FROM events, sharp, shifts, types)""", "sharp", "shifts", "types")
view("cells", """
    SELECT model, fold, y_true, y_pred, count(*) AS n FROM preds GROUP BY ALL""", "preds")
view("per_class_fold", """
    SELECT model, fold, label, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits,
           CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(hits)::DOUBLE / sum(predicted) END AS p,
           CASE WHEN sum(support) = 0 THEN 0 ELSE sum(hits)::DOUBLE / sum(support) END AS r,
           2.0::DOUBLE * sum(hits) / (sum(support) + sum(predicted)) AS f
    FROM (SELECT model, fold, y_true AS label, n AS support, 0 AS predicted,
                 CASE WHEN y_true = y_pred THEN n ELSE 0 END AS hits FROM cells
          UNION ALL SELECT model, fold, y_pred, 0, n, 0 FROM cells)
    GROUP BY model, fold, label""", "cells")
view("fold_reports", """
    SELECT model, fold, sum(hits)::DOUBLE / sum(support) AS accuracy, sum(f * support) / sum(support) AS f1_weighted,
           avg(f) AS f1_macro, avg(r) AS uar, sum(p * support) / sum(support) AS precision_weighted,
           sum(r * support) / sum(support) AS recall_weighted
    FROM per_class_fold GROUP BY model, fold""", "per_class_fold")
view("long_reports", """
    SELECT model, fold, metric, value FROM (UNPIVOT fold_reports
      ON accuracy, f1_weighted, f1_macro, uar, precision_weighted, recall_weighted INTO NAME metric VALUE value)""",
     "fold_reports")


def r6(*columns: str):
    """Columns rounded to six decimals under their own names."""
    return [V.rounded(F.col(c)).alias(c) for c in columns]
