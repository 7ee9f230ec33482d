"""Published results reproduced from published inputs."""

import pytest
from pyspark.sql import functions as F

from clipwright.operators import compare, labels, metrics, splits, tuning

CLASSES = ["angry", "happy", "neutral", "sad"]

# Published confusion matrices and their reports (accuracy, F1 weighted, F1 macro,
# UAR, precision weighted, recall weighted).
MATRICES = [
    ([[139, 36, 43, 3], [35, 178, 79, 35], [13, 46, 236, 47], [6, 23, 52, 136]],
     [0.6224, 0.6221, 0.6259, 0.6225, 0.6280, 0.6224]),
    ([[1045, 198, 28, 0], [878, 350, 43, 0], [335, 640, 112, 0], [513, 704, 54, 0]],
     [0.3076, 0.2291, 0.2269, 0.3001, 0.2506, 0.3076]),
    ([[125, 53, 49, 2], [42, 129, 80, 27], [7, 55, 192, 130], [1, 9, 23, 161]],
     [0.5594, 0.5555, 0.5663, 0.5849, 0.5726, 0.5594]),
    ([[126, 19, 21, 4], [85, 182, 126, 49], [19, 68, 225, 72], [9, 41, 45, 150]],
     [0.5504, 0.5445, 0.5597, 0.5878, 0.5560, 0.5504]),
    ([[852, 194, 202, 23], [450, 198, 464, 159], [31, 28, 617, 411], [31, 23, 224, 993]],
     [0.5429, 0.5135, 0.5121, 0.5438, 0.5312, 0.5429]),
]


def test_reports_follow_from_matrices(spark):
    rows = [
        (str(m), CLASSES[i], CLASSES[j], n)
        for m, (matrix, _) in enumerate(MATRICES) for i, line in enumerate(matrix) for j, n in enumerate(line) if n
    ]
    cells = spark.createDataFrame(rows, "model string, y_true string, y_pred string, n long")
    found = {r["model"]: r for r in metrics.report(cells, ["model"]).collect()}
    order = ["accuracy", "f1_weighted", "f1_macro", "uar", "precision_weighted", "recall_weighted"]
    for m, (_, expected) in enumerate(MATRICES):
        assert [round(found[str(m)][k], 4) for k in order] == expected


def test_matrix_keeps_zero_cells(spark):
    rows = [("angry", "angry"), ("sad", "angry")]
    cells = metrics.counts(spark.createDataFrame(rows, "y_true string, y_pred string"))
    full = {(r.y_true, r.y_pred): r.n for r in metrics.confusion_matrix(cells, CLASSES).collect()}
    assert len(full) == 16 and full["sad", "angry"] == 1 and full["happy", "sad"] == 0
    wide = {r["y_true"]: r for r in metrics.confusion_matrix_wide(cells, CLASSES).collect()}
    assert wide["happy"]["neutral"] == 0 and wide["angry"]["angry"] == 1


# Published accuracy per fold and the published summary line.
FOLDS = {
    "rf": ([0.5548, 0.5777, 0.5265, 0.5228, 0.5455], "0.5455 ± 0.0224"),
    "svm": ([0.5594, 0.6188, 0.5543, 0.5257, 0.5608], "0.5638 ± 0.0339"),
    "nb": ([0.4682, 0.4712, 0.4944, 0.4801, 0.4835], "0.4795 ± 0.0104"),
    "dtr": ([0.4488, 0.4721, 0.4257, 0.4355, 0.4013], "0.4367 ± 0.0263"),
}


def test_fold_summary(spark):
    rows = [(m, f, "accuracy", v) for m, (values, _) in FOLDS.items() for f, v in enumerate(values)]
    long = spark.createDataFrame(rows, "model string, fold int, metric string, value double")
    out = {r["model"]: r["text"] for r in metrics.fold_summary(metrics.model_fold_grid(long)).collect()}
    assert out == {m: text for m, (_, text) in FOLDS.items()}


def test_incomplete_and_single_folds(spark):
    rows = [("a", 0, "accuracy", 0.5), ("a", 1, "accuracy", 0.7), ("b", 0, "accuracy", 0.5)]
    schema = "model string, fold int, metric string, value double"
    out = {r["model"]: r for r in metrics.fold_summary(metrics.model_fold_grid(spark.createDataFrame(rows, schema))).collect()}
    assert out["b"]["mean"] is None and out["b"]["text"] == "N/A"
    single = metrics.fold_summary(metrics.model_fold_grid(spark.createDataFrame(rows[:1], schema))).first()
    assert single["std"] == 0.0 and single["text"] == "0.5000 ± 0.0000"


def test_quotas(spark):
    counts = {"angry": 1103, "happy": 1636, "neutral": 1708, "sad": 1084}
    rows = [(label,) for label, n in counts.items() for _ in range(n)]
    out = {r["label"]: r["quota"] for r in splits.stratified_quotas(
        spark.createDataFrame(rows, "label string").groupBy("label").agg(F.count("*").alias("n"))).collect()}
    assert out == {"angry": 882, "happy": 1309, "neutral": 1366, "sad": 867}


def test_label_audit(spark):
    counts = {"xxx": 2507, "fru": 1849, "neu": 1708, "ang": 1103, "sad": 1084, "exc": 1041, "hap": 595,
              "sur": 107, "fea": 40, "oth": 3, "dis": 2}
    rows = [(code,) for code, n in counts.items() for _ in range(n)]
    table = labels.label_table("IEMOCAP")
    mapped = spark.createDataFrame(rows, "code string").withColumn("label", labels.map_label(F.col("code"), table))
    audit = labels.ingest_audit(mapped, 272).first()
    assert (audit["total"], audit["processed"], audit["dropped"]) == (10039, 5531, 4508)
    kept = {r["label"]: r["n"] for r in labels.label_distribution(labels.keep_labelled(mapped), None).collect()}
    assert kept == {"neutral": 1708, "angry": 1103, "happy": 1636, "sad": 1084}


def test_label_table_case(spark):
    assert labels.label_table("CremaD")["ANG"] == "angry"
    with pytest.raises(ValueError):
        labels.label_table("other")
    codes = spark.createDataFrame([("ang",), ("ANG",), (None,)], "code string")
    out = [r[0] for r in codes.select(labels.map_label(F.col("code"), labels.label_table("iemocap"))).collect()]
    assert out == ["angry", "drop", "drop"]


# Published areas by model: 80_20, loso, pca.
AREAS = {
    "rf": (0.822408, 0.757216, 0.805013),
    "xgb": (0.854154, 0.737527, 0.817352),
    "svm": (0.718462, None, 0.846628),
    "knn": (0.628324, 0.645854, 0.802960),
    "dtr": (0.711765, 0.602044, 0.714458),
    "logistic": (0.791413, 0.532853, 0.828591),
    "nb": (0.751255, 0.511677, 0.658695),
}


def test_comparison(spark):
    rows = [(m, w, v) for m, values in AREAS.items() for w, v in zip(compare.WORKFLOWS, values)]
    areas = spark.createDataFrame(rows, "model string, workflow string, auc double")
    tops = {r["workflow"]: (r["best_model"], round(r["mean_auc"], 4)) for r in compare.best_model_per_workflow(areas).collect()}
    assert tops == {"80_20": ("xgb", 0.7540), "loso": ("rf", 0.6312), "pca": ("svm", 0.7820)}
    best = {r["model"]: r["best_workflow"] for r in compare.best_workflow_per_model(areas).collect()}
    assert best == {"rf": "80_20", "xgb": "80_20", "svm": "pca", "knn": "pca", "dtr": "pca", "logistic": "pca", "nb": "80_20"}
    table = {r["model"]: r for r in compare.auc_comparison(areas).collect()}
    assert table["svm"]["loso"] is None and table["rf"]["wins"] == "loso"


def test_comparison_ties(spark):
    rows = [("knn", "pca", 0.5), ("rf", "pca", 0.5), ("rf", "80_20", 0.5), ("knn", "80_20", None)]
    areas = spark.createDataFrame(rows, "model string, workflow string, auc double")
    assert {r["workflow"]: r["best_model"] for r in compare.best_model_per_workflow(areas).collect()} == {"pca": "rf", "80_20": "rf"}
    assert {r["model"]: r["best_workflow"] for r in compare.best_workflow_per_model(areas).collect()} == {"rf": "80_20", "knn": "pca"}


def test_grid_sizes(spark):
    out = {r["model"]: (r["grid_size"], r["total_fits"]) for r in tuning.grid_sizes(tuning.candidate_table(spark)).collect()}
    assert {m: v[0] for m, v in out.items()} == {"rf": 36, "xgb": 27, "svm": 6, "knn": 8, "dtr": 9, "logistic": 16, "nb": 5}
    assert sum(v[1] for v in out.values()) == 420


def test_best_candidate_ties(spark):
    rows = [("nb", 1, 0.5), ("nb", 0, 0.5), ("nb", 2, 0.4)]
    out = tuning.best_candidate(spark.createDataFrame(rows, "model string, candidate int, mean_score double")).first()
    assert out["candidate"] == 0
