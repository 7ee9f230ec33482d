"""Invariants, edge cases and brute-force comparisons."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from catalog import views as T
from clipwright.functions import spectra as S
from clipwright.operators import (
    bayes, components, labels, moments as M, neighbours, ranking, roc, signals, splits,
)
from clipwright.sources import readers, sinks


# ---- ordering helpers --------------------------------------------------------------

def skewed(spark, n=3000):
    """A third of the rows share one group and another third one value."""
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 7}", 0.5 if i % 3 == 1 else float((i * 37) % 1000) / 1000) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_running_sums_equal_plain_window(spark):
    df = skewed(spark)
    keyed = ranking.value_buckets(df, "v", buckets=16)
    ours = ranking.running_sums(keyed, ["g"], [F.col("v"), F.col("id")], {"s": F.col("id")})
    plain = df.withColumn("s", F.sum("id").over(
        Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(tuple, ours.select("id", "s").collect())) == sorted(map(tuple, plain.select("id", "s").collect()))


def test_split_quotas_and_determinism(spark):
    df = skewed(spark).withColumnRenamed("g", "label")
    first = {r["id"]: r["role"] for r in splits.stratified_split(df, "id").collect()}
    again = {r["id"]: r["role"] for r in splits.stratified_split(df.repartition(5), "id").collect()}
    assert first == again and len(first) == 3000
    quotas = {r["label"]: r["quota"] for r in splits.stratified_quotas(
        df.groupBy("label").agg(F.count("*").alias("n"))).collect()}
    train = splits.stratified_split(df, "id").where("role = 'train'").groupBy("label").count()
    assert {r["label"]: r["count"] for r in train.collect()} == quotas
    assert sum(quotas.values()) == 2400


def test_split_keeps_tiny_classes(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(11)], "id long, label string")
    out = splits.stratified_split(df, "id")
    assert out.count() == 11 and out.where("role = 'test'").count() == 3


def test_folds_are_balanced(spark):
    df = skewed(spark).withColumnRenamed("g", "label")
    for seed in (42, None):
        sizes = splits.stratified_folds(df, "id", 5, seed).groupBy("label", "fold").count().collect()
        by_label = {}
        for r in sizes:
            by_label.setdefault(r["label"], []).append(r["count"])
        assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in by_label.values())


def test_fold_order_is_lexicographic(spark):
    rows = [(f"x/Session{i}/a.wav",) for i in (1, 2, 10)] + [("x/none/a.wav",)]
    df = labels.with_subject(spark.createDataFrame(rows, "file_path string"))
    assert {r["subject"]: r["fold"] for r in splits.fold_index(df).collect()} == {"Session1": 0, "Session10": 1, "Session2": 2}
    with pytest.raises(ValueError):
        labels.require_subjects(df.where("false"))


def test_many_classes_are_numbered_in_order(spark):
    names = [f"k{(i * 7919) % 20011:05d}" for i in range(12_000)]
    df = spark.createDataFrame([(n,) for n in names], "label string").repartition(7)
    table = labels.class_table(df)
    coded = labels.encode(df, table)
    assert {r["label"]: r["label_enc"] for r in coded.collect()} == {n: i for i, n in enumerate(sorted(set(names)))}
    back = labels.decode(coded, table, "label_enc", "again")
    assert back.where("label <=> again").count() == 12_000


def test_null_labels_are_a_class_in_split_and_folds(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "id long, label string")
    split = splits.stratified_split(df, "id").groupBy("label", "role").count().collect()
    assert {(r["label"], r["role"]): r["count"] for r in split} == {
        (None, "train"): 40, (None, "test"): 10, ("a", "train"): 40, ("a", "test"): 10}
    folds = splits.stratified_folds(df, "id", 5).groupBy("label", "fold").count().collect()
    assert len(folds) == 10 and {r["count"] for r in folds} == {10}


def test_string_ids_order_folds_and_few_rows_leave_folds_empty(spark):
    df = skewed(spark, 2000).select(F.format_string("clip-%05d", "id").alias("id"), F.lit("a").alias("label"))
    got = {r["id"]: r["fold"] for r in splits.stratified_folds(df, "id", 4, None).collect()}
    assert got == {f"clip-{i:05d}": i // 500 for i in range(2000)}
    few = spark.createDataFrame([(1, "a"), (2, "a")], "id long, label string")
    assert sorted(r["fold"] for r in splits.stratified_folds(few, "id", 5, None).collect()) == [2, 4]


# ---- labels ------------------------------------------------------------------------

def test_paths_and_encoding(spark):
    rows = [("a/1_2_ANG_XX.wav",), ("a/1_2.wav",)]
    out = [r[0] for r in spark.createDataFrame(rows, "p string").select(labels.code_from_path(F.col("p"))).collect()]
    assert out == ["ANG", None]
    coded = spark.createDataFrame([("a",), ("c",)], "label string").select(labels.class_index(F.col("label"), ["a", "b"]))
    with pytest.raises(Exception, match="unseen label"):
        coded.collect()
    dropped = labels.keep_labelled(spark.createDataFrame([("a",), ("drop",), (None,)], "label string"))
    assert [r[0] for r in dropped.collect()] == ["a"]


def test_join_labels_matches_map(spark):
    table = spark.createDataFrame([("x", "one"), ("y", "drop")], "code string, label string")
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "code string")
    assert sorted(map(tuple, labels.join_labels(df, "code", table).collect())) == [("x", "one"), ("y", "drop"), ("z", "drop")]


def test_contracts(spark):
    df = spark.createDataFrame([(1.0, "a")], "f0 double, label string")
    with pytest.raises(readers.ContractError, match="missing 12 required columns"):
        readers.require_columns(df, [f"f{i}" for i in range(1, 13)])
    with pytest.raises(readers.ContractError):
        readers.require_rows(df, 2)
    assert readers.require_rows(df, 1) is df
    assert not readers.is_projected(df.columns) and readers.all_projected(["pca_0", "label"])


def test_raw_split_is_written_once(spark, tmp_path):
    df = spark.createDataFrame([("train", 1.0), ("test", 2.0)], "role string, f0 double")
    root = str(tmp_path / "versions")
    sinks.write_split_versions({sinks.RAW: df}, root)
    paths = sinks.write_split_versions({sinks.RAW: df.withColumn("f0", F.lit(9.0))}, root)
    assert {r["f0"] for r in readers.features(spark, paths[sinks.RAW]).collect()} == {1.0, 2.0}


# ---- scaling and Bayes -------------------------------------------------------------

def test_constant_feature_and_leakage(spark):
    rows = [(i, [float(i), 7.0], "train" if i < 8 else "test") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, features array<double>, role string")
    scaler = M.fit_scaler(df.where("role = 'train'"))
    row = scaler.first()
    assert row["std"][1] == 1.0 and row["std"][0] == pytest.approx(np.std(range(8)))
    moved = df.withColumn("features", F.when(F.col("role") == "test", F.array(F.lit(99.0), F.lit(-5.0))).otherwise(F.col("features")))
    assert M.fit_scaler(moved.where("role = 'train'")).first() == row
    assert all(r["features"][1] == 0.0 for r in M.apply_scaler(df, scaler).collect())


def test_leave_one_out_equals_refit(spark, sf_dir):
    rows = T.grouped(spark, sf_dir)
    centre = M.centre_of(rows)
    outside = M.leave_one_out(M.moment_sums(rows, ["fold", "label"], centre), "fold", "label")
    quick = {r["fold"]: r for r in M.fold_scalers(outside, "fold", centre).collect()}
    for fold in quick:
        plain = M.fit_scaler(rows.where(F.col("fold") != fold)).first()
        assert np.allclose(quick[fold]["mean"], plain["mean"]) and np.allclose(quick[fold]["std"], plain["std"])


def test_leave_one_out_drops_absent_class(spark):
    rows = [(0, "a", [1.0]), (0, "b", [2.0]), (1, "a", [3.0]), (1, "a", [5.0])]
    df = spark.createDataFrame(rows, "fold int, label string, features array<double>")
    centre = M.centre_of(df)
    out = M.leave_one_out(M.moment_sums(df, ["fold", "label"], centre), "fold", "label").collect()
    assert {(r["fold"], r["label"], r["n"]) for r in out} == {(0, "a", 2), (1, "a", 1), (1, "b", 1)}


def test_bayes_against_numpy(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(60, 3)) + np.repeat([[0.0], [1.5]], 30, axis=0)
    names = ["a"] * 30 + ["b"] * 30
    df = spark.createDataFrame([(i, p.tolist(), n) for i, (p, n) in enumerate(zip(points, names))],
                               "id long, features array<double>, label string")
    out = {r["id"]: r for r in bayes.predict(df, bayes.fit(df, smoothing=1e-3)).collect()}
    epsilon = 1e-3 * points.var(0).max()
    logs = []
    for n in ("a", "b"):
        own = points[[x == n for x in names]]
        var = own.var(0) + epsilon
        logs.append(np.log(0.5) - 0.5 * (np.log(2 * np.pi * var) + (points - own.mean(0)) ** 2 / var).sum(1))
    logs = np.array(logs).T
    proba = np.exp(logs - logs.max(1, keepdims=True))
    proba /= proba.sum(1, keepdims=True)
    for i in range(60):
        assert out[i]["pred_label"] == "ab"[logs[i].argmax()]
        assert [p["proba"] for p in out[i]["proba"]] == pytest.approx(proba[i].tolist())


# ---- neighbours --------------------------------------------------------------------

def brute(reference, queries, k):
    out = {}
    for qid, q in queries:
        near = sorted((float(np.sqrt(((np.array(q) - np.array(r)) ** 2).sum())), rid) for rid, r in reference)
        out[qid] = [rid for _, rid in near[:k]]
    return out


def test_neighbours_match_brute_force_with_a_hot_group(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 4)) * 6
    reference = [(i, (centres[i % 5] + rng.normal(size=4)).tolist()) for i in range(400)]
    reference += [(1000 + i, centres[0].tolist()) for i in range(200)]          # a third are copies
    queries = [(5000 + i, (centres[i % 5] + rng.normal(size=4)).tolist()) for i in range(60)] + [(6000, centres[0].tolist())]
    schema = "clip_id long, features array<double>"
    ref = spark.createDataFrame(reference, schema).withColumn("label", F.lit("x"))
    ask = spark.createDataFrame(queries, schema)
    found = neighbours.nearest(ref, ask, 7, pivots=6, block_rows=25).collect()
    ours = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        ours.setdefault(r["query_id"], []).append(r["reference_id"])
    assert ours == brute(reference, queries, 7)


def test_fewer_references_than_k(spark):
    ref = spark.createDataFrame([(1, [0.0, 0.0], "a"), (2, [1.0, 0.0], "b")], "clip_id long, features array<double>, label string")
    ask = spark.createDataFrame([(9, [0.0, 0.0])], "clip_id long, features array<double>")
    found = neighbours.nearest(ref, ask, 5)
    assert found.count() == 2
    shares = {r["label"]: r["share"] for r in neighbours.vote(found, "distance").collect()}
    assert shares == {"a": 1.0, "b": 0.0}
    tie = neighbours.elect(neighbours.vote(found, "uniform")).first()
    assert tie["pred_label"] == "a" and tie["pred_share"] == 0.5


# ---- curves ------------------------------------------------------------------------

def scored(spark, n=500, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(int(f), c, bool(h), float(s)) for f, c, h, s in zip(
        rng.integers(0, 3, n), rng.choice(["a", "b"], n), rng.random(n) < 0.4, np.round(rng.random(n), 2))]
    return rows, spark.createDataFrame(rows, "fold int, class string, hit boolean, score double")


def test_auc_equals_pair_counting(spark):
    rows, df = scored(spark)
    out = {(r["fold"], r["class"]): r["auc"] for r in roc.class_auc(df, ["fold"]).collect()}
    for key in out:
        pos = np.array([s for f, c, h, s in rows if (f, c) == key and h])
        neg = np.array([s for f, c, h, s in rows if (f, c) == key and not h])
        wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
        assert out[key] == pytest.approx(wins)


def test_missing_class_gives_null(spark):
    df = spark.createDataFrame([("a", True, 0.9), ("a", False, 0.1), ("b", False, 0.3), ("b", False, 0.2)],
                               "class string, hit boolean, score double")
    areas = roc.class_auc(df)
    assert {r["class"]: r["auc"] for r in areas.collect()} == {"a": 1.0, "b": None}
    assert roc.macro_auc(areas).first()["macro_auc"] is None


def _curve(rows, key):
    own = [(s, h) for f, c, h, s in rows if (f, c) == key]
    p, m = sum(h for _, h in own), sum(not h for _, h in own)
    points = [(0.0, 0.0)]
    for s in sorted({s for s, _ in own}, reverse=True):
        points.append((sum(not h for t, h in own if t >= s) / m, sum(h for t, h in own if t >= s) / p))
    return np.array(points).T


def test_macro_curve_equals_numpy_interpolation(spark):
    rows, df = scored(spark)
    curve = roc.macro_curve(roc.roc_points(df, ["fold"]), ["fold"])
    ours = sorted((r["fold"], r["fpr"], r["tpr"]) for r in curve.collect())
    expected, macro = [], {}
    for fold in range(3):
        curves = [_curve(rows, (fold, c)) for c in ("a", "b")]
        grid = np.unique(np.concatenate([c[0] for c in curves]))
        mean = np.mean([np.interp(grid, *c) for c in curves], axis=0)
        macro[fold] = (grid, mean)
        expected += [(fold, x, y) for x, y in zip(grid.tolist(), mean.tolist())]
    assert np.allclose(ours, expected)
    average = roc.average_curves(curve, [], "fold")
    steps = np.arange(101) / 100
    values = []
    for grid, mean in macro.values():
        y = np.interp(steps, grid, mean)
        y[0], y[-1] = 0.0, 1.0
        values.append(y)
    got = [r["tpr"] for r in average.orderBy("x").collect()]
    assert np.allclose(got, np.mean(values, axis=0))


# ---- signals -----------------------------------------------------------------------

def numpy_features(samples, g):
    """The published short-term features with numpy, one window at a time."""
    eps = S.EPS
    frames = [samples[i * g.hop:i * g.hop + g.frame] for i in range(1 + (len(samples) - g.frame) // g.hop)]
    flat = np.concatenate(frames)
    frames = [(f - flat.mean()) / (np.abs(flat - flat.mean()).max() + 1e-10) for f in frames]
    rows, before = [], None
    bank = S.filter_rows(g.rate, g.bins)
    pitch = S.pitch_bins(g.rate, g.bins)
    for a, b in zip(frames, frames[1:]):
        x = np.concatenate([a, b])
        m = np.abs(np.fft.fft(x))[: len(x) // 2] / (len(x) // 2)
        before = m if before is None else before

        def entropy(v):
            size = len(v) // 10
            e = (v[: size * 10].reshape(10, size) ** 2).sum(1) / ((v**2).sum() + eps)
            return -(e * np.log2(e + eps)).sum()

        ind = np.arange(1, len(m) + 1) / len(m)
        w = m / m.max()
        centre = (ind * w).sum() / (w.sum() + eps)
        spread = np.sqrt(((ind - centre) ** 2 * w).sum() / (w.sum() + eps))
        flux = ((m / (m + eps).sum() - before / (before + eps).sum()) ** 2).sum()
        passed = np.flatnonzero(np.cumsum(m**2) + eps > 0.9 * (m**2).sum())
        energies = np.log10([np.dot(m[f:f + len(v)], v) + eps for f, v in bank])
        cepstra = np.array(S.cosine_rows(len(bank))) @ energies
        chroma = np.zeros(12)
        for (c, v), value in zip(pitch, m**2):
            chroma[c] += value * v
        chroma /= (m**2).sum()
        rows.append(np.concatenate([
            [np.abs(np.diff(np.sign(x))).sum() / 2 / (len(x) - 1), (x**2).mean(), entropy(x), centre, spread, entropy(m),
             flux, passed[0] / len(m)], cepstra, chroma, [chroma.std()]]))
        before = m
    base = np.array(rows)
    full = np.hstack([base, np.vstack([np.zeros(base.shape[1]), np.diff(base, axis=0)])])
    return np.concatenate([full.mean(0), full.min(0), full.max(0), full.std(0)])


@pytest.mark.parametrize("g", [T.TOY, signals.Geometry(rate=16000, frame=400, hop=160)])
def test_clip_features_equal_numpy(spark, g):
    rng = np.random.default_rng(2)
    # the second clip has an offset, which centring removes
    clips = [(i, (3.0 * i + rng.normal(size=(3 + i) * g.shortest)).tolist()) for i in range(2)] + [(9, [0.1] * (g.shortest - 1))]
    df = spark.createDataFrame(clips, "clip_id long, samples array<double>")
    out = {r["clip_id"]: r["features"] for r in signals.clip_features(df, g, trim=False).collect()}
    assert set(out) == {0, 1}                       # the short clip is left out
    assert len(S.CLIP_FEATURE_NAMES) == 272
    for i, samples in clips[:2]:
        x = np.array(samples)
        assert np.allclose(out[i], numpy_features(x / np.abs(x).max(), g), atol=1e-6)


def test_trim_and_normalise_edges(spark):
    loud = [0.0] * 20 + [1.0, -2.0] * 10 + [0.0] * 20
    df = spark.createDataFrame([(0, loud), (1, [0.0] * 30), (2, [0.5])], "id long, x array<double>")
    out = {r["id"]: r for r in df.select(
        "id", signals.trimmed(F.col("x"), 8, 4).alias("t"), signals.peak_normalized(F.col("x")).alias("n"),
        signals.frames(F.col("x"), 8, 4).alias("f")).collect()}
    assert out[0]["t"] == loud[16:44] and max(map(abs, out[0]["n"])) == 1.0
    assert out[1]["t"] == [0.0] * 30 and out[1]["n"] == [0.0] * 30
    assert out[2]["t"] == [0.5] and out[2]["f"] is None
    with pytest.raises(ValueError):
        signals.prepare(df.withColumnRenamed("x", "samples"), signals.Geometry(400, 10, 4, 8, 4))


def test_centred(spark):
    df = spark.createDataFrame([([[1.0, 3.0], [8.0, 4.0]],)], "x array<array<double>>")
    out = df.select(signals.centred(F.col("x")).alias("c")).first()["c"]
    assert out == [pytest.approx([-0.75, -0.25]), pytest.approx([1.0, 0.0], abs=1e-9)]


# ---- components --------------------------------------------------------------------

def test_components(spark, sf_dir):
    rows = T.split(spark, sf_dir)
    train = rows.where("role = 'train'")
    fitted = components.fit(train)
    shares = np.cumsum(fitted.shares)
    assert shares[-1] > 0.99 and (fitted.k == 1 or shares[-2] <= 0.99)
    assert sum(components.fit(train, k=T.WIDTH).shares) == pytest.approx(1.0)
    table = components.loadings(spark, fitted).collect()
    matrix = np.zeros((T.WIDTH, fitted.k))
    for r in table:
        matrix[r["feature"], r["component"] - 1] = r["weight"]
    assert np.allclose(matrix.T @ matrix, np.eye(fitted.k), atol=1e-8)
    assert all(column[np.abs(column).argmax()] > 0 for column in matrix.T)
    points = np.array([r[0] for r in components.transform(train, fitted).select("features").collect()])
    spread = np.cov(points.T)
    assert np.allclose(spread - np.diag(np.diag(spread)), 0.0, atol=1e-8)
    assert np.allclose(points.mean(0), 0.0, atol=1e-8)


def test_clip_listing(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"abc")
    (tmp_path / "b.txt").write_bytes(b"x")
    found = readers.clip_listing(spark, str(tmp_path)).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["length"]) for r in found] == [("a.wav", 3)]


def test_neighbours_with_string_ids_run_without_the_package_on_the_path(spark):
    rng = np.random.default_rng(4)
    rows = [(f"r{i:03d}", rng.normal(size=3).tolist(), "a") for i in range(300)]
    ref = spark.createDataFrame(rows, "clip_id string, features array<double>, label string")
    ask = ref.where("clip_id < 'r020'")
    found = neighbours.nearest(ref, ask, 3, pivots=5, block_rows=40).collect()
    points = {i: np.array(v) for i, v, _ in rows}
    for q in {r["query_id"] for r in found}:
        expected = sorted(points, key=lambda i: (np.linalg.norm(points[i] - points[q]), i))[:3]
        assert [r["reference_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == expected
