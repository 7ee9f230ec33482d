"""Macro curves by the event sweep beside plain interpolation."""

import numpy as np
import pytest

from clipwright.operators import roc

CURVES = {
    # vertical runs, shared and own nodes, a curve that opens late and ends early
    "a": [(0.0, 0.0), (0.0, 0.3), (0.2, 0.3), (0.2, 0.5), (0.5, 0.9), (1.0, 1.0)],
    "b": [(0.0, 0.0), (1 / 3, 0.1), (0.5, 0.1), (0.5, 0.7), (1.0, 1.0)],
    "c": [(0.25, 0.4), (0.4, 0.6), (0.9995, 0.8)],
    "d": [(0.0, 0.0), (1e-7, 0.9), (1.0, 1.0)],
}


def at(points, x):
    """Value at x: the highest on a vertical run, level behind the last node, none before the first one."""
    low, high = {}, {}
    for px, py in points:
        low[px], high[px] = min(py, low.get(px, py)), max(py, high.get(px, py))
    xs = sorted(low)
    if x < xs[0]:
        return None
    left = max(v for v in xs if v <= x)
    right = min((v for v in xs if v > x), default=None)
    if left == x or right is None:
        return high[left]
    return high[left] + (low[right] - high[left]) * (x - left) / (right - left)


@pytest.mark.parametrize("keys", [[], ["fold"]])
def test_sweep_equals_interpolation(spark, keys):
    rows = [(f, c, x, y) for f in ([1, None] if keys else [1]) for c, points in CURVES.items() for x, y in points if not (f is None and c == "b")]
    df = spark.createDataFrame(rows, "fold int, class string, fpr double, tpr double")
    found = {(r["fold"] if keys else 1, r["fpr"]): r["tpr"] for r in roc.macro_curve(df if keys else df.drop("fold"), keys).collect()}
    expected = {}
    for f in {r[0] for r in rows}:
        mine = {c: p for c, p in CURVES.items() if not (f is None and c == "b")}
        for x in {x for p in mine.values() for x, _ in p}:
            expected[f, x] = np.mean([v for v in (at(p, x) for p in mine.values()) if v is not None])
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k], abs=1e-9) for k in expected)


def test_many_nodes(spark):
    draw = np.random.default_rng(3)
    rows = []
    for c in "abc":
        xs, ys = np.sort(draw.integers(0, 5000, 4000)) / 5000, np.sort(draw.random(4000))
        rows += [(c, 0.0, 0.0)] + [(c, float(x), float(y)) for x, y in zip(xs, ys)] + [(c, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "class string, fpr double, tpr double")
    found = roc.macro_curve(df).toPandas().sort_values("fpr")
    assert found["tpr"].is_monotonic_increasing
    curves = {c: [(x, y) for k, x, y in rows if k == c] for c in "abc"}
    for x, y in found.iloc[::500][["fpr", "tpr"]].to_numpy():
        assert y == pytest.approx(np.mean([at(p, x) for p in curves.values()]), abs=1e-9)


def test_empty(spark):
    assert roc.macro_curve(spark.createDataFrame([], "class string, fpr double, tpr double")).count() == 0
