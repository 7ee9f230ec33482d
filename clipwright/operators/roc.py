"""Exact one-vs-rest ROC curves and areas.

Scores are first counted per distinct value, then cut into ordered buckets, so neither a
popular score nor a large class lands in one task.  Inputs are long: (keys..., class, hit, score)
with ``hit`` telling whether the row's truth is that class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clipwright.operators import ranking
from clipwright.session import settle

GRID_STEPS = 100
X_BUCKETS = 1024         # equal parts of the x axis in which curves are interpolated


def one_vs_rest(df: DataFrame, keys: Sequence[str], truth: str, scores: Column) -> DataFrame:
    """Rows with an array of struct(label, score) -> long rows, one per class."""
    return df.select(*keys, F.col(truth).alias("_t"), F.explode(scores).alias("_s")).select(
        *keys,
        F.col("_s.label").alias("class"),
        (F.col("_t") == F.col("_s.label")).alias("hit"),
        F.col("_s.score").alias("score"),
    )


def align_scores(scores: Column, classes: Sequence[str]) -> Column:
    """Scores in encoder order; classes the model does not know get 0."""
    known = F.map_from_entries(scores)
    return F.transform(
        F.array(*[F.lit(c) for c in classes]),
        lambda c: F.struct(c.alias("label"), F.coalesce(F.try_element_at(known, c), F.lit(0.0)).alias("score")),
    )


def score_counts(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score, with an order-preserving ``_bucket``.

    Buckets ascend with *descending* score, the direction in which a ROC curve is walked.
    """
    cells = long.groupBy(*keys, "class", "score").agg(F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"))
    # everything below reads the distinct scores, never the rows again
    return ranking.value_buckets(settle(cells.withColumn("_down", -F.col("score"))), "_down")


def _walked(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct scores with cumulative ``tps`` / ``fps`` and the class totals ``p`` / ``m``."""
    return _walk(score_counts(long, keys), keys)


def _walk(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    group = [*keys, "class"]
    walked = ranking.running_sums(cells, group, [F.col("_down")], {"tps": F.col("pos"), "fps": F.col("neg")})
    totals = cells.groupBy(*group).agg(F.sum("pos").alias("p"), F.sum("neg").alias("m"))
    return ranking.meet(walked, totals, group)


def roc_points(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """FPR and TPR at each distinct score, plus the origin; ties are merged."""
    cells = score_counts(long.where(F.col("score").isNotNull()), keys)
    walked = _walk(cells, keys)
    tpr = F.try_divide(F.col("tps").cast("double"), F.col("p"))
    fpr = F.try_divide(F.col("fps").cast("double"), F.col("m"))
    points = walked.select(*keys, "class", "score", fpr.alias("fpr"), tpr.alias("tpr"))
    origin = cells.select(*keys, "class").distinct().select(
        *keys, "class", F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def class_auc(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Area per class; a tied pair counts one half.

    NULL if the class or its rest is empty, or if a score is missing.
    """
    won = F.col("pos") * (F.col("m") - F.col("fps") + F.col("neg") / 2.0)
    area = F.try_divide(F.sum(won), F.max("p").cast("double") * F.max("m"))
    return (
        _walked(long, keys)
        .groupBy(*keys, "class")
        .agg(F.when(F.count("score") == F.count("*"), area).alias("auc"))
    )


def macro_auc(areas: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over classes; NULL as soon as one class has no area."""
    return areas.groupBy(*keys).agg(
        F.when(F.count("auc") == F.count("*"), F.avg("auc")).alias("macro_auc")
    )


def fold_nanmean(values: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mean over folds that skips missing values; NULL if all are missing."""
    return values.groupBy(*keys).agg(F.avg(F.nanvl(column, F.lit(None).cast("double"))).alias(column))


# ---- curve interpolation -----------------------------------------------------------

def steps_of(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Curve as distinct FPR with its lowest and highest TPR; a vertical run becomes one row."""
    return points.where(F.col("fpr").isNotNull() & F.col("tpr").isNotNull()).groupBy(*keys, "class", "fpr").agg(
        F.min("tpr").alias("lo"), F.max("tpr").alias("hi")
    )


def fpr_grid(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct FPR values over all classes."""
    return points.where(F.col("fpr").isNotNull()).select(*keys, "fpr").distinct()


def interpolate(curves: DataFrame, wanted: DataFrame, group: Sequence[str], buckets: int = X_BUCKETS) -> DataFrame:
    """Linear interpolation of step curves (group..., x, lo, hi) at the points (group..., x) wanted.

    At a vertical run the highest value holds.  Curve rows and wanted rows meet in one ordered
    stream cut into x buckets; the last and first curve row of each bucket are handed on to its
    neighbours through a table of groups x buckets rows, so no task holds a whole curve.
    """
    group = list(group)
    slot = _slot(F.col("x"), buckets)
    nodes = curves.select(
        *group, "x", F.struct(F.col("x"), F.col("lo"), F.col("hi")).alias("node"), F.lit(False).alias("wanted")
    )
    blank = wanted.select(*group, "x").withColumns({"node": F.lit(None), "wanted": F.lit(True)})
    merged = nodes.unionByName(blank).withColumn("_bucket", slot)

    ends = nodes.withColumn("_bucket", slot).groupBy(*group, "_bucket").agg(
        F.min("node").alias("_first"), F.max("node").alias("_last")
    )
    edge = Window.partitionBy(*group).orderBy("_bucket")
    back = Window.partitionBy(*group).orderBy(F.desc("_bucket"))
    frame = ranking.meet(merged.select(*group, "_bucket").distinct(), ends, [*group, "_bucket"], "left")
    carried = frame.select(
        *group,
        "_bucket",
        F.last("_last", ignorenulls=True).over(edge.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.last("_first", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("_after"),
    )
    # both windows only ever look back, which keeps them linear; a node comes before a wanted row of
    # the same x on the way up and after it on the way down
    up = Window.partitionBy(*group, "_bucket").orderBy("x", "wanted")
    down = Window.partitionBy(*group, "_bucket").orderBy(F.desc("x"), F.desc("wanted"))
    so_far = (Window.unboundedPreceding, 0)
    walked = merged.withColumns({
        "_here": F.last("node", ignorenulls=True).over(up.rowsBetween(*so_far)),
        "_there": F.last("node", ignorenulls=True).over(down.rowsBetween(*so_far)),
    })
    found = ranking.meet(walked.where("wanted"), carried, [*group, "_bucket"]).select(
        *group, "x", F.coalesce("_here", "_before").alias("a"), F.coalesce("_there", "_after").alias("b")
    )
    a, b, x = F.col("a"), F.col("b"), F.col("x")
    blend = a["hi"] + (b["lo"] - a["hi"]) * (x - a["x"]) / (b["x"] - a["x"])
    value = F.when((x == a["x"]) | b.isNull(), a["hi"]).otherwise(blend)
    return found.select(*group, "x", value.alias("y"))


def _slot(x: Column, buckets: int) -> Column:
    """Even parts of the x axis; a curve has at most one node per negative, so its nodes spread over them."""
    return F.least(F.floor(x * buckets), F.lit(buckets - 1)).cast("int")


def curve_events(steps: DataFrame, group: Sequence[str], buckets: int = X_BUCKETS) -> DataFrame:
    """Step curves (group..., x, lo, hi) as rows (group..., x, jump, bend, opens): what changes at each node.

    ``jump`` is the rise at the node, ``bend`` the change of slope behind it and ``opens`` is 1 at a curve's first node.
    Behind its last node a curve is level.  Neighbours in other x buckets come from a table of curves x buckets rows.
    """
    group = list(group)
    placed = steps.withColumn("_bucket", _slot(F.col("x"), buckets))
    node = F.struct("x", "lo", "hi")
    ends = placed.groupBy(*group, "_bucket").agg(F.min(node).alias("_first"), F.max(node).alias("_last"))
    edge = Window.partitionBy(*group).orderBy("_bucket")
    carried = ends.select(*group, "_bucket", F.lag("_last").over(edge).alias("_before"), F.lead("_first").over(edge).alias("_after"))
    inside = Window.partitionBy(*group, "_bucket").orderBy("x")
    walked = placed.withColumns({"_left": F.lag(node).over(inside), "_right": F.lead(node).over(inside)})
    walked = ranking.meet(walked, carried, [*group, "_bucket"])
    left, right = F.coalesce("_left", "_before"), F.coalesce("_right", "_after")

    def slope(a: Column, b: Column) -> Column:
        return F.coalesce((b["lo"] - a["hi"]) / (b["x"] - a["x"]), F.lit(0.0))

    return walked.select(
        *group, "x", F.when(left.isNull(), F.col("hi")).otherwise(F.col("hi") - F.col("lo")).alias("jump"),
        (slope(node, right) - slope(left, node)).alias("bend"), left.isNull().cast("int").alias("opens"))


def macro_curve(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over classes of the curves, on the union of their FPR values.

    An event sweep: the sum of the curves at x is all jumps so far plus, for each bend so far, the bend times its distance
    from x.  One bucketed running sum gives both for every x, so there are never classes x grid rows.  What a steep
    tied step leaves behind by rounding is its slope times 1e-16, some 1e-8 for a hundred million negatives.
    """
    keys = list(keys)
    steps = settle(steps_of(points, keys)).withColumnRenamed("fpr", "x")
    events = curve_events(steps, [*keys, "class"]).groupBy(*keys, "x").agg(
        F.sum("jump").alias("jump"), F.sum("bend").alias("bend"), F.sum(F.col("bend") * F.col("x")).alias("turn"),
        F.sum("opens").alias("opens"))
    events = settle(events.withColumn("_bucket", _slot(F.col("x"), X_BUCKETS)))
    swept = ranking.running_sums(events, keys, [F.col("x")], {
        "_jump": F.col("jump"), "_bend": F.col("bend"), "_turn": F.col("turn"), "_open": F.col("opens")})
    height = F.col("_jump") + F.col("_bend") * F.col("x") - F.col("_turn")
    return swept.select(*keys, F.col("x").alias("fpr"), (height / F.col("_open")).alias("tpr"))


def average_curves(curves: DataFrame, keys: Sequence[str], fold: str, steps: int = GRID_STEPS) -> DataFrame:
    """Mean of fold curves at ``steps + 1`` even FPR values, ends forced to 0 and 1.

    ``curves`` is (keys..., fold, fpr, tpr).  Each curve shrinks to its first and last node per
    grid cell before any ordering happens.
    """
    keys = list(keys)
    curves = settle(curves)
    cell = F.floor(F.col("fpr") * steps).cast("int")
    # guard against 0.29 * 100 = 28.999...: a point belongs to cell j from j / steps on
    cell = F.when(F.col("fpr") >= (cell + 1) / F.lit(float(steps)), cell + 1).otherwise(cell)
    cell = F.when(F.col("fpr") < cell / F.lit(float(steps)), cell - 1).otherwise(cell)
    group = [*keys, fold]
    nodes = curves.groupBy(*group, "fpr").agg(F.min("tpr").alias("lo"), F.max("tpr").alias("hi"))
    node = F.struct(F.col("fpr").alias("x"), "lo", "hi")
    # the node exactly on a grid value, the first node of the cell and its last one
    packed = nodes.withColumn("_cell", cell).groupBy(*group, "_cell").agg(
        F.min(node).alias("_first"), F.max(node).alias("_last")
    )
    grid = nodes.select(*group).distinct().select(
        *group, F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("_cell")
    )
    edge = Window.partitionBy(*group).orderBy("_cell")
    back = Window.partitionBy(*group).orderBy(F.desc("_cell"))
    laid = ranking.meet(grid, packed, [*group, "_cell"], "left").withColumn("x", F.col("_cell") / F.lit(float(steps)))
    laid = laid.withColumns({
        "_before": F.last("_last", ignorenulls=True).over(edge.rowsBetween(Window.unboundedPreceding, -1)),
        "_after": F.last("_first", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)),
    })
    first, before, x = F.col("_first"), F.col("_before"), F.col("x")
    after = F.coalesce(first, F.col("_after"))
    blend = before["hi"] + (after["lo"] - before["hi"]) * (x - before["x"]) / (after["x"] - before["x"])
    value = (
        F.when(F.col("_cell") == 0, 0.0)
        .when(F.col("_cell") == steps, 1.0)
        .when(first["x"] == x, first["hi"])
        .when(before.isNull(), after["lo"])
        .when(after.isNull(), before["hi"])
        .otherwise(blend)
    )
    return laid.select(*group, "x", value.alias("y")).groupBy(*keys, "x").agg(F.avg("y").alias("tpr"))


def average_class_curves(points: DataFrame, keys: Sequence[str], fold: str, steps: int = GRID_STEPS) -> DataFrame:
    """Mean over folds of their macro curves at ``steps + 1`` even FPR values, ends forced to 0 and 1.

    What :func:`average_curves` gives for the :func:`macro_curve` of every fold, without building these: a macro curve is
    straight between neighbouring nodes of any class, so a grid value needs the nodes on both sides of it alone.  Class
    curves shrink to two nodes per class and grid cell before any ordering happens.
    """
    keys = list(keys)
    group = [*keys, fold]
    curves = steps_of(points, group).withColumnRenamed("fpr", "x")
    cell = F.floor(F.col("x") * steps).cast("int")
    # guard against 0.29 * 100 = 28.999...: a point belongs to cell j from j / steps on
    cell = F.when(F.col("x") >= (cell + 1) / F.lit(float(steps)), cell + 1).otherwise(cell)
    cell = F.when(F.col("x") < cell / F.lit(float(steps)), cell - 1).otherwise(cell)
    # these nodes are the first or last of their cell over all classes, so the ends of each class's own cells enclose them
    node = F.struct("x", "lo", "hi")
    ends = curves.withColumn("_cell", cell).groupBy(*group, "class", "_cell").agg(F.array_distinct(F.array(F.min(node), F.max(node))).alias("_ends"))
    curves = settle(ends.select(*group, "class", "_cell", F.explode("_ends").alias("n")).select(*group, "class", "_cell", "n.*"))
    packed = curves.groupBy(*group, "_cell").agg(F.min("x").alias("_first"), F.max("x").alias("_last"))
    known = curves.groupBy(*group).agg(F.collect_set("class").alias("_classes"))
    grid = known.select(*group, F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("_cell"))
    edge = Window.partitionBy(*group).orderBy("_cell")
    back = Window.partitionBy(*group).orderBy(F.desc("_cell"))
    past = (Window.unboundedPreceding, -1)
    laid = ranking.meet(grid, packed, [*group, "_cell"], "left").withColumn("x", F.col("_cell") / F.lit(float(steps)))
    laid = laid.withColumns({
        "_before": F.last("_last", ignorenulls=True).over(edge.rowsBetween(*past)),
        "_after": F.last("_first", ignorenulls=True).over(back.rowsBetween(*past)),
    })
    # the node on the grid value, or else the nodes on both sides of it
    exact = F.col("_first") == F.col("x")
    laid = settle(laid.select(
        *group, "_cell", "x", F.when(exact, F.col("_first")).otherwise(F.col("_before")).alias("a"),
        F.when(~F.coalesce(exact, F.lit(False)), F.coalesce("_first", "_after")).alias("b")))
    nodes = laid.select(*group, F.explode(F.array("a", "b")).alias("x")).where("x IS NOT NULL").distinct()
    wanted = ranking.meet(nodes, known, group).select(*group, "x", F.explode("_classes").alias("class"))
    heights = interpolate(curves.drop("_cell"), wanted, [*group, "class"]).groupBy(*group, "x").agg(F.avg("y").alias("y"))
    heights = settle(heights)
    for side in ("a", "b"):
        laid = laid.join(heights.select(*group, F.col("x").alias(side), F.col("y").alias(f"y_{side}")), [*group, side], "left")
    blend = F.col("y_a") + (F.col("y_b") - F.col("y_a")) * (F.col("x") - F.col("a")) / (F.col("b") - F.col("a"))
    value = (
        F.when(F.col("_cell") == 0, 0.0)
        .when(F.col("_cell") == steps, 1.0)
        .when(F.col("b").isNull(), F.col("y_a"))
        .when(F.col("a").isNull(), F.col("y_b"))
        .otherwise(blend)
    )
    return laid.select(*group, "x", value.alias("y")).groupBy(*keys, "x").agg(F.avg("y").alias("tpr"))
