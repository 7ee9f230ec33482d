"""Leakage-free splits: stratified hold-out, leave-one-group-out, stratified folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clipwright.operators import ranking
from clipwright.operators.sizing import ordered_codes


def stratified_quotas(counts: DataFrame, test_size: float = 0.2, label: str = "label") -> DataFrame:
    """Train rows per class of a table (label, n): floor of the exact share, then largest remainders.

    One row per class; the remainder ranking runs on that table only.  A null label is a class.
    """
    everything = Window.partitionBy()
    sizes = counts.withColumn("total", F.sum("n").over(everything)).withColumn(
        "n_train", F.col("total") - F.ceil(F.col("total") * F.lit(test_size)).cast("long")
    )
    shares = sizes.withColumn("base", F.expr("n * n_train div total")).withColumn(
        "rest", F.expr("n * n_train % total")
    )
    missing = F.col("n_train") - F.sum("base").over(everything)
    place = F.row_number().over(Window.orderBy(F.desc("rest"), label))
    return shares.withColumn("missing", missing).select(
        label,
        "n",
        (F.col("base") + F.when(place <= F.col("missing"), 1).otherwise(0)).alias("quota"),
    )


def stratified_split(
    df: DataFrame, id_column: str, test_size: float = 0.2, seed: int = 42, label: str = "label"
) -> DataFrame:
    """Add ``role`` (train / test) with exact class quotas.

    The rows themselves are not shuffled: each is compared with its class's cut-off key.
    """
    drawn = ranking.with_draw(df.select(id_column, label), id_column, seed)
    counts = ranking.bucket_counts(drawn, [label])
    quotas = stratified_quotas(counts.groupBy(label).agg(F.sum("_n").alias("n")), test_size, label)
    cuts = ranking.quota_cutoffs(drawn, counts, [label], id_column, quotas.select(label, F.lit(0).alias("part"), "quota"))
    inside = F.struct(ranking.draw_key(id_column, seed).alias("d"), F.col(id_column).alias("i")) <= F.struct(
        F.col("_cut_draw").alias("d"), F.col("_cut_id").alias("i")
    )
    return (
        ranking.meet(df, cuts.drop("part"), [label], "left")
        .withColumn("role", F.when(inside, "train").otherwise("test"))
        .drop("_cut_draw", "_cut_id")
    )


def fold_index(df: DataFrame, subject: str = "subject") -> DataFrame:
    """One row per group with its fold number in string order (Session10 before Session2)."""
    return ordered_codes(df, subject, "fold")


def with_fold(df: DataFrame, subject: str = "subject") -> DataFrame:
    """Add the fold in which the row's group is the test set."""
    return df.join(fold_index(df, subject), subject)


def leave_one_group_out(df: DataFrame, subject: str = "subject") -> DataFrame:
    """Every row once per fold, with its ``role`` there.

    This is the materialised form of the protocol: rows x groups by definition.  Fits that only
    need sums use :mod:`clipwright.operators.moments` instead, which never multiplies rows.
    """
    own = with_fold(df, subject).withColumnRenamed("fold", "_own")
    folds = fold_index(df, subject).agg(F.count("*").cast("int").alias("n"))
    return (
        own.withColumn("_folds", folds.scalar())
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.col("_folds") - 1)))
        .withColumn("role", F.when(F.col("fold") == F.col("_own"), "test").otherwise("train"))
        .drop("_own", "_folds")
    )


def stratified_folds(
    df: DataFrame, id_column: str, k: int = 5, seed: int | None = 42, label: str = "label"
) -> DataFrame:
    """Add ``fold`` (0..k-1) with per-class balance: ``k`` even segments of each class's order.

    ``seed=None`` takes rows in id order.  Rows are not shuffled: each is compared with its class's cut-off keys.
    """
    drawn = ranking.with_draw(df.select(id_column, label), id_column, seed)
    counts = ranking.bucket_counts(drawn, [label])
    quotas = counts.groupBy(label).agg(F.sum("_n").alias("n")).select(
        label, F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("part"), "n").withColumn("quota", F.expr(f"n * part div {k}"))
    cuts = ranking.quota_cutoffs(drawn, counts, [label], id_column, quotas.select(label, "part", "quota"))
    key = lambda d, i: F.struct(d.alias("d"), i.alias("i"))
    packed = ranking.meet(quotas.select(label, "part", "quota"), cuts, [label, "part"], "left").groupBy(label).agg(
        F.collect_list(F.when(F.col("quota") > 0, key(F.col("_cut_draw"), F.col("_cut_id")))).alias("_cuts"),
        F.count_if(F.col("quota") == 0).cast("int").alias("_passed"))
    here = key(ranking.draw_key(id_column, seed), F.col(id_column))
    fold = F.col("_passed") + F.size(F.filter("_cuts", lambda c: here > c))
    return ranking.meet(df, packed, [label], "left").withColumn("fold", fold.cast("int")).drop("_cuts", "_passed")
