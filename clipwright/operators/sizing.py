"""Class and group names: numbered without a driver or single-task pass, collected only where columns are named."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clipwright.session import settle


def ordered_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): every distinct non-null value with its place, from 0, in sort order.

    Values are sorted over all tasks; a window runs only over one count per task.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
    # the id holds the task in its upper bits and the place within it below
    placed = settle(values.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_task", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = placed.groupBy("_task").agg(F.count("*").alias("_n")).select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(tasks, "_task").select(column, (F.col("_before") + F.col("_at")).cast("int").alias(name))


def class_names(df: DataFrame, column: str = "label") -> list[str]:
    """The distinct non-null classes in string order, for results that have a column or a model per class."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)
