"""Exact ranks, cut-offs and running sums that never put a whole group into one task.

A plain window over a group sorts the group in one task.  Here a group is first cut
into ordered buckets; per-bucket totals give each bucket its offset, and the window runs
inside (group, bucket).  Results are the same as those of the plain window.  A null key is
a group like any other.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from clipwright.session import settle

HASH_DIGITS = 3          # 16**3 buckets
SAMPLED_STRINGS = 4096   # strings looked at to place bucket borders


def meet(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal name, null equal to null; ``df`` gives the key columns."""
    keys = {c: f"_k_{c}" for c in on}
    renamed = other.withColumnsRenamed(keys)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])
    return df.join(renamed, same, how).drop(*keys.values())


def draw_key(id_column: str, seed: int | None = 42) -> Column:
    """The pseudo-random but repeatable order of rows: md5 of seed and id; without a seed the id decides alone."""
    if seed is None:
        return F.lit("")
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_column).cast("string")))


def with_draw(df: DataFrame, id_column: str, seed: int | None, digits: int = HASH_DIGITS) -> DataFrame:
    drawn = df.withColumn("_draw", draw_key(id_column, seed))
    if seed is None:
        return value_buckets(drawn, id_column)
    return drawn.withColumn("_bucket", F.substring("_draw", 1, digits))


def bucket_count(n: int) -> int:
    """Buckets for ``n`` rows; both their number and their size grow with the square root."""
    return max(1, math.isqrt(n) // 16)


def value_buckets(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``: an order-preserving bucket from approximate quantiles of ``column``.

    Equal values share a bucket; only the balance depends on the approximation.  Borders between
    strings come from the values with the smallest hashes.
    """
    if buckets is None:
        buckets = bucket_count(df.count())
    if buckets == 1:
        return df.withColumn("_bucket", F.lit(0.0))
    if isinstance(df.schema[column].dataType, StringType):
        few = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.xxhash64(column), column).limit(SAMPLED_STRINGS)
        known = sorted(r[0] for r in few.collect())
        borders = sorted({known[i * len(known) // buckets] for i in range(1, buckets)}) if known else []
        below = F.filter(F.array(*map(F.lit, borders)), lambda b: b < F.col(column)) if borders else F.array()
        return df.withColumn("_bucket", F.size(below).cast("double"))
    probabilities = [i / buckets for i in range(1, buckets)]
    points = df.approxQuantile(column, probabilities, 1.0 / (4 * buckets))
    splits = [float("-inf"), *sorted(set(points)), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=column, outputCol="_bucket", handleInvalid="keep").transform(
        df.withColumn(column, F.col(column)))
    return bucketed.withColumn("_bucket", F.coalesce("_bucket", F.lit(-1.0)))


def bucket_counts(drawn: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows per group and bucket, written once: quotas and cut-offs are both read from it."""
    return settle(drawn.groupBy(*group, "_bucket").agg(F.count("*").alias("_n")))


def quota_cutoffs(drawn: DataFrame, counts: DataFrame, group: Sequence[str], id_column: str, quotas: DataFrame) -> DataFrame:
    """Per quota the key (``_cut_draw``, ``_cut_id``) of the row that fills it.

    ``drawn`` comes from :func:`with_draw`, ``counts`` from :func:`bucket_counts`; ``quotas`` holds rows
    (group, part, quota), any number of parts per group.  A quota of zero, or beyond the group, gives no row.
    Rows are never shuffled: only those of the one bucket in which a quota is reached are ranked.
    """
    group = list(group)
    upto = F.sum("_n").over(Window.partitionBy(*group).orderBy("_bucket"))
    edges = (
        meet(counts.withColumn("_upto", upto), quotas, group)
        .where((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
        .select(*group, "_bucket", "part", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    place = Window.partitionBy(*group, "part", "_bucket").orderBy("_draw", id_column)
    ranked = meet(drawn.select(*group, "_bucket", "_draw", id_column), edges, [*group, "_bucket"]).withColumn(
        "_rank", F.row_number().over(place))
    return ranked.where(F.col("_rank") == F.col("_need")).select(
        *group, "part", F.col("_draw").alias("_cut_draw"), F.col(id_column).alias("_cut_id")
    )


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Add inclusive running sums over ``group`` in ``order``; needs ``_bucket`` ascending in that order."""
    group = list(group)
    totals = df.groupBy(*group, "_bucket").agg(*[F.sum(c).alias(f"_all_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_bucket",
        *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums],
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    walked = df.withColumns({f"_in_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    return (
        meet(walked, offsets, [*group, "_bucket"])
        .withColumns({n: F.col(f"_in_{n}") + F.col(f"_off_{n}") for n in sums})
        .drop(*[f"_in_{n}" for n in sums], *[f"_off_{n}" for n in sums])
    )


def group_rank(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based exact position of each row in its group; needs ``_bucket``."""
    return running_sums(df, group, order, {name: F.lit(1)})
