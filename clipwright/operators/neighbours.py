"""Exact nearest neighbours without a row-by-row cross join.

Reference rows are assigned to the nearest of a few pivots.  A query's k-th distance is bounded
from the k smallest pivot distances of every cell; by the triangle inequality all cells whose
nearest possible member lies beyond the bound are skipped.  What remains is cut into blocks of
bounded size on both sides (a cell that holds most rows becomes many blocks), each block pair is
one vectorised distance computation that keeps k rows per query, and a top-k merges the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from clipwright.functions import vectors as V
from clipwright.session import settle

LEAST_PIVOTS = 16
BLOCK_ROWS = 4096
QUERY_SLICE = 256
SLACK = 1e-9          # relative room for rounding in bounds


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2.0 * points @ pivots.T
    return np.sqrt(np.maximum(squared, 0.0))


def _block_top_k(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """For each query the k nearest rows of one block, ties by id: (query, row, distance) arrays."""
    out = []
    row_norms = (rows**2).sum(1)
    for start in range(0, len(queries), QUERY_SLICE):
        part = queries[start:start + QUERY_SLICE]
        norms = (part**2).sum(1)
        rough = norms[:, None] + row_norms[None, :] - 2.0 * part @ rows.T
        if len(rows) > k:
            bar = np.partition(rough, k - 1, axis=1)[:, k - 1]
            near = rough <= (bar + SLACK * (1.0 + norms + row_norms.max()))[:, None]
        else:
            near = np.ones_like(rough, dtype=bool)
        q, r = np.nonzero(near)
        exact = np.sqrt(((part[q] - rows[r]) ** 2).sum(1))
        order = np.lexsort((ids[r], exact, q))
        q, r, exact = q[order], r[order], exact[order]
        first = np.searchsorted(q, np.arange(len(part)))
        keep = np.arange(len(q)) - first[q] < k
        out.append((q[keep] + start, r[keep], exact[keep]))
    return (np.concatenate(column) for column in zip(*out))


def nearest(
    reference: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "clip_id",
    features: str = "features",
    carry: str = "label",
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (query_id, reference_id, ``carry`` of the reference row, distance, rank), rank 1..k.

    Both inputs are written once, as several steps read them.  Pivots grow with the root of the reference rows
    unless given.
    """
    reference = settle(reference.select(id_column, carry, features))
    queries = settle(queries.select(id_column, features))
    if pivots is None:
        pivots = max(LEAST_PIVOTS, math.isqrt(reference.count()) // 8)
    head = (
        reference.select(id_column, features)
        .orderBy(F.md5(F.col(id_column).cast("string")), id_column)
        .limit(pivots)
        .toArrow()
    )
    if head.num_rows == 0:
        raise ValueError("no reference rows")
    centres = np.array(head.column(features).to_pylist(), dtype=float)

    @F.pandas_udf("cell int, reach double")
    def assign(values: pd.Series) -> pd.DataFrame:
        away = _distances(np.stack(values.to_numpy()), centres)
        cell = away.argmin(1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": away[np.arange(len(cell)), cell]})

    placed = V.fenced(reference, features, F.col(features)).select(
        F.col(id_column).alias("reference_id"), F.col(carry).alias("carried"), F.col(features).alias("point"),
        assign(F.col(features)).alias("_a"),
    ).select("reference_id", "carried", "point", "_a.cell", "_a.reach")

    # cell summary: at most pivots rows, and pivots x k smallest reaches
    inner = placed.select("cell", "reach").withColumn(
        "_r", F.row_number().over(Window.partitionBy("cell").orderBy("reach"))
    ).where(F.col("_r") <= k)
    summary = (
        placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high"))
        .join(inner.groupBy("cell").agg(F.collect_list("reach").alias("inner")), "cell")
        .collect()
    )
    cells = len(centres)
    low, high = np.full(cells, np.inf), np.full(cells, -np.inf)
    blocks = np.zeros(cells, dtype=int)
    inner_cell, inner_reach = [], []
    for row in summary:
        low[row.cell], high[row.cell] = row.low, row.high
        blocks[row.cell] = math.ceil(row.n / block_rows)
        inner_cell += [row.cell] * len(row.inner)
        inner_reach += row.inner
    inner_cell, inner_reach = np.array(inner_cell), np.array(inner_reach)
    wanted = min(k, len(inner_reach))
    occupied = blocks > 0

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def route(values: pd.Series) -> pd.Series:
        away = _distances(np.stack(values.to_numpy()), centres)
        worst = np.partition(away[:, inner_cell] + inner_reach, wanted - 1, axis=1)[:, wanted - 1]
        least = np.maximum(np.maximum(away - high, low - away), 0.0)
        room = SLACK * (1.0 + worst + away.max(1))
        # distances here come from expanded squares, whose absolute error near zero is larger
        near = (least <= (worst + room)[:, None] + 1e-6) & occupied
        return pd.Series([np.flatnonzero(n).astype("int32") for n in near])

    query_blocks = max(1, math.ceil(queries.count() / block_rows))
    sizes = F.array(*[F.lit(int(b)) for b in blocks])
    asked = settle(
        V.fenced(queries, features, F.col(features)).select(
            F.col(id_column).alias("query_id"), F.col(features).alias("point"),
            F.explode(route(F.col(features))).alias("cell"),
        )
        .withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
    )
    # a reference cell is offered only to the query blocks that asked for it
    tiles = asked.select(F.col("cell").alias("cell"), F.col("turn").alias("turn")).distinct()
    asked = asked.withColumn("slot", F.explode(F.sequence(F.lit(0), F.get(sizes, F.col("cell")) - 1)))
    offered = placed.select(
        "reference_id", "carried", "point", "cell",
        F.pmod(F.xxhash64("reference_id"), F.get(sizes, F.col("cell"))).cast("int").alias("slot"),
    ).join(tiles, "cell")
    id_type = reference.schema[id_column].dataType.simpleString()
    query_type = queries.schema[id_column].dataType.simpleString()
    carry_type = reference.schema[carry].dataType.simpleString()

    def compare(asked_block: pd.DataFrame, offered_block: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "reference_id", "carried", "distance"]
        if asked_block.empty or offered_block.empty:
            return pd.DataFrame({c: [] for c in columns})
        ids = offered_block["reference_id"].to_numpy()
        q, r, distance = _block_top_k(
            np.stack(asked_block["point"].to_numpy()), np.stack(offered_block["point"].to_numpy()), ids, k
        )
        return pd.DataFrame({
            "query_id": asked_block["query_id"].to_numpy()[q],
            "reference_id": ids[r],
            "carried": offered_block["carried"].to_numpy()[r],
            "distance": distance,
        })

    key = ["cell", "slot", "turn"]
    found = asked.groupBy(*key).cogroup(offered.groupBy(*key)).applyInPandas(
        compare, f"query_id {query_type}, reference_id {id_type}, carried {carry_type}, distance double"
    )
    best = Window.partitionBy("query_id").orderBy("distance", "reference_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .withColumnRenamed("carried", carry)
    )


def vote(neighbours: DataFrame, weights: str = "distance", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., query_id, label, share): posterior by uniform or inverse-distance votes.

    Exact matches take all the weight.  Each query has at most k rows here.
    """
    keys = [*by, "query_id"]
    if weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy(*keys))
        weight = F.when(F.col("exact") == 1, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
        weighed = neighbours.withColumn("exact", exact).withColumn("w", weight)
    else:
        weighed = neighbours.withColumn("w", F.lit(1.0))
    sums = weighed.groupBy(*keys, label).agg(F.sum("w").alias("w"))
    return sums.select(*keys, label, (F.col("w") / F.sum("w").over(Window.partitionBy(*keys))).alias("share"))


def elect(shares: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Predicted label per query; a tie goes to the first class in order."""
    place = Window.partitionBy(*by, "query_id").orderBy(F.desc(F.round("share", 12)), label)
    return shares.withColumn("_p", F.row_number().over(place)).where("_p = 1").select(
        *by, "query_id", F.col(label).alias("pred_label"), F.col("share").alias("pred_share")
    )


def predict(
    reference: DataFrame, queries: DataFrame, k: int = 15, weights: str = "distance",
    id_column: str = "clip_id", features: str = "features", label: str = "label", **options,
) -> DataFrame:
    found = nearest(reference, queries, k, id_column, features, label, **options)
    return elect(vote(found, weights, label), label)
