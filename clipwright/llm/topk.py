"""Exact top-k inner products over an impact-ordered index, score at a time.

The index cuts the rows into blocks.  A block keeps its postings - the components of its vectors - in segments by
quantised impact, that is by powers of two below their size, highest first, and for every segment boundary the length
of what the segments below still hold of each vector.

A block of queries takes the segments in descending impact.  What a vector can still gain is at most the length of its
rest times the query's; both are one more component of the product, so a pass gives the highest score each vector may
have.  As soon as no vector outside a small set can reach the k-th best score found so far, the query stops; the
possible members are then scored exactly from all their components.  The bound goes from one index block to the next.

Work is rows x queries by definition, in cells of a group of index blocks and a group of query blocks.  Both kinds are
dealt to the cells' tasks by a shuffle, never by a broadcast; a task keeps the index blocks of its cell, reads the query
blocks one after the other and hands on k rows per query.  So no task sees more than one cell, the driver none of it,
and a query is copied once per group of index blocks, not once per block.

Defined results: vectors that are null or empty or hold null or non-finite components take no part; only pairs of equal
length are scored; ties go to the smaller id; repeated rows are candidates of their own, and an id that stands in
several query rows is answered once, from all of them; null ids take no part; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwright.llm.common import written

#: Vectors and queries in one block: 64 components of either take at most 2 MB and 0.25 MB.
ROW_BLOCK, QUERY_BLOCK = 4096, 512
#: Components of the index blocks of one cell, and of its query blocks; at least a block of each.
CELL_ENTRIES = 1 << 21
#: Longest vector whose products are taken in single precision.
SINGLE = 1e15
#: Possible members that are scored exactly at a time.
MEMBERS = 1 << 15
INDEX_SCHEMA = "width int, block int, ids binary, vectors binary, order_ binary, cuts binary, left binary"
QUERY_SCHEMA = "width int, block int, ids binary, vectors binary"


def quantised(column: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double; null where a component is null or not finite."""
    sound = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(column.isNotNull() & sound, F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _compact(values: np.ndarray) -> bytes:
    """The integers in as few bytes each as hold all of them."""
    low, high = values.min(initial=0), values.max(initial=0)
    return values.astype(next(t for t in ("i1", "i2", "i4", "i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)).tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"i{max(1, len(data) // max(1, count))}").astype(np.int64)


def impact_segments(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the postings by falling impact level, and where each segment ends; the last one ends with the zeros.

    A segment takes levels until it has half of the postings that are left.
    """
    level = np.frexp(np.abs(matrix.astype(np.float64)))[1].ravel()
    order = np.argsort(-level, kind="stable").astype(np.int32)
    ends = len(order) - np.searchsorted(level[order][::-1], np.arange(level.max(initial=0), 0, -1) - 0.5, "left")
    cuts, begin = [], 0
    for end in np.unique(ends).tolist():
        if 2 * (end - begin) >= ends[-1] - begin:
            cuts.append(end)
            begin = end
    return order, np.array([*cuts[:-1], len(order)], np.int32)


def build_index(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The index blocks of one block of rows (one for each vector width in it)."""
    for width, own in rows.groupby("width"):
        matrix = np.stack(own["vector"].to_numpy()).astype(np.int64)
        order, cuts = impact_segments(matrix)
        left = np.zeros((len(cuts) + 1, len(matrix)))
        rest, begin = matrix.astype(np.float64).ravel(), 0
        for step, cut in enumerate([0, *cuts]):
            rest[order[begin:cut]] = 0
            left[step] = np.sqrt((rest.reshape(matrix.shape) ** 2).sum(1))
            begin = cut
        yield pd.DataFrame([{
            "width": width, "block": int(own["block"].iloc[0]), "ids": own["id"].to_numpy(np.int64).tobytes(),
            "vectors": _compact(matrix.ravel()[order]), "order_": order.tobytes(), "cuts": cuts.tobytes(), "left": left.tobytes()}])


class IndexBlock:
    """An index block as searches read it: after each segment, the components so far and the length of the rest."""

    def __init__(self, width: int, ids: bytes, vectors: bytes, order: bytes, cuts: bytes, left: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        n = len(self.ids)
        at, ends = np.frombuffer(order, np.int32), np.frombuffer(cuts, np.int32)
        values, rest = _unpacked(vectors, n * width), np.frombuffer(left).reshape(len(ends) + 1, n)
        self.exact = np.zeros(n * width, np.int64)
        self.exact[at] = values
        self.exact = self.exact.reshape(n, width)
        self.longest = rest[0].max(initial=0)
        so_far, begin, self.steps = np.zeros(n * width, np.float32 if self.longest < SINGLE else np.float64), 0, []
        for step, end in enumerate(ends.tolist()):
            so_far[at[begin:end]] = values[begin:end]
            begin = end
            self.steps.append(np.hstack([so_far.reshape(n, width), rest[step + 1][:, None].astype(so_far.dtype)]))


class Best:
    """The k best (query, id, score) of a block of queries, ties to the smaller id; ``kth``: a score that k rows reach."""

    def __init__(self, queries: int, k: int):
        self.k, self.kth = k, np.full(queries, -np.inf)
        self.query, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(queries, -1)         # where the query's k-th best stands, if it has so many

    def take(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        full = self.last[query] >= 0
        if full.any():
            worst = self.last[query[full]]
            full[full] = (score[full] < self.score[worst]) | (score[full] == self.score[worst]) & (ids[full] > self.id[worst])
        new = ~full
        query, ids, score = (np.concatenate(x) for x in (
            (self.query, query[new]), (self.id, ids[new]), (self.score, score[new])))
        by = np.lexsort((ids, -score, query))
        query = query[by]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.query, self.id, self.score = query[kept], ids[by[kept]], score[by[kept]]
        ends = np.flatnonzero(rank[kept] == self.k - 1)
        self.last[self.query[ends]] = ends
        self.kth[self.query[ends]] = self.score[ends]


def _bound(block: IndexBlock, ids: np.ndarray, queries: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """For each query the lowest exact score of the k vectors that may have the highest ones; none if there are fewer."""
    high = np.where(block.ids[None, :] == ids[:, None], -np.inf, high)
    likely = np.argpartition(-high, k - 1, axis=1)[:, :k]
    score = np.stack([(block.exact[rows] * queries).sum(1) for rows in likely.T], axis=1)
    return np.where(np.isneginf(np.take_along_axis(high, likely, 1)).any(1), -np.inf, score.min(1))


def search_block(block: IndexBlock, ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Take what one index block adds to the k best of each query of a block."""
    n, width = block.exact.shape
    length = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    q = np.hstack([queries, length[:, None]]).astype(np.float32 if length.max(initial=0) < SINGLE else np.float64)
    # covers what rounding of components, products and bounds can add up to
    loose = (2 * width + 8) * max(np.finfo(q.dtype).eps, np.finfo(block.steps[0].dtype).eps)
    open_ = np.arange(len(q))           # queries whose possible members are too many yet
    for step, segment in enumerate(block.steps):
        high = q[open_] @ segment.T
        if not step and n >= best.k and np.isneginf(best.kth).any():
            best.kth = np.maximum(best.kth, _bound(block, ids, queries, high, best.k))
        kth = best.kth[open_]
        least = np.where(np.isneginf(kth), kth, kth - loose * (length[open_] * block.longest + np.abs(kth)) - 1e-6)
        # a threshold that single precision rounds up would lose rows
        least = np.nextafter(least.astype(high.dtype), np.array(-np.inf, high.dtype))
        at = np.flatnonzero(high >= least[:, None])
        query, row = np.divmod(at, n)
        many = np.bincount(query, minlength=len(open_)) > max(4 * best.k, n // 64)
        if step == len(block.steps) - 1:
            many[:] = False
        settled = ~many[query]
        query, row = open_[query[settled]], row[settled]
        other = block.ids[row] != ids[query]
        query, row = query[other], row[other]
        for i in range(0, len(row), MEMBERS):
            part = slice(i, i + MEMBERS)
            score = (block.exact[row[part]] * queries[query[part]]).sum(1)
            best.take(query[part], block.ids[row[part]], score)
        open_ = open_[many]
        if not len(open_):
            return


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, {}
        for batch in batches:
            for r in batch.itertuples():
                if r.cell != cell:
                    cell, held = r.cell, {}
                if r.order_ is not None:
                    held.setdefault(r.width, []).append(IndexBlock(r.width, r.ids, r.vectors, r.order_, r.cuts, r.left))
                    continue
                ids = np.frombuffer(r.ids, np.int64)
                queries = _unpacked(r.vectors, len(ids) * r.width).reshape(len(ids), r.width)
                best = Best(len(ids), k)
                for block in held.get(r.width, []):
                    search_block(block, ids, queries, best)
                if len(best.query):
                    yield pd.DataFrame({"query_id": ids[best.query], "vec_id": best.id, "score": best.score})

    return run


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    out = [{"width": width, "block": int(own["block"].iloc[0]), "ids": own["id"].to_numpy(np.int64).tobytes(),
            "vectors": _compact(np.stack(own["vector"].to_numpy()).astype(np.int64).ravel())}
           for width, own in rows.groupby("width")]
    return pd.DataFrame(out)


def _count(vectors: DataFrame, size: int) -> int:
    return max(1, -(-vectors.count() // size))


def _blocks(vectors: DataFrame, size: int, count: int) -> DataFrame:
    """Rows dealt evenly into ``count`` blocks of about ``size`` by a hash of id and vector."""
    return vectors.withColumn("block", F.pmod(F.xxhash64("id", "vector", F.lit(size)), F.lit(count)).cast("int"))


def _cells(index: DataFrame, queries: DataFrame, index_blocks: int, query_blocks: int, width: int) -> DataFrame:
    """Index and query blocks with the ``cell`` in which they meet; a cell is a task, its index blocks come first."""
    rows, asked = (max(1, CELL_ENTRIES // (size * width)) for size in (ROW_BLOCK, QUERY_BLOCK))
    row_groups, query_groups = -(-index_blocks // rows), -(-query_blocks // asked)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = index.withColumn("_other", every(query_groups)).withColumn(
        "cell", F.expr(f"cast(block div {rows} as int)") * query_groups + F.col("_other"))
    copies = queries.withColumn("_other", every(row_groups)).withColumn(
        "cell", F.col("_other") * query_groups + F.expr(f"cast(block div {asked} as int)"))
    both = own.unionByName(copies, allowMissingColumns=True).drop("_other")
    return both.repartitionById(row_groups * query_groups, F.col("cell")).sortWithinPartitions(
        "cell", F.col("order_").isNull(), "block")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of every query row.

    Queries are the rows where ``is_query`` holds; candidates are all rows but those with the query's own id.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), quantised(F.col(vector_column)).alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).withColumn("width", F.size("vector"))
    rows = rows.filter("width > 0")
    rows = written(rows, "topk-vectors")
    queries = rows.filter("is_query").dropDuplicates(["id", "vector"])

    index_blocks, query_blocks = _count(rows, ROW_BLOCK), _count(queries, QUERY_BLOCK)
    width = rows.agg(F.max("width")).first()[0] or 1
    index = written(
        _blocks(rows, ROW_BLOCK, index_blocks).groupBy("block").applyInPandas(
            lambda own: pd.concat(list(build_index(own))), INDEX_SCHEMA), "topk-index")
    blocks = written(
        _blocks(queries, QUERY_BLOCK, query_blocks).groupBy("block").applyInPandas(_pack, QUERY_SCHEMA), "topk-queries")

    # each query block meets each index block: the stated queries against all rows
    local = _cells(index, blocks, index_blocks, query_blocks, width).mapInPandas(
        _search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
