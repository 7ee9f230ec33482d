"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is named by its smallest node.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger neighbours, then
    to its smaller ones.  A round is joins and minima, whatever the size of a component or the degree of a node, and is
    written before the next one reads it.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # larger neighbours of every node take the smallest node around it
        large = edges.join(smallest, edges["b"] == F.col("n")).select("a", F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # edges run from larger to smaller; the smaller ends take the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.alias("l").join(least.alias("s"), F.col("l.a") == F.col("s.a")).select(
            F.explode(F.array(F.struct(F.col("l.b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("l.a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = written(small.filter("a <> b").distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    heads = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)
