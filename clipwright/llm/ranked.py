"""Exact ranked lexical search in norm buckets, after LEMP (Teflioudi, Gemulla and Mykytiuk 2015).

Items are queries, documents are impact vectors over the items' terms: a coordinate is a term's weight times its damped
share in the document, an integer.  A score is the inner product of an item's term counts with a vector.

Vectors are range-partitioned by falling length, so a task holds vectors of like length, and looked at in buckets.  For
an item whose k-th best score is t so far, a bucket of longest vector l is skipped with all that follow it if
|item| x l < t (Cauchy-Schwarz); inside a bucket the item's heaviest coordinates give each vector a bound, what they add
up to plus what the lengths left over of item and vector can add, and vectors bounded below t are dropped.  Survivors are
scored from all coordinates in 64-bit integers.  The longest vectors are searched first and give every task its first t.
All that is skipped is proven to score less than k others.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, one after the other: a block's terms are what is broadcast.
Document texts are not shuffled, only their counts of the block's terms.  Equal lengths, as copies have, are spread by their
rows' places.  A task hands on k rows per item.

Defined results: a null or empty text has no terms; such documents are no candidates and count in nothing; an item without
terms has no rows; repeated documents are candidates of their own, equal scores go to the smaller id, null ids come last;
equal items with one id are answered once, items that differ under one id, or null ids, each by themselves; an empty table
on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwright.llm.common import lower_ascii, whole_text, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms as they are, A-Z lowered, all others as blanks.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Terms of the items of one block, rows of a bucket, and the longest vectors that are searched first.
BLOCK_TERMS, BUCKET = 1 << 18, 4096
#: Share of an item's squared weights that its heaviest coordinates hold.
FOCUS = 0.75

COUNTS = "id long, n long, terms array<int>, times array<int>"
FOUND = "item int, doc_id long, score long"


def _count_terms(numbers):
    """Terms of every document, and how often it holds each term of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        number, width = known.get, max(1, len(known))
        for batch in batches:
            sizes, keys = [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = text.translate(_LETTERS).split()
                sizes.append(len(words))
                hits = np.array([t for t in map(number, words) if t is not None], np.int64)
                keys.append(hits + row * width)
            found, times = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            offsets = pa.array(np.searchsorted(found, np.arange(batch.num_rows + 1) * width), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found % width, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], names=["id", "n", "terms", "times"])

    return run


class Impacts:
    """Coordinates of a batch of counted documents: term, row and impact of each, in row order."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, documents: int, terms: int):
        self.ids = batch.column("id")
        counted, times = batch.column("terms"), batch.column("times").flatten().to_numpy().astype(np.int64)
        sizes = np.diff(counted.offsets.to_numpy().astype(np.int64))
        self.term = counted.flatten().to_numpy().astype(np.int64)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        damping = 25 + (75 * batch.column("n").to_numpy().astype(np.int64) * documents) // terms
        self.impact = weights[self.term] * ((1_000_000_000 * times) // (1000 * times + 8 * damping[self.row]))
        squares = np.bincount(self.row, self.impact.astype(np.float64) ** 2, len(sizes))
        self.length = np.sqrt(squares)


def _lengths(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, documents, terms = known.value
        at = 0
        for batch in batches:
            length = pa.array(Impacts(batch, weights, documents, terms).length)
            salt = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, length, salt], names=[*batch.schema.names, "length", "salt"])

    return run


class Item:
    """An item's distinct terms, heaviest first, with their counts, and the heaviest ones that bounds look at."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray):
        own, counts = np.unique(terms, return_counts=True)
        order = np.argsort(-counts * weights[own], kind="stable")
        self.terms, self.counts = own[order], counts[order].astype(np.int64)
        self.length = math.sqrt(float((self.counts.astype(np.float64) ** 2).sum()))
        mass = np.cumsum((self.counts * weights[self.terms]).astype(np.float64) ** 2)
        self.focus = int(np.searchsorted(mass, FOCUS * mass[-1])) + 1
        self.rest = math.sqrt(float((self.counts[self.focus:].astype(np.float64) ** 2).sum()))


class Bucket:
    """Vectors by falling length, their coordinates by term."""

    def __init__(self, vectors: Impacts, weights: np.ndarray):
        self.ids = [None if i is None else int(i) for i in vectors.ids.to_pylist()]
        self.length = vectors.length
        by_term = np.argsort(vectors.term, kind="stable")
        self.row, self.impact = vectors.row[by_term], vectors.impact[by_term]
        self.starts = np.searchsorted(vectors.term[by_term], np.arange(len(weights) + 1))

    def postings(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, impact and item's count of every coordinate of these terms."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        return self.row[at], self.impact[at], np.repeat(counts, sizes)

    def survivors(self, item: Item, threshold: int) -> np.ndarray:
        """Rows that may score the threshold or more; none if no vector is long enough."""
        slack = 1 + 1e-9                                   # rounding of the bounds
        long_enough = int(np.searchsorted(-self.length * item.length * slack, -threshold, "right"))
        if not long_enough:
            return np.zeros(0, np.int64)
        row, impact, count = self.postings(item.terms[: item.focus], item.counts[: item.focus])
        impact = impact.astype(np.float64)
        reached = np.bincount(row, impact * count, len(self.length))[:long_enough]
        used = np.bincount(row, impact ** 2, len(self.length))[:long_enough]
        left = np.sqrt(np.maximum(self.length[:long_enough] ** 2 * slack - used, 0))
        return np.flatnonzero((reached + item.rest * left) * slack >= threshold)

    def scores(self, item: Item, rows: np.ndarray) -> np.ndarray:
        """Exact scores of some rows."""
        place = np.full(len(self.length), -1, np.int64)
        place[rows] = np.arange(len(rows))
        row, impact, count = self.postings(item.terms, item.counts)
        held = place[row] >= 0
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, place[row[held]], (impact * count)[held])
        return out


def _best(found: list[tuple[int, int | None]], k: int) -> list[tuple[int, int | None]]:
    return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]


def _search(known, k: int):
    """The k best vectors of a task for every item; buckets come by falling length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, documents, terms, own_terms, firsts = known.value
        items = [Item(t, weights) for t in own_terms]
        best: list[list] = [[] for _ in items]
        thresholds = list(firsts)
        open_ = [i for i, item in enumerate(items) if item.length]
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                bucket = Bucket(Impacts(batch.slice(at, BUCKET), weights, documents, terms), weights)
                longest = float(bucket.length[0])
                # buckets that follow are no longer: an item closed here stays closed
                open_ = [i for i in open_ if items[i].length * longest * (1 + 1e-9) >= thresholds[i]]
                for i in open_:
                    rows = bucket.survivors(items[i], thresholds[i])
                    scored = bucket.scores(items[i], rows)
                    high = scored >= thresholds[i]
                    if high.any():
                        best[i] = _best(best[i] + [(s, bucket.ids[r]) for s, r in zip(scored[high].tolist(), rows[high].tolist())], k)
                        if len(best[i]) == k:
                            thresholds[i] = max(thresholds[i], best[i][-1][0])
            if not open_:
                break
        flat = [(i, doc, score) for i, found in enumerate(best) for score, doc in found]
        if flat:
            item, doc, score = zip(*flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return run


def _block(spark: SparkSession, docs: DataFrame, own: list, k: int) -> DataFrame:
    """(item, doc_id, rank, score) for the items of one block, ``item`` being its place in the block."""
    numbers: dict[bytes, int] = {}
    own_terms = [np.array([numbers.setdefault(t.encode(), len(numbers)) for t in r["terms"]], np.int64) for r in own]
    vocabulary = spark.sparkContext.broadcast(numbers)
    counts = written(docs.mapInArrow(_count_terms(vocabulary), COUNTS), "ranked-counts")
    vocabulary.unpersist()
    size = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    documents, terms = size["documents"], size["terms"] or 0
    frequency = np.zeros(len(numbers), np.int64)
    if terms:
        # at most one row per term of the block
        for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            frequency[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)

    weighing = spark.sparkContext.broadcast((weights, documents, terms))
    vectors = written(counts.filter(F.size("terms") > 0).mapInArrow(_lengths(weighing), f"{COUNTS}, length double, salt long"), "ranked-vectors")
    columns = ["id", "n", "terms", "times"]

    def searched(rows: DataFrame, firsts: list[int]):
        state = spark.sparkContext.broadcast((weights, documents, terms, own_terms, firsts))
        return rows.select(*columns).mapInArrow(_search(state, k), FOUND), state

    # the longest vectors, a bucket of them or more where lengths are equal: their k-th best score is a bound for all
    cut = vectors.agg(F.percentile_approx("length", max(0.0, 1 - BUCKET / max(1, documents)), 10_000)).first()[0]
    longest, first_state = searched(vectors.filter(F.col("length") >= F.lit(cut)).sortWithinPartitions(F.desc("length")), [1] * len(own))
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    firsts = [1] * len(own)
    for row in longest.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") == k).collect():   # a row per item
        firsts[row["item"]] = row["score"]
    spread = vectors.repartitionByRange(F.desc("length"), F.xxhash64("id", "salt"))
    found, state = searched(spread.sortWithinPartitions(F.desc("length")), firsts)
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    out = written(ranked, "ranked-found")
    for held in (weighing, first_state, state):
        held.unpersist()
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for each item, above 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
    terms = F.regexp_extract_all(lower_ascii(whole_text(item_text)), F.lit(f"({TERM})"))
    asked = items.select(F.col(item_id).alias("item_id"), terms.alias("terms"), whole_text(item_text).alias("t"))
    asked = written(asked.filter(F.size("terms") > 0).dropDuplicates(["item_id", "t"]).drop("t"), "ranked-items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    kind = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for number in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == number).collect()   # one block
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item int, item_id {kind}")
        found = _block(spark, rows, own, k) if own else None
        if found is not None:
            out = out.unionByName(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
