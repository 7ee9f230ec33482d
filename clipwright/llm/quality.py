"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A document's terms are its byte trigrams, hashed into ``TRIGRAMS`` places, and a few word shapes (a repeat of the word
before, no letter at all, capitals only, a run of signs at the end).  Document frequencies are counted over all
documents.  A bounded sample of labelled documents spans the latent space (truncated singular value decomposition of
its weighted terms); its latent vectors and labels are broadcast, their size set by ``sample_rows`` x ``rank``.  Every
document's exact cosines with all of them are computed block by block, and its nearest neighbours vote with weights
that rise with similarity.

Learned from: labels of rows outside the held-out fold only.  Labels, lang, source and ids are never inputs of a score.

Defined results: a document without terms (null, empty, under three bytes without a word shape) gets the share of
label 1 in the sample, as does every document if nothing is labelled for learning (then 0.5); repeated rows and null
ids give a row each; null labels teach nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clipwright.llm.common import WordHasher, fresh, held_out, runs, text_slices, whole_text

TRIGRAMS, SHAPES = 4096, 5
TERMS = TRIGRAMS + SHAPES
#: A word shape counts as so many terms, as it stands for a whole word.
SHAPE_WEIGHT = 4.0

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_LETTER = np.ones(256, np.int32)            # letters, digits and parts of non-ASCII characters
_LETTER[:128] = [chr(i).isalnum() for i in range(128)]
_hashers: dict = {}


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents x terms: how often each term occurs in each text."""
    docs, n = len(offsets) - 1, len(data)
    counts = np.zeros((docs, TERMS), np.float32)
    if n == 0:
        return counts
    row = np.repeat(np.arange(docs), np.diff(offsets))
    if n >= 3:
        wide = data.astype(np.uint32)
        place = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
        place = (place ^ (place >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(20)
        whole = row[2:] == row[:-2]
        found = np.bincount(row[:-2][whole] * TRIGRAMS + place[whole], minlength=docs * TRIGRAMS)
        counts[:, :TRIGRAMS] = found.reshape(docs, TRIGRAMS)
    starts, ends, firsts = runs(~_SPACE[data], offsets)
    if len(starts):
        hashes = _hashers.setdefault(0, WordHasher())(data, starts, ends)
        of = np.repeat(np.arange(docs), np.diff(firsts))
        upper = np.add.reduceat(np.append(_UPPER[data], 0), np.column_stack([starts, ends]).ravel())[::2]
        letters = np.add.reduceat(np.append(_LETTER[data], 0), np.column_stack([starts, ends]).ravel())[::2]
        same, same2 = np.zeros(len(of), bool), np.zeros(len(of), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        same2[2:] = (hashes[2:] == hashes[:-2]) & (of[2:] == of[:-2])
        length = ends - starts
        signs = (length >= 3) & (_LETTER[data[ends - 1]] == 0) & (_LETTER[data[ends - 2]] == 0)
        for shape, hit in enumerate((same, same2, letters == 0, (upper == letters) & (upper >= 2), signs)):
            counts[:, TRIGRAMS + shape] = np.bincount(of[hit], minlength=docs)
    return counts


@dataclass
class Voter:
    """What workers need to score texts: term weights, the latent axes, and labelled latent vectors."""

    weights: np.ndarray          # terms
    axes: np.ndarray             # terms x rank
    vectors: np.ndarray          # sample x rank, unit length
    labels: np.ndarray           # sample, 0 or 1
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        projected = (np.log1p(counts) * self.weights) @ self.axes
        length = np.sqrt((projected ** 2).sum(1, keepdims=True))
        return np.divide(projected, length, out=np.zeros_like(projected), where=length > 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(counts), prior)
        latent = self.latent(counts)
        cosines = latent @ self.vectors.T                 # one exact block: documents x sample
        k = min(self.neighbours, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        similar = np.clip(np.take_along_axis(cosines, near, 1).astype(np.float64), 0, 1)
        weight = similar ** 8
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1)
        return np.where(total > 1e-9, vote / np.maximum(total, 1e-9), prior)


def _frequencies(batches):
    total, docs = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text")):
            total += (term_counts(data, offsets) > 0).sum(0)
            docs += len(offsets) - 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(np.append(total, docs))], names=["term", "n"])


def _vectors(batches):
    for batch in batches:
        labels, places, values = batch.column("label").to_numpy(zero_copy_only=False), [], []
        for _, _, data, offsets in text_slices(batch.column("text")):
            for row in term_counts(data, offsets):
                held = np.flatnonzero(row)
                places.append(held.astype(np.uint16).tobytes())
                values.append(row[held].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("hash"), pa.array(labels.astype(np.int32)), pa.array(places, pa.binary()), pa.array(values, pa.binary())],
            names=["hash", "label", "places", "counts"])


def latent_axes(matrix: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    rank = min(rank, *matrix.shape)
    basis = np.random.default_rng(7).standard_normal((matrix.shape[0], min(rank + 8, matrix.shape[0]))).astype(matrix.dtype)
    for _ in range(4):
        basis, _ = np.linalg.qr(matrix @ (matrix.T @ basis))
    _, _, axes = np.linalg.svd(basis.T @ matrix, full_matrices=False)
    return np.ascontiguousarray(axes[:rank].T)


def fit_voter(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 3000, rank: int = 64,
              neighbours: int = 15, fold: int = 0, id_column: str = "doc_id", text_column: str = "text") -> Voter:
    """Term weights from all of ``docs``; axes and labelled vectors from at most ``sample_rows`` labelled documents.

    The sample takes the labelled ids outside the held-out fold with the smallest hashes.
    """
    texts = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    frequency = texts.select("text").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = frequency.toPandas()                          # one number per term
    n = np.zeros(TERMS + 1)
    n[found["term"].to_numpy()] = found["n"].to_numpy()
    weights = np.log((1 + n[-1]) / (1 + n[:-1])) + 0.1
    weights[TRIGRAMS:] *= SHAPE_WEIGHT

    known = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id", fold))
    known = known.withColumn("hash", F.xxhash64("id"))
    known = known.groupBy("id", "hash").agg(F.max("label").alias("label")).orderBy("hash", "id").limit(sample_rows)
    rows = texts.join(F.broadcast(known), "id").select("hash", "label", "text")      # at most sample_rows rows
    rows = rows.orderBy("hash", F.xxhash64("text")).limit(sample_rows)
    sample = rows.mapInArrow(_vectors, "hash long, label int, places binary, counts binary").toPandas()
    sample = sample.sort_values(["hash", "places", "counts"], kind="stable")
    counts = np.zeros((len(sample), TERMS), np.float32)
    for i, (places, values) in enumerate(zip(sample["places"], sample["counts"])):
        counts[i, np.frombuffer(places, np.uint16)] = np.frombuffer(values, np.float32)
    weights = weights.astype(np.float32)
    if not len(sample):
        return Voter(weights, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), neighbours)
    weighted = np.log1p(counts) * weights
    length = np.sqrt((weighted ** 2).sum(1, keepdims=True))
    axes = latent_axes(weighted / np.maximum(length, 1e-12), rank)
    voter = Voter(weights, axes, np.zeros((0, 1), np.float32), np.zeros(0), neighbours)
    voter.vectors, voter.labels = voter.latent(counts), sample["label"].to_numpy(np.float64)
    return voter


def score_documents(docs: DataFrame, voter: Voter, into: str = "score", text_column: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all if None) of every document and ``into``: 0 to 1, higher for label 1.

    ``into`` must not be one of the kept columns.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    rows = docs.select(*[docs[c] for c in keep], whole_text(docs[text_column]).alias(fresh("whole", docs)))
    schema = StructType([*rows.schema.fields[:-1], StructField(into, DoubleType())])
    shared = spark.sparkContext.broadcast(voter)

    def run(batches):
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for at, to, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                scores[at:to] = shared.value.score(term_counts(data, offsets))
            # single-precision products differ in their last bits with the block they are in
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.round(scores, 6))],
                                             names=[*batch.schema.names[:-1], into])

    return rows.mapInArrow(run, schema)
