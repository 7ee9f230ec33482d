"""The corpus pipeline: quality, near duplicates, benchmark decontamination, personal data, segmentation.

Every stage takes all documents that the one before kept and calls one operator of ``clipwright.llm``.  All stages but
the last return the columns of ``documents``; the last returns the sampled segmentations.  Defined results are those
of the operators; a stage on an empty table returns an empty one, and rows are told apart by id and text, so null and
repeated ids lose nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.llm.common import fresh, row_key, written
from clipwright.llm.decontaminate import without_contaminated
from clipwright.llm.pii import redact
from clipwright.llm.quality import fit_voter, score_documents
from clipwright.llm.segment import encode_samples
from clipwright.llm.simhash import near_duplicates

#: Documents scoring less are rejected.
QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the nearest-neighbour vote scores at the threshold or above."""
    voter = fit_voter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh("score", docs)
    return score_documents(docs, voter, score).filter(F.col(score) >= QUALITY_THRESHOLD).select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of near duplicates, ties by text, one of equal rows."""
    key = fresh("row_key", docs)
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    marked = near_duplicates(keyed, id_column=key)
    kept = written(marked.filter(F.col(key) == F.col("component_id")).groupBy(key).count(), "kept")
    once = keyed.join(kept.filter("count = 1").select(key), key, "left_semi")
    more = keyed.join(kept.filter("count > 1").select(key), key, "left_semi").dropDuplicates([key])
    return once.unionByName(more).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document."""
    return encode_samples(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicate), ("decontamination", decontamination),
          ("personal_data", personal_data), ("segmentation", segmentation)]
#: Fitted models, fingerprint graphs and sampling cannot be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
