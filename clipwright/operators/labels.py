"""Ingestion of clip metadata: label maps, path parsing, audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clipwright.operators.sizing import ordered_codes

DROP = "drop"

# The published code tables of the two corpora.
CORPUS_LABELS: dict[str, dict[str, str]] = {
    "iemocap": {
        "ang": "angry",
        "hap": "happy",
        "exc": "happy",
        "sad": "sad",
        "neu": "neutral",
        "fea": DROP,
        "dis": DROP,
        "fru": DROP,
        "sur": DROP,
        "oth": DROP,
        "xxx": DROP,
    },
    "cremad": {
        "ANG": "angry",
        "HAP": "happy",
        "SAD": "sad",
        "NEU": "neutral",
        "FEA": DROP,
        "DIS": DROP,
    },
}
META_COLUMNS = ("label", "file_path", "dataset", "subject")


def label_table(corpus: str) -> Mapping[str, str]:
    """The code table of a corpus, whose name is not case-sensitive."""
    table = CORPUS_LABELS.get(corpus.lower())
    if table is None:
        raise ValueError(f"Unknown dataset: {corpus}")
    return table


def map_label(code: Column, table: Mapping[str, str]) -> Column:
    """Class of a (case-sensitive) code; codes outside the table become ``drop``."""
    cases = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(cases, code), F.lit(DROP))


def join_labels(df: DataFrame, code: str, table: DataFrame) -> DataFrame:
    """As :func:`map_label` for a code table held as a DataFrame (``code``, ``label``)."""
    renamed = table.select(F.col("code").alias(code), "label")
    return df.join(renamed, code, "left").withColumn(
        "label", F.coalesce("label", F.lit(DROP))
    )


def code_from_path(path: Column, position: int = 2) -> Column:
    """The ``_``-separated token of the file name; NULL if the name has fewer tokens."""
    return F.get(F.split(F.element_at(F.split(path, "/"), -1), "_"), F.lit(position))


def keep_labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull() & (F.col("label") != DROP))


def prefixed(path: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix.rstrip("/")), F.lit("/"), path)


def subject_of(path: Column, pattern: str = r"(Session\d+)") -> Column:
    """Group of a clip from its path; NULL when the pattern does not occur."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def with_subject(df: DataFrame, path: str = "file_path") -> DataFrame:
    """Add ``subject`` and drop rows that have none."""
    return df.withColumn("subject", subject_of(F.col(path))).where(F.col("subject").isNotNull())


def require_subjects(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no group could be derived from any path")
    return df


def feature_columns(columns: Sequence[str]) -> list[str]:
    """Feature columns are all columns that are not metadata."""
    return [c for c in columns if c not in META_COLUMNS]


def first_clips(df: DataFrame, limit: int, order: str = "file_path") -> DataFrame:
    """The first clips in path order: a top-k, never a full sort."""
    return df.orderBy(order).limit(limit)


# ---- encoding ----------------------------------------------------------------------

def class_table(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, code): every class with its index in sorted order."""
    return ordered_codes(df, label, "code")


def encode(df: DataFrame, classes: DataFrame, label: str = "label", into: str = "label_enc") -> DataFrame:
    """Add the index of each row's class from a :func:`class_table`; an unknown class is an error."""
    joined = df.join(classes.select(F.col("label").alias(label), F.col("code").alias(into)), label, "left")
    unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(label, F.lit("NULL")))).cast("int")
    return joined.withColumn(into, F.when(F.col(into).isNull(), unseen).otherwise(F.col(into)))


def decode(df: DataFrame, classes: DataFrame, code: str, into: str = "label") -> DataFrame:
    """Add the class of each row's index; NULL for an index that no class has."""
    return df.join(classes.select(F.col("code").alias(code), F.col("label").alias(into)), code, "left")


def class_index(label: Column, classes: Sequence[str]) -> Column:
    """Index of a class among names that a model already holds; an unknown class is an error."""
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), label).cast("int") - 1
    unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(label, F.lit("NULL")))).cast("int")
    return F.when(label.isNull() | (index < 0), unseen).otherwise(index)


def class_at(index: Column, classes: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index)


def unseen_labels(scored: DataFrame, known: DataFrame) -> DataFrame:
    """Labels of ``scored`` that ``known`` does not hold, with their row counts.

    Both sides shrink to one row per label before they meet.
    """
    counts = scored.groupBy("label").agg(F.count("*").alias("n"))
    return counts.join(known.select("label").distinct(), "label", "left_anti")


# ---- audits ------------------------------------------------------------------------

def label_distribution(df: DataFrame, role: str | None = "role") -> DataFrame:
    """Rows and percent (one decimal) per label, for all rows and for each role."""
    counts = df.groupBy(*([role] if role else []), "label").agg(F.count("*").alias("n"))
    overall = counts.groupBy("label").agg(F.sum("n").alias("n")).select(F.lit("overall").alias("role"), "label", "n")
    parts = overall.unionByName(counts.select(F.col(role).alias("role"), "label", "n")) if role else overall
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("role"))
    return parts.withColumn("pct", F.round(share, 1))


def arrival_counts(df: DataFrame, order_key: str) -> DataFrame:
    """Counts per label in order of first appearance."""
    first = df.groupBy("label").agg(F.count("*").alias("n"), F.min(order_key).alias("first_seen"))
    return first.orderBy("first_seen")


def ingest_audit(labelled: DataFrame, vector_size: int) -> DataFrame:
    """Total, kept and dropped rows in one pass over rows that still hold ``drop``."""
    kept = F.count_if(F.col("label").isNotNull() & (F.col("label") != DROP))
    return labelled.agg(F.count("*").alias("total"), kept.alias("processed")).select(
        "total",
        "processed",
        (F.col("total") - F.col("processed")).alias("dropped"),
        F.lit(vector_size).alias("vector_size"),
    )


