"""Sources.  Schemas are given or read from headers; no pass over the data infers them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clipwright.operators.labels import feature_columns

METADATA_SCHEMA = T.StructType([
    T.StructField("session", T.IntegerType()),
    T.StructField("method", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("emotion", T.StringType()),
    T.StructField("n_annotators", T.IntegerType()),
    T.StructField("agreement", T.IntegerType()),
    T.StructField("path", T.StringType()),
])

# Line prefixes of a metric report and the metric each one holds.
REPORT_LINES = {
    "Accuracy:": "accuracy",
    "F1-score (weighted):": "f1_weighted",
    "F1-score (macro):": "f1_macro",
    "UAR (Unweighted Average Recall):": "uar",
    "Precision (weighted):": "precision_weighted",
    "Recall (weighted):": "recall_weighted",
}


class ContractError(ValueError):
    """An input does not have what an operator needs."""


def metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).csv(path, header=True)


def clip_listing(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """Paths and lengths of the clip files; their bytes are never read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")


def features(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A feature or split table.  CSV columns outside the metadata are read as doubles."""
    if file_format != "csv":
        return spark.read.format(file_format).load(path)
    names = spark.read.csv(path, header=True, inferSchema=False).columns
    numeric = set(feature_columns(names))
    schema = T.StructType([
        T.StructField(n, T.DoubleType() if n in numeric else T.StringType()) for n in names
    ])
    return spark.read.schema(schema).csv(path, header=True)


def as_array(df: DataFrame, columns: Sequence[str] | None = None, name: str = "features") -> DataFrame:
    """Wide feature columns to one array, which keeps plans narrow and inside generated code."""
    chosen = list(columns or feature_columns(df.columns))
    rest = [c for c in df.columns if c not in chosen]
    return df.select(*rest, F.array(*[F.col(f"`{c}`").cast("double") for c in chosen]).alias(name))


def report_values(text: Column) -> list[Column]:
    """The six scalars of a report text; NULL where a line is missing."""
    found = []
    for prefix, name in REPORT_LINES.items():
        escaped = prefix.replace("(", r"\(").replace(")", r"\)")
        found.append(
            F.nullif(F.regexp_extract(text, escaped + r"\s*([\d.]+)", 1), F.lit("")).cast("double").alias(name)
        )
    return found


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """One row per report file below ``fold=<i>/model=<name>/`` with its six scalars."""
    raw = spark.read.schema("value string, fold int, model string").text(folder, wholetext=True)
    return raw.select("fold", "model", *report_values(F.col("value")))


# ---- contracts ---------------------------------------------------------------------

def missing_columns(columns: Sequence[str], needed: Sequence[str]) -> list[str]:
    present = set(columns)
    return [c for c in needed if c not in present]


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Fail before any job if columns are missing; the first ten are named."""
    missing = missing_columns(df.columns, needed)
    if missing:
        raise ContractError(f"missing {len(missing)} required columns (examples: {missing[:10]})")
    return df


def require_rows(df: DataFrame, minimum: int = 500) -> DataFrame:
    """Fail if the training set is too small; at most ``minimum`` rows are counted."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise ContractError(f"training set too small: {found} rows, {minimum} needed")
    return df


def is_projected(columns: Sequence[str], prefix: str = "pca_") -> bool:
    """Whether any feature column is already a principal component."""
    return any(c.startswith(prefix) for c in feature_columns(columns))


def all_projected(columns: Sequence[str], prefix: str = "pca_") -> bool:
    names = feature_columns(columns)
    return bool(names) and all(c.startswith(prefix) for c in names)
