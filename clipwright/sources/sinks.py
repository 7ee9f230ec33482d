"""Sinks.  Every write goes to a path of its own; an input path is never overwritten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clipwright.sources.readers import REPORT_LINES

RAW, PROJECTED = "raw", "pca"


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), file_format: str = "parquet") -> str:
    """Write features, predictions or metrics; splits are laid out by fold and role."""
    writer = df.write.mode("errorifexists").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)
    return path


def report_text(model: Column) -> Column:
    """A metric report as text, six lines at four decimals."""
    lines = [F.format_string(f"{prefix} %.4f", F.col(name)) for prefix, name in REPORT_LINES.items()]
    return F.concat_ws("\n", F.concat(F.lit("Evaluation report: "), model), *lines)


def write_reports(reports: DataFrame, path: str) -> str:
    """One text per (fold, model) from wide metric rows."""
    texts = reports.select("fold", "model", report_text(F.col("model")).alias("value"))
    texts.write.mode("errorifexists").partitionBy("fold", "model").text(path)
    return path


def params_json(params: Column, score: Column) -> Column:
    return F.to_json(F.struct(params.alias("best_params"), score.alias("best_cv_f1_weighted")))


def write_params(best: DataFrame, path: str) -> str:
    """One JSON per model below ``model=<name>/``: its best parameters and score."""
    best.select("model", params_json(F.col("params"), F.col("score")).alias("value")).write.mode(
        "errorifexists"
    ).partitionBy("model").text(path)
    return path


def write_split_versions(versions: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Keep the raw split and its projected version side by side below ``root``.

    A version that exists is kept, so the raw one is written once and can always be read again.
    """
    paths = {}
    for name, df in versions.items():
        paths[name] = f"{root}/{name}"
        df.write.mode("ignore").partitionBy("role").parquet(paths[name])
    return paths
