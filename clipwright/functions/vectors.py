"""Element-wise maths on ``array<double>`` columns, all evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` evaluated once per row.

    Inside a lambda an expression is evaluated anew for every element, and the optimizer may
    inline a column into one; a bound value is a lambda variable and cannot be repeated.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fenced(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add column ``name`` through a one-element generator.

    The optimizer does not merge projections across a generator, so ``value`` is computed once per
    row, and a Python function over it gets a plain column as its argument.  No shuffle is involved.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*keep, F.explode_outer(F.array(value)).alias(name))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def square_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def divide(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x / y)


def scale(a: Column, factor: Column) -> Column:
    return F.transform(a, lambda x: x * factor)


def squares(a: Column) -> Column:
    return F.transform(a, lambda x: x * x)


def dot(a: Column, b: Column) -> Column:
    return total(multiply(a, b))


def literal(values: Iterable[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def literal_matrix(rows: Iterable[Iterable[float]]) -> Column:
    return F.array(*[literal(r) for r in rows])


def to_vector(values: Column) -> Column:
    return array_to_vector(values)


def sum_vectors(values: Column) -> Column:
    """Aggregate: element-wise sum of an array column over the group, combined map-side."""
    return vector_to_array(Summarizer.sum(array_to_vector(values)))


def mean_variance(values: Column) -> Column:
    """Aggregate: struct(count, mean vector, *sample* variance vector) in one stable pass."""
    return Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(values))


def rounded(value: Column, digits: int = 6) -> Column:
    """Round and turn a negative zero into zero, so that results compare across engines."""
    return F.round(value, digits) + F.lit(0.0)
