"""Reading values and bands."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Edges and names of the consumption bands.
DEFAULT_BINS = (-1.0, 5.0, 15.0, 50.0, 999999.0)
DEFAULT_LABELS = ("very_low", "low", "medium", "high")


def reading(df: DataFrame, column: str = "consumption_kwh") -> Column:
    """Reading as double; NaN (a null that went through a float file) becomes null."""
    col = F.col(column).cast("double")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def band(value: Column, bins: Sequence[float] = DEFAULT_BINS,
         labels: Sequence[str] = DEFAULT_LABELS) -> Column:
    """Label of the right-closed bin that holds ``value``; null outside all bins."""
    edges = [float(b) for b in bins]
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError("bins must increase monotonically")
    if len(labels) != len(edges) - 1:
        raise ValueError("there must be one label fewer than bin edges")
    chosen = F.lit(None).cast("string")
    for low, high, label in zip(edges, edges[1:], labels):
        chosen = F.when((value > low) & (value <= high), F.lit(label)).otherwise(chosen)
    return chosen


def cosine(a: Column, norm_a: Column, b: Column, norm_b: Column) -> Column:
    """Cosine of two equally long arrays; 0 where one of them is all zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(F.try_divide(dot, norm_a * norm_b), F.lit(0.0))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
