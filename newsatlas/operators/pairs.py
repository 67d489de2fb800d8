"""Unordered pairs, the edges of an undirected graph."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.functions import not_blank


def unordered_pairs(df: DataFrame, one: str, other: str, low: str, high: str) -> DataFrame:
    """Add the pair of two different, non-blank values in columns ``low`` <= ``high``."""
    a, b = F.col(one), F.col(other)
    return df.filter(not_blank(a) & not_blank(b) & (a != b)).withColumns(
        {low: F.least(a, b), high: F.greatest(a, b)}
    )
