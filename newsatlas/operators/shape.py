"""Output shaping."""

from pyspark.sql import DataFrame, functions as F


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, names and order unchanged."""
    return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])
