"""Delimited text to rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsatlas.functions import delimited


def explode_delimited(
    df: DataFrame, text: Column, item: str, keep: Sequence[str | Column], separator: str = ";"
) -> DataFrame:
    """One row per item of the text, blank items included; rows with NULL text yield none."""
    return df.select(*keep, F.explode(delimited(text, separator)).alias(item))
