"""Top rows, overall and per group, and the newest row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in a total order; every task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str
) -> DataFrame:
    """First ``n`` rows of each group, numbered from 1 in column ``rank``.

    The rank filter sits right on the window, so Spark trims every group to ``n`` rows in each task
    before the shuffle; a group holding most of the rows still sends only ``n`` per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def latest_per_key(df: DataFrame, key: str, newest: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Row with the greatest ``newest`` columns per key, NULLs counting as least.

    An aggregate instead of a window: repeats of a key are merged before the shuffle. The kept
    columns take part in the comparison, after ``newest``, which makes the choice deterministic.
    """
    row = F.struct(*newest, *[c for c in keep if c not in newest])
    best = df.groupBy(key).agg(F.max(row).alias("_row"))
    return best.select(key, *[F.col("_row")[c].alias(c) for c in keep])
