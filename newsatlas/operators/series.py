"""Frames over the observed points of a series; gaps are not filled in."""

from collections.abc import Sequence

from pyspark.sql import Column, Window, functions as F


def moving_average(value: Column, by: Sequence[str], order: str, points: int) -> Column:
    """Average over the current and the ``points - 1`` observed points before it."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - points, Window.currentRow)
    return F.avg(value).over(window)


def rolling_sum(value: Column, by: Sequence[str], order: str, reach: int) -> Column:
    """Sum over all points whose ``order`` value is at most ``reach`` behind, both ends included."""
    window = Window.partitionBy(*by).orderBy(order).rangeBetween(-reach, Window.currentRow)
    return F.sum(value).over(window)


def previous(value: Column, by: Sequence[str], order: str) -> Column:
    """Value of the observed point before."""
    return F.lag(value).over(Window.partitionBy(*by).orderBy(order))


def following(value: Column, by: Sequence[str], order: str) -> Column:
    """Value of the observed point after."""
    return F.lead(value).over(Window.partitionBy(*by).orderBy(order))
