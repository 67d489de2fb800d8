"""Counts per slice, by the mentions' own columns or by the country of their event, and removal of repeated events."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsatlas.functions import feed_date, feed_timestamp
from newsatlas.plans.common import COUNTRY, EVENT


def slice_counts(
    rows: DataFrame, moment: str, keys: Sequence[str], delay: str = "1 hour", length: str = "15 minutes"
) -> DataFrame:
    """Rows per feed slice and keys, each slice final once the watermark has passed it.

    Moments further ahead of the clock than ``delay`` are left out: one of them would move the watermark for good.
    """
    return (
        rows.filter(not_ahead(moment, delay))
        .withWatermark(moment, delay)
        .groupBy(F.window(moment, length), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("slice"), *keys, "n")
    )


def country_slices(
    mentions: DataFrame,
    events: DataFrame,
    delay: str = "1 hour",
    late_events: str = "1 day",
    reach: str = "7 days",
    length: str = "15 minutes",
) -> DataFrame:
    """Mentions per slice and country of their event, while both tables come in.

    A mention counts for the events of its id whose day began at most ``reach`` before the end of its slice; every event row counts, repeats included,
    as in the source diversity. Either side may come first: a mention waits for its event for as long as events may be late (``late_events`` after
    the newest day), and an event for its mentions for ``reach``. What is older leaves the state, so that it is bounded by the
    rows of that time. A slice is final, and comes out, when both watermarks have passed it by ``reach``.

    Mentions are counted by event and slice before they meet their events, so that a busy event is one row for each slice in the join.
    """
    counted = (
        mentions.filter(F.col(EVENT).isNotNull())
        .select(F.col(EVENT).alias("id"), feed_timestamp("MentionTimeDate").alias("moment"))
        .filter(F.col("moment").isNotNull() & not_ahead("moment", delay))
        .withWatermark("moment", delay)
        .groupBy(F.window("moment", length), "id")
        .agg(F.count("*").alias("n"))
        .select("id", F.window_time("window").alias("moment"), "n")
    )
    located = (
        events.filter(F.col(EVENT).isNotNull() & F.col(COUNTRY).isNotNull())
        .select(EVENT, F.col(COUNTRY).alias("pais"), feed_date("SQLDATE").cast("timestamp").alias("day"))
        .filter(F.col("day").isNotNull() & not_ahead("day", delay))
        .withWatermark("day", late_events)
    )
    near = f"id = {EVENT} AND moment >= day AND moment < day + INTERVAL {reach}"
    return (
        counted.join(located, F.expr(near))
        .select("pais", "moment", "n")
        .groupBy(F.window("moment", length), "pais")
        .agg(F.sum("n").alias("menciones"))
        .select(F.col("window.start").alias("slice"), "pais", "menciones")
    )


def first_seen(events: DataFrame, delay: str = "6 hours", arrival: str | None = None) -> DataFrame:
    """Each event id once, as long as its repeats arrive within ``delay``; state older is dropped.

    Time is that of arrival: the column ``arrival``, or else the clock of each batch. The day of an event has no part
    in it, so that an older event that was never seen is not late.
    """
    moment = F.current_timestamp() if arrival is None else F.col(arrival)
    timed = events.withColumn("_arrival", moment).withWatermark("_arrival", delay)
    return timed.dropDuplicatesWithinWatermark([EVENT]).drop("_arrival")


def not_ahead(moment: str, delay: str) -> Column:
    """False for moments later than the clock of the batch by more than ``delay``."""
    return F.col(moment) <= F.current_timestamp() + F.expr(f"INTERVAL {delay}")
