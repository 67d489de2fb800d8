"""Bursts of mentions: sessions that go on as long as mentions follow each other closely."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from newsatlas.functions import feed_timestamp
from newsatlas.plans.common import EVENT
from newsatlas.streaming.counts import not_ahead

# The functions below travel with the job, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STRETCH = f"{EVENT} long, first long, span long, mentions long"


def _stretches(gap: int):
    """Mentions of one event that lie within the gap of each other, as one row for each stretch of them."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.sort_values([EVENT, "second"], kind="stable")
            apart = (rows[EVENT] != rows[EVENT].shift()) | (rows["second"] - rows["second"].shift() > gap)
            groups = rows.groupby(apart.cumsum().to_numpy())
            found = groups.agg(**{EVENT: (EVENT, "first"), "first": ("second", "min"), "last": ("second", "max"), "mentions": ("second", "size")})
            found["span"] = found["last"] - found["first"]
            yield found[[EVENT, "first", "span", "mentions"]]

    return merge


def mention_bursts(mentions: DataFrame, gap_minutes: int = 30, delay: str = "1 hour") -> DataFrame:
    """Bursts of each event: stretches of mentions at most ``gap_minutes`` apart, with their first and last moment and their number.

    A burst comes out when the watermark has passed its last mention by the gap, so that nothing can join it any more. Until then a late mention
    may begin a burst earlier, go on with it, or close the gap between two, which then are one. State is a row for each open burst, and
    goes with it.

    Tasks merge their own mentions before the shuffle: an event with a third of all mentions sends a row for each stretch that a task
    saw, not one for each mention. Mentions without an event or a real time are left out, as are those
    further ahead of the clock than ``delay``.
    """
    gap = gap_minutes * 60
    timed = (
        mentions.filter(F.col(EVENT).isNotNull())
        .select(EVENT, feed_timestamp("MentionTimeDate").alias("moment"))
        .filter(F.col("moment").isNotNull() & not_ahead("moment", delay))
        .select(EVENT, F.unix_timestamp("moment").alias("second"))
    )
    stretches = timed.mapInPandas(_stretches(gap), _STRETCH)
    # A stretch lasts until a second after the gap: sessions meet where their ends overlap, and a mention just at the gap belongs to both.
    until = F.expr(f"concat(cast(span + {gap + 1} AS string), ' seconds')")
    return (
        stretches.withColumn("moment", F.timestamp_seconds("first"))
        .withWatermark("moment", delay)
        .groupBy(F.session_window("moment", until), EVENT)
        .agg(F.sum("mentions").alias("mentions"))
        .select(
            EVENT,
            F.col("session_window.start").alias("burst_start"),
            (F.col("session_window.end") - F.expr(f"INTERVAL {gap + 1} SECONDS")).alias("burst_end"),
            "mentions",
        )
    )
