"""Escalation and breaking news with state of their own, kept in Spark's state store and ended by timers.

Both reduce the mentions by a first aggregation, whose tasks share the mentions of a busy event among them. Only its rows, few for each event, meet
the state of their event. That is one small value, read and written once for each batch that has rows of the event; what a batch doesn't touch is neither
read nor written. Every access is a message to the JVM, and takes longer than the work of an event.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from newsatlas.functions import feed_timestamp, feed_timestamp_prefix
from newsatlas.plans.common import EVENT
from newsatlas.sources.history import RETENTION
from newsatlas.streaming.counts import not_ahead

# The functions below travel with the job, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HOUR, _DAY = 3600, 86_400
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def check_state_store(spark: SparkSession) -> None:
    """Streams with state of their own need the RocksDB state store, which the session must name before they start."""
    if not spark.conf.get(_STORE, "").endswith("RocksDBStateStoreProvider"):
        raise ValueError(f"set {_STORE} to {_ROCKS}")


class _Speed(StatefulProcessor):
    """One event: the counts of its last 25 hours, the sum at its newest hour, and when it will be forgotten."""

    def __init__(self, keep_seconds: int):
        self.keep = keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "hours array<long>, counts array<long>, total long, ends long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        arrived: dict[int, int] = {}
        for row in rows:
            arrived[row.hour] = arrived.get(row.hour, 0) + row.n
        state = self.day.get()
        hours = dict(zip(state[0], state[1])) if state else {}
        before = state[2] if state else 0
        out = []
        for hour, n in sorted(arrived.items()):  # hours come when they are over, so in order over all batches
            for old in [h for h in hours if h < hour - _DAY]:
                del hours[old]
            hours[hour] = n
            total = sum(hours.values())
            out.append(Row(**{EVENT: key[0], "hour": hour, "mentions": n, "mentions_24h": total, "mentions_24h_before": before}))
            before = total
        ends = (max(arrived) + _HOUR + self.keep) * 1000
        self.day.update((list(hours), list(hours.values()), before, ends))
        if state:
            self.handle.deleteTimer(state[3])
        self.handle.registerTimer(ends)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.day.clear()
        return iter(())

    def close(self) -> None:
        pass


def escalation_speeds(mentions: DataFrame, delay: str = "1 hour", keep: timedelta = timedelta(days=30)) -> DataFrame:
    """Every hour with mentions of an event, once it is over: those of the 25 hours up to it, and how many more than before.

    These are the rows that the batch analysis ranks: the frame holds both its ends, and ``acceleration`` is the growth over the event's
    previous hour with mentions. The state of an event that isn't mentioned for ``keep`` goes; it is forgotten, and then begins at zero again.
    """
    check_state_store(mentions.sparkSession)
    hourly = (
        mentions.filter(F.col(EVENT).isNotNull())
        .select(EVENT, feed_timestamp("MentionTimeDate").alias("moment"))
        .filter(F.col("moment").isNotNull() & not_ahead("moment", delay))
        .withWatermark("moment", delay)
        .groupBy(F.window("moment", "1 hour"), EVENT)
        .agg(F.count("*").alias("n"))
        .select(EVENT, F.window_time("window").alias("moment"), F.unix_timestamp("window.start").alias("hour"), "n")
    )
    rows = hourly.groupBy(EVENT).transformWithState(
        _Speed(int(keep.total_seconds())),
        f"{EVENT} long, hour long, mentions long, mentions_24h long, mentions_24h_before long",
        "Append",
        "EventTime",
    )
    return rows.withColumn("hour", F.timestamp_seconds("hour")).withColumn(
        "acceleration", F.col("mentions_24h") - F.col("mentions_24h_before")
    )


class _FirstHour(StatefulProcessor):
    """One event: when its first hour began, its mentions so far, and the sources that have named it."""

    def __init__(self, keep_seconds: int):
        self.keep = keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hour = handle.getValueState("hour", "first long, mentions long, sources array<string>, over boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.hour.get()
        if state and state[3]:
            return iter(())  # the hour is over: its mentions are counted
        # Seconds come when the watermark has passed them, so that no later batch has an earlier one. Within a batch they are in no order.
        first = state[0] if state else None
        counts: dict[int, int] = {}
        seen: dict[str, int] = {}
        for row in rows:
            second = row.second
            if first is None or second < first:
                first = second
            if second < first + _HOUR:
                counts[second] = counts.get(second, 0) + row.n
                seen[row.source] = min(second, seen.get(row.source, second))
        mentions = (state[1] if state else 0) + sum(n for second, n in counts.items() if second < first + _HOUR)
        sources = {name for name, second in seen.items() if second < first + _HOUR}.union(state[2] if state else ())
        self.hour.update((first, mentions, sorted(sources), False))
        if not state:
            self.handle.registerTimer((first + _HOUR) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, mentions, sources, over = self.hour.get()
        if over:
            self.hour.clear()
            return
        yield Row(**{EVENT: key[0], "first": first, "mentions": mentions, "sources": len(sources)})
        self.hour.update((first, mentions, [], True))
        self.handle.registerTimer((first + _HOUR + self.keep) * 1000)

    def close(self) -> None:
        pass


def first_hours(mentions: DataFrame, delay: str = "15 minutes", keep: timedelta = RETENTION) -> DataFrame:
    """Mentions and sources in the hour after each event's first mention, once that hour is over.

    The same rows as :func:`newsatlas.streaming.breaking_hours`, for events of any size. Mentions are first counted by event, second and source,
    which divides even the mentions of one event among all tasks; an event's state sees one row for each of these. It holds three numbers and
    the names of the sources of the hour, which go when it is over. The state of an event that is
    over has a time to live, ``keep``, as its stored results have: mentions until then do not begin another hour.
    """
    check_state_store(mentions.sparkSession)
    counted = (
        mentions.filter(F.col(EVENT).isNotNull())
        .select(
            EVENT,
            feed_timestamp_prefix("MentionTimeDate").alias("moment"),
            F.coalesce("MentionSourceName", F.lit("SIN_FUENTE")).alias("source"),
        )
        .filter(F.col("moment").isNotNull() & not_ahead("moment", delay))
        .withWatermark("moment", delay)
        .groupBy(F.window("moment", "1 second"), EVENT, "source")
        .agg(F.count("*").alias("n"))
        .select(EVENT, F.window_time("window").alias("moment"), F.unix_timestamp("window.start").alias("second"), "source", "n")
    )
    rows = counted.groupBy(EVENT).transformWithState(
        _FirstHour(int(keep.total_seconds())),
        f"{EVENT} long, first long, mentions long, sources long",
        "Append",
        "EventTime",
    )
    return rows.withColumn("first", F.timestamp_seconds("first"))
