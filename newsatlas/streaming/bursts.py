"""Escalation and breaking news while the mentions come in."""

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsatlas.functions import feed_timestamp, feed_timestamp_prefix
from newsatlas.plans.common import EVENT
from newsatlas.streaming.counts import not_ahead

_HOUR_SECONDS = 3600
#: Shares of the events by hash. A stream keeps their number, for its state is divided by it.
_SHARES = 2048

# The functions below travel with the job, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def escalation_windows(mentions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Mentions per event in 24-hour windows that move by the hour.

    Mentions are first counted by the hour. Only these counts are copied to the 24 windows they
    belong to, not every mention.
    """
    hourly = (
        mentions.filter(F.col(EVENT).isNotNull())
        .select(EVENT, feed_timestamp("MentionTimeDate").alias("moment"))
        .filter(F.col("moment").isNotNull() & not_ahead("moment", delay))
        .withWatermark("moment", delay)
        .groupBy(F.window("moment", "1 hour"), EVENT)
        .agg(F.count("*").alias("mentions"))
        .select(EVENT, F.window_time("window").alias("moment"), "mentions")
    )
    return (
        hourly.groupBy(F.window("moment", "24 hours", "1 hour"), EVENT)
        .agg(F.sum("mentions").alias("mentions_24h"))
        .select(
            EVENT,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "mentions_24h",
        )
    )


def breaking_hours(
    mentions: DataFrame, delay: str = "15 minutes", keep_hours: int = 6
) -> DataFrame:
    """Mentions and sources in the hour after each event's first mention, once that hour is over.

    A row comes out when the watermark has passed the hour, so that no mention can still move it.
    The state of an event is at most one count per second of the hour and one entry per source. An
    empty remainder stays for ``keep_hours``, so that later mentions do not start another hour.

    A call for each event would take far longer than its few rows, so that events share their state with others of the same hash.
    """
    timed = (
        mentions.filter(F.col(EVENT).isNotNull())
        .select(
            EVENT,
            feed_timestamp_prefix("MentionTimeDate").alias("moment"),
            F.coalesce("MentionSourceName", F.lit("SIN_FUENTE")).alias("source"),
        )
        .filter(F.col("moment").isNotNull() & not_ahead("moment", delay))
        .select(EVENT, F.unix_timestamp("moment").alias("second"), "source")
    )
    # Copies are merged before the shuffle; a streaming aggregate must not precede the state.
    merged = timed.mapInPandas(
        _merge_copies, f"{EVENT} bigint, second bigint, source string, mentions bigint"
    )
    hours = (
        merged.withColumn("moment", F.timestamp_seconds("second"))
        .withColumn("share", F.pmod(F.xxhash64(EVENT), F.lit(_SHARES)))
        .withWatermark("moment", delay)
        .groupBy("share")
        .applyInPandasWithState(
            _first_hours(keep_hours * _HOUR_SECONDS),
            outputStructType=f"{EVENT} bigint, first bigint, mentions bigint, sources bigint",
            stateStructType=(
                "events array<bigint>, starts array<bigint>, over array<boolean>, "
                "counted array<bigint>, seconds array<bigint>, counts array<bigint>, "
                "named array<bigint>, sources array<string>, source_starts array<bigint>"
            ),
            outputMode="append",
            timeoutConf=GroupStateTimeout.EventTimeTimeout,
        )
    )
    return hours.withColumn("first", F.timestamp_seconds("first"))


def _merge_copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys = [EVENT, "second", "source"]
    for rows in batches:
        yield rows.groupby(keys, sort=False).size().reset_index(name="mentions")


class _Hour:
    """First hour of one event: mentions by second, and the first second of each source."""

    __slots__ = ("start", "over", "counts", "sources")

    def __init__(self, start: int, over: bool = False):
        self.start, self.over, self.counts, self.sources = start, over, {}, {}

    def wakes(self, keep_seconds: int) -> int:
        """When the hour is over, or, if it is, when the event is forgotten."""
        return self.start + _HOUR_SECONDS + (keep_seconds if self.over else 0)

    def begin(self, start: int) -> None:
        """An earlier mention moves the hour; what is no longer in it goes."""
        self.start = start
        self.counts = {s: n for s, n in self.counts.items() if s < start + _HOUR_SECONDS}
        self.sources = {name: s for name, s in self.sources.items() if s < start + _HOUR_SECONDS}


def _unpacked(state: GroupState) -> dict[int, _Hour]:
    if not state.exists:
        return {}
    events, starts, over, counted, seconds, counts, named, sources, source_starts = state.get
    hours = {e: _Hour(start, done) for e, start, done in zip(events, starts, over)}
    for e, second, n in zip(counted, seconds, counts):
        hours[e].counts[second] = n
    for e, source, second in zip(named, sources, source_starts):
        hours[e].sources[source] = second
    return hours


def _packed(hours: dict[int, _Hour]) -> tuple:
    counts = [(e, s, n) for e, hour in hours.items() for s, n in hour.counts.items()]
    sources = [(e, name, s) for e, hour in hours.items() for name, s in hour.sources.items()]
    return (
        list(hours), [h.start for h in hours.values()], [h.over for h in hours.values()],
        *([row[i] for row in rows] for rows in (counts, sources) for i in range(3)),
    )


def _first_hours(keep_seconds: int) -> Callable:
    """State function of the events of one share; their rows come in any order, batch by batch."""

    def follow(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        moment = state.getCurrentWatermarkMs()
        watermark = moment // 1000
        hours, done, looked_at = _unpacked(state), [], set()

        def look(event: int, now: bool) -> None:
            """End the hour of an event, or forget it, once the watermark is there (``now``) or has passed."""
            hour = hours[event]
            wakes = hour.wakes(keep_seconds)
            if not (watermark >= wakes if now else moment > wakes * 1000):
                return
            if hour.over:
                del hours[event]
                return
            done.append((event, hour.start, sum(hour.counts.values()), len(hour.sources)))
            hour.over, hour.counts, hour.sources = True, {}, {}

        for rows in [] if state.hasTimedOut else batches:
            firsts = rows.groupby(EVENT, sort=False)["second"].min()
            for event, second in zip(firsts.index.tolist(), firsts.tolist()):
                if event in hours and event not in looked_at:
                    look(event, now=True)
                looked_at.add(event)
                if event not in hours:
                    hours[event] = _Hour(second)
                elif not hours[event].over and second < hours[event].start:
                    hours[event].begin(second)
            ends = {e: -1 if hour.over else hour.start + _HOUR_SECONDS for e, hour in hours.items()}
            inside = rows[rows["second"] < rows[EVENT].map(ends)]
            for event, second, source, n in zip(*(inside[c].tolist() for c in (EVENT, "second", "source", "mentions"))):
                hour = hours[event]
                hour.counts[second] = hour.counts.get(second, 0) + n
                hour.sources[source] = min(second, hour.sources.get(source, second))
        for event in [e for e in hours if e not in looked_at]:
            look(event, now=False)
        if done:
            yield pd.DataFrame(done, columns=[EVENT, "first", "mentions", "sources"])
        if not hours:
            if state.exists:
                state.remove()
            return
        state.update(_packed(hours))
        wake = min(hour.wakes(keep_seconds) for hour in hours.values())
        state.setTimeoutTimestamp(max(wake * 1000, moment + 1))

    return follow
