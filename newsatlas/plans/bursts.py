"""Events whose mentions come suddenly."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import (
    day_text,
    feed_date,
    feed_timestamp,
    feed_timestamp_prefix,
    mention_time_text,
)
from newsatlas.operators import lookup_few, previous, rolling_sum, spread_join, top_n
from newsatlas.operators.joins import ROWS_PER_TASK
from newsatlas.plans.common import EVENT, newest_event_columns

_DAY_SECONDS = 86_400


def mention_escalation_24h(
    feed: Feed, min_mentions_24h: int = 1, top: int = 50
) -> DataFrame:
    """Event hours whose 24-hour mention count grew most over the event's previous active hour.

    Mentions are merged to hours before the windows see them: an event brings at most one row per
    hour of history to its window.
    """
    hourly = (
        feed.mentions.filter(F.col(EVENT).isNotNull())
        .select(EVENT, F.date_trunc("hour", feed_timestamp("MentionTimeDate")).alias("hour"))
        .filter(F.col("hour").isNotNull())
        .groupBy(EVENT, "hour")
        .agg(F.count("*").alias("menciones_hora"))
        .withColumn("seconds", F.unix_timestamp("hour"))
    )
    last_24h = rolling_sum(F.col("menciones_hora"), [EVENT], "seconds", _DAY_SECONDS)
    rolling = hourly.withColumn("menciones_ultimas_24h", last_24h)
    before = previous(F.col("menciones_ultimas_24h"), [EVENT], "seconds")
    growth = F.col("menciones_ultimas_24h") - F.col("menciones_24h_previas")
    fastest = top_n(
        rolling.withColumn("menciones_24h_previas", F.coalesce(before, F.lit(0)))
        .withColumn("aceleracion_menciones", growth)
        .filter(
            (F.col("menciones_ultimas_24h") >= min_mentions_24h)
            & (F.col("aceleracion_menciones") > 0)
        ),
        [F.desc("aceleracion_menciones"), F.col(EVENT), F.col("hour")],
        top,
    )
    described = lookup_few(
        fastest,
        feed.events,
        EVENT,
        newest_event_columns(),
        ["SQLDATE", "ActionGeo_CountryCode", "EventCode", "CAMEOCodeDescription", "SOURCEURL"],
    )
    return described.select(
        EVENT,
        day_text(feed_date("SQLDATE")).alias("fecha_evento"),
        F.col("ActionGeo_CountryCode").alias("pais"),
        "EventCode",
        "CAMEOCodeDescription",
        mention_time_text(F.col("hour")).alias("hora"),
        "menciones_hora",
        "menciones_ultimas_24h",
        "menciones_24h_previas",
        "aceleracion_menciones",
        "SOURCEURL",
    ).orderBy(F.desc("aceleracion_menciones"), EVENT, "hora")


def breaking_news(
    feed: Feed, min_mentions: int = 1, top: int = 50, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Events with the most mentions within an hour of their first one.

    Mentions with the same event, second and source are merged first. The first mention of each
    event is an aggregate; it is joined back with the keys of very busy events spread over many
    tasks, where a window over the event would put all their mentions into one.
    """
    timed = (
        feed.mentions.filter(F.col(EVENT).isNotNull())
        .select(
            EVENT,
            feed_timestamp_prefix("MentionTimeDate").alias("moment"),
            F.coalesce("MentionSourceName", F.lit("SIN_FUENTE")).alias("source"),
        )
        .filter(F.col("moment").isNotNull())
    )
    merged = timed.groupBy(EVENT, "moment", "source").agg(F.count("*").alias("mentions"))
    firsts = merged.groupBy(EVENT).agg(F.min("moment").alias("first"), F.sum("mentions").alias("rows"))
    dated = spread_join(
        merged, firsts, EVENT, "rows", spread_by=["moment", "source"], rows_per_task=rows_per_task
    )
    first_hour = (
        dated.filter(F.col("moment") < F.col("first") + F.expr("INTERVAL 1 HOUR"))
        .groupBy(EVENT, "first")
        .agg(
            F.sum("mentions").alias("menciones_primera_hora"),
            F.count_distinct("source").alias("fuentes_primera_hora"),
        )
        .filter(F.col("menciones_primera_hora") >= min_mentions)
    )
    # The event settles all ties; the last column is only there for both uses of the rows to need it.
    order = [F.desc("menciones_primera_hora"), F.col(EVENT), F.col("fuentes_primera_hora")]
    busiest = top_n(first_hour, order, top)
    described = lookup_few(
        busiest,
        feed.events,
        EVENT,
        newest_event_columns(),
        ["SQLDATE", "ActionGeo_CountryCode", "EventCode", "CAMEOCodeDescription", "SOURCEURL"],
    )
    return described.select(
        EVENT,
        mention_time_text(F.col("first")).alias("primera_mencion"),
        day_text(feed_date("SQLDATE")).alias("fecha_evento"),
        F.col("ActionGeo_CountryCode").alias("pais"),
        "EventCode",
        "CAMEOCodeDescription",
        "menciones_primera_hora",
        "fuentes_primera_hora",
        "SOURCEURL",
    ).orderBy(F.desc("menciones_primera_hora"), EVENT)
