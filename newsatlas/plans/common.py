"""Shared columns and row sets of the analyses."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.functions import feed_date

EVENT = "GLOBALEVENTID"
COUNTRY = "ActionGeo_CountryCode"


def is_conflict():
    """Verbal or material conflict."""
    return F.col("QuadClass").isin(3, 4)


def is_cooperation():
    """Verbal or material cooperation."""
    return F.col("QuadClass").isin(1, 2)


def distinct_events():
    return F.count_distinct(EVENT)


def event_day():
    return feed_date("SQLDATE")


def or_default(column: str, default: str):
    return F.coalesce(F.col(column), F.lit(default)).alias(column)


def mentions_per_event_source(mentions: DataFrame) -> DataFrame:
    """Mentions per (event, source). Every later count builds on these merged rows, so that an
    event mentioned by a third of all articles weighs no more than its number of sources."""
    return (
        mentions.filter(F.col(EVENT).isNotNull())
        .groupBy(EVENT, "MentionSourceName")
        .agg(
            F.count("*").alias("mentions"),
            F.sum("MentionDocTone").alias("tone_sum"),
            F.count("MentionDocTone").alias("tone_count"),
        )
    )


def coverage_per_event(mentions: DataFrame) -> DataFrame:
    """Per event: mentions, distinct named sources and average document tone."""
    return (
        mentions_per_event_source(mentions)
        .groupBy(EVENT)
        .agg(
            F.sum("mentions").alias("mentions"),
            F.count("MentionSourceName").alias("sources"),
            F.try_divide(F.sum("tone_sum"), F.sum("tone_count")).alias("tone"),
        )
    )


def newest_event_columns() -> list[str]:
    """Order that picks one row of a repeated event id: newest day first, then fixed tie-breakers."""
    return ["SQLDATE", "EventCode", "SOURCEURL"]
