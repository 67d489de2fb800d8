"""Tone of the coverage and what it goes along with."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import count_where, day_text, mean, mean_of, moments, pearson, pearson_of
from newsatlas.operators import following, moving_average
from newsatlas.plans.common import COUNTRY, EVENT, event_day, is_conflict
from newsatlas.plans.partials import DISTINCT, Part, whole


def _toned_rows(feed: Feed) -> DataFrame:
    """Events with a tone, by day and country. The windows that follow see one row per country and observed day."""
    return feed.events.filter(
        F.col("SQLDATE").isNotNull() & F.col(COUNTRY).isNotNull() & F.col("AvgTone").isNotNull()
    ).withColumns({"day": event_day(), "pais": F.col(COUNTRY)})


def _correlation(state: DataFrame) -> DataFrame:
    n = F.col("both")["n"]
    return state.select(
        n.alias("eventos_analizados"),
        F.round(pearson_of(F.col("both")), 4).alias("correlacion_avgTone_numSources"),
        mean_of(F.col("tone"), n, 2).alias("promedio_tono"),
        mean_of(F.col("sources"), n, 2).alias("promedio_fuentes"),
    )


TONE_SOURCES = Part(
    lambda feed: feed.events.filter(F.col("AvgTone").isNotNull() & F.col("NumSources").isNotNull()),
    (),
    _correlation,
    lambda: {"tone": F.sum("AvgTone"), "sources": F.sum(F.col("NumSources").cast("double"))},
    lambda: {"both": moments(F.col("AvgTone"), F.col("NumSources").cast("double"))},
)


def tone_source_correlation(feed: Feed) -> DataFrame:
    """One row: does tone go along with the number of sources?"""
    return whole(TONE_SOURCES, feed)


def _trend(groups: DataFrame, points: int = 7) -> DataFrame:
    daily = groups.select(
        day_text(F.col("day")).alias("fecha"),
        "pais",
        F.col(DISTINCT).alias("total_eventos"),
        mean_of(F.col("tone"), F.col("n"), 2).alias("tono_promedio_dia"),
    )
    # Daily averages have two decimals; averaged as such, the result does not depend on the order of additions.
    average = moving_average(F.col("tono_promedio_dia").cast("decimal(12,2)"), ["pais"], "fecha", points)
    smooth = F.round(average, 2).cast("double")
    return daily.withColumn("promedio_movil_7_dias", smooth).orderBy("pais", "fecha")


TREND = Part(
    _toned_rows,
    ("day", "pais"),
    _trend,
    lambda: {"tone": F.sum("AvgTone"), "n": F.count("*")},
    counted=EVENT,
    day="day",
)


def sentiment_trend(feed: Feed, points: int = 7) -> DataFrame:
    """Daily tone per country with its moving average over the last observed days."""
    return whole(TREND, feed, points=points)


def _lagged(groups: DataFrame) -> DataFrame:
    daily = groups.select("day", "pais", mean_of(F.col("tone"), F.col("n"), 4).alias("tone"), "conflicts")
    shifted = daily.withColumn("tomorrow", following(F.col("conflicts"), ["pais"], "day"))
    return (
        shifted.filter(F.col("tomorrow").isNotNull())
        .groupBy("pais")
        .agg(
            F.count("*").alias("dias_analizados"),
            F.round(pearson(F.col("tone"), F.col("tomorrow").cast("double")), 4).alias(
                "correlacion_tono_hoy_conflicto_manana"
            ),
            mean(F.col("tone"), 2).alias("tono_promedio"),
            mean(F.col("tomorrow"), 2).alias("conflictos_promedio_manana"),
        )
        .orderBy(F.abs("correlacion_tono_hoy_conflicto_manana").desc(), "pais")
    )


TONE_LAG = Part(
    _toned_rows,
    ("day", "pais"),
    _lagged,
    lambda: {"tone": F.sum("AvgTone"), "n": F.count("*"), "conflicts": count_where(is_conflict())},
)


def tone_conflict_lag(feed: Feed) -> DataFrame:
    """Does a country's tone go along with its conflicts on the next observed day?"""
    return whole(TONE_LAG, feed)
