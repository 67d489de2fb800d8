"""How much attention countries and events get from the media."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import day_text, entropy, not_blank, ratio
from newsatlas.operators import as_text, top_n_per_group
from newsatlas.plans.common import (
    COUNTRY,
    EVENT,
    coverage_per_event,
    event_day,
    is_cooperation,
    mentions_per_event_source,
)
from newsatlas.plans.partials import DISTINCT, Joined, Part, whole


def _top_countries(groups: DataFrame, top: int = 10) -> DataFrame:
    daily = groups.select(
        day_text(F.col("day")).alias("fecha"),
        "pais",
        F.col(DISTINCT).alias("total_eventos"),
        "total_menciones",
        "total_articulos",
    )
    order = [F.desc("total_eventos"), F.col("pais")]
    return top_n_per_group(daily, ["fecha"], order, top, "ranking").orderBy(
        F.desc("fecha"), "ranking"
    )


TOP_COUNTRIES = Part(
    lambda feed: feed.events.filter(F.col(COUNTRY).isNotNull() & F.col("SQLDATE").isNotNull()).withColumns(
        {"day": event_day(), "pais": F.col(COUNTRY)}
    ),
    ("day", "pais"),
    _top_countries,
    lambda: {"total_menciones": F.sum("NumMentions"), "total_articulos": F.sum("NumArticles")},
    counted=EVENT,
    day="day",
)


def top_countries_by_day(feed: Feed, top: int = 10) -> DataFrame:
    """Countries with the most events, day by day."""
    return whole(TOP_COUNTRIES, feed, top=top)


def media_coverage_by_country(feed: Feed, min_events: int = 5) -> DataFrame:
    """Mentions per event, for countries with enough events."""
    located = (
        feed.events.filter(F.col(EVENT).isNotNull() & F.col(COUNTRY).isNotNull())
        .select(EVENT, F.col(COUNTRY).alias("pais"))
        .distinct()
    )
    # Both sides have one row per event (and country) by now, so no key of the join can be heavy.
    joined = located.join(coverage_per_event(feed.mentions), EVENT, "left")
    return (
        joined.groupBy("pais")
        .agg(
            F.count("*").alias("total_eventos"),
            F.sum(F.coalesce("mentions", F.lit(0))).alias("total_menciones"),
            F.sum(F.coalesce("sources", F.lit(0))).alias("total_fuentes_distintas_evento"),
        )
        .filter(F.col("total_eventos") >= min_events)
        .withColumn(
            "razon_menciones_por_evento", ratio(F.col("total_menciones"), F.col("total_eventos"), 2)
        )
        .orderBy(F.desc("razon_menciones_por_evento"), "pais")
    )


def _located_copies(feed: Feed) -> DataFrame:
    return (
        feed.events.filter(F.col(EVENT).isNotNull() & F.col(COUNTRY).isNotNull())
        .groupBy(EVENT, F.col(COUNTRY).alias("pais"))
        .agg(F.count("*").alias("copies"))
    )


def _named_mentions(feed: Feed) -> DataFrame:
    named = mentions_per_event_source(feed.mentions.filter(not_blank(F.col("MentionSourceName"))))
    return named.select(EVENT, F.col("MentionSourceName").alias("fuente"), "mentions")


def _heard(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("pais", "fuente").agg(F.sum(F.col("copies") * F.col("mentions")).alias("n"))


def _diversity(per_source: DataFrame) -> DataFrame:
    return (
        per_source.groupBy("pais")
        .agg(
            F.count("*").alias("medios_distintos"),
            F.sum("n").alias("total_menciones"),
            F.round(entropy(F.col("n")), 4).alias("indice_shannon_fuentes"),
        )
        .orderBy(F.desc("indice_shannon_fuentes"), "pais")
    )


DIVERSITY = Joined(_located_copies, _named_mentions, EVENT, ("pais", "fuente"), _heard, _diversity)


def source_diversity(feed: Feed) -> DataFrame:
    """Shannon index of the sources that mention each country's events.

    Every event row counts once per mention row, repeats included. Both sides are merged to counts
    before they meet, and the join multiplies the counts instead of producing the repeats.
    """
    return _diversity(_heard(_located_copies(feed).join(_named_mentions(feed), EVENT)))


def positive_events_by_country(feed: Feed, top: int = 10) -> DataFrame:
    """Most covered cooperative events of each country; all text.

    The best events of each country are found on narrow rows, one per country and event, by their counts and best row:
    ``top`` of them rule out every row of any other event. These few keys, with their counts, then meet the wide rows. How they are joined is left to
    Spark, which sees the size of the keys once they are there. Ranking trims a country's rows to ``top`` in every task, copies of an event among them.
    """
    positive = feed.events.filter(
        F.col(COUNTRY).isNotNull()
        & F.col(EVENT).isNotNull()
        & (F.col("GoldsteinScale") > 0)
        & is_cooperation()
    ).withColumns({"pais": F.col(COUNTRY), "day": event_day()})
    covered = (
        positive.groupBy("pais", EVENT)
        .agg(F.max(F.struct("NumMentions", "GoldsteinScale")).alias("best"))
        .join(coverage_per_event(feed.mentions), EVENT, "left")
        .select(
            "pais",
            EVENT,
            "best",
            F.coalesce("mentions", F.lit(0)).alias("mentions"),
            F.coalesce("sources", F.lit(0)).alias("sources"),
            F.coalesce(F.round("tone", 2), F.lit(0.0)).alias("doc_tone"),
        )
    )
    key_order = [
        F.desc("mentions"), F.desc("sources"),
        F.desc("best.NumMentions"), F.desc("best.GoldsteinScale"), F.col(EVENT),
    ]
    keys = top_n_per_group(covered, ["pais"], key_order, top, "key_place").drop("key_place", "best")
    joined = positive.join(keys, ["pais", EVENT])
    order = [
        F.desc("mentions"), F.desc("sources"), F.desc("NumMentions"), F.desc("GoldsteinScale"),
        F.col(EVENT), F.desc("day"), F.col("EventCode"), F.col("SOURCEURL"),
    ]
    ranked = top_n_per_group(joined, ["pais"], order, top, "ranking_pais")
    shown = ranked.select(
        "ranking_pais",
        F.col(EVENT).alias("global_event_id"),
        day_text(F.col("day")).alias("fecha_evento"),
        "pais",
        F.coalesce("ActionGeo_FullName", F.lit("SIN_UBICACION")).alias("ubicacion"),
        F.col("EventCode").alias("event_code"),
        F.col("EventBaseCode").alias("event_base_code"),
        F.col("EventRootCode").alias("event_root_code"),
        F.coalesce("CAMEOCodeDescription", F.lit("SIN_DESCRIPCION")).alias("descripcion_cameo"),
        F.round("AvgTone", 2).alias("tono_evento"),
        F.round("GoldsteinScale", 2).alias("goldstein"),
        F.coalesce("NumMentions", F.lit(0)).alias("num_mentions_event"),
        F.coalesce("NumSources", F.lit(0)).alias("num_sources_event"),
        F.coalesce("NumArticles", F.lit(0)).alias("num_articles_event"),
        F.col("mentions").alias("total_menciones_reales"),
        F.col("sources").alias("fuentes_distintas_reales"),
        F.col("doc_tone").alias("tono_promedio_documentos"),
        F.coalesce("SOURCEURL", F.lit("SIN_URL")).alias("source_url"),
    )
    return as_text(shown.orderBy("pais", "ranking_pais"))
