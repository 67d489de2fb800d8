"""Where and between whom conflict happens."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import count_where, day_text, mean_of, ratio, region_of
from newsatlas.operators import top_n, unordered_pairs, unpivot_roles
from newsatlas.plans.common import COUNTRY, EVENT, event_day, is_conflict, is_cooperation
from newsatlas.plans.partials import DISTINCT, Part, whole


def _heatmap_rows(feed: Feed) -> DataFrame:
    return feed.events.filter(
        F.col(COUNTRY).isNotNull()
        & F.col("SQLDATE").isNotNull()
        & F.col("GoldsteinScale").isNotNull()
        & is_conflict()
    ).withColumns({"day": event_day(), "pais": F.col(COUNTRY)})


def _heatmap(groups: DataFrame) -> DataFrame:
    located = groups.withColumns(
        {axis: F.try_divide(f"{axis}_sum", f"{axis}_n") for axis in ("lat", "lon")}
    )
    return located.select(
        day_text(F.col("day")).alias("fecha"),
        "pais",
        region_of("pais", "lat", "lon").alias("region"),
        F.round("lat", 4).alias("latitud"),
        F.round("lon", 4).alias("longitud"),
        F.col(DISTINCT).alias("total_eventos_conflicto"),
        mean_of(F.col("intensity"), F.col("n"), 2).alias("intensidad_promedio_goldstein"),
        F.round("intensity", 2).alias("intensidad_total_goldstein"),
    ).orderBy(F.desc("fecha"), F.desc("intensidad_total_goldstein"), "pais")


HEATMAP = Part(
    _heatmap_rows,
    ("day", "pais"),
    _heatmap,
    lambda: {
        "lat_sum": F.sum("ActionGeo_Lat"),
        "lat_n": F.count("ActionGeo_Lat"),
        "lon_sum": F.sum("ActionGeo_Long"),
        "lon_n": F.count("ActionGeo_Long"),
        "intensity": F.sum(F.abs("GoldsteinScale")),
        "n": F.count("*"),
    },
    counted=EVENT,
    day="day",
)


def conflict_heatmap(feed: Feed) -> DataFrame:
    """Conflict intensity per day and country, placed at the mean coordinates."""
    return whole(HEATMAP, feed)


def _scale_and_tone() -> dict:
    """Sums and counts behind the averages of :func:`_average_scale_and_tone`."""
    return {
        "gold": F.sum("GoldsteinScale"),
        "gold_n": F.count("GoldsteinScale"),
        "tone": F.sum("AvgTone"),
        "tone_n": F.count("AvgTone"),
    }


def _average_scale_and_tone() -> list:
    return [
        mean_of(F.col("gold"), F.col("gold_n"), 2).alias("goldstein_promedio"),
        mean_of(F.col("tone"), F.col("tone_n"), 2).alias("tono_promedio"),
    ]


def _pairs(events: DataFrame) -> DataFrame:
    return unordered_pairs(events, "Actor1CountryCode", "Actor2CountryCode", "pais_a", "pais_b")


def _conflict_pairs(groups: DataFrame, top: int = 50) -> DataFrame:
    pairs = groups.select("pais_a", "pais_b", F.col(DISTINCT).alias("total_conflictos"), *_average_scale_and_tone())
    return top_n(pairs, [F.desc("total_conflictos"), F.col("pais_a"), F.col("pais_b")], top)


CONFLICT_PAIRS = Part(
    lambda feed: _pairs(feed.events.filter(is_conflict())),
    ("pais_a", "pais_b"),
    _conflict_pairs,
    _scale_and_tone,
    counted=EVENT,
)


def conflict_country_pairs(feed: Feed, top: int = 50) -> DataFrame:
    """Country pairs most often in conflict."""
    return whole(CONFLICT_PAIRS, feed, top=top)


def _graph(groups: DataFrame, top: int = 100) -> DataFrame:
    edges = groups.filter(F.col(DISTINCT) > 0).select(
        "pais_a",
        "pais_b",
        "interacciones_diplomaticas",
        "interacciones_conflicto",
        F.col(DISTINCT).alias("total_interacciones"),
        ratio(F.col("interacciones_conflicto"), F.col(DISTINCT), 4).alias("proporcion_conflicto"),
    )
    return top_n(edges, [F.desc("total_interacciones"), F.col("pais_a"), F.col("pais_b")], top)


GRAPH = Part(
    lambda feed: _pairs(feed.events),
    ("pais_a", "pais_b"),
    _graph,
    lambda: {
        "interacciones_diplomaticas": count_where(is_cooperation()),
        "interacciones_conflicto": count_where(is_conflict()),
    },
    counted=EVENT,
)


def diplomacy_conflict_graph(feed: Feed, top: int = 100) -> DataFrame:
    """Edges between countries, weighted by cooperation and conflict."""
    return whole(GRAPH, feed, top=top)


_RELIGIONS = [f"Actor{a}Religion{n}Code" for a in (1, 2) for n in (1, 2)]


def _religion_rows(feed: Feed) -> DataFrame:
    def religion(actor: int):
        first, second = _RELIGIONS[2 * actor - 2 : 2 * actor]
        return F.coalesce(first, second, F.lit("SIN_RELIGION"))

    known = F.coalesce(*_RELIGIONS).isNotNull()
    return feed.events.filter(is_conflict() & known).withColumns(
        {
            "region": region_of(COUNTRY, "ActionGeo_Lat", "ActionGeo_Long"),
            "religion_actor1": religion(1),
            "religion_actor2": religion(2),
        }
    )


def _religions(groups: DataFrame) -> DataFrame:
    keys = ["region", "religion_actor1", "religion_actor2"]
    shown = groups.select(*keys, F.col(DISTINCT).alias("total_conflictos"), *_average_scale_and_tone())
    return shown.orderBy(F.desc("total_conflictos"), *keys)


RELIGIONS = Part(
    _religion_rows, ("region", "religion_actor1", "religion_actor2"), _religions, _scale_and_tone, counted=EVENT
)


def religion_conflicts(feed: Feed) -> DataFrame:
    """Conflicts by region and the religions of both actors."""
    return whole(RELIGIONS, feed)


def _ethnic_rows(feed: Feed) -> DataFrame:
    actors = unpivot_roles(
        feed.events.filter(is_conflict()),
        {"Actor1": {"etnia": "Actor1EthnicCode"}, "Actor2": {"etnia": "Actor2EthnicCode"}},
        role=None,
        keep=[EVENT, "GoldsteinScale", "AvgTone"],
    )
    return actors.filter(F.col("etnia").isNotNull())


def _ethnicities(groups: DataFrame) -> DataFrame:
    shown = groups.select("etnia", "apariciones", F.col(DISTINCT).alias("eventos_distintos"), *_average_scale_and_tone())
    return shown.orderBy(F.desc("apariciones"), "etnia")


ETHNICITIES = Part(
    _ethnic_rows, ("etnia",), _ethnicities, lambda: {"apariciones": F.count("*"), **_scale_and_tone()}, counted=EVENT
)


def ethnic_conflicts(feed: Feed) -> DataFrame:
    """Conflicts by ethnic group, each actor of an event counted for itself."""
    return whole(ETHNICITIES, feed)
