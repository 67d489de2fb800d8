"""Who acts, and in what kinds of events."""

from pyspark.sql import DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import actor_category, count_where, mean_of, not_blank, percent_of, region_of
from newsatlas.operators import as_text, top_n, unpivot_roles
from newsatlas.plans.common import COUNTRY, EVENT, is_conflict, or_default
from newsatlas.plans.partials import DISTINCT, Part, whole

_CODES = ("EventRootCode", "EventBaseCode", "EventCode", "descripcion_cameo")


def _cameo_rows(feed: Feed) -> DataFrame:
    return feed.events.filter(F.col("EventCode").isNotNull() & F.col(COUNTRY).isNotNull()).select(
        region_of(COUNTRY, "ActionGeo_Lat", "ActionGeo_Long").alias("region"),
        or_default("EventRootCode", "SIN_ROOT_CODE"),
        or_default("EventBaseCode", "SIN_BASE_CODE"),
        "EventCode",
        F.coalesce("CAMEOCodeDescription", F.lit("Sin descripción")).alias("descripcion_cameo"),
        EVENT,
    )


def _cameo_shares(groups: DataFrame) -> DataFrame:
    counts = groups.withColumnRenamed(DISTINCT, "total_eventos")
    # There are at most eight regions, whatever the data: their totals can be sent to every task,
    # and no task has to hold all event types of the busiest region.
    totals = counts.groupBy("region").agg(F.sum("total_eventos").alias("region_total"))
    shares = counts.join(F.broadcast(totals), "region").select(
        "region",
        *_CODES,
        "total_eventos",
        percent_of(F.col("total_eventos"), F.col("region_total")).alias("porcentaje_region"),
    )
    return as_text(shares.orderBy("region", F.desc("total_eventos"), *_CODES))


CAMEO = Part(_cameo_rows, ("region", *_CODES), _cameo_shares, counted=EVENT)


def cameo_by_region(feed: Feed) -> DataFrame:
    """Event types per world region, with their share of the region's events; all text."""
    return whole(CAMEO, feed)


def _typed_rows(feed: Feed) -> DataFrame:
    def category(actor: int):
        types = [f"Actor{actor}Type{n}Code" for n in (1, 2, 3)]
        return actor_category(*types).alias(f"actor{actor}_categoria")

    rows = feed.events.select(EVENT, "QuadClass", "GoldsteinScale", category(1), category(2))
    return rows.filter(F.col("actor1_categoria").isNotNull() & F.col("actor2_categoria").isNotNull())


def _type_matrix(groups: DataFrame) -> DataFrame:
    return groups.select(
        "actor1_categoria",
        "actor2_categoria",
        F.col(DISTINCT).alias("frecuencia"),
        "eventos_conflicto",
        mean_of(F.col("gold"), F.col("gold_n"), 2).alias("goldstein_promedio"),
    ).orderBy(F.desc("frecuencia"), "actor1_categoria", "actor2_categoria")


ACTOR_TYPES = Part(
    _typed_rows,
    ("actor1_categoria", "actor2_categoria"),
    _type_matrix,
    lambda: {
        "eventos_conflicto": count_where(is_conflict()),
        "gold": F.sum("GoldsteinScale"),
        "gold_n": F.count("GoldsteinScale"),
    },
    counted=EVENT,
)


def actor_type_matrix(feed: Feed) -> DataFrame:
    """Interactions between government, military and rebel actors."""
    return whole(ACTOR_TYPES, feed)


_ACTOR = ("nombre_actor", "codigo_actor", "pais_actor", "tipo_actor", "rol_actor")


def _negative_rows(feed: Feed) -> DataFrame:
    negative = (F.col("AvgTone") < 0) | (F.col("GoldsteinScale") < 0) | is_conflict()
    roles = {
        f"Actor{n}": {
            "nombre_actor": f"Actor{n}Name",
            "codigo_actor": f"Actor{n}Code",
            "pais_actor": f"Actor{n}CountryCode",
            "tipo_actor": f"Actor{n}Type1Code",
        }
        for n in (1, 2)
    }
    kept = [EVENT, "AvgTone", "GoldsteinScale", "QuadClass"]
    actors = unpivot_roles(feed.events.filter(negative), roles, role="rol_actor", keep=kept)
    return actors.filter(not_blank(F.col("nombre_actor"))).select(
        "nombre_actor",
        or_default("codigo_actor", "SIN_CODIGO"),
        or_default("pais_actor", "SIN_PAIS"),
        or_default("tipo_actor", "SIN_TIPO"),
        "rol_actor",
        *kept,
    )


def _negative(groups: DataFrame, top: int = 100) -> DataFrame:
    shown = groups.select(
        *_ACTOR,
        "apariciones",
        F.col(DISTINCT).alias("eventos_distintos"),
        mean_of(F.col("tone"), F.col("tone_n"), 2).alias("tono_promedio"),
        mean_of(F.col("gold"), F.col("gold_n"), 2).alias("goldstein_promedio"),
        "eventos_conflicto",
        percent_of(F.col("eventos_conflicto"), F.col("apariciones")).alias("porcentaje_conflicto"),
    )
    order = [F.desc("apariciones"), F.desc("eventos_distintos"), *[F.col(k) for k in _ACTOR]]
    return as_text(top_n(shown, order, top))


NEGATIVE = Part(
    _negative_rows,
    _ACTOR,
    _negative,
    lambda: {
        "apariciones": F.count("*"),
        "tone": F.sum("AvgTone"),
        "tone_n": F.count("AvgTone"),
        "gold": F.sum("GoldsteinScale"),
        "gold_n": F.count("GoldsteinScale"),
        "eventos_conflicto": count_where(is_conflict()),
    },
    counted=EVENT,
)


def negative_actors(feed: Feed, top: int = 100) -> DataFrame:
    """Actors most often seen in negative events; all text."""
    return whole(NEGATIVE, feed, top=top)
