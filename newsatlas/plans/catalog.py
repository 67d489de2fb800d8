"""The catalog: what analyses there are, how they are shown, and running all of them."""

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from newsatlas.feed import Feed
from newsatlas.plans import actors, bursts, conflict, coverage, knowledge, tone

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Bars:
    """Bar chart of an analysis: label columns, value column and number of bars."""

    labels: tuple[str, ...]
    value: str
    top: int = 20


@dataclass(frozen=True)
class Analysis:
    """One analysis. ``result`` is the name its rows are stored under."""

    name: str
    result: str
    title: str
    build: Callable[..., DataFrame]
    bars: Bars | None = None
    colour: str = "magnitud"
    on_map: bool = False


# Result names, titles and chart settings of the stored results, in catalog order.
ANALYSES = (
    Analysis(
        "conflict_heatmap",
        "mapa_calor_intensidad_conflictos",
        "Mapa de calor de intensidad de conflictos por país por día",
        conflict.conflict_heatmap,
        Bars(("pais",), "intensidad_total_goldstein"),
        on_map=True,
    ),
    Analysis(
        "top_countries_by_day",
        "top_10_paises_eventos_por_dia",
        "Top 10 países que generan más eventos noticiosos por día",
        coverage.top_countries_by_day,
        Bars(("pais",), "total_eventos"),
    ),
    Analysis(
        "tone_source_correlation",
        "correlacion_avg_tone_fuentes",
        "Correlación entre AvgTone y número de fuentes noticiosas",
        tone.tone_source_correlation,
        colour="signo",
    ),
    Analysis(
        "cameo_by_region",
        "distribucion_cameo_por_region",
        "Distribución de tipos de eventos CAMEO por región del mundo",
        actors.cameo_by_region,
        Bars(("region", "descripcion_cameo"), "total_eventos"),
    ),
    Analysis(
        "actor_type_matrix",
        "matriz_interaccion_actores",
        "Matriz de interacción entre tipos de actores",
        actors.actor_type_matrix,
        Bars(("actor1_categoria", "actor2_categoria"), "frecuencia"),
    ),
    Analysis(
        "media_coverage_by_country",
        "paises_mayor_cobertura_mediatica",
        "Países con mayor cobertura mediática por evento",
        coverage.media_coverage_by_country,
        Bars(("pais",), "razon_menciones_por_evento"),
    ),
    Analysis(
        "sentiment_trend",
        "tendencia_sentimiento_pais",
        "Tendencia de sentimiento por país (promedio móvil del AvgTone)",
        tone.sentiment_trend,
        colour="signo",
    ),
    Analysis(
        "conflict_country_pairs",
        "conflictos_pares_paises",
        "Pares de países que entran en conflicto con mayor frecuencia",
        conflict.conflict_country_pairs,
        Bars(("pais_a", "pais_b"), "total_conflictos"),
    ),
    Analysis(
        "mention_escalation_24h",
        "escalada_eventos_menciones_24h",
        "Detección de escalada de eventos en 24 horas",
        bursts.mention_escalation_24h,
        Bars(("pais", "EventCode"), "aceleracion_menciones"),
    ),
    Analysis(
        "religion_conflicts",
        "conflictos_religion_region",
        "Agrupamiento de conflictos basados en religión por región",
        conflict.religion_conflicts,
        Bars(("region", "religion_actor1"), "total_conflictos"),
    ),
    Analysis(
        "themes_by_region_year",
        "temas_gkg_continente_anio",
        "Principales temas extraídos por el GKG por continente por año",
        knowledge.themes_by_region_year,
        Bars(("tema",), "total_documentos"),
    ),
    Analysis(
        "organizations_by_day",
        "organizaciones_mas_mencionadas_por_dia",
        "Organizaciones más mencionadas a nivel global por día",
        knowledge.organizations_by_day,
        Bars(("organizacion",), "total_documentos"),
    ),
    Analysis(
        "tone_conflict_lag",
        "analisis_rezago_tono_conflicto",
        "Análisis de rezago: ¿el tono de hoy predice conflictos de mañana?",
        tone.tone_conflict_lag,
        Bars(("pais",), "correlacion_tono_hoy_conflicto_manana"),
        colour="signo",
    ),
    Analysis(
        "diplomacy_conflict_graph",
        "grafo_diplomacia_vs_conflicto",
        "Grafo de interacciones diplomáticas vs conflictos entre países",
        conflict.diplomacy_conflict_graph,
        Bars(("pais_a", "pais_b"), "total_interacciones"),
    ),
    Analysis(
        "source_diversity",
        "indice_diversidad_fuentes_pais",
        "Índice de diversidad de fuentes por país (Shannon)",
        coverage.source_diversity,
        Bars(("pais",), "indice_shannon_fuentes"),
    ),
    Analysis(
        "ethnic_conflicts",
        "frecuencia_conflictos_por_etnia",
        "Frecuencia de conflictos por etnia de los actores",
        conflict.ethnic_conflicts,
        Bars(("etnia",), "apariciones"),
    ),
    Analysis(
        "breaking_news",
        "noticias_ultima_hora",
        "Detección de noticias de última hora (más de 100 menciones en menos de 1 hora)",
        bursts.breaking_news,
        Bars(("pais", "EventCode"), "menciones_primera_hora"),
    ),
    Analysis(
        "negative_actors",
        "actores_mas_asociados_eventos_negativos",
        "Extra: actores más asociados a eventos negativos",
        actors.negative_actors,
        Bars(("nombre_actor",), "apariciones"),
    ),
    Analysis(
        "positive_events_by_country",
        "eventos_positivos_mas_cubiertos_por_pais",
        "Extra: eventos positivos más cubiertos por país",
        coverage.positive_events_by_country,
        Bars(("pais",), "total_menciones_reales"),
    ),
)

#: Analyses with a mergeable state, by name: what they need of a slice.
INCREMENTAL = {
    "conflict_heatmap": conflict.HEATMAP,
    "top_countries_by_day": coverage.TOP_COUNTRIES,
    "tone_source_correlation": tone.TONE_SOURCES,
    "cameo_by_region": actors.CAMEO,
    "actor_type_matrix": actors.ACTOR_TYPES,
    "sentiment_trend": tone.TREND,
    "conflict_country_pairs": conflict.CONFLICT_PAIRS,
    "religion_conflicts": conflict.RELIGIONS,
    "organizations_by_day": knowledge.ORGANIZATIONS,
    "tone_conflict_lag": tone.TONE_LAG,
    "diplomacy_conflict_graph": conflict.GRAPH,
    "source_diversity": coverage.DIVERSITY,
    "ethnic_conflicts": conflict.ETHNICITIES,
    "negative_actors": actors.NEGATIVE,
}

_BY_NAME = {key: a for a in ANALYSES for key in (a.name, a.result)}
# Stored collections that are not results.
_HIDDEN, _HIDDEN_PREFIX = {"startup_log"}, "system."


def find(name: str) -> Analysis | None:
    """The analysis with this name or result name."""
    return _BY_NAME.get(name)


def title_of(result: str) -> str:
    """Title of a stored result; its own name when the catalog does not know it."""
    known = find(result)
    return known.title if known else result


def listed(results: Iterable[str]) -> list[str]:
    """Stored result names to show: known ones in catalog order, then the others by name."""
    stored = {r for r in results if r not in _HIDDEN and not r.startswith(_HIDDEN_PREFIX)}
    known = [a.result for a in ANALYSES if a.result in stored]
    return known + sorted(stored.difference(known))


def run_all(
    feed: Feed, store: Callable[[Analysis, DataFrame], None], analyses: Iterable[Analysis] = ANALYSES
) -> dict[str, Exception]:
    """Build every analysis and hand it to ``store``; one that fails does not stop the others.

    Returns the failures by analysis name.
    """
    failures = {}
    for analysis in analyses:
        try:
            store(analysis, analysis.build(feed))
        except Exception as error:  # noqa: BLE001 - reported to the caller, by name
            logger.exception("analysis %s failed", analysis.name)
            failures[analysis.name] = error
    return failures
