"""The same tables and results as plain SQL for DuckDB, to check the Spark ones against.

Each statement derives the feed tables it needs from the test tables, as CTEs named ``news_*``.
Numbers are rounded through text: half away from zero on the printed digits, as Spark does it.
"""

from newsatlas.testbed import derived

# Fixed values, written out here once more, so that a wrong code in the library shows as a difference.
NO_REGION = "Sin región"
REGION_CODES = {
    "Norteamérica": ["US", "CA", "GL"],
    "Latinoamérica y Caribe": [
        "MX", "CR", "CS", "GT", "HO", "HN", "ES", "SV", "NU", "PM", "PA", "CU", "DR", "HA", "JM", "RQ", "PR",
    ],
    "Sudamérica": ["BR", "AR", "CO", "VE", "PE", "EC", "CI", "CHL", "UY", "BL", "BO", "GY"],
    "Europa": [
        "UK", "GB", "FR", "GM", "DE", "SP", "ES2", "IT", "RS", "RU", "UP", "UA", "PL", "PO", "NL", "BE", "SZ", "SW",
        "NO", "FI",
    ],
    "Asia": [
        "CH", "CN", "JA", "JP", "KS", "KR", "KN", "IN", "PK", "BG", "TH", "VM", "RP", "PH", "ID", "MY", "IR", "IZ",
        "IQ", "IS", "SA", "TU", "AF",
    ],
    "África": ["EG", "NI", "NG", "SF", "ZA", "KE", "ET", "SU", "SD", "MO", "MA", "AG", "DZ", "LY", "TZ"],
    "Oceanía": ["AS", "AU", "NZ", "PP", "FJ"],
}
CATEGORY_CODES = {
    "Gobierno": ["GOV", "LEG", "JUD", "COP", "SPY"],
    "Militar": ["MIL"],
    "Grupo rebelde": ["REB", "INS", "SEP"],
}


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[cast(({index}) % {len(values)} as int) + 1]"


def _r(value: str, digits: int) -> str:
    return f"cast(round(cast(cast({value} as varchar) as decimal(38,18)), {digits}) as double)"


def _actor(n: int, key: str, nation: str, types: tuple[str, str, str]) -> str:
    columns = [
        f"{_pick(derived.NAMES[n], 'k')} AS Actor{n}Name",
        f"{_pick(derived.CODES[n], 'k')} AS Actor{n}Code",
        f"{_pick(derived.NATIONS, nation)} AS Actor{n}CountryCode",
        *[f"{_pick(derived.TYPES, types[t])} AS Actor{n}Type{t + 1}Code" for t in range(3)],
        *[f"{_pick(derived.RELIGIONS[n][r], key)} AS Actor{n}Religion{r + 1}Code" for r in range(2)],
        f"{_pick(derived.ETHNICITIES[n], key)} AS Actor{n}EthnicCode",
    ]
    return ",\n        ".join(columns)


EVENTS = f"""
base_rows AS (
    SELECT event_id AS k, user_id AS u, event_type AS kind, ts, 0 AS again FROM events
    UNION ALL
    SELECT event_id, user_id, event_type, ts + INTERVAL 1 DAY, 1 FROM events WHERE event_id % 50 = 0
),
news_events AS (
    SELECT
        k AS GLOBALEVENTID,
        cast(strftime(ts, '%Y%m%d') AS bigint) AS SQLDATE,
        CASE kind WHEN 'signup' THEN 1 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2
                  WHEN 'click' THEN 3 WHEN 'error' THEN 4 END AS QuadClass,
        {_pick(derived.COUNTRIES, 'u')} AS ActionGeo_CountryCode,
        CASE WHEN k % 13 <> 0 THEN 'Place ' || u END AS ActionGeo_FullName,
        CASE WHEN k % 17 <> 0 THEN (7 * k % 561) / 4.0::double - 70 END AS ActionGeo_Lat,
        CASE WHEN k % 17 <> 0 THEN (13 * k % 1441) / 4.0::double - 180 END AS ActionGeo_Long,
        CASE WHEN k % 29 <> 0 THEN (k % 41) / 4.0::double
             * CASE WHEN kind IN ('click', 'error') THEN -1 ELSE 1 END END AS GoldsteinScale,
        CASE WHEN k % 31 <> 0 THEN (11 * k % 161) / 8.0::double - 10 END AS AvgTone,
        cast(1 + k % 10 AS int) AS NumMentions,
        cast(1 + k % 7 AS int) AS NumSources,
        cast(1 + k % 9 AS int) AS NumArticles,
        lpad(cast(1 + k % 20 AS varchar), 2, '0') AS EventRootCode,
        CASE WHEN k % 37 <> 0 THEN lpad(cast(1 + k % 20 AS varchar), 2, '0') || (k % 4) END AS EventBaseCode,
        lpad(cast(1 + k % 20 AS varchar), 2, '0') || (k % 4) || again AS EventCode,
        CASE WHEN k % 11 <> 0 THEN 'desc ' || (1 + k % 20) END AS CAMEOCodeDescription,
        {_actor(1, "k", "u", ("k", "k % 5", "k % 3 + 4"))},
        {_actor(2, "u", "k % 8 + 3 * (u % 5)", ("u", "u % 7", "u % 2 + 4"))},
        CASE WHEN k % 19 <> 0 THEN 'https://news.example/' || k || '/' || again END AS SOURCEURL
    FROM base_rows
)"""

MENTIONS = """
mention_rows AS (
    SELECT cast(floor(event_id / 20) AS bigint) AS id, event_id AS k, user_id AS u, ts FROM events
    UNION ALL
    SELECT event_id % 50, event_id, user_id, ts FROM events
),
news_mentions AS (
    SELECT
        id AS GLOBALEVENTID,
        CASE WHEN k % 101 = 0 THEN 20249905120000 WHEN k % 103 = 0 THEN NULL
             ELSE cast(strftime(ts, '%Y%m%d%H%M%S') AS bigint) END AS MentionTimeDate,
        CASE WHEN k % 23 = 0 THEN NULL WHEN k % 47 = 0 THEN '' ELSE 'src' || (u % 40) END AS MentionSourceName,
        CASE WHEN k % 31 <> 0 THEN (5 * k % 161) / 8.0::double - 10 END AS MentionDocTone
    FROM mention_rows
)"""


def _coordinate(value: str, j: str) -> str:
    return (
        f"CASE ({j}) % 6 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN 'n/a' "
        f"ELSE cast({value} AS varchar) END"
    )


def _place(j: str, extra: str) -> str:
    lat = _coordinate(f"((7 * ({j}) % 561) / 4.0::double - 70)", j)
    lon = _coordinate(f"((13 * ({j}) % 1441) / 4.0::double - 180)", j)
    return (
        f"'4#Place ' || ({j}) || '#' || {_pick(derived.PLACES, j)} || '#A1#{extra}' "
        f"|| {lat} || '#' || {lon} || '#F' || ({j})"
    )


GKG = f"""
news_gkg AS (
    SELECT
        '20240101-' || doc_id AS GKGRECORDID,
        cast((2023 + doc_id % 2) || '01' || lpad(cast(1 + doc_id % 28 AS varchar), 2, '0') || '120000' AS bigint) AS "DATE",
        CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
            WHEN 2 THEN {_place("doc_id", "A2#")} || ';'
            WHEN 3 THEN {_place("doc_id", "A2#")} || ';' || {_place("doc_id + 7", "A2#")}
            ELSE {_place("doc_id", "A2#")} END AS V2Locations,
        CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN {_place("doc_id + 3", "")} || ';'
            ELSE {_place("doc_id + 3", "")} END AS Locations,
        CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ''
            ELSE 'TAX_' || (doc_id % 9) || ',' || n_chars || ';CRISIS_' || (doc_id % 5) || ',12;' END AS V2Themes,
        CASE WHEN doc_id % 7 <> 0 THEN 'TAX_' || (doc_id % 9) || ';ELECTION;' END AS Themes,
        CASE WHEN doc_id % 8 <> 0 THEN source || ' Agency; ' || upper(source) || ' agency;' || lang || ' Press;' END AS Organizations
    FROM documents
)"""


def _region(country: str, lat: str, lon: str) -> str:
    by_code = "\n            ".join(
        f"WHEN upper(trim({country})) IN ({', '.join(map(repr, codes))}) THEN '{name}'"
        for name, codes in REGION_CODES.items()
    )
    return f"""CASE
            {by_code}
            WHEN {lat} IS NULL OR {lon} IS NULL THEN '{NO_REGION}'
            WHEN {lon} BETWEEN -170 AND -50 AND {lat} >= 32 THEN 'Norteamérica'
            WHEN {lon} BETWEEN -120 AND -30 AND {lat} < 32 THEN 'Latinoamérica y Caribe'
            WHEN {lon} BETWEEN -90 AND -30 AND {lat} < 15 THEN 'Sudamérica'
            WHEN {lon} BETWEEN -25 AND 60 AND {lat} BETWEEN 35 AND 75 THEN 'Europa'
            WHEN {lon} BETWEEN -20 AND 55 AND {lat} BETWEEN -35 AND 38 THEN 'África'
            WHEN {lon} BETWEEN 25 AND 180 AND {lat} BETWEEN -10 AND 80 THEN 'Asia'
            WHEN {lon} BETWEEN 110 AND 180 AND {lat} BETWEEN -50 AND 0 THEN 'Oceanía'
            ELSE '{NO_REGION}' END"""


EVENT_REGION = _region("ActionGeo_CountryCode", "ActionGeo_Lat", "ActionGeo_Long")
DAY = "try_strptime(cast(SQLDATE AS varchar), '%Y%m%d')"
DAY_TEXT = f"strftime({DAY}, '%Y-%m-%d')"
N = "count(DISTINCT GLOBALEVENTID)"


def _corr(x: str, y: str) -> str:
    c = f"corr({x}, {y})"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {_r(c, 4)} END"


def _percent(part: str, whole: str) -> str:
    return f"cast(round(cast(100 * ({part}) AS decimal(38,12)) / ({whole}), 2) AS decimal(18,2))"


def _category(actor: int) -> str:
    types = [f"coalesce(Actor{actor}Type{t}Code, '')" for t in (1, 2, 3)]
    whens = " ".join(
        "WHEN " + " OR ".join(f"{t} IN ({', '.join(map(repr, codes))})" for t in types)
        + f" THEN '{name}'"
        for name, codes in CATEGORY_CODES.items()
    )
    return f"CASE {whens} END"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CONFLICT_HEATMAP = f"""SELECT {DAY_TEXT} AS fecha, ActionGeo_CountryCode AS pais,
    {_region("ActionGeo_CountryCode", "avg(ActionGeo_Lat)", "avg(ActionGeo_Long)")} AS region,
    {_r("avg(ActionGeo_Lat)", 4)} AS latitud, {_r("avg(ActionGeo_Long)", 4)} AS longitud,
    {N} AS total_eventos_conflicto,
    {_r("avg(abs(GoldsteinScale))", 2)} AS intensidad_promedio_goldstein,
    {_r("sum(abs(GoldsteinScale))", 2)} AS intensidad_total_goldstein
FROM news_events
WHERE ActionGeo_CountryCode IS NOT NULL AND SQLDATE IS NOT NULL AND GoldsteinScale IS NOT NULL
  AND QuadClass IN (3, 4)
GROUP BY fecha, pais"""

PAIRS = """pairs AS (
    SELECT *, least(Actor1CountryCode, Actor2CountryCode) AS pais_a,
           greatest(Actor1CountryCode, Actor2CountryCode) AS pais_b
    FROM news_events
    WHERE trim(Actor1CountryCode) <> '' AND trim(Actor2CountryCode) <> ''
      AND Actor1CountryCode <> Actor2CountryCode
)"""

COVERAGE = f"""coverage AS (
    SELECT GLOBALEVENTID, count(*) AS mentions, count(DISTINCT MentionSourceName) AS sources,
           {_r("avg(MentionDocTone)", 2)} AS tone
    FROM news_mentions WHERE GLOBALEVENTID IS NOT NULL GROUP BY GLOBALEVENTID
)"""

NEWEST = """newest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY GLOBALEVENTID ORDER BY SQLDATE DESC NULLS LAST,
            EventCode DESC NULLS LAST, SOURCEURL DESC NULLS LAST) AS rn
        FROM news_events WHERE GLOBALEVENTID IS NOT NULL
    ) WHERE rn = 1
)"""

TONED_DAYS = """SQLDATE IS NOT NULL AND ActionGeo_CountryCode IS NOT NULL AND AvgTone IS NOT NULL"""

# Daily averages have two decimals: their moving average is taken of whole hundredths, and rounded half away from zero.
_CENTS = "cast(sum(cast(round(tono_promedio_dia * 100) AS bigint)) OVER (w ROWS 6 PRECEDING) AS bigint)"
_DAYS = "count(*) OVER (w ROWS 6 PRECEDING)"
_SMOOTH = f"cast(sign({_CENTS}) * ((2 * abs({_CENTS}) + {_DAYS}) // (2 * {_DAYS})) AS double) / 100"

FIRST_HOUR = """valid AS (
    SELECT *, min(ts) OVER (PARTITION BY GLOBALEVENTID) AS first FROM (
        SELECT GLOBALEVENTID, MentionSourceName,
               try_strptime(substr(lpad(cast(MentionTimeDate AS varchar), 14, '0'), 1, 14), '%Y%m%d%H%M%S') AS ts
        FROM news_mentions WHERE GLOBALEVENTID IS NOT NULL)
    WHERE ts IS NOT NULL
),
first_hour AS (
    SELECT GLOBALEVENTID, first, count(*) AS n, count(DISTINCT coalesce(MentionSourceName, 'SIN_FUENTE')) AS s
    FROM valid WHERE ts - first < INTERVAL 1 HOUR GROUP BY GLOBALEVENTID, first
)"""


def _number(position: str) -> str:
    text = f"trim(split(place, '#')[{position}])"
    return f"CASE WHEN regexp_full_match({text}, '-?[0-9]+(\\.[0-9]+)?') THEN try_cast({text} AS double) END"


# Each record's places and themes are unnested from its one row.
THEMES = f"""placed AS (
    SELECT GKGRECORDID, try_cast(substr(cast("DATE" AS varchar), 1, 4) AS int) AS anio, coalesce(V2Themes, Themes) AS listed,
           unnest(split(if(V2Locations <> '', V2Locations, Locations), ';')) AS place, if(V2Locations <> '', 6, 5) AS lat_at
    FROM news_gkg WHERE V2Locations <> '' OR Locations <> ''
),
tagged AS (
    SELECT GKGRECORDID, anio, split(place, '#')[3] AS pais, {_number("lat_at")} AS lat, {_number("lat_at + 1")} AS lon,
           regexp_extract(trim(unnest(split(listed, ';'))), '^([^,]+)', 1) AS tema
    FROM placed
),
counts AS (
    SELECT {_region("pais", "lat", "lon")} AS continente, anio, tema, count(DISTINCT GKGRECORDID) AS total_documentos
    FROM tagged WHERE tema <> '' GROUP BY ALL
)"""

ORGANISATIONS = """counts AS (
    SELECT strftime(try_strptime(substr(cast("DATE" AS varchar), 1, 8), '%Y%m%d'), '%Y-%m-%d') AS fecha,
           lower(trim(o)) AS organizacion, count(DISTINCT GKGRECORDID) AS total_documentos
    FROM (SELECT *, unnest(split(Organizations, ';')) AS o FROM news_gkg)
    WHERE trim(o) <> '' GROUP BY ALL
)"""

SQL = {
    "conflict_heatmap": f"{_with(EVENTS)} {CONFLICT_HEATMAP}",
    "top_countries_by_day": f"""{_with(EVENTS)}, daily AS (
        SELECT {DAY_TEXT} AS fecha, ActionGeo_CountryCode AS pais, {N} AS total_eventos,
               cast(sum(NumMentions) AS bigint) AS total_menciones,
               cast(sum(NumArticles) AS bigint) AS total_articulos
        FROM news_events WHERE ActionGeo_CountryCode IS NOT NULL AND SQLDATE IS NOT NULL
        GROUP BY ALL)
        SELECT *, cast(row_number() OVER (PARTITION BY fecha ORDER BY total_eventos DESC, pais) AS int) AS ranking
        FROM daily QUALIFY ranking <= 10""",
    "tone_source_correlation": f"""{_with(EVENTS)} SELECT count(*) AS eventos_analizados,
        {_corr("AvgTone", "NumSources")} AS "correlacion_avgTone_numSources",
        {_r("avg(AvgTone)", 2)} AS promedio_tono, {_r("avg(NumSources)", 2)} AS promedio_fuentes
        FROM news_events WHERE AvgTone IS NOT NULL AND NumSources IS NOT NULL""",
    "cameo_by_region": f"""{_with(EVENTS)}, counts AS (
        SELECT {EVENT_REGION} AS region, coalesce(EventRootCode, 'SIN_ROOT_CODE') AS EventRootCode,
               coalesce(EventBaseCode, 'SIN_BASE_CODE') AS EventBaseCode, EventCode,
               coalesce(CAMEOCodeDescription, 'Sin descripción') AS descripcion_cameo,
               count(DISTINCT GLOBALEVENTID) AS total_eventos
        FROM news_events e WHERE EventCode IS NOT NULL AND ActionGeo_CountryCode IS NOT NULL
        GROUP BY ALL)
        SELECT region, EventRootCode, EventBaseCode, EventCode, descripcion_cameo,
               cast(total_eventos AS varchar) AS total_eventos,
               cast({_percent("total_eventos", "sum(total_eventos) OVER (PARTITION BY region)")} AS varchar) AS porcentaje_region
        FROM counts""",
    "actor_type_matrix": f"""{_with(EVENTS)}, rows_of AS (
        SELECT *, {_category(1)} AS actor1_categoria, {_category(2)} AS actor2_categoria FROM news_events)
        SELECT actor1_categoria, actor2_categoria, {N} AS frecuencia,
               count(*) FILTER (QuadClass IN (3, 4)) AS eventos_conflicto,
               {_r("avg(GoldsteinScale)", 2)} AS goldstein_promedio
        FROM rows_of WHERE actor1_categoria IS NOT NULL AND actor2_categoria IS NOT NULL
        GROUP BY actor1_categoria, actor2_categoria""",
    "media_coverage_by_country": f"""{_with(EVENTS, MENTIONS, COVERAGE)}, located AS (
        SELECT DISTINCT GLOBALEVENTID, ActionGeo_CountryCode AS pais FROM news_events
        WHERE GLOBALEVENTID IS NOT NULL AND ActionGeo_CountryCode IS NOT NULL)
        SELECT pais, count(DISTINCT l.GLOBALEVENTID) AS total_eventos,
               cast(sum(coalesce(mentions, 0)) AS bigint) AS total_menciones,
               cast(sum(coalesce(sources, 0)) AS bigint) AS total_fuentes_distintas_evento,
               {_r("sum(coalesce(mentions, 0)) / count(DISTINCT l.GLOBALEVENTID)", 2)} AS razon_menciones_por_evento
        FROM located l LEFT JOIN coverage c ON l.GLOBALEVENTID = c.GLOBALEVENTID
        GROUP BY pais HAVING count(DISTINCT l.GLOBALEVENTID) >= 5""",
    "sentiment_trend": f"""{_with(EVENTS)}, daily AS (
        SELECT {DAY_TEXT} AS fecha, ActionGeo_CountryCode AS pais, {N} AS total_eventos,
               {_r("avg(AvgTone)", 2)} AS tono_promedio_dia
        FROM news_events WHERE {TONED_DAYS} GROUP BY ALL)
        SELECT *, {_SMOOTH} AS promedio_movil_7_dias
        FROM daily WINDOW w AS (PARTITION BY pais ORDER BY fecha)""",
    "conflict_country_pairs": f"""{_with(EVENTS, PAIRS)} SELECT pais_a, pais_b, {N} AS total_conflictos,
        {_r("avg(GoldsteinScale)", 2)} AS goldstein_promedio, {_r("avg(AvgTone)", 2)} AS tono_promedio
        FROM pairs WHERE QuadClass IN (3, 4) GROUP BY pais_a, pais_b
        ORDER BY total_conflictos DESC, pais_a, pais_b LIMIT 50""",
    "mention_escalation_24h": f"""{_with(EVENTS, MENTIONS, NEWEST)}, hourly AS (
        SELECT GLOBALEVENTID, hora, count(*) AS menciones_hora FROM (
            SELECT GLOBALEVENTID, date_trunc('hour', try_strptime(
                lpad(cast(MentionTimeDate AS varchar), 14, '0'), '%Y%m%d%H%M%S')) AS hora
            FROM news_mentions WHERE GLOBALEVENTID IS NOT NULL AND MentionTimeDate IS NOT NULL)
        WHERE hora IS NOT NULL GROUP BY ALL),
        rolling AS (SELECT h.GLOBALEVENTID, h.hora, h.menciones_hora,
                cast(sum(p.menciones_hora) AS bigint) AS menciones_ultimas_24h
            FROM hourly h JOIN hourly p ON p.GLOBALEVENTID = h.GLOBALEVENTID
                AND p.hora BETWEEN h.hora - INTERVAL 24 HOUR AND h.hora GROUP BY ALL),
        speeds AS (SELECT *, coalesce(lag(menciones_ultimas_24h) OVER (
            PARTITION BY GLOBALEVENTID ORDER BY hora), 0) AS menciones_24h_previas FROM rolling)
        SELECT s.GLOBALEVENTID, {DAY_TEXT} AS fecha_evento, ActionGeo_CountryCode AS pais, EventCode,
               CAMEOCodeDescription, strftime(hora, '%Y-%m-%d %H:%M:%S') AS hora, menciones_hora,
               menciones_ultimas_24h, menciones_24h_previas,
               menciones_ultimas_24h - menciones_24h_previas AS aceleracion_menciones, SOURCEURL
        FROM speeds s LEFT JOIN newest e ON s.GLOBALEVENTID = e.GLOBALEVENTID
        WHERE menciones_ultimas_24h >= 1 AND menciones_ultimas_24h - menciones_24h_previas > 0
        ORDER BY aceleracion_menciones DESC, s.GLOBALEVENTID, s.hora LIMIT 50""",
    "religion_conflicts": f"""{_with(EVENTS)} SELECT {EVENT_REGION} AS region,
        coalesce(Actor1Religion1Code, Actor1Religion2Code, 'SIN_RELIGION') AS religion_actor1,
        coalesce(Actor2Religion1Code, Actor2Religion2Code, 'SIN_RELIGION') AS religion_actor2,
        {N} AS total_conflictos, {_r("avg(GoldsteinScale)", 2)} AS goldstein_promedio,
        {_r("avg(AvgTone)", 2)} AS tono_promedio
        FROM news_events WHERE QuadClass IN (3, 4) AND coalesce(Actor1Religion1Code,
            Actor1Religion2Code, Actor2Religion1Code, Actor2Religion2Code) IS NOT NULL
        GROUP BY ALL""",
    "themes_by_region_year": f"""{_with(GKG, THEMES)} SELECT *, cast(row_number() OVER (
        PARTITION BY continente, anio ORDER BY total_documentos DESC, tema) AS int) AS ranking
        FROM counts QUALIFY ranking <= 20""",
    "organizations_by_day": f"""{_with(GKG, ORGANISATIONS)} SELECT *, cast(row_number() OVER (
        PARTITION BY fecha ORDER BY total_documentos DESC, organizacion) AS int) AS ranking
        FROM counts QUALIFY ranking <= 20""",
    "tone_conflict_lag": f"""{_with(EVENTS)}, daily AS (
        SELECT {DAY_TEXT} AS fecha, ActionGeo_CountryCode AS pais, {_r("avg(AvgTone)", 4)} AS tone,
               count(*) FILTER (QuadClass IN (3, 4)) AS conflicts
        FROM news_events WHERE {TONED_DAYS} GROUP BY ALL),
        shifted AS (SELECT *, lead(conflicts) OVER (PARTITION BY pais ORDER BY fecha) AS tomorrow FROM daily)
        SELECT pais, count(*) AS dias_analizados,
               {_corr("tone", "tomorrow")} AS correlacion_tono_hoy_conflicto_manana,
               {_r("avg(tone)", 2)} AS tono_promedio, {_r("avg(tomorrow)", 2)} AS conflictos_promedio_manana
        FROM shifted WHERE tomorrow IS NOT NULL GROUP BY pais""",
    "diplomacy_conflict_graph": f"""{_with(EVENTS, PAIRS)} SELECT pais_a, pais_b,
        count(*) FILTER (QuadClass IN (1, 2)) AS interacciones_diplomaticas,
        count(*) FILTER (QuadClass IN (3, 4)) AS interacciones_conflicto,
        {N} AS total_interacciones,
        {_r(f"count(*) FILTER (QuadClass IN (3, 4)) / {N}", 4)} AS proporcion_conflicto
        FROM pairs GROUP BY pais_a, pais_b HAVING {N} > 0
        ORDER BY total_interacciones DESC, pais_a, pais_b LIMIT 100""",
    "source_diversity": f"""{_with(EVENTS, MENTIONS)}, heard AS (
        SELECT DISTINCT pais, medio, count(*) OVER (PARTITION BY pais) AS total,
               count(*) OVER (PARTITION BY pais, medio) / count(*) OVER (PARTITION BY pais) AS share
        FROM (SELECT ActionGeo_CountryCode AS pais, MentionSourceName AS medio
              FROM news_events JOIN news_mentions USING (GLOBALEVENTID)
              WHERE ActionGeo_CountryCode IS NOT NULL AND trim(MentionSourceName) <> ''))
        SELECT pais, count(*) AS medios_distintos, max(total) AS total_menciones,
               {_r("-sum(share * ln(share))", 4)} AS indice_shannon_fuentes
        FROM heard GROUP BY pais""",
    "ethnic_conflicts": f"""{_with(EVENTS)}, actors AS (
        SELECT Actor1EthnicCode AS etnia, * FROM news_events UNION ALL
        SELECT Actor2EthnicCode AS etnia, * FROM news_events)
        SELECT etnia, count(*) AS apariciones, {N} AS eventos_distintos,
               {_r("avg(GoldsteinScale)", 2)} AS goldstein_promedio, {_r("avg(AvgTone)", 2)} AS tono_promedio
        FROM actors WHERE QuadClass IN (3, 4) AND etnia IS NOT NULL GROUP BY etnia""",
    "breaking_news": f"""{_with(EVENTS, MENTIONS, NEWEST, FIRST_HOUR)}
        SELECT h.GLOBALEVENTID, strftime(first, '%Y-%m-%d %H:%M:%S') AS primera_mencion,
               {DAY_TEXT} AS fecha_evento, ActionGeo_CountryCode AS pais, EventCode, CAMEOCodeDescription,
               n AS menciones_primera_hora, s AS fuentes_primera_hora, SOURCEURL
        FROM first_hour h LEFT JOIN newest e ON h.GLOBALEVENTID = e.GLOBALEVENTID
        WHERE n >= 1 ORDER BY n DESC, h.GLOBALEVENTID LIMIT 50""",
    "negative_actors": f"""{_with(EVENTS)}, actors AS (
        SELECT 'Actor1' AS rol_actor, Actor1Name AS name, Actor1Code AS code, Actor1CountryCode AS nation,
               Actor1Type1Code AS type, * FROM news_events UNION ALL
        SELECT 'Actor2', Actor2Name, Actor2Code, Actor2CountryCode, Actor2Type1Code, * FROM news_events),
        groups AS (SELECT name AS nombre_actor, coalesce(code, 'SIN_CODIGO') AS codigo_actor,
            coalesce(nation, 'SIN_PAIS') AS pais_actor, coalesce(type, 'SIN_TIPO') AS tipo_actor, rol_actor,
            count(*) AS apariciones, {N} AS eventos_distintos,
            cast({_r("avg(AvgTone)", 2)} AS varchar) AS tono_promedio,
            cast({_r("avg(GoldsteinScale)", 2)} AS varchar) AS goldstein_promedio,
            count(*) FILTER (QuadClass IN (3, 4)) AS eventos_conflicto
        FROM actors WHERE trim(name) <> '' AND (AvgTone < 0 OR GoldsteinScale < 0 OR QuadClass IN (3, 4))
        GROUP BY name, codigo_actor, pais_actor, tipo_actor, rol_actor
        ORDER BY apariciones DESC, eventos_distintos DESC, nombre_actor, codigo_actor, pais_actor, tipo_actor, rol_actor
        LIMIT 100)
        SELECT nombre_actor, codigo_actor, pais_actor, tipo_actor, rol_actor,
            cast(apariciones AS varchar) AS apariciones, cast(eventos_distintos AS varchar) AS eventos_distintos,
            tono_promedio, goldstein_promedio, cast(eventos_conflicto AS varchar) AS eventos_conflicto,
            cast({_percent("eventos_conflicto", "apariciones")} AS varchar) AS porcentaje_conflicto
        FROM groups""",
    "positive_events_by_country": f"""{_with(EVENTS, MENTIONS, COVERAGE)}, joined AS (
        SELECT e.*, {DAY} AS day, coalesce(mentions, 0) AS m, coalesce(sources, 0) AS s, coalesce(tone, 0) AS t
        FROM news_events e LEFT JOIN coverage c ON e.GLOBALEVENTID = c.GLOBALEVENTID
        WHERE ActionGeo_CountryCode IS NOT NULL AND e.GLOBALEVENTID IS NOT NULL AND GoldsteinScale > 0
          AND QuadClass IN (1, 2)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY ActionGeo_CountryCode ORDER BY m DESC, s DESC,
            NumMentions DESC, GoldsteinScale DESC, GLOBALEVENTID, day DESC NULLS LAST,
            EventCode NULLS FIRST, SOURCEURL NULLS FIRST) AS rk FROM joined QUALIFY rk <= 10)
        SELECT cast(rk AS varchar) AS ranking_pais, cast(GLOBALEVENTID AS varchar) AS global_event_id,
            strftime(day, '%Y-%m-%d') AS fecha_evento, ActionGeo_CountryCode AS pais,
            coalesce(ActionGeo_FullName, 'SIN_UBICACION') AS ubicacion, EventCode AS event_code,
            EventBaseCode AS event_base_code, EventRootCode AS event_root_code,
            coalesce(CAMEOCodeDescription, 'SIN_DESCRIPCION') AS descripcion_cameo,
            cast({_r("AvgTone", 2)} AS varchar) AS tono_evento,
            cast({_r("GoldsteinScale", 2)} AS varchar) AS goldstein,
            cast(NumMentions AS varchar) AS num_mentions_event, cast(NumSources AS varchar) AS num_sources_event,
            cast(NumArticles AS varchar) AS num_articles_event, cast(m AS varchar) AS total_menciones_reales,
            cast(s AS varchar) AS fuentes_distintas_reales, cast(cast(t AS double) AS varchar) AS tono_promedio_documentos,
            coalesce(SOURCEURL, 'SIN_URL') AS source_url
        FROM ranked""",
}
