"""Registered queries and the SQL each one is compared with.

Next to the nineteen analyses there is a query for every column builder and operator, run over the
whole derived tables, so that each is checked for itself.
"""

import contextlib
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsatlas import functions as fn
from newsatlas import operators as op
from newsatlas import schemas, sources, streaming
from newsatlas.feed import Feed
from newsatlas.plans import ANALYSES, INCREMENTAL, Analysis, find
from newsatlas.plans.common import COUNTRY, EVENT
from newsatlas.sources.landing import exists, with_day
from newsatlas.testbed import oracle
from newsatlas.testbed.derived import derived_feed, news_events, news_mentions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _register(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = sql


def _on_feed(sql: str | None):
    """Register a function of the feed under its own name."""

    def decorate(build: Callable[[Feed], DataFrame]):
        query = lambda spark, sf_dir: build(derived_feed(spark, sf_dir))
        _register(build.__name__, query, sql)
        return build

    return decorate


def _analysis(analysis: Analysis) -> Query:
    return lambda spark, sf_dir: analysis.build(derived_feed(spark, sf_dir))


for _a in ANALYSES:
    _register(_a.name, _analysis(_a), oracle.SQL[_a.name])


def _result(feed: Feed, name: str) -> DataFrame:
    return find(name).build(feed)


def _events(body: str) -> str:
    return f"{oracle._with(oracle.EVENTS)} {body}"


def _mentions(body: str) -> str:
    return f"{oracle._with(oracle.MENTIONS)} {body}"


def _gkg(body: str) -> str:
    return f"{oracle._with(oracle.GKG)} {body}"


# --- column builders -------------------------------------------------------------------------


@_on_feed(_events(f"""SELECT GLOBALEVENTID, {oracle.DAY_TEXT} AS day,
    cast(substr(cast(SQLDATE AS varchar), 1, 4) AS int) AS year FROM news_events"""))
def packed_dates(feed: Feed) -> DataFrame:
    return feed.events.select(
        EVENT,
        fn.day_text(fn.feed_date("SQLDATE")).alias("day"),
        fn.feed_year(F.col("SQLDATE")).alias("year"),
    )


_TS = "try_strptime(lpad(cast({} AS varchar), 14, '0'), '%Y%m%d%H%M%S')"
_TEXT_FORMAT = "'%Y-%m-%d %H:%M:%S'"


@_on_feed(_mentions(f"""SELECT GLOBALEVENTID,
    strftime(t, {_TEXT_FORMAT}) AS moment, cast(NULL AS varchar) AS too_long,
    strftime(t, {_TEXT_FORMAT}) AS prefix, strftime(date_trunc('hour', t), {_TEXT_FORMAT}) AS hour,
    cast(epoch(date_trunc('hour', t)) AS bigint) AS hour_seconds,
    strftime(t + INTERVAL 1 HOUR, {_TEXT_FORMAT}) AS an_hour_later
    FROM (SELECT *, {_TS.format("MentionTimeDate")} AS t FROM news_mentions)"""))
def packed_timestamps(feed: Feed) -> DataFrame:
    moment = fn.feed_timestamp("MentionTimeDate")
    return feed.mentions.select(
        EVENT,
        fn.mention_time_text(moment).alias("moment"),
        fn.mention_time_text(fn.feed_timestamp("MentionTimeDate * 10")).alias("too_long"),
        fn.mention_time_text(fn.feed_timestamp_prefix("(MentionTimeDate * 10 + 7)")).alias("prefix"),
        fn.mention_time_text(F.date_trunc("hour", moment)).alias("hour"),
        F.unix_timestamp(F.date_trunc("hour", moment)).alias("hour_seconds"),
        fn.mention_time_text(moment + F.expr("INTERVAL 1 HOUR")).alias("an_hour_later"),
    )


@_on_feed(_mentions(f"""SELECT strftime(time_bucket(INTERVAL 15 MINUTE, t - INTERVAL 6 HOUR,
        TIMESTAMP '2000-01-01 00:00:00'), {_TEXT_FORMAT}) AS slice, count(*) AS n
    FROM (SELECT {_TS.format("MentionTimeDate")} AS t FROM news_mentions) WHERE t IS NOT NULL GROUP BY slice"""))
def feed_slices(feed: Feed) -> DataFrame:
    start = fn.slice_start(fn.feed_timestamp("MentionTimeDate"))
    slices = feed.mentions.select(fn.mention_time_text(start).alias("slice"))
    return slices.filter(F.col("slice").isNotNull()).groupBy("slice").agg(F.count("*").alias("n"))


@_on_feed(_events(f"SELECT GLOBALEVENTID, EventCode, {oracle.EVENT_REGION} AS region FROM news_events"))
def world_regions(feed: Feed) -> DataFrame:
    region = fn.region_of(COUNTRY, "ActionGeo_Lat", "ActionGeo_Long")
    return feed.events.select(EVENT, "EventCode", region.alias("region"))


@_on_feed(_events(f"""SELECT ActionGeo_CountryCode AS country,
    {oracle._region("ActionGeo_CountryCode", "avg(ActionGeo_Lat)", "avg(ActionGeo_Long)")} AS region
    FROM news_events GROUP BY country"""))
def world_regions_in_sql(feed: Feed) -> DataFrame:
    spark = feed.events.sparkSession
    fn.register_region_function(spark)
    return spark.sql(
        """SELECT ActionGeo_CountryCode AS country, region_from_geo(ActionGeo_CountryCode,
           avg(ActionGeo_Lat), avg(ActionGeo_Long)) AS region FROM {events} GROUP BY ALL""",
        events=feed.events,
    )


def _v2_number(position: int) -> str:
    text = f"trim(split(loc, '#')[{position}])"
    return (
        f"CASE WHEN regexp_full_match({text}, '-?[0-9]+(\\.[0-9]+)?') "
        f"THEN try_cast({text} AS double) END"
    )


@_on_feed(_gkg(f"""SELECT GKGRECORDID, split(loc, '#')[3] AS country, {_v2_number(6)} AS lat,
    {_v2_number(7)} AS lon, try_cast(split(loc, '#')[6] AS double) AS loose_lat,
    split(loc, '#')[20] AS missing
    FROM (SELECT GKGRECORDID, unnest(split(V2Locations, ';')) AS loc FROM news_gkg)"""))
def delimited_places(feed: Feed) -> DataFrame:
    places = op.explode_delimited(feed.gkg, F.col("V2Locations"), "place", ["GKGRECORDID"])
    place = F.col("place")
    return places.select(
        "GKGRECORDID",
        fn.field(place, 3).alias("country"),
        fn.number_text(fn.field(place, 6)).alias("lat"),
        fn.number_text(fn.field(place, 7)).alias("lon"),
        fn.safe_float(fn.field(place, 6)).alias("loose_lat"),
        fn.field(place, 20).alias("missing"),
    )


@_on_feed(_gkg("""SELECT GKGRECORDID, regexp_extract(trim(t), '^([^,]+)', 1) AS theme,
    try_cast(split(t, ',')[2] AS double) AS number, try_cast(split(t, ',')[1] AS double) AS no_number
    FROM (SELECT GKGRECORDID, unnest(split(V2Themes, ';')) AS t FROM news_gkg) WHERE trim(t) <> ''"""))
def delimited_themes(feed: Feed) -> DataFrame:
    items = op.explode_delimited(feed.gkg, F.col("V2Themes"), "item", ["GKGRECORDID"])
    item = F.col("item")
    return items.filter(fn.not_blank(item)).select(
        "GKGRECORDID",
        fn.leading_item(item).alias("theme"),
        fn.strict_number(fn.field(item, 2, ",")).alias("number"),
        fn.strict_number(fn.field(item, 1, ",")).alias("no_number"),
    )


@_on_feed(_events(f"""SELECT GLOBALEVENTID, EventCode, {oracle._category(1)} AS one,
    {oracle._category(2)} AS other FROM news_events"""))
def actor_categories(feed: Feed) -> DataFrame:
    def category(n: int):
        return fn.actor_category(*[f"Actor{n}Type{t}Code" for t in (1, 2, 3)])

    return feed.events.select(EVENT, "EventCode", category(1).alias("one"), category(2).alias("other"))


@_on_feed(_events(f"""SELECT ActionGeo_CountryCode AS country, count(*) AS n,
    {oracle._corr("AvgTone", "GoldsteinScale")} AS r,
    {oracle._corr("AvgTone", "1.0::double")} AS constant,
    count(*) FILTER (QuadClass IN (3, 4)) AS conflicts,
    {oracle._percent("count(*) FILTER (QuadClass IN (3, 4))", "count(*)")} AS conflict_percent,
    {oracle._r("sum(NumMentions) / sum(NumSources)", 4)} AS mentions_per_source
    FROM news_events GROUP BY country"""))
def safe_aggregates(feed: Feed) -> DataFrame:
    conflicts = fn.count_where(F.col("QuadClass").isin(3, 4))
    return feed.events.groupBy(F.col(COUNTRY).alias("country")).agg(
        F.count("*").alias("n"),
        F.round(fn.pearson(F.col("AvgTone"), F.col("GoldsteinScale")), 4).alias("r"),
        F.round(fn.pearson(F.col("AvgTone"), F.lit(1.0)), 4).alias("constant"),
        conflicts.alias("conflicts"),
        fn.percent_of(conflicts, F.count("*")).cast("decimal(18,2)").alias("conflict_percent"),
        fn.ratio(F.sum("NumMentions"), F.sum("NumSources"), 4).alias("mentions_per_source"),
    )


@_on_feed(_events(f"""SELECT country, {oracle._r("-sum(n / total * ln(n / total))", 4)} AS entropy FROM (
    SELECT country, n, sum(n) OVER (PARTITION BY country) AS total FROM (
        SELECT ActionGeo_CountryCode AS country, EventRootCode, count(*) AS n FROM news_events
        GROUP BY ALL)) GROUP BY country"""))
def event_entropy(feed: Feed) -> DataFrame:
    counts = feed.events.groupBy(F.col(COUNTRY).alias("country"), "EventRootCode").agg(
        F.count("*").alias("n")
    )
    return counts.groupBy("country").agg(F.round(fn.entropy(F.col("n")), 4).alias("entropy"))


# --- operators -------------------------------------------------------------------------------


@_on_feed(f"""{oracle._with(oracle.EVENTS, oracle.PAIRS)}
    SELECT pais_a AS low, pais_b AS high, count(*) AS n FROM pairs GROUP BY ALL""")
def unordered_pairs(feed: Feed) -> DataFrame:
    pairs = op.unordered_pairs(
        feed.events, "Actor1CountryCode", "Actor2CountryCode", "low", "high"
    )
    return pairs.groupBy("low", "high").agg(F.count("*").alias("n"))


@_on_feed(_events("""SELECT GLOBALEVENTID, EventCode, 'first' AS role, Actor1Name AS name FROM news_events
    UNION ALL SELECT GLOBALEVENTID, EventCode, 'second', Actor2Name FROM news_events"""))
def unpivoted_roles(feed: Feed) -> DataFrame:
    roles = {"first": {"name": "Actor1Name"}, "second": {"name": "Actor2Name"}}
    return op.unpivot_roles(feed.events, roles, "role", [EVENT, "EventCode"])


@_on_feed(_events("""SELECT ActionGeo_CountryCode AS country, GLOBALEVENTID, EventCode,
    cast(row_number() OVER (PARTITION BY ActionGeo_CountryCode ORDER BY NumArticles DESC,
        GLOBALEVENTID, EventCode) AS int) AS place FROM news_events QUALIFY place <= 3"""))
def top_per_group(feed: Feed) -> DataFrame:
    rows = feed.events.select(F.col(COUNTRY).alias("country"), EVENT, "EventCode", "NumArticles")
    order = [F.desc("NumArticles"), F.col(EVENT), F.col("EventCode")]
    return op.top_n_per_group(rows, ["country"], order, 3, "place").drop("NumArticles")


@_on_feed(_events("""SELECT GLOBALEVENTID, SQLDATE, EventCode FROM news_events
    ORDER BY SQLDATE DESC, GLOBALEVENTID DESC LIMIT 25"""))
def top_overall(feed: Feed) -> DataFrame:
    rows = feed.events.select(EVENT, "SQLDATE", "EventCode")
    return op.top_n(rows, [F.desc("SQLDATE"), F.desc(EVENT)], 25)


@_on_feed(_events("""SELECT GLOBALEVENTID, max(SQLDATE) AS SQLDATE, max_by(EventCode, SQLDATE) AS EventCode
    FROM news_events GROUP BY GLOBALEVENTID"""))
def latest_per_key(feed: Feed) -> DataFrame:
    return op.latest_per_key(feed.events, EVENT, ["SQLDATE"], ["SQLDATE", "EventCode"])


_HOURLY = f"""hourly AS (SELECT GLOBALEVENTID, cast(epoch(date_trunc('hour', t)) AS bigint) AS second,
    count(*) AS n FROM (SELECT *, {_TS.format("MentionTimeDate")} AS t FROM news_mentions)
    WHERE t IS NOT NULL GROUP BY ALL)"""


@_on_feed(f"""{oracle._with(oracle.MENTIONS, _HOURLY)},
    rolled AS (SELECT *, cast(sum(n) OVER (PARTITION BY GLOBALEVENTID ORDER BY second
        RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS bigint) AS last_day FROM hourly)
    SELECT *, lag(last_day) OVER (PARTITION BY GLOBALEVENTID ORDER BY second) AS before FROM rolled""")
def rolling_day(feed: Feed) -> DataFrame:
    moment = F.date_trunc("hour", fn.feed_timestamp("MentionTimeDate"))
    hourly = (
        feed.mentions.select(EVENT, F.unix_timestamp(moment).alias("second"))
        .filter(F.col("second").isNotNull())
        .groupBy(EVENT, "second")
        .agg(F.count("*").alias("n"))
    )
    rolled = hourly.withColumn("last_day", op.rolling_sum(F.col("n"), [EVENT], "second", 86_400))
    return rolled.withColumn("before", op.previous(F.col("last_day"), [EVENT], "second"))


@_on_feed(_events(f"""SELECT country, day, n, {oracle._r("avg(n) OVER (w ROWS 2 PRECEDING)", 4)} AS smooth,
    lead(n) OVER w AS after FROM (
        SELECT ActionGeo_CountryCode AS country, {oracle.DAY_TEXT} AS day, count(*) AS n
        FROM news_events GROUP BY ALL) WINDOW w AS (PARTITION BY country ORDER BY day)"""))
def smoothed_days(feed: Feed) -> DataFrame:
    daily = feed.events.groupBy(
        F.col(COUNTRY).alias("country"), fn.day_text(fn.feed_date("SQLDATE")).alias("day")
    ).agg(F.count("*").alias("n"))
    return daily.select(
        "*",
        F.round(op.moving_average(F.col("n"), ["country"], "day", 3), 4).alias("smooth"),
        op.following(F.col("n"), ["country"], "day").alias("after"),
    )


@_on_feed(_mentions("""SELECT m.GLOBALEVENTID, m.MentionTimeDate, m.MentionSourceName, t.n
    FROM news_mentions m JOIN (SELECT GLOBALEVENTID, count(*) AS n FROM news_mentions
    GROUP BY GLOBALEVENTID) t ON m.GLOBALEVENTID = t.GLOBALEVENTID"""))
def spread_join(feed: Feed) -> DataFrame:
    """Fifty event ids are heavy here: their mentions are divided by a salt."""
    rows = feed.mentions.select(EVENT, "MentionTimeDate", "MentionSourceName")
    counts = rows.groupBy(EVENT).agg(F.count("*").alias("n"))
    lookup = counts.withColumn("rows", F.col("n"))
    spread_by = ["MentionTimeDate", "MentionSourceName"]
    return op.spread_join(rows, lookup, EVENT, "rows", spread_by, rows_per_task=50)


@_on_feed(f"""{oracle._with(oracle.EVENTS, oracle.MENTIONS, oracle.NEWEST)},
    few AS (SELECT GLOBALEVENTID, count(*) AS n FROM news_mentions GROUP BY GLOBALEVENTID
            ORDER BY n DESC, GLOBALEVENTID LIMIT 40)
    SELECT few.GLOBALEVENTID, n, SQLDATE, EventCode FROM few LEFT JOIN newest
    ON few.GLOBALEVENTID = newest.GLOBALEVENTID""")
def lookup_few(feed: Feed) -> DataFrame:
    counts = feed.mentions.groupBy(EVENT).agg(F.count("*").alias("n"))
    few = op.top_n(counts, [F.desc("n"), F.col(EVENT)], 40)
    return op.lookup_few(few, feed.events, EVENT, ["SQLDATE", "EventCode"], ["SQLDATE", "EventCode"])


@_on_feed(_events("""SELECT cast(QuadClass AS varchar) AS QuadClass,
    cast(count(*) AS varchar) AS n FROM news_events GROUP BY ALL"""))
def result_as_text(feed: Feed) -> DataFrame:
    return op.as_text(feed.events.groupBy("QuadClass").agg(F.count("*").alias("n")))


# --- views of results ------------------------------------------------------------------------


def _bars(name: str) -> Query:
    analysis = find(name)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = analysis.build(derived_feed(spark, sf_dir))
        return op.bar_chart(rows, analysis.bars.labels, analysis.bars.value, analysis.bars.top)

    return query


def _bars_sql(name: str) -> str:
    bars = find(name).bars
    label = " || ' - ' || ".join(f"coalesce(cast({c} AS varchar), '')" for c in bars.labels)
    return f"""SELECT {label} AS label, sum(try_cast({bars.value} AS double)) AS value
        FROM ({oracle.SQL[name]}) WHERE try_cast({bars.value} AS double) IS NOT NULL
        GROUP BY 1 ORDER BY abs(sum(try_cast({bars.value} AS double))) DESC, label LIMIT {bars.top}"""


for _a in ANALYSES:
    if _a.bars is not None:
        _register(f"bars_{_a.name}", _bars(_a.name), _bars_sql(_a.name))


@_on_feed(f"""SELECT label, value, CASE sign(value) WHEN 1 THEN 'positive' WHEN -1 THEN 'negative'
    ELSE 'zero' END AS sign FROM ({_bars_sql("tone_conflict_lag")})""")
def bar_colours_sign(feed: Feed) -> DataFrame:
    bars = find("tone_conflict_lag").bars
    rows = _result(feed, "tone_conflict_lag")
    return op.bar_colours(op.bar_chart(rows, bars.labels, bars.value, bars.top), "signo")


@_on_feed(f"""SELECT label, value, abs(value) / max(abs(value)) OVER () AS share
    FROM ({_bars_sql("conflict_heatmap")})""")
def bar_colours_magnitude(feed: Feed) -> DataFrame:
    bars = find("conflict_heatmap").bars
    rows = _result(feed, "conflict_heatmap")
    return op.bar_colours(op.bar_chart(rows, bars.labels, bars.value, bars.top), "magnitud")


def _numeric_sql(name: str, columns: list[str]) -> str:
    number = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"WITH r AS ({oracle.SQL[name]}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (cast({c} AS varchar) <> '') > 0 AND "
        f"count(*) FILTER (cast({c} AS varchar) <> '' AND "
        f"NOT regexp_full_match(trim(cast({c} AS varchar)), '{number}')) = 0 AS numeric FROM r"
        for c in columns
    )


@_on_feed(_numeric_sql("conflict_heatmap", [
    "fecha", "pais", "region", "latitud", "longitud", "total_eventos_conflicto",
    "intensidad_promedio_goldstein", "intensidad_total_goldstein"]))
def numeric_columns(feed: Feed) -> DataFrame:
    return op.numeric_columns(_result(feed, "conflict_heatmap"))


_DOTS = f"""SELECT pais, sum(cast(total_eventos_conflicto AS double)) AS eventos, avg(latitud) AS lat,
    avg(longitud) AS lon, coalesce(avg(intensidad_promedio_goldstein), 0) AS inten
    FROM ({oracle.SQL["conflict_heatmap"]})
    WHERE pais <> '' AND latitud IS NOT NULL AND longitud IS NOT NULL GROUP BY pais"""


@_on_feed(f"""SELECT pais, eventos, {oracle._r("lat", 6)} AS lat, {oracle._r("lon", 6)} AS lon,
    {oracle._r("inten", 6)} AS inten FROM ({_DOTS})""")
def country_map(feed: Feed) -> DataFrame:
    dots = op.country_map(_result(feed, "conflict_heatmap"))
    return dots.select(
        "pais", "eventos", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "inten")]
    )


@_on_feed(f"""SELECT max(eventos) AS max_eventos, {oracle._r("min(inten)", 6)} AS inten_min,
    {oracle._r("(min(inten) + max(inten)) / 2", 6)} AS inten_mid, {oracle._r("max(inten)", 6)} AS inten_max
    FROM ({_DOTS})""")
def map_scale(feed: Feed) -> DataFrame:
    scale = op.map_scale(op.country_map(_result(feed, "conflict_heatmap")))
    return scale.select(
        "max_eventos", *[F.round(c, 6).alias(c) for c in ("inten_min", "inten_mid", "inten_max")]
    )


@_on_feed(f"""SELECT pais, total_eventos, CAST(NULL AS bigint) AS total_menciones
    FROM ({oracle.SQL["sentiment_trend"]})
    UNION ALL SELECT pais, total_eventos, total_menciones FROM ({oracle.SQL["top_countries_by_day"]})""")
def result_columns(feed: Feed) -> DataFrame:
    trend = _result(feed, "sentiment_trend").select("pais", "total_eventos")
    ranks = _result(feed, "top_countries_by_day").select("pais", "total_eventos", "total_menciones")
    return op.all_columns([trend, ranks])


# --- sources and history ---------------------------------------------------------------------

_NOW = datetime(2024, 1, 30, 12, 30)


def _stamped(rows: DataFrame, hours_ago: int) -> DataFrame:
    created = F.lit(_NOW) - F.make_dt_interval(hours=F.lit(hours_ago))
    return rows.withColumn("created_at", created).withColumn(
        "created_hour", F.date_format("created_at", "yyyyMMddHH").cast("int")
    )


def _cycles(rows: DataFrame) -> DataFrame:
    """The rows as three cycles stored them, the last one out of date."""
    return _stamped(rows, 0).unionByName(_stamped(rows, 1)).unionByName(_stamped(rows, 7))


@_on_feed(oracle.SQL["sentiment_trend"])
def history_without_repeats(feed: Feed) -> DataFrame:
    return op.drop_repeats(_cycles(_result(feed, "sentiment_trend")))


@_on_feed(f"""SELECT count(*) AS shown, cast(3 * count(*) AS bigint) AS total
    FROM ({oracle.SQL["sentiment_trend"]})""")
def history_shown_and_total(feed: Feed) -> DataFrame:
    return op.shown_and_total(_cycles(_result(feed, "sentiment_trend")))


@_on_feed(f"""SELECT pais, cast(2 * count(*) AS bigint) AS n FROM ({oracle.SQL["sentiment_trend"]})
    GROUP BY pais""")
def history_not_expired(feed: Feed) -> DataFrame:
    live = sources.live_results(_cycles(_result(feed, "sentiment_trend")), _NOW)
    return live.groupBy("pais").agg(F.count("*").alias("n"))


@_on_feed(f"""SELECT * FROM ({oracle.SQL["sentiment_trend"]})
    ORDER BY fecha, pais, total_eventos, tono_promedio_dia LIMIT 1000""")
def history_page(feed: Feed) -> DataFrame:
    return sources.history_page(_cycles(_result(feed, "sentiment_trend")))


_SUMMARISED = ("top_countries_by_day", "sentiment_trend", "conflict_country_pairs")


@_on_feed(" UNION ALL ".join(
    f"""SELECT '{find(n).result}' AS nombre, '{find(n).title}' AS titulo,
        {str(find(n).bars is not None).lower()} AS tiene_grafico, count(*) AS filas,
        cast(3 * count(*) AS bigint) AS total FROM ({oracle.SQL[n]})""" for n in _SUMMARISED))
def history_summary(feed: Feed) -> DataFrame:
    return sources.summary({find(n).result: _cycles(_result(feed, n)) for n in _SUMMARISED})


@_on_feed(_events("SELECT GLOBALEVENTID, SQLDATE, EventCode FROM news_events"))
def unwrapped_longs(feed: Feed) -> DataFrame:
    def wrapped(name: str):
        return F.struct(F.col(name).cast("string").alias("$numberLong")).alias(name)

    return sources.unwrap_number_long(
        feed.events.select(wrapped(EVENT), wrapped("SQLDATE"), "EventCode")
    )


@_on_feed(_mentions("SELECT * FROM news_mentions"))
def typed_mentions(feed: Feed) -> DataFrame:
    """Integers as the raw JSON may have them: bare, wrapped or as doubles."""

    def raw(name: str):
        bare = F.col(name).cast("string")
        wrapped = F.concat(F.lit('{"$numberLong":"'), bare, F.lit('"}'))
        kind = F.pmod(F.col(name), F.lit(3))
        return F.when(kind == 0, wrapped).when(kind == 1, F.concat(bare, F.lit(".0"))).otherwise(bare)

    mentions = feed.mentions.withColumns({n: raw(n) for n in (EVENT, "MentionTimeDate")})
    return sources.typed(mentions, "mentions")


@_on_feed(_events("SELECT GLOBALEVENTID, EventCode FROM news_events"))
def without_empty_columns(feed: Feed) -> DataFrame:
    return sources.drop_empty_columns(
        feed.events.select(EVENT, F.lit(None).cast("string").alias("nothing"), "EventCode")
    )


@_on_feed(_gkg("""SELECT strftime(try_strptime(substr(cast("DATE" AS varchar), 1, 8), '%Y%m%d'), '%Y-%m-%d')
    AS day, count(*) AS n FROM news_gkg GROUP BY day"""))
def partition_days(feed: Feed) -> DataFrame:
    dated = with_day(feed.gkg, "gkg")
    return dated.groupBy(fn.day_text(F.col("event_date")).alias("day")).agg(F.count("*").alias("n"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new place that all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def _as_array(files: int):
    """The objects of one task as the lines of one JSON array, or of its part, if an array has several files."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % files
        begin, empty = part == 0, True
        for batch in batches:
            lines = [("[" if begin and empty and i == 0 else ",") + text for i, text in enumerate(batch.column(0).to_pylist())]
            empty = empty and not lines
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        end = ("[" if begin and empty else "") + ("]" if part == files - 1 else "")
        yield pa.RecordBatch.from_arrays([pa.array([end] if end else [], pa.string())], ["value"])

    return run


#: Rows of an array that one task writes.
_ARRAY_ROWS = 500_000


def _land(rows: DataFrame, path: str, arrays: int = 8) -> None:
    """Write rows as JSON arrays, row by row. An array of many rows is divided among tasks: its files are the array, one after the other."""
    files = 1 + rows.count() // (arrays * _ARRAY_ROWS)
    objects = rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).repartition(arrays * files)
    objects.mapInArrow(_as_array(files), "value string").write.text(path)


@_on_feed(_gkg("SELECT * FROM news_gkg"))
def json_slices(feed: Feed) -> DataFrame:
    spark = feed.gkg.sparkSession
    path = _folder(spark, "slices")
    _land(feed.gkg, path)
    return sources.read_json(spark, path, "gkg")


@_on_feed(_events("SELECT GLOBALEVENTID, SQLDATE, EventCode, AvgTone, SOURCEURL FROM news_events"))
def json_one_array(feed: Feed) -> DataFrame:
    """All events as one array, which is read in blocks: in one file, or in several one after the other where one task could not write it."""
    spark = feed.events.sparkSession
    path = _folder(spark, "array")
    _land(feed.events, path, arrays=1)
    return sources.read_json(spark, path, "events").select(EVENT, "SQLDATE", "EventCode", "AvgTone", "SOURCEURL")


@_on_feed(f"""WITH shown(position, nombre) AS (VALUES (0, '{find("conflict_heatmap").result}'),
        (1, '{find("sentiment_trend").result}'), (2, 'aa_own'), (3, 'zz_own'))
    SELECT CAST(position AS bigint) AS position, nombre, n FROM shown, (SELECT count(*) AS n FROM ({oracle.SQL["sentiment_trend"]}))""")
def catalog_of_results(feed: Feed) -> DataFrame:
    """Stored results as the catalog lists them: known ones in its order, others by name, hidden ones not at all."""
    trend = _result(feed, "sentiment_trend")
    spark = trend.sparkSession
    root = _folder(spark, "history")
    known = [find(n).result for n in ("sentiment_trend", "conflict_heatmap")]
    for name in ("startup_log", "zz_own", known[0], "system.views", "aa_own", known[1]):
        sources.append_results(trend, root, name, _NOW)
    listed = None
    for position, name in enumerate(sources.stored_results(spark, root)):
        rows = sources.read_results(spark, root, name).agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(position).cast("long").alias("position"), F.lit(name).alias("nombre"), "n")
        listed = rows if listed is None else listed.unionAll(rows)
    return listed


@_on_feed(oracle.SQL["sentiment_trend"])
def json_result(feed: Feed) -> DataFrame:
    trend = _result(feed, "sentiment_trend")
    path = _folder(trend.sparkSession, "result")
    sources.write_json(trend, path)
    return trend.sparkSession.read.schema(trend.schema).json(path)


@_on_feed(_mentions("SELECT * FROM news_mentions UNION ALL SELECT * FROM news_mentions"))
def table_backfill_then_ingest(feed: Feed) -> DataFrame:
    """Every mention twice in one table: by a batch, and by the slices of a stream."""
    spark = feed.mentions.sparkSession
    root = _folder(spark, "tables")
    sources.write_table(feed.mentions, root, "mentions")
    _land(feed.mentions, f"{root}/landing/mentions")
    streaming.ingest(spark, f"{root}/landing", root, "mentions", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(schemas.MENTIONS).parquet(f"{root}/mentions").select(schemas.MENTIONS.names)


@_on_feed(_events("""SELECT ActionGeo_CountryCode AS pais, count(*) AS n FROM news_events
    WHERE SQLDATE BETWEEN 20240105 AND 20240110 GROUP BY pais"""))
def table_days_between(feed: Feed) -> DataFrame:
    spark = feed.events.sparkSession
    root = _folder(spark, "tables")
    for name in schemas.TABLES:
        sources.write_table(getattr(feed, name), root, name)
    days = Feed.from_parquet(spark, root).between(date(2024, 1, 5), date(2024, 1, 10))
    return days.events.groupBy(F.col(COUNTRY).alias("pais")).agg(F.count("*").alias("n"))


@_on_feed(f"""SELECT pais, cast(2 * count(*) AS bigint) AS n FROM ({oracle.SQL["sentiment_trend"]})
    GROUP BY pais""")
def history_expired(feed: Feed) -> DataFrame:
    """Three stored cycles, of which the oldest is removed."""
    trend = _result(feed, "sentiment_trend")
    spark = trend.sparkSession
    root = _folder(spark, "history")
    for hours in (0, 1, 7):
        sources.append_results(trend, root, "trend", _NOW - timedelta(hours=hours))
    sources.expire_results(spark, root, _NOW)
    return sources.read_results(spark, root, "trend").groupBy("pais").agg(F.count("*").alias("n"))


# --- streams ---------------------------------------------------------------------------------


def _drained(stream: DataFrame, run: str) -> DataFrame:
    """All rows of a stream, stored as they come out and read back."""
    spark = stream.sparkSession
    stream.writeStream.option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True).start(
        f"{run}/rows", format="parquet", outputMode="append"
    ).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{run}/rows")


def _on_stream(sql: str):
    """Register a stream over the test events; it is drained to Parquet files and read back."""

    def decorate(build: Callable[[DataFrame], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            path = f"{sf_dir}/events.parquet"
            # The reader wants a directory; where the table is one file, its name is the pattern in it.
            reader = spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet")
            if exists(spark, path, file=True):
                arriving = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
            else:
                arriving = reader.parquet(path)
            return _drained(build(arriving), _folder(spark, build.__name__))

        _register(build.__name__, query, sql)
        return build

    return decorate


#: Rows that one file of a slice or batch holds, so that many tasks write and read it.
_FILE_ROWS = 200_000


def _arriving(rows: DataFrame, folder: str, batches: int, order: str) -> DataFrame:
    """Rows as a stream of several batches, in order of an expression but for one row in five, which comes a batch later."""
    spark = rows.sparkSession
    keys = rows.select(F.expr(order).alias("k")).distinct()
    placed = keys.select("k", F.expr(f"cast({batches} * percent_rank() OVER (ORDER BY k) AS int)").alias("batch"))
    late = F.when(F.pmod(F.xxhash64(*rows.columns), F.lit(5)) == 0, 1).otherwise(0)
    dealt = rows.withColumn("k", F.expr(order)).join(placed, "k").withColumn("batch", F.least(F.col("batch") + late, F.lit(batches)))
    dealt = dealt.drop("k").persist()
    files = 1 + dealt.count() // (batches * _FILE_ROWS)
    stored, nothing = spark.read.schema(rows.schema), spark.createDataFrame([], rows.schema).coalesce(1)
    for n in range(batches + 1):
        # One batch after the other, as the reader takes files in order of their times. All batches have as many files; if rows are too few, some without rows.
        dealt.filter(F.col("batch") == n).drop("batch").repartition(files).write.mode("append").parquet(folder)
        for _ in range((n + 1) * files - len(stored.parquet(folder).inputFiles())):
            nothing.write.mode("append").parquet(folder)
    dealt.unpersist()
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _on_batches(sql: str):
    """Register a stream over the base rows of the feed, which arrive in several batches, some of them late."""

    def decorate(build: Callable[[DataFrame, str], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            run = _folder(spark, build.__name__)
            base = spark.read.parquet(f"{sf_dir}/events.parquet")
            return _drained(build(_arriving(base, f"{run}/base", 4, "date_trunc('hour', ts)")), run)

        _register(build.__name__, query, sql)
        return build

    return decorate


_TIMED = f"""timed AS (SELECT * FROM (SELECT *, {_TS.format("MentionTimeDate")} AS t FROM news_mentions)
    WHERE t IS NOT NULL)"""


@_on_stream(f"""{oracle._with(oracle.MENTIONS, _TIMED)},
    sliced AS (SELECT time_bucket(INTERVAL 15 MINUTE, t, TIMESTAMP '2000-01-01 00:00:00') AS s,
        MentionSourceName, count(*) AS n FROM timed GROUP BY s, MentionSourceName)
    SELECT strftime(s, {_TEXT_FORMAT}) AS slice, MentionSourceName, n FROM sliced
    WHERE s + INTERVAL 15 MINUTE <= (SELECT max(t) - INTERVAL 1 HOUR FROM timed)""")
def stream_slice_counts(base: DataFrame) -> DataFrame:
    mentions = news_mentions(base).withColumn("moment", fn.feed_timestamp("MentionTimeDate"))
    counts = streaming.slice_counts(
        mentions.filter(F.col("moment").isNotNull()), "moment", ["MentionSourceName"]
    )
    return counts.withColumn("slice", fn.mention_time_text(F.col("slice")))


@_on_stream(_events("SELECT DISTINCT GLOBALEVENTID FROM news_events"))
def stream_first_seen(base: DataFrame) -> DataFrame:
    """In one batch every repeat is near enough to be dropped."""
    return streaming.first_seen(news_events(base)).select(EVENT)


@_on_stream(f"""{oracle._with(oracle.MENTIONS, _TIMED)},
    hourly AS (SELECT GLOBALEVENTID, date_trunc('hour', t) AS h, count(*) AS n FROM timed GROUP BY ALL),
    moved AS (SELECT GLOBALEVENTID, h - to_hours(cast(i AS int)) AS s, n FROM hourly, range(24) r(i))
    SELECT GLOBALEVENTID, strftime(s, {_TEXT_FORMAT}) AS window_start,
           strftime(s + INTERVAL 24 HOUR, {_TEXT_FORMAT}) AS window_end, cast(sum(n) AS bigint) AS mentions_24h
    FROM moved WHERE s + INTERVAL 24 HOUR <= (SELECT max(t) - INTERVAL 1 HOUR FROM timed)
    GROUP BY GLOBALEVENTID, s""")
def stream_escalation(base: DataFrame) -> DataFrame:
    windows = streaming.escalation_windows(news_mentions(base))
    return windows.withColumns(
        {c: fn.mention_time_text(F.col(c)) for c in ("window_start", "window_end")}
    )


@_on_stream(f"""{oracle._with(oracle.MENTIONS, oracle.FIRST_HOUR)}
    SELECT GLOBALEVENTID, strftime(first, {_TEXT_FORMAT}) AS first, n AS mentions, s AS sources
    FROM first_hour
    WHERE first + INTERVAL 1 HOUR < (SELECT max(ts) - INTERVAL 15 MINUTE FROM valid)""")
def stream_breaking_hours(base: DataFrame) -> DataFrame:
    hours = streaming.breaking_hours(news_mentions(base))
    return hours.withColumn("first", fn.mention_time_text(F.col("first")))


# The base rows arrive in five batches; a row that is late is late by as much as a batch covers.
_LATE = "10 days"
_DONE = "(SELECT max(t) - INTERVAL 10 DAY FROM timed)"


@_on_batches(f"""{oracle._with(oracle.MENTIONS, _TIMED)},
    apart AS (SELECT GLOBALEVENTID, t, coalesce(t - lag(t) OVER w > INTERVAL 30 MINUTE, true) AS begins
        FROM timed WINDOW w AS (PARTITION BY GLOBALEVENTID ORDER BY t)),
    numbered AS (SELECT *, count(*) FILTER (begins) OVER (PARTITION BY GLOBALEVENTID ORDER BY t
        ROWS UNBOUNDED PRECEDING) AS island FROM apart),
    islands AS (SELECT GLOBALEVENTID, min(t) AS a, max(t) AS b, count(*) AS mentions FROM numbered GROUP BY GLOBALEVENTID, island)
    SELECT GLOBALEVENTID, strftime(a, {_TEXT_FORMAT}) AS burst_start, strftime(b, {_TEXT_FORMAT}) AS burst_end, mentions
    FROM islands WHERE b + INTERVAL 1801 SECOND <= {_DONE}""")
def stream_bursts(base: DataFrame) -> DataFrame:
    bursts = streaming.mention_bursts(news_mentions(base), 30, _LATE)
    return bursts.withColumns({c: fn.mention_time_text(F.col(c)) for c in ("burst_start", "burst_end")})


@_on_batches(f"""{oracle._with(oracle.EVENTS, oracle.MENTIONS, _TIMED)},
    sliced AS (SELECT time_bucket(INTERVAL 15 MINUTE, t, TIMESTAMP '2000-01-01 00:00:00') AS s, GLOBALEVENTID, count(*) AS n
        FROM timed GROUP BY ALL),
    located AS (SELECT GLOBALEVENTID, ActionGeo_CountryCode AS pais, {oracle.DAY} AS day FROM news_events
        WHERE ActionGeo_CountryCode IS NOT NULL),
    last AS (SELECT least({_DONE}, (SELECT max(day) FROM located) - INTERVAL 10 DAY) - INTERVAL 3 DAY AS final)
    SELECT strftime(s, {_TEXT_FORMAT}) AS slice, pais, CAST(sum(n) AS bigint) AS menciones
    FROM sliced JOIN located USING (GLOBALEVENTID), last
    WHERE s + INTERVAL 15 MINUTE > day AND s + INTERVAL 15 MINUTE <= day + INTERVAL 3 DAY AND s + INTERVAL 15 MINUTE <= final
    GROUP BY s, pais""")
def stream_country_slices(base: DataFrame) -> DataFrame:
    counts = streaming.country_slices(news_mentions(base), news_events(base), _LATE, _LATE, "3 days")
    return counts.withColumn("slice", fn.mention_time_text(F.col("slice")))


@contextlib.contextmanager
def _rocksdb(spark: SparkSession):
    """Streams that start meanwhile keep their state in RocksDB, as those with state of their own need it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _on_rocksdb(name: str) -> None:
    """Let a registered stream have state of its own."""
    query = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with _rocksdb(spark):
            return query(spark, sf_dir)

    QUERIES[name] = run


@_on_batches(f"""{oracle._with(oracle.MENTIONS, _TIMED)},
    hourly AS (SELECT GLOBALEVENTID, date_trunc('hour', t) AS h, count(*) AS n FROM timed GROUP BY ALL),
    rolled AS (SELECT a.GLOBALEVENTID, a.h, a.n, cast(sum(b.n) AS bigint) AS day FROM hourly a JOIN hourly b
        ON a.GLOBALEVENTID = b.GLOBALEVENTID AND b.h BETWEEN a.h - INTERVAL 24 HOUR AND a.h GROUP BY ALL),
    lagged AS (SELECT *, coalesce(lag(day) OVER (PARTITION BY GLOBALEVENTID ORDER BY h), 0) AS before FROM rolled)
    SELECT GLOBALEVENTID, strftime(h, {_TEXT_FORMAT}) AS hour, n AS mentions, day AS mentions_24h, before AS mentions_24h_before,
        day - before AS acceleration FROM lagged WHERE h + INTERVAL 1 HOUR <= {_DONE}""")
def stream_escalation_speeds(base: DataFrame) -> DataFrame:
    speeds = streaming.escalation_speeds(news_mentions(base), _LATE)
    return speeds.withColumn("hour", fn.mention_time_text(F.col("hour")))


@_on_batches(f"""{oracle._with(oracle.MENTIONS, oracle.FIRST_HOUR)}
    SELECT GLOBALEVENTID, strftime(first, {_TEXT_FORMAT}) AS first, n AS mentions, s AS sources
    FROM first_hour WHERE first + INTERVAL 1 HOUR < (SELECT max(ts) - INTERVAL 10 DAY FROM valid)""")
def stream_first_hours(base: DataFrame) -> DataFrame:
    hours = streaming.first_hours(news_mentions(base), _LATE, timedelta(days=400))
    return hours.withColumn("first", fn.mention_time_text(F.col("first")))


for _n in ("stream_escalation_speeds", "stream_first_hours"):
    _on_rocksdb(_n)


# --- results brought up to date slice by slice -----------------------------------------------


def _in_three_slices(feed: Feed, root: str) -> Feed:
    """Streams of the tables that arrive in three slices, each of as many files as its rows need. Rows are dealt in turn, so that copies of an id come in different ones."""
    streams = {}
    for name, schema in schemas.TABLES.items():
        rows = getattr(feed, name).select(schema.names)
        files = 1 + rows.count() // (3 * _FILE_ROWS)
        rows.repartition(3 * files).write.parquet(f"{root}/{name}")
        reader = rows.sparkSession.readStream.schema(schema).option("maxFilesPerTrigger", files)
        streams[name] = reader.parquet(f"{root}/{name}")
    return Feed(**streams)


def _newest(spark: SparkSession, history: str, result: str) -> DataFrame:
    stored = sources.read_results(spark, history, result)
    newest = stored.agg(F.max("created_at")).first()[0]
    return stored.filter(F.col("created_at") == F.lit(newest)).drop("created_at", "created_hour")


def _refreshed(name: str, approximate: bool = False) -> Query:
    """The result after the last of three slices, each of which was read once."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark, f"refresh-{name}")
        arrivals = _in_three_slices(derived_feed(spark, sf_dir), root)
        streaming.refresh_increments(
            arrivals, f"{root}/states", f"{root}/history", f"{root}/checkpoint", analyses=[name], approximate=approximate
        ).awaitTermination()
        return _newest(spark, f"{root}/history", find(name).result)

    return query


for _n in INCREMENTAL:
    _register(f"refreshed_{_n}", _refreshed(_n), oracle.SQL[_n])


@_on_feed(_events("""SELECT ActionGeo_CountryCode AS pais, count(DISTINCT GLOBALEVENTID) AS total_eventos,
    true AS within_3_percent, true AS slices_equal_whole FROM news_events WHERE ActionGeo_CountryCode IS NOT NULL GROUP BY pais"""))
def sketched_events_by_country(feed: Feed) -> DataFrame:
    """Distinct events counted by sketches of three slices, which are stored and merged, beside the exact count and one sketch of all."""
    spark = feed.events.sparkSession
    store = sources.StateStore(spark, _folder(spark, "sketches"))
    events = feed.events.filter(F.col(COUNTRY).isNotNull()).select(F.col(COUNTRY).alias("pais"), EVENT, "EventCode")
    for n in range(3):
        arrived = events.filter(F.pmod(F.xxhash64(EVENT, "EventCode"), F.lit(3)) == n)
        sketches = arrived.groupBy("pais").agg(fn.distinct_sketch(F.col(EVENT)).alias("sketch"))
        store.append(sketches, "countries", n)
    merged = store.log("countries", 3, sketches.schema).groupBy("pais").agg(fn.merged_sketches(F.col("sketch")).alias("sketch"))
    whole = events.groupBy("pais").agg(F.count_distinct(EVENT).alias("total_eventos"), fn.distinct_sketch(F.col(EVENT)).alias("one"))
    estimate = fn.sketch_estimate(F.col("sketch"))
    return whole.join(merged, "pais").select(
        "pais",
        "total_eventos",
        (F.abs(estimate - F.col("total_eventos")) <= 0.03 * F.col("total_eventos")).alias("within_3_percent"),
        (estimate == fn.sketch_estimate(F.col("one"))).alias("slices_equal_whole"),
    )
