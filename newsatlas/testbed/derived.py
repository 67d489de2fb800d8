"""The three feed tables, derived row by row from the ``events`` and ``documents`` test tables.

Every value follows from the row's own keys by plain arithmetic, so that another engine can derive
the same tables. Numbers are multiples of 1/4 or 1/8: sums and averages do not depend on row order.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsatlas.feed import Feed

QUAD_CLASS = {"signup": 1, "purchase": 1, "view": 2, "click": 3, "error": 4}
COUNTRIES = ["US", "MX", "BR", "GM", "CH", "NI", "AS", "XX", "", None, "ES", " uk "]
PLACES = ["US", "MX", "BR", "GM", "CH", "NI", "AS", "XX", "", "ES", " uk "]
NAMES = {
    1: ["GOVERNMENT", "POLICE", "REBELS", "", None, "PRESS"],
    2: ["SENATE", "ARMY", None, "WORKERS", "CITY"],
}
CODES = {1: ["GOV", "COP", "REB", None], 2: ["LEG", "MIL", None, "LAB", "CVL"]}
NATIONS = ["USA", "MEX", "BRA", "DEU", "CHN", "", "RUS", None]
TYPES = ["GOV", "MIL", "REB", "BUS", None, "LEG", "INS", "CVL"]
RELIGIONS = {
    1: (["CHR", "MOS", None, None, "JEW"], [None, "CTH", None]),
    2: ([None, "MOS", None, "HIN"], [None, None, "SUN"]),
}
ETHNICITIES = {1: ["ara", "kur", None, None, "tam"], 2: [None, "ara", None, "slv"]}


def pick(values: Sequence[str | None], index: str) -> str:
    """Element of a fixed list, the index wrapping around."""
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"get(array({items}), cast(({index}) % {len(values)} AS int))"


def unless(divisor: int, key: str, value: str) -> str:
    """NULL for every ``divisor``-th key."""
    return f"CASE WHEN {key} % {divisor} <> 0 THEN {value} END"


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def _latitude(j: str) -> str:
    return f"((7 * ({j}) % 561) / 4D - 70)"


def _longitude(j: str) -> str:
    return f"((13 * ({j}) % 1441) / 4D - 180)"


def news_events(base: DataFrame) -> DataFrame:
    """One event per base row; every fiftieth comes again a day later with another code and link."""
    # Packed in the generator, the date is a plain column; otherwise Spark repeats its formatting wherever an analysis refers to it.
    days = [f"struct({n}, cast(date_format(ts + make_dt_interval({n}), 'yyyyMMdd') AS bigint))" for n in (0, 1)]
    rows = base.selectExpr(
        "event_id AS k",
        "user_id AS u",
        "event_type AS kind",
        f"inline(CASE WHEN event_id % 50 = 0 THEN array({days[0]}, {days[1]}) ELSE array({days[0]}) END) AS (again, day)",
    )
    quad = " ".join(f"WHEN '{name}' THEN {value}" for name, value in QUAD_CLASS.items())
    root = "lpad(cast(1 + k % 20 AS string), 2, '0')"
    columns = {
        "GLOBALEVENTID": "k",
        "SQLDATE": "day",
        "QuadClass": f"CASE kind {quad} END",
        "ActionGeo_CountryCode": pick(COUNTRIES, "u"),
        "ActionGeo_FullName": unless(13, "k", "concat('Place ', u)"),
        "ActionGeo_Lat": unless(17, "k", _latitude("k")),
        "ActionGeo_Long": unless(17, "k", _longitude("k")),
        "GoldsteinScale": unless(
            29, "k", "(k % 41) / 4D * CASE WHEN kind IN ('click', 'error') THEN -1D ELSE 1D END"
        ),
        "AvgTone": unless(31, "k", "(11 * k % 161) / 8D - 10"),
        "NumMentions": "cast(1 + k % 10 AS int)",
        "NumSources": "cast(1 + k % 7 AS int)",
        "NumArticles": "cast(1 + k % 9 AS int)",
        "EventRootCode": root,
        "EventBaseCode": unless(37, "k", f"concat({root}, k % 4)"),
        "EventCode": f"concat({root}, k % 4, again)",
        "CAMEOCodeDescription": unless(11, "k", "concat('desc ', 1 + k % 20)"),
        "SOURCEURL": unless(19, "k", "concat('https://news.example/', k, '/', again)"),
    }
    nation_index = {1: "u", 2: "k % 8 + 3 * (u % 5)"}
    type_index = {1: ("k", "k % 5", "k % 3 + 4"), 2: ("u", "u % 7", "u % 2 + 4")}
    for n, key in ((1, "k"), (2, "u")):
        columns[f"Actor{n}Name"] = pick(NAMES[n], "k")
        columns[f"Actor{n}Code"] = pick(CODES[n], "k")
        columns[f"Actor{n}CountryCode"] = pick(NATIONS, nation_index[n])
        for t in (1, 2, 3):
            columns[f"Actor{n}Type{t}Code"] = pick(TYPES, type_index[n][t - 1])
        for r in (1, 2):
            columns[f"Actor{n}Religion{r}Code"] = pick(RELIGIONS[n][r - 1], key)
        columns[f"Actor{n}EthnicCode"] = pick(ETHNICITIES[n], key)
    return _select(rows, columns)


def news_mentions(base: DataFrame) -> DataFrame:
    """Two mentions per base row: one in a burst of twenty, one of fifty events mentioned all along."""
    moment = (
        "CASE WHEN event_id % 101 = 0 THEN 20249905120000 WHEN event_id % 103 = 0 THEN NULL "
        "ELSE cast(date_format(ts, 'yyyyMMddHHmmss') AS bigint) END"
    )
    # Packed in the generator, as in the events.
    twice = f"inline(array(struct(event_id div 20, {moment}), struct(event_id % 50, {moment}))) AS (id, moment)"
    columns = {
        "GLOBALEVENTID": "id",
        "MentionTimeDate": "moment",
        "MentionSourceName": (
            "CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 47 = 0 THEN '' "
            "ELSE concat('src', user_id % 40) END"
        ),
        "MentionDocTone": unless(31, "event_id", "(5 * event_id % 161) / 8D - 10"),
    }
    return _select(base.selectExpr("event_id", "user_id", twice), columns)


def _coordinate(value: str, j: str) -> str:
    return (
        f"CASE ({j}) % 6 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN 'n/a' "
        f"ELSE cast({value} AS string) END"
    )


def _place(j: str, extra: str) -> str:
    return (
        f"concat('4#Place ', {j}, '#', {pick(PLACES, j)}, '#A1#{extra}', "
        f"{_coordinate(_latitude(j), j)}, '#', {_coordinate(_longitude(j), j)}, '#F', {j})"
    )


def news_gkg(documents: DataFrame) -> DataFrame:
    """One record per document, with every oddity of the delimited columns."""
    v2, v2_next, v1 = _place("doc_id", "A2#"), _place("doc_id + 7", "A2#"), _place("doc_id + 3", "")
    theme = "concat('TAX_', doc_id % 9)"
    columns = {
        "GKGRECORDID": "concat('20240101-', doc_id)",
        "DATE": (
            "cast(concat(2023 + doc_id % 2, '01', lpad(cast(1 + doc_id % 28 AS string), 2, '0'), "
            "'120000') AS bigint)"
        ),
        "V2Locations": (
            f"CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat({v2}, ';') "
            f"WHEN 3 THEN concat({v2}, ';', {v2_next}) ELSE {v2} END"
        ),
        "Locations": (
            f"CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN concat({v1}, ';') ELSE {v1} END"
        ),
        "V2Themes": (
            "CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' "
            f"ELSE concat({theme}, ',', n_chars, ';CRISIS_', doc_id % 5, ',12;') END"
        ),
        "Themes": unless(7, "doc_id", f"concat({theme}, ';ELECTION;')"),
        "Organizations": unless(
            8, "doc_id",
            "concat(source, ' Agency; ', upper(source), ' agency;', lang, ' Press;')",
        ),
    }
    return _select(documents, columns)


def derived_feed(spark: SparkSession, sf_dir: str) -> Feed:
    """The feed over the whole test tables in ``sf_dir``."""
    base = spark.read.parquet(f"{sf_dir}/events.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return Feed(events=news_events(base), mentions=news_mentions(base), gkg=news_gkg(documents))
