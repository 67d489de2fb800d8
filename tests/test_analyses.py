from datetime import datetime, timedelta

import pytest

from newsatlas import Feed
from newsatlas.plans import ANALYSES, find
from newsatlas.plans.bursts import breaking_news

CONFLICT = {"QuadClass": 4, "GoldsteinScale": -2.0, "AvgTone": -1.0, "SQLDATE": 20240101}


def run(name, feed, **parameters):
    return [tuple(r) for r in find(name).build(feed, **parameters).collect()]


@pytest.mark.parametrize("analysis", ANALYSES, ids=lambda a: a.name)
def test_empty_input(analysis, feed):
    got = analysis.build(feed()).collect()
    if analysis.name == "tone_source_correlation":
        assert [tuple(r) for r in got] == [(0, None, None, None)]
    else:
        assert got == []


@pytest.mark.parametrize("analysis", ANALYSES, ids=lambda a: a.name)
def test_chart_columns_exist(analysis, feed):
    columns = analysis.build(feed()).columns
    if analysis.bars:
        assert set(analysis.bars.labels) | {analysis.bars.value} <= set(columns)


def test_conflict_heatmap(feed):
    place = {"ActionGeo_CountryCode": "XX", "ActionGeo_Lat": 40.0, "ActionGeo_Long": 10.0}
    events = [
        {**CONFLICT, **place, "GLOBALEVENTID": 1},
        {**CONFLICT, **place, "GLOBALEVENTID": 1, "GoldsteinScale": -4.0, "ActionGeo_Lat": 50.0},
        {**CONFLICT, **place, "GLOBALEVENTID": 2, "QuadClass": 1},
        {**CONFLICT, **place, "GLOBALEVENTID": 3, "GoldsteinScale": None},
        {**CONFLICT, **place, "GLOBALEVENTID": 4, "SQLDATE": 20249999},
        {**CONFLICT, **place, "GLOBALEVENTID": 5, "SQLDATE": None},
        {**CONFLICT, **place, "GLOBALEVENTID": 6, "ActionGeo_CountryCode": "US", "SQLDATE": 20240102},
    ]
    assert run("conflict_heatmap", feed(events)) == [
        ("2024-01-02", "US", "Norteamérica", 40.0, 10.0, 1, 2.0, 2.0),
        ("2024-01-01", "XX", "Europa", 45.0, 10.0, 1, 3.0, 6.0),
        (None, "XX", "Europa", 40.0, 10.0, 1, 2.0, 2.0),
    ]


def test_top_countries_by_day_breaks_ties_and_keeps_ten(feed):
    events = [
        {"GLOBALEVENTID": 100 * c + n, "SQLDATE": 20240101, "ActionGeo_CountryCode": f"C{c:02}",
         "NumMentions": 2, "NumArticles": 3}
        for c in range(12)
        for n in range(2 if c == 11 else 1)
    ]
    got = run("top_countries_by_day", feed(events))
    assert got[0] == ("2024-01-01", "C11", 2, 4, 6, 1)
    assert [r[1] for r in got[1:]] == [f"C{c:02}" for c in range(9)]
    assert [r[5] for r in got] == list(range(1, 11))


def test_tone_source_correlation_of_a_constant(feed):
    events = [{"AvgTone": float(t), "NumSources": 2} for t in range(4)] + [{"AvgTone": 1.0}]
    assert run("tone_source_correlation", feed(events)) == [(4, None, 1.5, 2.0)]


def test_cameo_by_region_shares_and_defaults(feed):
    code = {"ActionGeo_CountryCode": "US", "EventCode": "010"}
    events = [{**code, "GLOBALEVENTID": n} for n in (1, 2, 2)]
    events += [{**code, "GLOBALEVENTID": 3, "EventRootCode": "01", "CAMEOCodeDescription": "d"}]
    events += [{"GLOBALEVENTID": 4, "EventCode": "010"}, {**code, "EventCode": None}]
    assert run("cameo_by_region", feed(events)) == [
        ("Norteamérica", "SIN_ROOT_CODE", "SIN_BASE_CODE", "010", "Sin descripción", "2", "66.67"),
        ("Norteamérica", "01", "SIN_BASE_CODE", "010", "d", "1", "33.33"),
    ]


def test_actor_type_matrix_counts_rows_and_distinct_events(feed):
    pair = {"Actor1Type2Code": "GOV", "Actor2Type3Code": "INS", "GoldsteinScale": 1.0}
    events = [
        {**pair, "GLOBALEVENTID": 1, "QuadClass": 3},
        {**pair, "GLOBALEVENTID": 1, "QuadClass": 4, "GoldsteinScale": 2.0},
        {**pair, "GLOBALEVENTID": 2, "QuadClass": None},
        {**pair, "GLOBALEVENTID": 3, "Actor2Type3Code": None},
    ]
    assert run("actor_type_matrix", feed(events)) == [("Gobierno", "Grupo rebelde", 2, 2, 1.33)]


def test_media_coverage_needs_five_events(feed):
    events = [{"GLOBALEVENTID": n, "ActionGeo_CountryCode": "US"} for n in (1, 1, 2, 3, 4, 5)]
    events += [{"GLOBALEVENTID": n, "ActionGeo_CountryCode": "MX"} for n in range(4)]
    mentions = [{"GLOBALEVENTID": 1, "MentionSourceName": s} for s in ("a", "a", "b", None)]
    got = run("media_coverage_by_country", feed(events, mentions))
    assert got == [("US", 5, 4, 2, 0.8)]


def test_sentiment_trend_averages_observed_days(feed):
    days = [20240101, 20240103, 20240104, 20240105, 20240106, 20240107, 20240108, 20240120]
    events = [
        {"GLOBALEVENTID": n, "SQLDATE": d, "ActionGeo_CountryCode": "US", "AvgTone": float(n)}
        for n, d in enumerate(days)
    ]
    got = run("sentiment_trend", feed(events))
    assert [r[4] for r in got] == [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0]


def test_country_pairs_ignore_order(feed):
    def pair(n, a, b, **more):
        return {**CONFLICT, "GLOBALEVENTID": n, "Actor1CountryCode": a, "Actor2CountryCode": b, **more}

    events = [
        pair(1, "USA", "MEX"), pair(2, "MEX", "USA"), pair(2, "MEX", "USA", QuadClass=1),
        pair(3, "MEX", "MEX"), pair(4, " ", "USA"), pair(5, None, "USA"), pair(6, "BRA", "USA"),
    ]
    assert run("conflict_country_pairs", feed(events)) == [
        ("MEX", "USA", 2, -2.0, -1.0), ("BRA", "USA", 1, -2.0, -1.0)
    ]
    assert run("diplomacy_conflict_graph", feed(events)) == [
        ("MEX", "USA", 1, 2, 2, 1.0), ("BRA", "USA", 0, 1, 1, 1.0)
    ]


def _mention(event, when, source="s"):
    return {"GLOBALEVENTID": event, "MentionTimeDate": int(when.strftime("%Y%m%d%H%M%S")),
            "MentionSourceName": source}


def test_escalation_window_includes_both_ends(feed):
    start = datetime(2024, 1, 1)
    mentions = [_mention(1, start), _mention(1, start + timedelta(hours=24, minutes=59))]
    mentions += [_mention(2, start)] * 2 + [_mention(2, start + timedelta(hours=25))] * 3
    mentions += [{"GLOBALEVENTID": 3, "MentionTimeDate": 202401011200001}]
    events = [
        {"GLOBALEVENTID": 1, "SQLDATE": 20240101, "EventCode": "old"},
        {"GLOBALEVENTID": 1, "SQLDATE": 20240102, "EventCode": "new", "ActionGeo_CountryCode": "US"},
    ]
    got = run("mention_escalation_24h", feed(events, mentions))
    assert got == [
        (2, None, None, None, None, "2024-01-01 00:00:00", 2, 2, 0, 2, None),
        (1, "2024-01-02", "US", "new", None, "2024-01-01 00:00:00", 1, 1, 0, 1, None),
        (1, "2024-01-02", "US", "new", None, "2024-01-02 00:00:00", 1, 2, 1, 1, None),
        (2, None, None, None, None, "2024-01-02 01:00:00", 3, 3, 2, 1, None),
    ]
    assert len(run("mention_escalation_24h", feed(events, mentions), min_mentions_24h=3)) == 1


def test_breaking_news_hour_is_half_open(feed):
    start = datetime(2024, 1, 1, 10, 30)
    mentions = [
        _mention(1, start, "a"), _mention(1, start, "a"), _mention(1, start, None),
        _mention(1, start + timedelta(minutes=59, seconds=59), None),
        _mention(1, start + timedelta(hours=1), "b"),
        {"GLOBALEVENTID": 2, "MentionTimeDate": 202401011200001, "MentionSourceName": "x"},
    ]
    got = run("breaking_news", feed(mentions=mentions))
    assert got == [
        (1, "2024-01-01 10:30:00", None, None, None, None, 4, 2, None),
        (2, "2024-01-01 12:00:00", None, None, None, None, 1, 1, None),
    ]
    assert len(run("breaking_news", feed(mentions=mentions), min_mentions=2)) == 1


def test_breaking_news_is_the_same_when_hot_events_are_spread(feed):
    start = datetime(2024, 1, 1)
    mentions = [_mention(n % 3 and 7, start + timedelta(seconds=41 * n), f"s{n % 11}") for n in range(300)]
    tables = feed(mentions=mentions)
    plain = [tuple(r) for r in breaking_news(tables).collect()]
    spread = [tuple(r) for r in breaking_news(tables, rows_per_task=10).collect()]
    assert plain == spread and len(plain) == 2


def test_religion_conflicts(feed):
    event = {**CONFLICT, "ActionGeo_CountryCode": "IN"}
    events = [
        {**event, "GLOBALEVENTID": 1, "Actor1Religion2Code": "HIN"},
        {**event, "GLOBALEVENTID": 2, "Actor2Religion1Code": "MOS", "Actor1Religion1Code": "HIN"},
        {**event, "GLOBALEVENTID": 3},
    ]
    assert run("religion_conflicts", feed(events)) == [
        ("Asia", "HIN", "MOS", 1, -2.0, -1.0), ("Asia", "HIN", "SIN_RELIGION", 1, -2.0, -1.0)
    ]


def test_themes_fall_back_and_blank_places_count(feed):
    gkg = [
        {"GKGRECORDID": "r1", "DATE": 20240101120000, "V2Locations": "1#P#US#A#B#1#2#F;",
         "V2Themes": "TAX,12;TAX,40; ,;WAR,1"},
        {"GKGRECORDID": "r1", "DATE": 20240101120000, "V2Locations": "1#P#US#A#B#1#2#F;",
         "V2Themes": "TAX,12"},
        {"GKGRECORDID": "r2", "DATE": 20240101, "V2Locations": "", "Locations": "1#P#XX#A#45#10#F",
         "Themes": "TAX;"},
        {"GKGRECORDID": "r3", "DATE": 20240101, "Locations": "1#P#US#A#45#10#F", "V2Themes": "",
         "Themes": "TAX"},
        {"GKGRECORDID": "r4", "DATE": 20240101, "Themes": "TAX"},
        {"GKGRECORDID": None, "DATE": 20240101, "V2Locations": "1#P#US", "Themes": "TAX"},
    ]
    assert run("themes_by_region_year", feed(gkg=gkg)) == [
        ("Europa", 2024, "TAX", 1, 1),
        ("Norteamérica", 2024, "TAX", 1, 1),
        ("Norteamérica", 2024, "WAR", 1, 2),
        ("Sin región", 2024, "TAX", 1, 1),
        ("Sin región", 2024, "WAR", 1, 2),
    ]


def test_places_and_themes_of_one_record_meet_across_its_rows(feed):
    gkg = [
        {"GKGRECORDID": "r", "DATE": 20240101, "V2Locations": "1#P#US"},
        {"GKGRECORDID": "r", "DATE": 20240101, "V2Themes": "WAR,1"},
    ]
    assert run("themes_by_region_year", feed(gkg=gkg)) == [("Norteamérica", 2024, "WAR", 1, 1)]


def test_organizations_by_day(feed):
    gkg = [
        {"GKGRECORDID": "a", "DATE": 20240101120000, "Organizations": "UN; un ;NATO;"},
        {"GKGRECORDID": "b", "DATE": 20240101, "Organizations": "Un"},
        {"GKGRECORDID": "c", "DATE": 20249901, "Organizations": "UN"},
        {"GKGRECORDID": "d", "DATE": 20240101},
    ]
    assert run("organizations_by_day", feed(gkg=gkg)) == [
        ("2024-01-01", "un", 2, 1), ("2024-01-01", "nato", 1, 2), (None, "un", 1, 1)
    ]


def test_tone_conflict_lag(feed):
    events = []
    for day, tone, conflicts in ((1, 1.0, 0), (2, 2.0, 1), (4, 3.0, 2), (5, 0.0, 3)):
        event = {"SQLDATE": 20240100 + day, "ActionGeo_CountryCode": "US", "AvgTone": tone}
        events += [{**event, "QuadClass": 4}] * conflicts + [{**event, "QuadClass": 1}]
    events.append({"SQLDATE": 20240101, "ActionGeo_CountryCode": "MX", "AvgTone": 1.0})
    assert run("tone_conflict_lag", feed(events)) == [("US", 3, 1.0, 2.0, 2.0)]


def test_source_diversity_counts_repeated_events(feed):
    events = [{"GLOBALEVENTID": 1, "ActionGeo_CountryCode": "US"}] * 2
    events += [{"GLOBALEVENTID": 2, "ActionGeo_CountryCode": "MX"}]
    mentions = [{"GLOBALEVENTID": 1, "MentionSourceName": s} for s in ("a", "b", "b", "b", " ", None)]
    mentions += [{"GLOBALEVENTID": 2, "MentionSourceName": "a"}, {"GLOBALEVENTID": 9, "MentionSourceName": "a"}]
    assert run("source_diversity", feed(events, mentions)) == [("US", 2, 8, 0.5623), ("MX", 1, 1, 0.0)]


def test_ethnic_conflicts_count_both_actors(feed):
    events = [
        {**CONFLICT, "GLOBALEVENTID": 1, "Actor1EthnicCode": "ara", "Actor2EthnicCode": "ara"},
        {**CONFLICT, "GLOBALEVENTID": 2, "Actor2EthnicCode": "kur"},
        {**CONFLICT, "GLOBALEVENTID": 3, "QuadClass": 2, "Actor1EthnicCode": "ara"},
    ]
    assert run("ethnic_conflicts", feed(events)) == [("ara", 2, 1, -2.0, -1.0), ("kur", 1, 1, -2.0, -1.0)]


def test_negative_actors(feed):
    events = [
        {"GLOBALEVENTID": 1, "Actor1Name": "A", "Actor2Name": "B", "AvgTone": -1.5, "QuadClass": 1},
        {"GLOBALEVENTID": 2, "Actor1Name": "A", "Actor2Name": " ", "QuadClass": 3},
        {"GLOBALEVENTID": 3, "Actor1Name": "A", "AvgTone": 1.0, "GoldsteinScale": 1.0, "QuadClass": 2},
    ]
    none = ("SIN_CODIGO", "SIN_PAIS", "SIN_TIPO")
    assert run("negative_actors", feed(events)) == [
        ("A", *none, "Actor1", "2", "2", "-1.5", None, "1", "50.00"),
        ("B", *none, "Actor2", "1", "1", "-1.5", None, "0", "0.00"),
    ]


def test_positive_events_rank_repeats_and_keep_ten(feed):
    event = {"ActionGeo_CountryCode": "US", "QuadClass": 1, "GoldsteinScale": 2.0, "SQLDATE": 20240101}
    events = [{**event, "GLOBALEVENTID": 1, "EventCode": "x"}] * 14
    events += [{**event, "GLOBALEVENTID": 2, "NumMentions": 3}, {**event, "GLOBALEVENTID": 3, "QuadClass": 4}]
    events += [{**event, "GLOBALEVENTID": 4, "GoldsteinScale": 0.0}]
    mentions = [{"GLOBALEVENTID": 1, "MentionSourceName": "a", "MentionDocTone": 1.5}]
    mentions += [{"GLOBALEVENTID": 2, "MentionSourceName": s} for s in ("a", "b")]
    got = run("positive_events_by_country", feed(events, mentions))
    assert [(r[0], r[1], r[14], r[15], r[16]) for r in got] == [("1", "2", "2", "2", "0.0")] + [
        (str(n), "1", "1", "1", "1.5") for n in range(2, 11)
    ]
    assert got[0][4] == "SIN_UBICACION" and got[0][17] == "SIN_URL"


def test_results_do_not_depend_on_mode_or_partitions(spark, ansi_off):
    from newsatlas.testbed.derived import derived_feed

    tables = derived_feed(spark, "/root/testdata/sf0.001")
    lenient = {a.name: [tuple(r) for r in a.build(tables).collect()] for a in ANALYSES}
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        for analysis in ANALYSES:
            assert [tuple(r) for r in analysis.build(tables).collect()] == lenient[analysis.name]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_feed_opens_tables_views_and_sql(spark, tmp_path, feed):
    tables = feed([{"GLOBALEVENTID": 1, "ActionGeo_CountryCode": "US"}])
    for name in ("events", "mentions", "gkg"):
        getattr(tables, name).write.parquet(f"{tmp_path}/{name}")
    opened = Feed.from_parquet(spark, str(tmp_path))
    opened.create_views()
    assert spark.sql("SELECT GLOBALEVENTID FROM events").first()[0] == 1
    assert Feed.from_catalog(spark).events.columns == tables.events.columns
