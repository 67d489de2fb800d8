"""How the registered queries build their input: by many tasks, whatever its size."""

import json
from datetime import datetime

from newsatlas import schemas, sources, streaming
from newsatlas.functions import feed_date, feed_timestamp_prefix
from newsatlas.plans import find
from newsatlas.testbed import checks, derived


def files(folder):
    return sorted(folder.glob("part-*"))


def events(n):
    return [{"GLOBALEVENTID": i, "SQLDATE": 20240101 + i % 3, "ActionGeo_CountryCode": "US" if i % 2 else "MX", "QuadClass": 4, "SOURCEURL": 'a "}{" b'} for i in range(n)]


def test_slices_have_many_files(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(checks, "_FILE_ROWS", 10)
    rows = feed(events=events(100))
    arrivals = checks._in_three_slices(rows, str(tmp_path))
    assert len(files(tmp_path / "events")) == 12
    taken = []
    arrivals.events.writeStream.foreachBatch(lambda batch, n: taken.append(batch.count())).option(
        "checkpointLocation", f"{tmp_path}/count"
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(taken) == 3 and sum(taken) == 100 and max(taken) <= 40
    streaming.refresh_increments(
        arrivals, f"{tmp_path}/states", f"{tmp_path}/history", f"{tmp_path}/check", analyses=["top_countries_by_day"]
    ).awaitTermination()
    analysis = find("top_countries_by_day")
    expected = analysis.build(rows)
    newest = checks._newest(spark, f"{tmp_path}/history", analysis.result).select(expected.columns)
    assert sorted(map(repr, newest.collect())) == sorted(map(repr, expected.collect())) != []


def test_a_slice_is_held_in_plain_columns(feed, tmp_path, monkeypatch):
    """As structs of all tables in one frame, they were not compressed, and a task read those of all tables for one of them."""
    held = []
    monkeypatch.setattr(streaming.cycle, "advance", lambda part, name, arrived, *_: held.extend(
        (t, getattr(arrived, t).is_cached, getattr(arrived, t).columns) for t in schemas.TABLES) or arrived.events.limit(0))
    monkeypatch.setattr(streaming.cycle, "append_results", lambda *_: None)
    arrivals = checks._in_three_slices(feed(events=events(3)), str(tmp_path))
    streaming.refresh_increments(
        arrivals, f"{tmp_path}/states", f"{tmp_path}/history", f"{tmp_path}/check", analyses=["top_countries_by_day"]
    ).awaitTermination()
    assert held[:3] == [(t, True, s.names) for t, s in schemas.TABLES.items()]


def test_files_of_a_large_array_are_one_array(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(checks, "_ARRAY_ROWS", 30)
    rows = make("events", *events(100))
    checks._land(rows, f"{tmp_path}/array", arrays=1)
    assert len(files(tmp_path / "array")) == 4
    text = "".join(f.read_text() for f in files(tmp_path / "array"))
    assert sorted(o["GLOBALEVENTID"] for o in json.loads(text)) == list(range(100))
    got = sources.read_json(spark, f"{tmp_path}/array", "events")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect()))


def test_batches_have_many_files(spark, tmp_path, monkeypatch):
    """One task wrote a batch, and as few read it."""
    monkeypatch.setattr(checks, "_FILE_ROWS", 20)
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "id div 100 AS part")
    stream = checks._arriving(rows, f"{tmp_path}/base", 4, "part")
    assert len(files(tmp_path / "base")) == 5 * 6
    taken = []
    stream.writeStream.foreachBatch(lambda batch, n: taken.append(sorted(batch.toPandas()["part"].unique().tolist()))).option(
        "checkpointLocation", f"{tmp_path}/check"
    ).trigger(availableNow=True).start().awaitTermination()
    assert taken == [[0], [0, 1], [1, 2], [2], [3]] and stream.sparkSession.read.parquet(f"{tmp_path}/base").count() == 400


def test_batches_without_enough_rows_keep_their_places(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checks, "_FILE_ROWS", 1)
    rows = spark.range(0, 8, 1, 1).selectExpr("id", "1 AS part")
    stream = checks._arriving(rows, f"{tmp_path}/base", 4, "part")
    taken = []
    stream.writeStream.foreachBatch(lambda batch, n: taken.append(batch.count())).option(
        "checkpointLocation", f"{tmp_path}/check"
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(taken) == 5 and sum(taken) == 8 and taken[2:] == [0, 0, 0]


def test_packed_moments_are_formatted_once(spark):
    """Spark put the formatting in the place of every reference to the packed number."""
    base = spark.createDataFrame([(1, datetime(2024, 1, 1), 2, "view")], "event_id long, ts timestamp, user_id long, event_type string")
    mentions = derived.news_mentions(base).select(feed_timestamp_prefix("MentionTimeDate").alias("t")).filter("t IS NOT NULL")
    events = derived.news_events(base).select(feed_date("SQLDATE").alias("day")).filter("day IS NOT NULL")
    for frame in (mentions, events):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("date_format") <= 3
        assert frame.count() > 0
