import glob
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsatlas import Feed, schemas, sources, streaming
from newsatlas.functions import feed_timestamp
from newsatlas.plans import find
from newsatlas.plans.bursts import breaking_news, mention_escalation_24h

START = datetime(2024, 1, 1)


def packed(moment):
    return int(moment.strftime("%Y%m%d%H%M%S"))


@pytest.fixture
def mentions(make):
    """Mentions over two days, one event with a third of them, and one late marker to close all."""
    random.seed(11)
    data = []
    for n in range(600):
        event = 1 if n % 3 == 0 else random.randrange(2, 30)
        moment = START + timedelta(seconds=random.randrange(172_800))
        data.append((moment, {"GLOBALEVENTID": event, "MentionTimeDate": packed(moment),
                              "MentionSourceName": random.choice(["a", "b", "c", None])}))
    data.sort(key=lambda pair: pair[0])
    return [row for _, row in data]


@pytest.fixture
def arrive(spark, make, tmp_path):
    """Stream of rows that arrive in the given batches, one file each."""

    def build(table, batches):
        path = f"{tmp_path}/arriving_{table}"
        for n, batch in enumerate(batches):
            make(table, *batch).coalesce(1).write.mode("append").parquet(path)
            newest = max((f for f in os.scandir(path) if f.name.endswith(".parquet")),
                         key=lambda f: f.stat().st_mtime_ns)
            os.utime(newest.path, (1_700_000_000 + n, 1_700_000_000 + n))
        reader = spark.readStream.schema(schemas.TABLES[table]).option("maxFilesPerTrigger", 1)
        return reader.parquet(path)

    return build


@pytest.fixture
def drain(spark, tmp_path):
    def run(stream, name):
        writer = stream.writeStream.format("parquet").option("path", f"{tmp_path}/{name}")
        query = writer.option("checkpointLocation", f"{tmp_path}/check_{name}").trigger(
            availableNow=True
        ).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}")

    return run


def batches_of(data, size):
    return [data[i:i + size] for i in range(0, len(data), size)]


def shuffled_nearby(data, minutes=10):
    """Out of order, but within the watermark delay."""
    random.seed(2)
    key = lambda row: datetime.strptime(str(row["MentionTimeDate"]), "%Y%m%d%H%M%S") + timedelta(
        minutes=random.uniform(0, minutes))
    return sorted(data, key=key)


def test_breaking_hours_equal_batch(spark, feed, mentions, arrive, drain):
    stream = arrive("mentions", batches_of(shuffled_nearby(mentions), 100))
    got = drain(streaming.breaking_hours(stream, keep_hours=1000), "breaking")
    batch = breaking_news(feed(mentions=mentions), top=10_000)
    expected = {
        (r.GLOBALEVENTID, r.primera_mencion, r.menciones_primera_hora, r.fuentes_primera_hora)
        for r in batch.collect()
    }
    rows = got.select("GLOBALEVENTID", F.date_format("first", "yyyy-MM-dd HH:mm:ss"), "mentions", "sources")
    assert {tuple(r) for r in rows.collect()} == expected and rows.count() == len(expected) == 29


def test_breaking_hours_forget_after_a_while(spark, make, arrive, drain):
    def at(hours, event=1):
        return {"GLOBALEVENTID": event, "MentionTimeDate": packed(START + timedelta(hours=hours))}

    stream = arrive("mentions", [[at(0)], [at(2)], [at(30, 2)], [at(31)], [at(40, 2)]])
    got = drain(streaming.breaking_hours(stream, keep_hours=6), "forget")
    starts = [(r.GLOBALEVENTID, r["first"].hour, r["first"].day) for r in got.collect()]
    assert sorted(starts) == [(1, 0, 1), (1, 7, 2), (2, 6, 2)]


@pytest.mark.parametrize("shares", [1, 3])
def test_breaking_hours_of_events_that_share_their_state(spark, make, arrive, tmp_path, monkeypatch, shares):
    monkeypatch.setattr(streaming.bursts, "_SHARES", shares)

    def at(hours, event):
        return {"GLOBALEVENTID": event, "MentionTimeDate": packed(START + timedelta(hours=hours)), "MentionSourceName": f"s{event}"}

    first = [at(n / 100 + m / 10, n) for n in range(40) for m in range(4)] + [at(1.2, 0), at(1.3, 1)]
    # Event 0 ends, event 50 begins meanwhile, 1 comes again while it is remembered, 2 when it is forgotten.
    batches = [first[::2], first[1::2], [at(2, 50), at(2.1, 1)], [at(20, 51)], [at(30, 2), at(30.5, 2)], [at(40, 52)], [at(41, 52)]]
    query = streaming.breaking_hours(arrive("mentions", batches), "1 hour", keep_hours=6).writeStream.option(
        "checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start(f"{tmp_path}/out", format="parquet")
    query.awaitTermination()
    got = sorted((r.GLOBALEVENTID, (r["first"] - START).total_seconds() / 3600, r.mentions, r.sources)
                 for r in spark.read.parquet(f"{tmp_path}/out").collect())
    expected = [(n, n / 100, 4, 1) for n in range(40)] + [(2, 30, 2, 1), (50, 2, 1, 1), (51, 20, 1, 1)]
    assert got == sorted(expected)
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= shares


def test_escalation_windows_equal_batch_counts(spark, feed, mentions, arrive, drain):
    stream = arrive("mentions", batches_of(mentions, 150))
    got = drain(streaming.escalation_windows(stream), "escalation")
    moments = [(m["GLOBALEVENTID"], datetime.strptime(str(m["MentionTimeDate"]), "%Y%m%d%H%M%S"))
               for m in mentions]
    limit = max(t for _, t in moments) - timedelta(hours=1)
    expected = {}
    for event, moment in moments:
        hour = moment.replace(minute=0, second=0)
        for back in range(24):
            start = hour - timedelta(hours=back)
            if start + timedelta(hours=24) <= limit:
                expected[event, start] = expected.get((event, start), 0) + 1
    assert {(r.GLOBALEVENTID, r.window_start): r.mentions_24h for r in got.collect()} == expected
    assert mention_escalation_24h(feed(mentions=mentions)).count() == 50


def test_slice_counts_wait_for_the_watermark(spark, mentions, arrive, drain):
    stream = arrive("mentions", batches_of(mentions, 200)).withColumn(
        "moment", feed_timestamp("MentionTimeDate")
    )
    got = drain(streaming.slice_counts(stream, "moment", ["GLOBALEVENTID"], "15 minutes"), "slices")
    expected = {}
    moments = [(m["GLOBALEVENTID"], datetime.strptime(str(m["MentionTimeDate"]), "%Y%m%d%H%M%S"))
               for m in mentions]
    limit = max(t for _, t in moments) - timedelta(minutes=15)
    for event, moment in moments:
        start = moment.replace(minute=moment.minute // 15 * 15, second=0)
        if start + timedelta(minutes=15) <= limit:
            expected[start, event] = expected.get((start, event), 0) + 1
    assert {(r.slice, r.GLOBALEVENTID): r.n for r in got.collect()} == expected


def test_first_seen_drops_repeats_of_later_batches(arrive, drain):
    def event(n, day):
        return {"GLOBALEVENTID": n, "SQLDATE": 20240100 + day, "EventCode": str(day)}

    stream = arrive("events", [[event(1, 1), event(2, 1)], [event(1, 1), event(3, 1)], [event(2, 2)]])
    got = drain(streaming.first_seen(stream, "3 days"), "first")
    assert sorted((r.GLOBALEVENTID, r.EventCode) for r in got.collect()) == [
        (1, "1"), (2, "1"), (3, "1")
    ]


def _land(root, table, name, data):
    os.makedirs(f"{root}/{table}", exist_ok=True)
    with open(f"{root}/{table}/{name}.json", "w") as file:
        json.dump(data, file, indent=2)


def test_cycle_from_landing_to_history(spark, tmp_path):
    landing, root, history, check = (f"{tmp_path}/{d}" for d in ("land", "tables", "history", "check"))

    def slice_of(n):
        moment = START + timedelta(minutes=15 * n)
        _land(landing, "events", n, [
            {"GLOBALEVENTID": {"$numberLong": str(n)}, "SQLDATE": 20240101, "QuadClass": 4,
             "GoldsteinScale": -1.0, "ActionGeo_CountryCode": "US", "AvgTone": 1.0}])
        _land(landing, "mentions", n, [{"GLOBALEVENTID": n, "MentionTimeDate": packed(moment),
                                        "MentionSourceName": "s"}])
        _land(landing, "gkg", n, [{"GKGRECORDID": f"r{n}", "DATE": packed(moment), "Themes": "A",
                                   "Locations": "1#P#US"}])

    def cycle():
        for table in schemas.TABLES:
            streaming.ingest(spark, landing, root, table, check, files_per_batch=1).awaitTermination()
        arrivals = spark.readStream.schema(schemas.MENTIONS).parquet(f"{root}/mentions")
        streaming.refresh(arrivals, root, history, check).awaitTermination()

    slice_of(1)
    slice_of(2)
    cycle()
    slice_of(3)
    cycle()
    cycle()  # nothing new: no batch, no results
    feed = Feed.from_parquet(spark, root)
    assert sorted(r[0] for r in feed.events.select("GLOBALEVENTID").collect()) == [1, 2, 3]
    heat = sources.read_results(spark, history, "mapa_calor_intensidad_conflictos")
    counts = [r.total_eventos_conflicto for r in heat.orderBy("created_at").collect()]
    assert counts == [2, 3]
    names = sources.stored_results(spark, history)
    assert names[0] == "mapa_calor_intensidad_conflictos" and "noticias_ultima_hora" in names
    assert "conflictos_pares_paises" not in names


def test_first_seen_keeps_older_events_that_are_new(arrive, drain):
    def event(n, day):
        return {"GLOBALEVENTID": n, "SQLDATE": day, "EventCode": "1"}

    stream = arrive("events", [[event(1, 20240105)], [event(2, 20240105)], [event(3, 20240104), event(1, 20240105)], [event(4, 20230105)]])
    got = drain(streaming.first_seen(stream), "older")
    assert sorted(r.GLOBALEVENTID for r in got.collect()) == [1, 2, 3, 4]


def test_loaded_and_arriving_rows_are_in_one_table(spark, tmp_path, make):
    landing, root, check = (f"{tmp_path}/{d}" for d in ("land", "tables", "check"))
    sources.write_table(make("events", {"GLOBALEVENTID": 1, "SQLDATE": 20240101}), root, "events")
    _land(landing, "events", "a", [{"GLOBALEVENTID": 2, "SQLDATE": 20240101}])
    streaming.ingest(spark, landing, root, "events", check).awaitTermination()
    sources.write_table(make("events", {"GLOBALEVENTID": 3, "SQLDATE": 20240102}), root, "events")
    _land(landing, "events", "b", [{"GLOBALEVENTID": 4, "SQLDATE": 20240103}])
    streaming.ingest(spark, landing, root, "events", check).awaitTermination()
    stored = spark.read.schema(schemas.EVENTS).parquet(f"{root}/events")
    assert sorted(r.GLOBALEVENTID for r in stored.collect()) == [1, 2, 3, 4]


def test_a_repeated_batch_is_stored_once(spark, tmp_path):
    landing, root, check = (f"{tmp_path}/{d}" for d in ("land", "tables", "check"))
    _land(landing, "events", "a", [{"GLOBALEVENTID": 2, "SQLDATE": 20240101}])
    streaming.ingest(spark, landing, root, "events", check).awaitTermination()
    os.remove(f"{check}/ingest_events/commits/0")  # as if the stream had ended before noting its batch
    for crc in glob.glob(f"{check}/ingest_events/commits/.0.crc"):
        os.remove(crc)
    streaming.ingest(spark, landing, root, "events", check).awaitTermination()
    assert spark.read.parquet(f"{root}/events").count() == 1


def test_a_stamp_in_the_future_moves_nothing(arrive, drain):
    def mention(stamp, n=1):
        return {"GLOBALEVENTID": n, "MentionTimeDate": stamp, "MentionSourceName": "s"}

    days = [[mention(20990101000000), mention(20240101000000)], [mention(20240101000100)], [mention(20240101001000)], [mention(20240102000000)]]
    moments = arrive("mentions", days).withColumn("moment", F.to_timestamp(F.col("MentionTimeDate").cast("string"), "yyyyMMddHHmmss"))
    got = {r.slice.isoformat(): r.n for r in drain(streaming.slice_counts(moments, "moment", []), "future").collect()}
    assert got["2024-01-01T00:00:00"] == 3


def _forget_commits(checkpoint, batch=0):
    """As if the stream had ended before it noted its batch."""
    for path in glob.glob(f"{checkpoint}/commits/{batch}") + glob.glob(f"{checkpoint}/commits/.{batch}.crc"):
        os.remove(path)


def test_a_batch_that_was_cut_short_is_completed_by_the_next_start(spark, tmp_path, monkeypatch):
    """One of its three days was published when the stream ended; the others follow, and nothing comes twice."""
    from newsatlas.sources import landing

    landing_, root, check = (f"{tmp_path}/{d}" for d in ("land", "tables", "check"))
    _land(landing_, "events", "a", [{"GLOBALEVENTID": n, "SQLDATE": 20240101 + n % 3} for n in range(30)])
    publish, days = landing._publish, []

    def cut_short(session, staged, table, day, *rest):
        if days:
            raise OSError("lost")
        days.append(day)
        publish(session, staged, table, day, *rest)

    monkeypatch.setattr(landing, "_publish", cut_short)
    with pytest.raises(Exception, match="lost"):
        streaming.ingest(spark, landing_, root, "events", check).awaitTermination()
    assert spark.read.parquet(f"{root}/events").count() == 10
    monkeypatch.setattr(landing, "_publish", publish)
    for _ in range(2):
        streaming.ingest(spark, landing_, root, "events", check).awaitTermination()
        _forget_commits(f"{check}/ingest_events")
    rows = spark.read.schema(schemas.EVENTS).parquet(f"{root}/events").select("GLOBALEVENTID").collect()
    assert sorted(r[0] for r in rows) == list(range(30))


def test_a_repeated_refresh_counts_nothing_twice(spark, make, tmp_path):
    events = [{"GLOBALEVENTID": n % 7, "SQLDATE": 20240101, "ActionGeo_CountryCode": "US", "NumMentions": 2, "AvgTone": 1.5} for n in range(9)]
    for table, rows in (("events", events), ("mentions", []), ("gkg", [])):
        make(table, *rows).coalesce(1).write.parquet(f"{tmp_path}/{table}")

    def cycle():
        feed = Feed(**{t: spark.readStream.schema(s).parquet(f"{tmp_path}/{t}") for t, s in schemas.TABLES.items()})
        names = ["top_countries_by_day", "sentiment_trend"]
        streaming.refresh_increments(feed, f"{tmp_path}/states", f"{tmp_path}/history", f"{tmp_path}/check", analyses=names).awaitTermination()

    cycle()
    _forget_commits(f"{tmp_path}/check/refresh_increments")
    cycle()
    for name, columns in (("top_countries_by_day", ("total_eventos", "total_menciones")), ("sentiment_trend", ("total_eventos",))):
        stored = sources.read_results(spark, f"{tmp_path}/history", find(name).result)
        assert [tuple(r) for r in stored.select(*columns).collect()] == [(7, 18)[: len(columns)]] * 2
