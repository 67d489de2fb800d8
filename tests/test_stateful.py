"""Streams with state: bursts, countries, speeds and first hours, over batches in and out of order."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from newsatlas import schemas, streaming
from newsatlas.plans.bursts import breaking_news, mention_escalation_24h
from newsatlas.sources.history import RETENTION

START = datetime(2024, 1, 1)
_STORE = "spark.sql.streaming.stateStore.providerClass"


def at(minutes, event=1, source="s"):
    moment = START + timedelta(minutes=minutes)
    return {"GLOBALEVENTID": event, "MentionTimeDate": int(moment.strftime("%Y%m%d%H%M%S")), "MentionSourceName": source}


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(_STORE, before)


@pytest.fixture
def arrive(spark, make, tmp_path):
    def build(table, batches):
        path = f"{tmp_path}/arriving_{table}"
        for n, batch in enumerate(batches):
            make(table, *batch).coalesce(1).write.mode("append").parquet(path)
            newest = max((f for f in os.scandir(path) if f.name.endswith(".parquet")), key=lambda f: f.stat().st_mtime_ns)
            os.utime(newest.path, (1_700_000_000 + n,) * 2)
        return spark.readStream.schema(schemas.TABLES[table]).option("maxFilesPerTrigger", 1).parquet(path)

    return build


@pytest.fixture
def drain(spark, tmp_path):
    def run(stream, name):
        writer = stream.writeStream.format("parquet").option("path", f"{tmp_path}/{name}")
        query = writer.option("checkpointLocation", f"{tmp_path}/check_{name}").trigger(availableNow=True).start()
        query.awaitTermination()
        run.progress = query.recentProgress
        return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}")

    return run


def minutes(moment):
    return (moment - START).total_seconds() / 60


def bursts_of(frame):
    return sorted((r.GLOBALEVENTID, minutes(r.burst_start), minutes(r.burst_end), r.mentions) for r in frame.collect())


def test_a_late_mention_makes_two_bursts_one(arrive, drain):
    batches = [
        [at(0), at(10), at(100), at(0, 2), at(61, 2)],
        [at(55), at(130), at(31, 2)],  # closes the gap between 10 and 100 only together with the next
        [at(80), at(25), at(500, 2)],
        [at(2000, 3), {"GLOBALEVENTID": None, "MentionTimeDate": 20240101000000}, {"GLOBALEVENTID": 1, "MentionTimeDate": 20240199000000}],
        [at(4000, 3)],
    ]
    got = bursts_of(drain(streaming.mention_bursts(arrive("mentions", batches), 30, "3 hours"), "bursts"))
    assert got == [(1, 0, 130, 7), (2, 0, 0, 1), (2, 31, 61, 2), (2, 500, 500, 1), (3, 2000, 2000, 1)]


def test_bursts_meet_at_exactly_the_gap(arrive, drain):
    batches = [[at(0), at(60, 2)], [at(30), at(90.5, 2)], [at(3000, 9)], [at(3001, 9)]]
    got = bursts_of(drain(streaming.mention_bursts(arrive("mentions", batches), 30, "2 hours"), "exact"))
    assert got == [(1, 0, 30, 2), (2, 60, 60, 1), (2, 90.5, 90.5, 1)]


def test_bursts_of_a_busy_event_equal_brute_force(arrive, drain):
    rng = random.Random(4)
    data = sorted((rng.uniform(0, 3000), 1 if rng.random() < 0.4 else rng.randint(2, 12)) for _ in range(700))
    late = sorted(data, key=lambda r: r[0] + rng.uniform(0, 100))
    batches = [[at(m, e) for m, e in late[i : i + 120]] for i in range(0, 700, 120)] + [[at(9000, 99)]]
    got = bursts_of(drain(streaming.mention_bursts(arrive("mentions", batches), 5, "3 hours"), "busy"))
    expected = {}
    for m, e in sorted((int(m * 60), e) for m, e in data):
        own = expected.setdefault(e, [])
        if own and m - own[-1][1] <= 300:
            own[-1][1:] = [m, own[-1][2] + 1]
        else:
            own.append([m, m, 1])
    assert got == sorted((e, a / 60, b / 60, n) for e, own in expected.items() for a, b, n in own)


def event(n, day, country="US"):
    return {"GLOBALEVENTID": n, "SQLDATE": 20240100 + day, "ActionGeo_CountryCode": country}


def test_country_slices_with_late_events_on_either_side(arrive, drain):
    day = 24 * 60
    mentions = [[at(5), at(6), at(20, 2), at(7, 3)], [at(day + 3), at(2 * day, 4)], [at(30 * day, 9)], [at(60 * day, 9)], [at(90 * day, 9)]]
    events = [
        [event(2, 1, "MX"), event(3, 2, "BR")],  # 3 is of a later day than its mention
        [event(1, 1), event(1, 1, "CA"), event(4, 1, None)],  # later than its mentions, within the delay
        [event(8, 30)],
        [event(7, 61)],
        [event(7, 91)],
    ]
    stream = streaming.country_slices(arrive("mentions", mentions), arrive("events", events), "1 hour", "2 days", "7 days")
    got = sorted((minutes(r.slice), r.pais, r.menciones) for r in drain(stream, "countries").collect())
    assert got == [(0, "CA", 2), (0, "US", 2), (15, "MX", 1), (day, "CA", 1), (day, "US", 1)]
    # What is too old for a partner has left the state.
    joins = [o for p in drain.progress for o in p["stateOperators"] if o["operatorName"] == "symmetricHashJoin"]
    assert max(o["numRowsTotal"] for o in joins) > 4 and joins[-1]["numRowsTotal"] <= 4


@pytest.fixture
def data():
    rng = random.Random(11)
    rows = sorted((rng.uniform(0, 4000), 1 if n % 3 == 0 else rng.randrange(2, 30), rng.choice(["a", "b", "c", None])) for n in range(600))
    return [at(*row) for row in rows]


def in_batches(data, size):
    return [data[i : i + size] for i in range(0, len(data), size)] + [[at(9000, 99)]]


def test_speeds_equal_the_batch_analysis(spark, rocksdb, feed, data, arrive, drain):
    stream = streaming.escalation_speeds(arrive("mentions", in_batches(data, 90)))
    got = drain(stream, "speeds").filter("acceleration > 0")
    batch = mention_escalation_24h(feed(mentions=data), top=100_000)
    expected = {
        (r.GLOBALEVENTID, r.hora, r.menciones_hora, r.menciones_ultimas_24h, r.menciones_24h_previas, r.aceleracion_menciones)
        for r in batch.collect()
    }
    rows = got.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss")).select("GLOBALEVENTID", "hour", "mentions", "mentions_24h",
                                                                                       "mentions_24h_before", "acceleration")
    assert {tuple(r) for r in rows.collect()} == expected and len(expected) > 100


def test_speeds_of_a_forgotten_event_begin_again(rocksdb, arrive, drain):
    batches = [[at(0), at(1)], [at(70)], [at(600, 2)], [at(5000, 2)], [at(5010)], [at(9000, 2)], [at(9500, 2)]]
    stream = streaming.escalation_speeds(arrive("mentions", batches), keep=timedelta(days=2))
    rows = drain(stream, "forgotten").filter("GLOBALEVENTID = 1").orderBy("hour")
    assert [(r.mentions, r.mentions_24h, r.mentions_24h_before) for r in rows.collect()] == [(2, 2, 0), (1, 3, 2), (1, 1, 0)]


def test_first_hours_equal_the_batch_analysis(rocksdb, feed, data, arrive, drain):
    stream = streaming.first_hours(arrive("mentions", in_batches(data, 90)), keep=timedelta(days=100))
    got = drain(stream, "hours")
    rows = got.filter("GLOBALEVENTID < 99").select("GLOBALEVENTID", F.date_format("first", "yyyy-MM-dd HH:mm:ss"), "mentions", "sources")
    expected = {
        (r.GLOBALEVENTID, r.primera_mencion, r.menciones_primera_hora, r.fuentes_primera_hora)
        for r in breaking_news(feed(mentions=data), top=10_000).collect()
    }
    assert {tuple(r) for r in rows.collect()} == expected and rows.count() == len(expected) == 29


def test_state_of_idle_events_goes_after_the_retention_of_results(rocksdb, arrive, drain):
    assert RETENTION == timedelta(hours=6)
    batches = [[at(n, n, f"s{n % 4}") for n in range(1, 40)], [at(300, 50)], [at(900, 51)], [at(1500, 52)], [at(2100, 53)]]
    rows = drain(streaming.first_hours(arrive("mentions", batches)), "idle").collect()
    assert sorted(r.GLOBALEVENTID for r in rows) == [*range(1, 40), 50, 51, 52]
    held = [o["numRowsTotal"] for p in drain.progress for o in p["stateOperators"] if o["operatorName"].startswith("transformWithState")]
    assert max(held) >= 39 and held[-1] < 15


def test_the_state_store_is_checked(make):
    with pytest.raises(ValueError, match="RocksDB"):
        streaming.first_hours(make("mentions"))


class _Handle:
    """State of one event that counts how often it is reached."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, *_):
        return self

    def __getattr__(self, name):
        def reach(*arguments):
            self.calls += 1
            if name == "get":
                return self.value
            if name in ("update", "clear"):
                self.value = arguments[0] if arguments else None
            elif name not in ("registerTimer", "deleteTimer"):
                raise AttributeError(name)

        return reach


def test_state_of_a_first_hour_is_reached_a_few_times_whatever_the_sources():
    handle, processor = _Handle(), streaming.stateful._FirstHour(100)
    processor.init(handle)
    rows = [Row(second=5000 - n, source=f"s{n % 40}", n=2) for n in range(4000)]
    assert list(processor.handleInputRows((1,), iter(rows), None)) == [] and handle.calls == 3
    later = [Row(second=4601, source="s1", n=1), Row(second=4602, source="new", n=1)]
    list(processor.handleInputRows((1,), iter([Row(second=1001 + 3600, source="late", n=1), *later]), None))
    assert handle.calls == 5
    assert [tuple(r) for r in processor.handleExpiredTimer((1,), None, None)] == [(1, 1001, 2 * 3600, 40)]
    list(processor.handleInputRows((1,), iter(rows), None))  # the hour is over
    assert handle.value == (1001, 7200, [], True)
    assert list(processor.handleExpiredTimer((1,), None, None)) == [] and handle.value is None


def test_state_of_speeds_is_reached_a_few_times_whatever_the_hours():
    handle, processor = _Handle(), streaming.stateful._Speed(100)
    processor.init(handle)
    out = list(processor.handleInputRows((1,), iter([Row(hour=3600 * h, n=h + 1) for h in range(20)]), None))
    assert handle.calls == 3 and tuple(out[-1]) == (1, 3600 * 19, 20, 210, 190)
    out = list(processor.handleInputRows((1,), iter([Row(hour=3600 * 26, n=5)]), None))
    assert handle.calls == 7 and [tuple(r) for r in out] == [(1, 3600 * 26, 5, 210 - 3 + 5, 210)]
