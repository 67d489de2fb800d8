"""Results brought up to date slice by slice, against the batch analyses over everything so far."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from newsatlas import Feed, schemas, sources, streaming
from newsatlas.functions import combined_moments, distinct_sketch, merged_sketches, moments, pearson, pearson_of, sketch_estimate
from newsatlas.plans import INCREMENTAL, find
from newsatlas.plans.partials import advance, advance_joined, Joined


def event(rng, n):
    code = lambda values: rng.choice(values)
    return {
        "GLOBALEVENTID": rng.choice([n, rng.randrange(30), None]),
        "SQLDATE": rng.choice([20240101, 20240102, 20240103, 99999999, None]),
        "QuadClass": rng.randint(1, 4),
        "ActionGeo_CountryCode": code(["US", "MX", "", None]),
        "ActionGeo_Lat": code([1.5, -20.25, None]),
        "ActionGeo_Long": code([10.0, None]),
        "GoldsteinScale": code([1.0, -2.5, 4.25, None]),
        "AvgTone": code([0.5, -3.0, 2.75, None]),
        "NumMentions": code([1, 2, None]),
        "NumSources": code([1, 3, None]),
        "NumArticles": code([4, None]),
        "Actor1CountryCode": code(["USA", "MEX", " ", None]),
        "Actor2CountryCode": code(["USA", "BRA", None]),
        "Actor1Religion1Code": code(["CHR", None]),
        "Actor2Religion2Code": code(["MOS", None]),
        "Actor1EthnicCode": code(["ara", None]),
        "Actor2EthnicCode": code(["kur", "ara", None]),
        "EventCode": code(["010", "020", None]),
        "EventRootCode": code(["01", None]),
        "CAMEOCodeDescription": code(["d", None]),
        **{f"Actor{a}Type{t}Code": code(["GOV", "MIL", "REB", "BUS", None]) for a in (1, 2) for t in (1, 2, 3)},
        **{f"Actor{a}Name": code(["A", "B", " ", None]) for a in (1, 2)},
        **{f"Actor{a}Code": code(["X", None]) for a in (1, 2)},
    }


def mention(rng, n):
    return {
        "GLOBALEVENTID": rng.choice([n, rng.randrange(30), 7, None]),
        "MentionTimeDate": 20240101000000,
        "MentionSourceName": rng.choice(["a", "b", "c", " ", None]),
    }


def record(rng, n):
    return {
        "GKGRECORDID": rng.choice([f"r{n}", f"r{rng.randrange(20)}", None]),
        "DATE": rng.choice([20240101120000, 20240102000000, 99999999, None]),
        "Organizations": rng.choice(["Un Agency;WHO", " who ;x;", "", None]),
    }


@pytest.fixture
def slices():
    rng = random.Random(5)
    return [
        ([event(rng, n) for n in range(80)], [mention(rng, n) for n in range(90)], [record(rng, n) for n in range(50)])
        for _ in range(3)
    ]


def sorted_rows(frame):
    return sorted(map(repr, frame.collect()))


def step(name, arrived, store, batch, **more):
    part = INCREMENTAL[name]
    run = advance_joined if isinstance(part, Joined) else advance
    return run(part, name, arrived, store, batch, **more)


@pytest.mark.parametrize("name", list(INCREMENTAL))
def test_states_equal_batch_analyses(spark, feed, slices, tmp_path, name):
    store = sources.StateStore(spark, f"{tmp_path}/states")
    events, mentions, gkg = [], [], []
    for batch, (e, m, g) in enumerate(slices):
        events, mentions, gkg = events + e, mentions + m, gkg + g
        arrived = feed(events=e, mentions=m, gkg=g)
        result = sorted_rows(step(name, arrived, store, batch))
        assert result == sorted_rows(find(name).build(feed(events=events, mentions=mentions, gkg=gkg))) != []
        # A repeated batch counts nothing twice.
        assert sorted_rows(step(name, arrived, store, batch)) == result
    empty = feed()
    assert sorted_rows(step(name, empty, store, 3)) == result


@pytest.mark.parametrize("name", ["sentiment_trend", "source_diversity"])
def test_a_first_batch_without_rows(spark, feed, slices, tmp_path, name):
    store = sources.StateStore(spark, f"{tmp_path}/states")
    assert step(name, feed(), store, 0).collect() == []
    arrived = feed(events=slices[0][0], mentions=slices[0][1])
    assert sorted_rows(step(name, arrived, store, 1)) == sorted_rows(find(name).build(arrived))


def test_sketched_counts(spark, feed, tmp_path):
    store = sources.StateStore(spark, f"{tmp_path}/states")
    def rows(a, b):
        return [{"GLOBALEVENTID": n, "SQLDATE": 20240101, "ActionGeo_CountryCode": "US"} for n in range(a, b)]
    for batch, (a, b) in enumerate([(0, 300), (200, 500), (0, 10)]):
        [row] = step("top_countries_by_day", feed(events=rows(a, b)), store, batch, approximate=True).collect()
    assert abs(row.total_eventos - 500) <= 15


def test_sketches_and_moments_of_parts_are_those_of_the_whole(spark):
    rows = spark.range(30_000).selectExpr("id % 7001 AS id", "id % 3 AS part", "cast(id * 37 % 101 AS double) + 1e6 AS x",
                                          "if(id % 11 = 0, NULL, cast(id * 17 % 97 AS double)) AS y")
    parts = rows.groupBy("part").agg(distinct_sketch(F.col("id")).alias("s"), moments(F.col("x"), F.col("y")).alias("m"))
    merged = parts.agg(sketch_estimate(merged_sketches(F.col("s"))).alias("n"), combined_moments(F.collect_list("m")).alias("m"))
    got = merged.select("n", pearson_of(F.col("m")).alias("r"), "m.n").first()
    whole = rows.agg(sketch_estimate(distinct_sketch(F.col("id"))), pearson(F.col("x"), F.col("y")), F.count("y")).first()
    assert got[0] == whole[0] and abs(got[0] - 7001) < 0.03 * 7001
    assert got[1] == pytest.approx(whole[1], abs=1e-9) and got[2] == whole[2]
    nothing = rows.filter("false").agg(moments(F.col("x"), F.col("y")).alias("m"))
    assert nothing.select(pearson_of(F.col("m"))).first()[0] is None


def test_states_survive_half_written_folders_and_are_folded(spark, tmp_path):
    store = sources.StateStore(spark, f"{tmp_path}/states")
    def frame(n):
        return spark.createDataFrame([(n, n % 2)], "n long, day long")
    for n in range(7):
        store.append(frame(n), "log", n, by="day", most_parts=3)
    (tmp_path / "states/log/batches=000000000009-000000000009").mkdir()  # begun, never finished
    schema = frame(0).schema
    assert sorted(r.n for r in store.log("log", 7, schema).collect()) == list(range(7))
    assert sorted(r.n for r in store.log("log", 20, schema, F.col("day") == 1).collect()) == [1, 3, 5]
    assert len(list((tmp_path / "states/log").iterdir())) < 7
    for n in range(4):
        store.put(frame(n), "state", n)
    assert [store.version("state", b, schema).first().n for b in (9, 3)] == [3, 2]
    assert store.version("state", 2, schema) is None  # only the newest and the one before it stay
    assert store.version("none", 5, schema) is None and store.log("none", 5, schema) is None


def test_stream_reads_only_new_slices(spark, make, feed, slices, tmp_path):
    """The first slice is gone from the disk when the second one comes."""
    names = ["conflict_heatmap", "top_countries_by_day", "source_diversity", "tone_source_correlation"]
    history = f"{tmp_path}/history"

    def arrive(n):
        for table, rows in zip(("events", "mentions"), slices[n]):
            make(table, *rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{table}")
        make("gkg").coalesce(1).write.mode("append").parquet(f"{tmp_path}/gkg")

    def cycle():
        tables = {t: spark.readStream.schema(s).parquet(f"{tmp_path}/{t}") for t, s in schemas.TABLES.items()}
        streaming.refresh_increments(Feed(**tables), f"{tmp_path}/states", history, f"{tmp_path}/check", analyses=names).awaitTermination()

    arrive(0)
    cycle()
    for table in schemas.TABLES:
        shutil.rmtree(f"{tmp_path}/{table}")
    arrive(1)
    cycle()
    cycle()  # nothing new
    so_far = feed(events=slices[0][0] + slices[1][0], mentions=slices[0][1] + slices[1][1])
    for name in names:
        stored = sources.read_results(spark, history, find(name).result)
        newest = stored.filter(F.col("created_at") == stored.agg(F.max("created_at")).first()[0])
        assert stored.select("created_at").distinct().count() == 2
        expected = find(name).build(so_far)
        assert sorted_rows(newest.select(expected.columns)) == sorted_rows(expected)
