import json
import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from newsatlas import Feed, sources
from newsatlas.plans import ANALYSES, catalog, find, run_all


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        json.dump(data, file, indent=4)


def test_read_landing_types_every_form_of_integer(spark, tmp_path, rows):
    write(f"{tmp_path}/events.json", [
        {"GLOBALEVENTID": 1, "SQLDATE": {"$numberLong": "20240105"}, "QuadClass": 4, "AvgTone": -1.5},
        {"GLOBALEVENTID": {"$numberLong": "2"}, "SQLDATE": 20240106.0, "EventCode": "010", "new": 1},
        {"GLOBALEVENTID": "x", "SQLDATE": None, "QuadClass": "3"},
    ])
    write(f"{tmp_path}/mentions.json", [{"GLOBALEVENTID": 1, "MentionTimeDate": 20240105120000}])
    write(f"{tmp_path}/gkg.json", [{"GKGRECORDID": "r", "DATE": 20240105120000, "Themes": "A;B"}])
    feed = sources.read_landing(spark, str(tmp_path))
    got = rows(feed.events.select("GLOBALEVENTID", "SQLDATE", "QuadClass", "AvgTone", "EventCode"))
    assert got == [(1, 20240105, 4, -1.5, None), (2, 20240106, None, None, "010"),
                   (None, None, 3, None, None)]
    assert rows(feed.mentions)[0][:2] == (1, 20240105120000)
    assert rows(feed.gkg.select("DATE", "Themes")) == [(20240105120000, "A;B")]


def test_unwrap_number_long(spark, rows):
    df = spark.createDataFrame(
        [("5", "a", 1.5), (None, "b", None), ("x", "c", 2.0)], "n string, s string, d double"
    ).select(F.struct(F.col("n").alias("$numberLong")).alias("a.n"), "s", F.struct("d").alias("t"))
    out = sources.unwrap_number_long(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "string", "struct<d:double>"]
    assert [r[0] for r in rows(out)] == [5, None, None]


def test_drop_empty_columns(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert sources.drop_empty_columns(df).columns == ["a", "b"]
    assert sources.drop_empty_columns(df.limit(0)).columns == ["a", "b", "c"]


def test_table_days_are_replaced_or_appended(spark, tmp_path, make, rows):
    def day(n, event):
        return {"SQLDATE": 20240100 + n, "GLOBALEVENTID": event}

    sources.write_table(make("events", day(1, 1), day(2, 2)), str(tmp_path), "events")
    sources.write_table(make("events", day(2, 3)), str(tmp_path), "events")
    sources.write_table(make("events", day(1, 4)), str(tmp_path), "events", replace_days=True)
    stored = spark.read.parquet(f"{tmp_path}/events")
    assert sorted(rows(stored.select("GLOBALEVENTID"))) == [(2,), (3,), (4,)]
    assert sorted(d for d in os.listdir(f"{tmp_path}/events") if d.startswith("event")) == [
        "event_date=2024-01-01", "event_date=2024-01-02"
    ]


def test_write_json_keeps_nulls_and_formats_times(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string").select(
        "*",
        F.lit("2024-01-02").cast("date").alias("d"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("t"),
    )
    sources.write_json(df, f"{tmp_path}/out")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert [json.loads(line) for line in lines] == [
        {"a": 1, "b": None, "d": "2024-01-02", "t": "2024-01-02 03:04:05"}
    ]


NOW = datetime(2024, 1, 2, 12, 30)


def test_history_is_appended_hidden_and_expired(spark, tmp_path, rows):
    root = str(tmp_path)
    df = spark.createDataFrame([("US", 1), ("MX", 2)], "pais string, n int")
    for age in (timedelta(), timedelta(hours=5, minutes=59), timedelta(hours=6), timedelta(hours=9)):
        sources.append_results(df, root, "r", NOW - age)
    stored = sources.read_results(spark, root, "r")
    assert stored.count() == 8
    live = sources.live_results(stored, NOW)
    assert live.count() == 4
    assert rows(sources.history_page(live)) == [("MX", 2), ("US", 1)]
    # The hour of 06:30 holds live rows too; only that of 03:30 goes.
    assert sources.expire_results(spark, root, NOW) == 1
    assert sources.read_results(spark, root, "r").count() == 6


def test_retention_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    sources.append_results(df, str(tmp_path), "r", NOW)
    live = sources.live_results(sources.read_results(spark, str(tmp_path), "r"), NOW)
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_hour" in plan


def test_empty_result_leaves_no_trace(spark, tmp_path):
    df = spark.createDataFrame([], "n int")
    sources.append_results(df, str(tmp_path), "r", NOW)
    assert sources.stored_results(spark, str(tmp_path)) == []
    assert sources.stored_results(spark, f"{tmp_path}/nowhere") == []


def test_catalog_order_and_hidden_names():
    known = [a.result for a in ANALYSES]
    names = ["zeta", "startup_log", "system.x", known[3], "alpha", known[0]]
    assert catalog.listed(names) == [known[0], known[3], "alpha", "zeta"]
    assert catalog.title_of("zeta") == "zeta"
    assert catalog.title_of(known[2]) == "Correlación entre AvgTone y número de fuentes noticiosas"
    assert len(known) == len(set(known)) == 19
    assert find("conflict_heatmap").on_map and find("nothing") is None


def test_summary_counts_distinct_and_stored_rows(spark, tmp_path, rows):
    root, known = str(tmp_path), "conflictos_pares_paises"
    df = spark.createDataFrame([("US", 1), ("MX", None)], "pais string, n int")
    for hours in (0, 1):
        sources.append_results(df, root, known, NOW - timedelta(hours=hours))
        sources.append_results(df.limit(1), root, "other", NOW)
    names = sources.stored_results(spark, root)
    got = rows(sources.summary({n: sources.read_results(spark, root, n) for n in names}))
    assert got == [
        (known, "Pares de países que entran en conflicto con mayor frecuencia", True, 2, 4),
        ("other", "other", False, 1, 2),
    ]


def test_run_all_survives_a_failing_analysis(spark, feed, tmp_path):
    done = []

    def store(analysis, df):
        if analysis.name == "cameo_by_region":
            raise ValueError("disk full")
        done.append((analysis.result, df.columns))

    failures = run_all(feed(), store)
    assert list(failures) == ["cameo_by_region"] and len(done) == 18
    with pytest.raises(ValueError):
        raise failures["cameo_by_region"]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_expiry_follows_no_time_zone(spark, tmp_path, zone):
    df = spark.createDataFrame([(1,)], "n int")
    now = datetime.now(timezone.utc)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for age in (0, 3, 8):
            sources.append_results(df, str(tmp_path), "r", now - timedelta(hours=age))
        assert sources.live_results(sources.read_results(spark, str(tmp_path), "r"), now).count() == 2
        assert sources.expire_results(spark, str(tmp_path), now) == 1
        assert sources.read_results(spark, str(tmp_path), "r").count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stored_columns_may_differ_or_be_none(spark, tmp_path, rows):
    root = str(tmp_path)
    assert sources.read_results(spark, root, "r").count() == 0
    sources.append_results(spark.createDataFrame([(1,)], "n int"), root, "r", NOW)
    sources.append_results(spark.createDataFrame([(2, "x")], "n int, more string"), root, "r", NOW + timedelta(hours=1))
    stored = sources.read_results(spark, root, "r")
    assert sorted(rows(stored.select("n", "more"))) == [(1, None), (2, "x")]
    assert rows(sources.summary({})) == []
    assert rows(sources.summary_totals(sources.summary({}))) == [(0, 0, 0)]
    assert rows(sources.summary_totals(sources.summary({"r": stored}))) == [(1, 2, 2)]


def test_days_between_are_the_only_ones_read(spark, tmp_path, make, rows):
    for table, column in (("events", "SQLDATE"), ("mentions", "MentionTimeDate"), ("gkg", "DATE")):
        days = [20240100 + d if table == "events" else (20240100 + d) * 1_000_000 for d in (1, 2, 3)]
        sources.write_table(make(table, *({column: d} for d in days)), str(tmp_path), table)
    part = Feed.from_parquet(spark, str(tmp_path)).between(date(2024, 1, 2), date(2024, 1, 3))
    assert [part.events.count(), part.mentions.count(), part.gkg.count()] == [2, 2, 2]
    plan = part.gkg._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_named_batch_is_stored_once_and_days_that_lack_follow(spark, tmp_path, make, rows, monkeypatch):
    from newsatlas.sources import landing

    data = make("events", *[{"SQLDATE": 20240100 + d, "GLOBALEVENTID": d} for d in (1, 2, 3)], {"GLOBALEVENTID": 9})
    publish, done = landing._publish, []

    def cut_short(*arguments):
        if len(done) == 2:
            raise OSError("lost")
        done.append(publish(*arguments))

    monkeypatch.setattr(landing, "_publish", cut_short)
    with pytest.raises(OSError):
        sources.write_table(data, str(tmp_path), "events", batch="b1")
    stored = spark.read.parquet(f"{tmp_path}/events")
    assert stored.count() == 2 and stored.schema["batch"]
    monkeypatch.setattr(landing, "_publish", publish)
    for _ in range(2):
        sources.write_table(data, str(tmp_path), "events", batch="b1")
    stored = spark.read.parquet(f"{tmp_path}/events")
    assert sorted(rows(stored.select("GLOBALEVENTID"))) == [(1,), (2,), (3,), (9,)]


def test_a_job_that_ends_in_the_middle_leaves_nothing_to_readers(spark, tmp_path, make, rows):
    """Half of a batch's files were written before the executor was lost."""
    staged = tmp_path / "_staged" / "events" / "b1" / "event_date=2024-01-01"
    make("events", {"GLOBALEVENTID": 77}).write.parquet(str(staged))
    sources.write_table(make("events", {"SQLDATE": 20240101, "GLOBALEVENTID": 1}), str(tmp_path), "events")
    assert rows(spark.read.parquet(f"{tmp_path}/events").select("GLOBALEVENTID")) == [(1,)]
    sources.write_table(make("events", {"SQLDATE": 20240101, "GLOBALEVENTID": 2}), str(tmp_path), "events", batch="b1")
    assert sorted(rows(spark.read.parquet(f"{tmp_path}/events").select("GLOBALEVENTID"))) == [(1,), (2,)]
