import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsatlas import functions as fn


def column(spark, rows, values, kind, build):
    """Values of one built column, by position."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[1] for r in sorted(rows(df.select("i", build(F.col("v")))))] if values else []


def regions(spark, places):
    df = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(places)], "i int, c string, lat double, lon double"
    )
    out = df.select("i", fn.region_of("c", "lat", "lon").alias("r"))
    return [r.r for r in sorted(out.collect())]


def test_every_region_code(spark):
    pairs = [(code, name) for name, codes in fn.REGION_CODES.items() for code in codes.split()]
    assert len(pairs) == len({c for c, _ in pairs}) == 95
    assert regions(spark, [(c, 0.0, 0.0) for c, _ in pairs]) == [name for _, name in pairs]


def test_regions_by_their_codes_literally(spark):
    pairs = [("US", "Norteamérica"), ("GL", "Norteamérica"), ("MX", "Latinoamérica y Caribe"), ("PR", "Latinoamérica y Caribe"),
             ("BR", "Sudamérica"), ("CHL", "Sudamérica"), ("UK", "Europa"), ("ES2", "Europa"), ("CH", "Asia"), ("AF", "Asia"),
             ("EG", "África"), ("NI", "África"), ("TZ", "África"), ("AS", "Oceanía"), ("FJ", "Oceanía"), ("QQ", "Sin región")]
    assert regions(spark, [(c, None, None) for c, _ in pairs]) == [name for _, name in pairs]


def test_categories_by_their_codes_literally(spark, rows):
    pairs = [("COP", "Gobierno"), ("GOV", "Gobierno"), ("INS", "Grupo rebelde"), ("JUD", "Gobierno"), ("LEG", "Gobierno"),
             ("MIL", "Militar"), ("REB", "Grupo rebelde"), ("SEP", "Grupo rebelde"), ("SPY", "Gobierno"), ("XXX", None)]
    df = spark.createDataFrame([(c,) for c, _ in pairs], "a string")
    assert sorted(rows(df.select("a", fn.actor_category("a")))) == pairs


def test_region_code_is_trimmed_and_upper_cased(spark):
    codes = [" uk ", "\tuk ", "Uk\n", "ni", "UK "]
    assert regions(spark, [(c, None, None) for c in codes]) == [
        "Europa", "Europa", "Europa", "África", "Europa",
    ]


@pytest.mark.parametrize(
    "lat, lon, region",
    [
        (32.0, -170.0, "Norteamérica"),
        (32.0, -50.0, "Norteamérica"),
        (31.75, -120.0, "Latinoamérica y Caribe"),
        (10.0, -60.0, "Latinoamérica y Caribe"),
        (14.0, -90.0, "Latinoamérica y Caribe"),
        (31.0, -120.25, "Sin región"),
        (35.0, -25.0, "Europa"),
        (75.0, 60.0, "Europa"),
        (34.75, 55.0, "África"),
        (-35.0, -20.0, "África"),
        (80.0, 180.0, "Asia"),
        (-10.0, 130.0, "Asia"),
        (-10.25, 130.0, "Oceanía"),
        (-50.0, 180.0, "Oceanía"),
        (-50.25, 180.0, "Sin región"),
        (math.nan, -60.0, "Sin región"),
        (40.0, math.nan, "Sin región"),
        (None, -60.0, "Sin región"),
        (40.0, None, "Sin región"),
        (math.inf, -60.0, "Norteamérica"),
    ],
)
def test_region_boxes(spark, lat, lon, region):
    assert regions(spark, [("XX", lat, lon), (None, lat, lon), ("", lat, lon)]) == [region] * 3


def test_region_in_sql(spark, rows):
    fn.register_region_function(spark)
    spark.createDataFrame(
        [("US", 1.0, 2.0), ("XX", 40.0, 8.0), ("XX", 50.0, 12.0), (None, None, None)],
        "c string, lat double, lon double",
    ).createOrReplaceTempView("places")
    plain = spark.sql("SELECT region_from_geo(c, lat, lon) FROM places")
    assert [r[0] for r in rows(plain)] == ["Norteamérica", "Europa", "Europa", "Sin región"]
    grouped = spark.sql(
        "SELECT c, region_from_geo(c, avg(lat), avg(lon)) FROM places GROUP BY c ORDER BY c"
    )
    assert rows(grouped) == [(None, "Sin región"), ("US", "Norteamérica"), ("XX", "Europa")]
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["true", "false"])
def test_dates_equal_text_parsing(spark, rows, mode):
    random.seed(3)
    values = [None, 0, 7, 20240229, 20230229, 2024010, 202401011, 20241301, 20240132,
              20240100, 10000101, 99991231, 9999, 2**62, 20240431]
    values += [random.randrange(10**random.randrange(1, 12)) for _ in range(300)]
    values += [random.randrange(19000101, 20301232) for _ in range(300)]
    spark.conf.set("spark.sql.ansi.enabled", mode)
    try:
        ours = column(spark, rows, values, "bigint", lambda _: fn.day_text(fn.feed_date("v")))
        theirs = column(
            spark, rows, values, "bigint",
            lambda c: fn.day_text(F.try_to_date(c.cast("string"), "yyyyMMdd")),
        )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert ours == theirs
    assert ours[3] == "2024-02-29"


shown = fn.mention_time_text


def _times():
    random.seed(5)
    values = [None, 0, 7, 20240101120000, 2024010112000, 202401011200001,
              20249905120000, 20240101246000, 20240101240000, 20240101235960, 20240230000000,
              101000000, 10101000000, 10000101000000, 99991231235959, 2**62,
              202401011200009999, 2024010112000099999]
    values += [random.randrange(10**random.randrange(1, 19)) for _ in range(300)]
    for _ in range(300):
        parts = (random.randrange(1900, 2030), random.randrange(14), random.randrange(33),
                 random.randrange(25), random.randrange(62), random.randrange(62))
        values.append(int("%04d%02d%02d%02d%02d%02d" % parts))
    return values


def test_timestamps_equal_text_parsing(spark, rows):
    pattern = F.lit("yyyyMMddHHmmss")

    def text(c):
        return F.lpad(c.try_cast("decimal(14,0)").cast("string"), 14, "0")

    values = _times()
    ours = column(spark, rows, values, "bigint", lambda _: shown(fn.feed_timestamp("v")))
    assert ours == column(
        spark, rows, values, "bigint", lambda c: shown(F.try_to_timestamp(text(c), pattern))
    )
    assert ours[3] == "2024-01-01 12:00:00" and ours[5] is None


def test_timestamp_prefixes_equal_text_parsing(spark, rows):
    def text(c):
        return F.substring(F.lpad(c.cast("decimal(20,0)").cast("string"), 14, "0"), 1, 14)

    values = _times()
    ours = column(spark, rows, values, "bigint", lambda _: shown(fn.feed_timestamp_prefix("v")))
    assert ours == column(
        spark, rows, values, "bigint",
        lambda c: shown(F.try_to_timestamp(text(c), F.lit("yyyyMMddHHmmss"))),
    )
    assert ours[5] == "2024-01-01 12:00:00"


def test_numbers_from_text(spark, rows):
    values = [None, "", "null", "NULL", "n/a", " 12.5 ", "-3", "1e3", ".5", "5.", "+1", "2026-06-22",
              "1d", "NaN", "0x10", "  "]
    assert column(spark, rows, values, "string", fn.number_text) == [
        None, None, None, None, None, 12.5, -3.0, None, None, None, None, None, None, None, None, None
    ]
    assert column(spark, rows, values, "string", fn.strict_number) == [
        None, None, None, None, None, 12.5, -3.0, 1000.0, 0.5, 5.0, 1.0, None, None, None, None, None
    ]
    loose = column(spark, rows, values[:8], "string", fn.safe_float)
    assert loose == [None, None, None, None, None, 12.5, -3.0, 1000.0]


def test_fields_of_delimited_text(spark, rows):
    values = ["4#Place#US#A#B#1.5#2.5", "4#Place", "", None]
    assert column(spark, rows, values, "string", lambda c: fn.field(c, 3)) == ["US", None, None, None]
    assert column(spark, rows, ["a;b;", ""], "string", fn.delimited) == [["a", "b", ""], [""]]
    assert column(spark, rows, [" A,1 ", ",x", "B"], "string", fn.leading_item) == ["A", "", "B"]


def test_slice_start(spark, rows):
    values = [datetime(2024, 1, 1, 12, 14, 59), datetime(2024, 1, 1, 12, 15), datetime(2024, 1, 1, 2)]
    assert column(spark, rows, values, "timestamp", fn.slice_start) == [
        datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 6, 15), datetime(2023, 12, 31, 20)
    ]


def test_actor_category_takes_the_first_that_matches(spark, rows):
    df = spark.createDataFrame(
        [(1, "MIL", "GOV", None), (2, "REB", None, "MIL"), (3, None, None, "SEP"),
         (4, "BUS", None, None), (5, None, None, None), (6, "gov", None, None)],
        "i int, a string, b string, c string",
    )
    out = df.select("i", fn.actor_category("a", "b", "c"))
    assert [r[1] for r in sorted(rows(out))] == [
        "Gobierno", "Militar", "Grupo rebelde", None, None, None
    ]


def test_pearson(spark, rows):
    df = spark.createDataFrame(
        [("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 6.0), ("up", None, 9.0),
         ("flat", 1.0, 5.0), ("flat", 2.0, 5.0), ("one", 1.0, 1.0), ("none", None, None)],
        "g string, x double, y double",
    )
    got = dict(rows(df.groupBy("g").agg(F.round(fn.pearson(F.col("x"), F.col("y")), 10))))
    assert got == {"up": 1.0, "flat": None, "one": None, "none": None}


def test_entropy_equals_its_definition(spark, rows):
    counts = [3, 1, 4, 1, 5, 92]
    df = spark.createDataFrame([(n,) for n in counts], "n bigint")
    total = sum(counts)
    expected = -sum(n / total * math.log(n / total) for n in counts)
    assert rows(df.agg(fn.entropy(F.col("n"))))[0][0] == pytest.approx(expected)
    assert rows(df.limit(1).agg(F.round(fn.entropy(F.col("n")), 4)))[0][0] == 0.0


def test_percent_is_decimal_and_half_up(spark, rows):
    df = spark.createDataFrame([(1, 3), (1, 8), (0, 7)], "a bigint, b bigint")
    got = [r[0] for r in rows(df.select(fn.percent_of(F.col("a"), F.col("b")).cast("string")))]
    assert got == ["33.33", "12.50", "0.00"]
