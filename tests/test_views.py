from pyspark.sql import functions as F

from newsatlas import operators as op


def test_bar_chart_sums_labels_and_drops_what_is_no_number(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", "1"), ("a", "x", "2.5"), ("b", None, "-9"), ("c", "y", "2024-01-01"),
         ("d", "y", None), ("e", "y", ""), ("f", "z", "3.5")],
        "p string, q string, v string",
    )
    assert rows(op.bar_chart(df, ["p", "q"], "v")) == [("b - ", -9.0), ("a - x", 3.5), ("f - z", 3.5)]
    assert rows(op.bar_chart(df, ["p"], "v", top=1)) == [("b", -9.0)]


def test_bar_colours(spark, rows):
    bars = spark.createDataFrame([("a", -4.0), ("b", 2.0), ("c", 0.0)], "label string, value double")
    assert [r[2] for r in rows(op.bar_colours(bars, "signo"))] == ["negative", "positive", "zero"]
    assert [r[2] for r in rows(op.bar_colours(bars, "magnitud"))] == [1.0, 0.5, 0.0]
    flat = bars.filter("value = 0")
    assert [r[2] for r in rows(op.bar_colours(flat, "magnitud"))] == [0.0]


def test_numeric_columns(spark, rows):
    df = spark.createDataFrame(
        [("1", "x", None, "", 1), (None, "2", None, "", 2), ("-2e3", "3", None, "5", 3)],
        "a string, b string, c string, d string, e int",
    )
    assert dict(rows(op.numeric_columns(df))) == {
        "a": True, "b": False, "c": False, "d": True, "e": True
    }


def _days(spark):
    return spark.createDataFrame(
        [("US", "40", "-100", "3", "2.0"), ("US", "50", "-90", None, None), ("US", "bad", "1", "9", "9"),
         ("MX", "20", "-99", "10", None), ("", "1", "1", "1", "1"), (None, "1", "1", "1", "1"),
         ("BR", None, "1", "1", "1")],
        "pais string, latitud string, longitud string, total_eventos_conflicto string, "
        "intensidad_promedio_goldstein string",
    )


def test_country_map(spark, rows):
    assert rows(op.country_map(_days(spark))) == [
        ("MX", 10.0, 20.0, -99.0, 0.0), ("US", 3.0, 45.0, -95.0, 2.0)
    ]


def test_map_scale(spark, rows):
    dots = op.country_map(_days(spark))
    assert rows(op.map_scale(dots)) == [(10.0, 0.0, 1.0, 2.0)]
    assert rows(op.map_scale(dots.withColumn("eventos", F.lit(0.0))))[0][0] == 1.0


def test_repeats_are_shown_once(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "p string, n int")
    stored = df.withColumns({"created_at": F.current_timestamp(), "created_hour": F.lit(1)})
    stored = stored.union(df.withColumns({"created_at": F.lit("2020-01-01").cast("timestamp"),
                                          "created_hour": F.lit(2)}))
    assert sorted(rows(op.drop_repeats(stored))) == [("a", 1), ("b", None)]
    assert rows(op.shown_and_total(stored)) == [(2, 6)]
    assert rows(op.shown_and_total(stored.limit(0))) == [(0, 0)]


def test_as_text(spark, rows):
    df = spark.createDataFrame([(1, 2.5, None)], "a int, b double, c string")
    assert rows(op.as_text(df)) == [("1", "2.5", None)]


def test_all_columns_of_differing_batches(spark, rows):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    other = spark.createDataFrame([("y", 2.5)], "b string, c double")
    union = op.all_columns([one, other])
    assert union.columns == ["a", "b", "c"]
    assert rows(union) == [(1, "x", None), (None, "y", 2.5)]
