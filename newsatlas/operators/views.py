"""Roll-ups of stored results for charts, tables and maps."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from newsatlas.functions import strict_number

# Bookkeeping columns of the result history; they never take part in a comparison of rows.
HISTORY_COLUMNS = ("created_at", "created_hour")


def drop_repeats(df: DataFrame) -> DataFrame:
    """Identical result rows once, whatever the cycle that stored them."""
    return df.drop(*HISTORY_COLUMNS).distinct()


def all_columns(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of several batches of a result under all their columns, in order of first appearance."""
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def shown_and_total(df: DataFrame) -> DataFrame:
    """One row: distinct result rows and all stored rows.

    Copies are merged before the shuffle, so a row stored by every cycle costs one row per task.
    """
    content = [c for c in df.columns if c not in HISTORY_COLUMNS]
    groups = df.groupBy(*content).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.count("*").alias("shown"), F.coalesce(F.sum("copies"), F.lit(0)).alias("total")
    )


def bar_chart(df: DataFrame, labels: Sequence[str], value: str, top: int = 20) -> DataFrame:
    """Bars ``(label, value)``: summed per label, largest magnitude first, ``top`` of them."""
    label = F.concat_ws(" - ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in labels])
    rows = df.select(label.alias("label"), strict_number(F.col(value)).alias("value"))
    bars = rows.filter(F.col("value").isNotNull()).groupBy("label").agg(F.sum("value").alias("value"))
    return bars.orderBy(F.abs("value").desc(), "label").limit(top)


def bar_colours(bars: DataFrame, mode: str) -> DataFrame:
    """Colour scale of bars: ``signo`` gives the sign class, ``magnitud`` the share of the longest.

    ``bars`` is the limited output of :func:`bar_chart`, so the frame over all of them is small.
    """
    if mode == "signo":
        sign = F.signum("value")
        name = F.when(sign > 0, "positive").when(sign < 0, "negative").otherwise("zero")
        return bars.withColumn("sign", name)
    longest = F.max(F.abs("value")).over(Window.partitionBy())
    return bars.withColumn("share", F.coalesce(F.try_divide(F.abs("value"), longest), F.lit(0.0)))


def numeric_columns(df: DataFrame) -> DataFrame:
    """One row per column telling whether it is numeric: some value, and every value a number.

    All columns are judged in a single aggregate.
    """
    checks = []
    for name in df.columns:
        text = F.col(f"`{name}`").cast("string")
        filled = text.isNotNull() & (text != "")
        number = strict_number(text).isNotNull()
        checks.append(
            F.struct(
                F.lit(name).alias("column"),
                ((F.count_if(filled) > 0) & (F.count_if(filled & ~number) == 0)).alias("numeric"),
            )
        )
    return df.agg(F.array(*checks).alias("_checks")).select(F.inline("_checks"))


def country_map(df: DataFrame) -> DataFrame:
    """One dot per country over all days: events summed, place and intensity averaged by day.

    Rows without a usable place are left out; a country without intensity gets 0.
    """
    lat, lon = strict_number(F.col("latitud")), strict_number(F.col("longitud"))
    events = F.coalesce(strict_number(F.col("total_eventos_conflicto")), F.lit(0.0))
    intensity = strict_number(F.col("intensidad_promedio_goldstein"))
    rows = df.select(
        "pais", lat.alias("lat"), lon.alias("lon"), events.alias("eventos"), intensity.alias("inten")
    )
    return (
        rows.filter((F.col("pais") != "") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .groupBy("pais")
        .agg(
            F.sum("eventos").alias("eventos"),
            F.avg("lat").alias("lat"),
            F.avg("lon").alias("lon"),
            F.coalesce(F.avg("inten"), F.lit(0.0)).alias("inten"),
        )
        .orderBy(F.desc("eventos"), "pais")
    )


def map_scale(dots: DataFrame) -> DataFrame:
    """One row: largest event count and the low, middle and high end of the intensity scale."""
    most, low, high = F.max("eventos"), F.min("inten"), F.max("inten")
    return dots.agg(
        F.when(most == 0, 1.0).otherwise(most).alias("max_eventos"),
        low.alias("inten_min"),
        ((low + high) / 2).alias("inten_mid"),
        high.alias("inten_max"),
    )
