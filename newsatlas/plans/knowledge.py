"""What the documents are about: themes, places and organisations."""

from pyspark.sql import Column, DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import (
    day_text,
    delimited,
    feed_date,
    feed_year,
    field,
    leading_item,
    not_blank,
    number_text,
    region_of,
)
from newsatlas.operators import explode_delimited, top_n_per_group
from newsatlas.plans.partials import DISTINCT, Part, whole

RECORD = "GKGRECORDID"


def _items(gkg: DataFrame) -> DataFrame:
    """The (record, place?, year, value) of the regions and themes a record names, from one scan.

    The second location format has one field more before the coordinates. The first one counts only
    where the second is missing or blank; a blank item stands for a place without a region. A blank list of
    themes of the second format still hides the first one. Only regions have a year.
    """
    has_v2 = F.coalesce(F.col("V2Locations") != "", F.lit(False))
    locations = F.when(has_v2, F.col("V2Locations")).when(F.col("Locations") != "", F.col("Locations"))
    tagged = [
        F.coalesce(
            F.transform(delimited(text), lambda item: F.struct(F.lit(place).alias("place"), item.alias("item"))),
            F.expr("array()").cast("array<struct<place:boolean,item:string>>"),
        )
        for place, text in ((True, locations), (False, F.coalesce("V2Themes", "Themes")))
    ]
    items = gkg.select(
        RECORD, feed_year(F.col("DATE")).alias("anio"), has_v2.alias("v2"), F.explode(F.concat(*tagged)).alias("t")
    ).select(RECORD, "anio", "v2", "t.place", "t.item")

    def coordinate(position: int) -> Column:
        item = F.col("item")
        return number_text(F.when(F.col("v2"), field(item, position + 1)).otherwise(field(item, position)))

    located = items.filter(F.col("place") | not_blank(F.col("item"))).select(
        RECORD,
        "place",
        F.when(F.col("place"), F.col("anio")).alias("anio"),
        leading_item(F.col("item")).alias("tema"),
        field(F.col("item"), 3).alias("country"),
        coordinate(5).alias("lat"),
        coordinate(6).alias("lon"),
    )
    value = F.when(F.col("place"), region_of("country", "lat", "lon")).otherwise(F.col("tema"))
    named = located.filter(F.col("place") | (F.col("tema") != ""))
    return named.select(RECORD, "place", "anio", value.alias("value"))


def themes_by_region_year(feed: Feed, top: int = 20) -> DataFrame:
    """Leading themes per region and year, by number of documents.

    A record's places and themes are made distinct by one narrow aggregate, in which every task merges its own first, so copies of a record cost
    nothing. Their product is taken within the record's one row and needs no shuffle: each (record, region, theme) comes out once, and a plain
    count, merged in every task before its shuffle, replaces a distinct count over all combinations.
    """
    items = _items(feed.gkg.filter(F.col(RECORD).isNotNull()))
    merged = items.groupBy(RECORD).agg(F.collect_set(F.struct("place", "anio", "value")).alias("items"))
    pairs = F.filter("items", lambda i: i["place"])
    themes = F.transform(F.filter("items", lambda i: ~i["place"]), lambda i: i["value"])
    counts = (
        merged.select(F.explode(pairs).alias("pair"), themes.alias("temas"))
        .select(F.col("pair.value").alias("continente"), "pair.anio", F.explode("temas").alias("tema"))
        .groupBy("continente", "anio", "tema")
        .agg(F.count("*").alias("total_documentos"))
    )
    order = [F.desc("total_documentos"), F.col("tema")]
    return top_n_per_group(counts, ["continente", "anio"], order, top, "ranking").orderBy(
        F.desc("anio"), "continente", "ranking"
    )


def _named_organizations(feed: Feed) -> DataFrame:
    named = explode_delimited(
        feed.gkg, F.col("Organizations"), "item", [RECORD, _document_day().alias("day")]
    )
    return named.filter(not_blank(F.col("item"))).select("day", F.lower(F.trim("item")).alias("organizacion"), RECORD)


def _top_organizations(groups: DataFrame, top: int = 20) -> DataFrame:
    counts = groups.select(day_text(F.col("day")).alias("fecha"), "organizacion", F.col(DISTINCT).alias("total_documentos"))
    order = [F.desc("total_documentos"), F.col("organizacion")]
    return top_n_per_group(counts, ["fecha"], order, top, "ranking").orderBy(
        F.desc("fecha"), "ranking"
    )


ORGANIZATIONS = Part(_named_organizations, ("day", "organizacion"), _top_organizations, counted=RECORD, day="day")


def organizations_by_day(feed: Feed, top: int = 20) -> DataFrame:
    """Organisations named in the most documents, day by day."""
    return whole(ORGANIZATIONS, feed, top=top)


def _document_day() -> Column:
    """Day of a record's date, which has a time of day behind it or not."""
    return feed_date("substr(cast(DATE AS string), 1, 8)")
