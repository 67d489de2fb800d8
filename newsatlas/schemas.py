"""Declared schemas of the feed tables; nothing is ever inferred from data."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _table(columns: dict) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def _actor(n: int) -> dict:
    parts = (
        "Name", "Code", "CountryCode",
        "Type1Code", "Type2Code", "Type3Code",
        "Religion1Code", "Religion2Code", "EthnicCode",
    )
    return {f"Actor{n}{part}": StringType() for part in parts}


EVENTS = _table(
    {
        "GLOBALEVENTID": LongType(),
        "SQLDATE": LongType(),
        "QuadClass": IntegerType(),
        "ActionGeo_CountryCode": StringType(),
        "ActionGeo_FullName": StringType(),
        "ActionGeo_Lat": DoubleType(),
        "ActionGeo_Long": DoubleType(),
        "GoldsteinScale": DoubleType(),
        "AvgTone": DoubleType(),
        "NumMentions": IntegerType(),
        "NumSources": IntegerType(),
        "NumArticles": IntegerType(),
        "EventRootCode": StringType(),
        "EventBaseCode": StringType(),
        "EventCode": StringType(),
        "CAMEOCodeDescription": StringType(),
        **_actor(1),
        **_actor(2),
        "SOURCEURL": StringType(),
    }
)

MENTIONS = _table(
    {
        "GLOBALEVENTID": LongType(),
        "MentionTimeDate": LongType(),
        "MentionSourceName": StringType(),
        "MentionDocTone": DoubleType(),
    }
)

GKG = _table(
    {
        "GKGRECORDID": StringType(),
        "DATE": LongType(),
        "V2Locations": StringType(),
        "Locations": StringType(),
        "V2Themes": StringType(),
        "Themes": StringType(),
        "Organizations": StringType(),
    }
)

TABLES = {"events": EVENTS, "mentions": MENTIONS, "gkg": GKG}
