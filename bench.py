"""Time the analyses over the derived feed tables and print one JSON line.

The feed is derived from the test tables in ``$BENCH_SF_DIR`` and stored as Parquet first, because
that is what the analyses read in use; this is timed as ``ingest``. Each analysis then runs once to
warm up and three times for its median, with its whole result computed and thrown away.

    python bench.py            the headline numbers
    python bench.py --compare  also the plain forms that the operators here replace
"""

import json
import os
import statistics
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from newsatlas import Feed, schemas
from newsatlas.functions import feed_timestamp_prefix, region_of
from newsatlas.operators import unpivot_roles
from newsatlas.plans import ANALYSES
from newsatlas.sources import write_table
from newsatlas.testbed.derived import derived_feed

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(build) -> float:
    """Time to build, plan and run a frame; built anew, since a frame keeps its finished stages."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(build) -> float:
    seconds(build)
    return round(statistics.median(seconds(build) for _ in range(RUNS)), 3)


def comparisons(feed: Feed) -> dict:
    """Pairs of (this repo's form, a plain form with the same result), to see what a choice is worth."""

    def native_region() -> DataFrame:
        place = region_of("ActionGeo_CountryCode", "ActionGeo_Lat", "ActionGeo_Long")
        return feed.events.groupBy(place.alias("r")).count()

    def udf_region() -> DataFrame:
        # Only the cost of the round trip to Python: the function does next to nothing.
        udf = F.udf(lambda country, lat, lon: country if lat is None or lon is None else "box", "string")
        place = udf("ActionGeo_CountryCode", "ActionGeo_Lat", "ActionGeo_Long")
        return feed.events.groupBy(place.alias("r")).count()

    def one_scan() -> DataFrame:
        roles = {"a": {"n": "Actor1Name"}, "b": {"n": "Actor2Name"}}
        return unpivot_roles(feed.events, roles, "role", ["GLOBALEVENTID"]).groupBy("role", "n").count()

    def two_scans() -> DataFrame:
        parts = [
            feed.events.select(F.lit(r).alias("role"), F.col(c).alias("n"), "GLOBALEVENTID")
            for r, c in (("a", "Actor1Name"), ("b", "Actor2Name"))
        ]
        return parts[0].unionAll(parts[1]).groupBy("role", "n").count()

    def arithmetic_time() -> DataFrame:
        return feed.mentions.agg(F.max(feed_timestamp_prefix("MentionTimeDate")))

    def text_time() -> DataFrame:
        text = F.lpad(F.col("MentionTimeDate").cast("decimal(20,0)").cast("string"), 14, "0")
        pattern = F.lit("yyyyMMddHHmmss")
        return feed.mentions.agg(F.max(F.try_to_timestamp(F.substring(text, 1, 14), pattern)))

    def entropy_join() -> DataFrame:
        pairs = feed.events.join(feed.mentions, "GLOBALEVENTID").filter(
            F.col("ActionGeo_CountryCode").isNotNull() & (F.trim("MentionSourceName") != "")
        )
        counts = pairs.groupBy("ActionGeo_CountryCode", "MentionSourceName").agg(F.count("*").alias("n"))
        total = F.sum("n").over(Window.partitionBy("ActionGeo_CountryCode"))
        share = F.col("n") / F.col("total")
        return counts.withColumn("total", total).groupBy("ActionGeo_CountryCode").agg(
            F.sum(-share * F.log(share))
        )

    diversity = next(a for a in ANALYSES if a.name == "source_diversity")
    return {
        "region: expression / Python UDF": (native_region, udf_region),
        "roles: one scan / two scans": (one_scan, two_scans),
        "time: arithmetic / text": (arithmetic_time, text_time),
        "diversity: merged counts / joined rows": (lambda: diversity.build(feed), entropy_join),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("newsatlas-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{spark.conf.get('spark.sql.warehouse.dir')}/bench-{uuid.uuid4().hex}"  # a place that executors share
    start = time.perf_counter()
    derived = derived_feed(spark, SF_DIR)
    for table in schemas.TABLES:
        write_table(getattr(derived, table), root, table)
    ingest = round(time.perf_counter() - start, 3)
    feed = Feed.from_parquet(spark, root)
    timings = {a.name: median(lambda a=a: a.build(feed)) for a in ANALYSES}
    report = {
        "metric": "19 analyses, sum of medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
        "ingest": ingest,
        "cpus": int(CPUS),
    }
    if "--compare" in sys.argv:
        report["compare"] = {
            name: [median(form) for form in forms] for name, forms in comparisons(feed).items()
        }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
