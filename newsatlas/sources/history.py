"""Result history: appended every cycle, expired after six hours.

Each result has its own directory, partitioned by the hour of ``created_at``: a reader's retention
filter prunes whole hours, and expiry removes whole hours without rewriting anything.
"""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsatlas.operators.views import drop_repeats
from newsatlas.plans.catalog import find, listed, title_of

RETENTION = timedelta(hours=6)
PAGE_ROWS = 1000


def _hour_of(moment: Column) -> Column:
    """Hours since 1970 in UTC, whatever the session's time zone."""
    return F.floor(F.unix_timestamp(moment) / F.lit(3600)).cast("int")


def append_results(
    df: DataFrame, root: str, result: str, created_at: datetime | None = None
) -> None:
    """Append a result. An empty one leaves no trace: a partitioned write makes no files for it."""
    stamp = F.current_timestamp() if created_at is None else F.lit(created_at)
    (
        df.withColumn("created_at", stamp)
        .withColumn("created_hour", _hour_of(F.col("created_at")))
        .write.mode("append")
        .partitionBy("created_hour")
        .parquet(f"{root}/{result}")
    )


def read_results(spark: SparkSession, root: str, result: str) -> DataFrame:
    """All stored rows of a result, with the columns of all cycles; without any an empty frame."""
    if not _hours(spark, root, result):
        return spark.createDataFrame([], "created_at timestamp, created_hour int")
    return spark.read.option("mergeSchema", True).parquet(f"{root}/{result}")


def live_results(df: DataFrame, now: datetime | None = None, keep: timedelta = RETENTION) -> DataFrame:
    """Rows not yet expired at ``now``. The hour condition prunes partitions, the other is exact."""
    moment: Column = F.current_timestamp() if now is None else F.lit(now)
    oldest = moment - F.lit(keep)
    return df.filter(
        (F.col("created_hour") >= _hour_of(oldest)) & (F.col("created_at") > oldest)
    )


def history_page(df: DataFrame, rows: int = PAGE_ROWS) -> DataFrame:
    """First rows of a result for viewing: repeats removed first, so they crowd nothing out."""
    shown = drop_repeats(df)
    return shown.orderBy(*shown.columns).limit(rows)


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _children(spark: SparkSession, root: str) -> list[str]:
    fs, path = _file_system(spark, root)
    if not fs.exists(path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]


def stored_results(spark: SparkSession, root: str) -> list[str]:
    """Names of the results with stored rows, in catalog order."""
    names = [n for n in _children(spark, root) if not n.startswith(("_", "."))]
    return listed(n for n in names if _hours(spark, root, n))


def _hours(spark: SparkSession, root: str, result: str) -> list[str]:
    prefix = "created_hour="
    return [c for c in _children(spark, f"{root}/{result}") if c.startswith(prefix)]


def expire_results(
    spark: SparkSession, root: str, now: datetime | None = None, keep: timedelta = RETENTION
) -> int:
    """Remove the hours that have expired as a whole; returns how many.

    Only directory names are listed. The hour in which the limit falls stays until all of it has
    expired; :func:`live_results` hides its old rows.
    """
    moment = now or datetime.now(timezone.utc)
    first_kept = int((moment - keep).timestamp() // 3600)
    removed = 0
    for result in stored_results(spark, root):
        for hour in _hours(spark, root, result):
            if int(hour.partition("=")[2]) < first_kept:
                fs, path = _file_system(spark, f"{root}/{result}/{hour}")
                removed += bool(fs.delete(path, True))
    return removed


def summary(results: dict[str, DataFrame]) -> DataFrame:
    """Per stored result: title, distinct rows, all rows, and whether it has a chart.

    Every row is reduced to its name and content; copies are merged before the shuffle. One job
    covers all results, although their columns differ. No results give no rows.
    """
    if not results:
        spark = SparkSession.active()
        return spark.createDataFrame([], "nombre string, titulo string, tiene_grafico boolean, filas long, total long")
    parts = [
        df.drop("created_at", "created_hour").select(
            F.lit(position).alias("position"),
            F.lit(name).alias("nombre"),
            F.lit(title_of(name)).alias("titulo"),
            F.lit(bool(find(name) and find(name).bars)).alias("tiene_grafico"),
            F.to_json(F.struct("*")).alias("content"),
        )
        for position, name in enumerate(listed(results))
        for df in [results[name]]
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    keys = ["position", "nombre", "titulo", "tiene_grafico"]
    return (
        rows.groupBy(*keys, "content")
        .agg(F.count("*").alias("copies"))
        .groupBy(*keys)
        .agg(F.count("*").alias("filas"), F.sum("copies").alias("total"))
        .orderBy("position")
        .drop("position")
    )


def summary_totals(results: DataFrame) -> DataFrame:
    """One row over a :func:`summary`: the number of results, distinct rows and all rows."""
    return results.agg(
        F.count("*").alias("analisis"),
        F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
    )
