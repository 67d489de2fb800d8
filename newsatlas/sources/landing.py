"""JSON slices in, Parquet tables and JSON results out."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from newsatlas import schemas
from newsatlas.functions import feed_date
from newsatlas.feed import Feed
from newsatlas.sources.arrays import pieces, records

_WRAPPED = "$numberLong"
# The integer column that carries the day of each table's rows; partitions follow it.
DAY_SOURCE = {"events": "SQLDATE", "mentions": "MentionTimeDate", "gkg": "DATE"}


def raw_schema(table: str) -> StructType:
    """Schema to read raw JSON with: integers as text, since some writers wrap them in an object."""
    return StructType(
        [
            StructField(f.name, StringType() if _is_integer(f) else f.dataType)
            for f in schemas.TABLES[table].fields
        ]
    )


def _is_integer(field: StructField) -> bool:
    return isinstance(field.dataType, (LongType, IntegerType))


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Raw JSON columns to the declared types, in one projection.

    An integer may come bare, as a whole double, or as ``{"$numberLong": "..."}``; text that is
    none of these becomes NULL.
    """

    def column(field: StructField) -> Column:
        text = F.col(field.name)
        if not _is_integer(field):
            return text
        inner = F.get_json_object(text, f"$['{_WRAPPED}']")
        number = F.coalesce(text.try_cast("decimal(20,0)"), inner.try_cast("decimal(20,0)"))
        return number.try_cast(field.dataType).alias(field.name)

    return raw.select([column(f) for f in schemas.TABLES[table].fields])


def parsed(objects: DataFrame, table: str) -> DataFrame:
    """Rows of a table from JSON objects in column ``record``; one that cannot be parsed gives a row of NULLs."""
    row = F.from_json("record", raw_schema(table)).alias("row")
    return typed(objects.select(row).select("row.*"), table)


def read_json(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read JSON array files (one or more per slice and table) or a directory of them.

    A large array is read by as many tasks as any other text of its size; see :mod:`newsatlas.sources.arrays`.
    """
    return parsed(records(pieces(spark, path)), table)


def read_landing(spark: SparkSession, root: str) -> Feed:
    """The three tables from ``root/{events,mentions,gkg}.json``, files or directories."""
    return Feed(**{t: read_json(spark, f"{root}/{t}.json", t) for t in schemas.TABLES})


def unwrap_number_long(df: DataFrame) -> DataFrame:
    """Every ``struct<$numberLong: string>`` column to BIGINT, the others unchanged."""

    def column(field: StructField) -> Column:
        name = f"`{field.name}`"
        if isinstance(field.dataType, StructType) and _WRAPPED in field.dataType.fieldNames():
            return F.col(name).getField(_WRAPPED).try_cast("bigint").alias(field.name)
        return F.col(name)

    return df.select([column(f) for f in df.schema.fields])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Leave out the columns that are NULL in every row; an empty table is left as it is.

    One aggregate over the table decides; only its single row of counts comes to the driver.
    """
    counts = df.agg(
        F.count("*"), *[F.count(f"`{name}`").alias(str(i)) for i, name in enumerate(df.columns)]
    ).first()
    if counts[0] == 0:
        return df
    return df.select([f"`{name}`" for name, filled in zip(df.columns, counts[1:]) if filled])


def with_day(df: DataFrame, table: str) -> DataFrame:
    """Add ``event_date``, the day the table is partitioned by."""
    packed = f"substr(cast({DAY_SOURCE[table]} AS string), 1, 8)"
    return df.withColumn("event_date", feed_date(packed))


def write_table(df: DataFrame, root: str, table: str, replace_days: bool = False, batch: str | None = None) -> None:
    """Store a batch in the Parquet table ``root/table``, divided by day and, within a day, by batch.

    It is added, or with ``replace_days`` takes the place of the days it holds; other days are never touched. A ``batch`` of a given
    name is stored once: of a batch that is repeated, only the days that are not there yet.

    The batch is first written beside the table, and then each of its days is moved to its place by one rename, which
    is all or nothing on HDFS and local disks. Readers, streams over the table among them, never see half a day of a batch. Slices arrive in time
    order, so that a batch has a day or two, and a task writes few files without a shuffle.
    """
    name = batch or f"load-{uuid.uuid4().hex}"
    staged = f"{root}/{_STAGED}/{table}/{name}"
    with_day(df, table).write.mode("overwrite").partitionBy(_DAY).parquet(staged)
    system, place = _file_system(df.sparkSession, staged)
    for status in system.listStatus(place):
        if status.isDirectory():
            _publish(df.sparkSession, staged, f"{root}/{table}", status.getPath().getName(), name, replace_days)
    system.delete(place, True)


_DAY = "event_date"
#: Folder of a day, within which its rows are divided by the batch they came in. Readers of the declared schemas don't see it.
BATCH = "batch"
_STAGED = "_staged"


def _publish(spark: SparkSession, staged: str, table: str, day: str, batch: str, replace: bool) -> None:
    """Move one day of a batch to its place, unless it is there."""
    system, source = _file_system(spark, f"{staged}/{day}")
    _, target = _file_system(spark, f"{table}/{day}/{BATCH}={batch}")
    if replace:
        _, old = _file_system(spark, f"{table}/{day}")
        if system.exists(old):
            _, aside = _file_system(spark, f"{staged}/_replaced_{day}")
            _moved(system, old, aside)
    if not system.exists(target):
        system.mkdirs(target.getParent())
        _moved(system, source, target)


def _moved(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str, file: bool = False) -> bool:
    """Whether there is a folder or file, or with ``file`` a file, on any file system that Spark reads."""
    system, place = _file_system(spark, path)
    return system.isFile(place) if file else system.exists(place)


def write_json(df: DataFrame, path: str) -> None:
    """Store a result as JSON lines, written by the tasks that computed it."""
    (
        df.write.mode("overwrite")
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .option("ignoreNullFields", "false")
        .json(path)
    )
