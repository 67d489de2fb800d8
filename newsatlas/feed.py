"""The three tables every analysis reads."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsatlas import schemas


@dataclass(frozen=True)
class Feed:
    """Lazy handles on the coded events, their media mentions and the per-document records."""

    events: DataFrame
    mentions: DataFrame
    gkg: DataFrame

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Feed":
        """Open ``root/{events,mentions,gkg}`` with the declared schemas, so no inference job runs."""
        return cls(
            **{
                name: spark.read.schema(schema).parquet(f"{root}/{name}")
                for name, schema in schemas.TABLES.items()
            }
        )

    @classmethod
    def from_catalog(cls, spark: SparkSession) -> "Feed":
        """Open the catalog tables or views named ``events``, ``mentions`` and ``gkg``."""
        return cls(**{name: spark.table(name) for name in schemas.TABLES})

    def between(self, first_day: date, last_day: date) -> "Feed":
        """The rows of these days, both included; the days are partitions of the stored tables, and others are not read."""
        inside = F.col("event_date").between(first_day, last_day)
        return Feed(**{name: getattr(self, name).filter(inside) for name in schemas.TABLES})

    def create_views(self) -> None:
        """Expose the tables to SQL under their own names."""
        for name in schemas.TABLES:
            getattr(self, name).createOrReplaceTempView(name)
