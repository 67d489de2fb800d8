"""The cycle: slices land as JSON, become tables, and every arrival refreshes the results."""

import logging
import zlib
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsatlas import schemas
from newsatlas.feed import Feed
from newsatlas.plans import INCREMENTAL, find, run_all
from newsatlas.plans.partials import Joined, advance, advance_joined
from newsatlas.sources import append_results, expire_results
from newsatlas.sources.arrays import PIECE_END, records, with_places
from newsatlas.sources.landing import parsed, write_table
from newsatlas.sources.states import StateStore

logger = logging.getLogger(__name__)

def read_slices(
    spark: SparkSession, landing: str, table: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the text of the JSON array files that land in ``landing/table``, in pieces.

    Each micro-batch of it has whole files; ``parsed(records(batch), table)`` gives their rows.
    """
    reader = spark.readStream.option("lineSep", PIECE_END)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_places(reader.text(f"{landing}/{table}"))


def ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    table: str,
    checkpoint: str,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append landed slices to the Parquet table ``root/table``, each exactly once.

    They go through :func:`write_table`, so that slices and loads of other origin are in one table. A micro-batch is published day by day
    under its own name: when it was cut short, at whatever point, and is repeated, the days that are there stay and the others follow.
    Names are told apart by the checkpoint, so a table may have several streams, but a stream keeps its checkpoint.

    Without ``every`` it takes in what is there and stops; otherwise it keeps polling.
    """
    place = f"{checkpoint}/ingest_{table}"
    origin = f"{zlib.crc32(place.encode()):08x}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_table(parsed(records(batch), table), root, table, batch=f"stream-{origin}-{batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        read_slices(spark, landing, table, files_per_batch)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", place)
        .trigger(**trigger)
        .start()
    )


def refresh(
    arrivals: DataFrame,
    root: str,
    history: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run all analyses over the accumulated tables for every batch of ``arrivals``.

    Rankings and row-based frames need whole tables, which a stream does not have; so each batch
    only triggers the batch analyses. A repeated batch appends its results again, which readers see
    once: stored rows are compared without their time. Expired results are removed afterwards.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = datetime.now(timezone.utc)
        failures = run_all(
            Feed.from_parquet(spark, root),
            lambda analysis, df: append_results(df, history, analysis.result, now),
        )
        expire_results(spark, history)
        if failures:
            raise RuntimeError(f"analyses failed: {', '.join(sorted(failures))}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{checkpoint}/refresh")
        .trigger(**trigger)
        .start()
    )


def _together(feed: Feed) -> DataFrame:
    """The rows of all three tables as one stream, so that one batch has what came in of each."""
    parts = []
    for name in schemas.TABLES:
        columns = [
            (F.struct(*schema.names) if table == name else F.lit(None).cast(schema)).alias(table)
            for table, schema in schemas.TABLES.items()
        ]
        parts.append(getattr(feed, name).select(F.lit(name).alias("kind"), *columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _apart(batch: DataFrame) -> dict[str, DataFrame]:
    return {name: batch.filter(F.col("kind") == name).select(f"{name}.*") for name in schemas.TABLES}


def refresh_increments(
    arrivals: Feed,
    states: str,
    history: str,
    checkpoint: str,
    every: str | None = None,
    analyses: Iterable[str] = tuple(INCREMENTAL),
    approximate: bool = False,
) -> StreamingQuery:
    """Bring results up to date with every batch of rows, without reading earlier ones again.

    ``arrivals`` holds streams of the three tables. The analyses of ``newsatlas.plans.INCREMENTAL`` (or some of them) keep merged states below
    ``states``; a batch is reduced to its own part and merged into them, so that a cycle costs what the slice and the states
    cost, however many rows there have been. Results equal those of the batch analyses over all rows so far, and
    are appended to the history as :func:`refresh` does it. A repeated batch finds the states as they were before it.

    With ``approximate`` distinct ids are counted by mergeable sketches instead of logs of ids. Sketches and logs are different
    states: a state that was begun with the one is not continued by the other.
    """
    chosen = [find(name) for name in analyses]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store, now = StateStore(spark, states), datetime.now(timezone.utc)
        # One slice; every analysis reads it. Tables are held apart, for their plain columns are compressed, and one that no analysis reads isn't held.
        held = {name: rows.persist() for name, rows in _apart(batch).items()}
        try:
            arrived, failures = Feed(**held), []
            for analysis in chosen:
                part = INCREMENTAL[analysis.name]
                try:
                    if isinstance(part, Joined):
                        result = advance_joined(part, analysis.name, arrived, store, batch_id)
                    else:
                        result = advance(part, analysis.name, arrived, store, batch_id, approximate)
                    append_results(result, history, analysis.result, now)
                except Exception:  # noqa: BLE001 - the others go on; the batch is repeated
                    logger.exception("analysis %s failed", analysis.name)
                    failures.append(analysis.name)
        finally:
            for rows in held.values():
                rows.unpersist()
        expire_results(spark, history)
        if failures:
            raise RuntimeError(f"analyses failed: {', '.join(sorted(failures))}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        _together(arrivals)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{checkpoint}/refresh_increments")
        .trigger(**trigger)
        .start()
    )
