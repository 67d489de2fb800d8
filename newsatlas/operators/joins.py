"""Joins that hold when one key has a large part of all rows, and lookups for a handful of keys."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsatlas.operators.ranking import latest_per_key

# A key is heavy beyond this many rows; one task should not get more of them.
ROWS_PER_TASK = 1_000_000


def _fan(rows: str, rows_per_task: int) -> Column:
    """Number of tasks for a key's rows."""
    return F.greatest(F.lit(1), F.ceil(F.col(rows) / F.lit(rows_per_task)).cast("int"))


def heavy_keys(
    lookup: DataFrame, key: str, rows: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """All keys with too many rows for one task and the number of tasks to spread each over."""
    return lookup.filter(F.col(rows) > rows_per_task).select(key, _fan(rows, rows_per_task).alias("_fan"))


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    rows: str,
    spread_by: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``facts`` to ``lookup``, dividing the facts of each heavy key by a salt.

    ``lookup`` has at most one row per key, with the number of its facts (or more) in column
    ``rows``, which does not come out; a key without a lookup row is not divided. The salt is a hash of the ``spread_by`` columns, so that a task that is
    run again makes the same choice; these columns should tell apart the facts of a key. A lookup
    row is repeated for every salt its facts can have; keys that are not heavy only have salt 0. The heavy
    keys and the repeated rows number no more than facts / ``rows_per_task``; whether the keys are broadcast is left to Spark,
    which sees their size when it runs.
    """
    heavy = heavy_keys(lookup, key, rows, rows_per_task)
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_fan", F.lit(1))).cast("int")
    salted = facts.join(heavy, key, "left").withColumn("_salt", salt).drop("_fan")
    salts = F.sequence(F.lit(0), _fan(rows, rows_per_task) - 1)
    fanned = lookup.withColumn("_salt", F.explode(salts)).drop(rows)
    return salted.join(fanned, [key, "_salt"], how).drop("_salt")


def lookup_few(
    few: DataFrame,
    table: DataFrame,
    key: str,
    newest: Sequence[str],
    attributes: Sequence[str],
) -> DataFrame:
    """Left join of a few rows (the result of a LIMIT) to the newest ``table`` row per key.

    The keys travel to the table, not the table to them: Spark knows the size of a LIMIT and broadcasts it, the table is
    scanned once with a semi join, its repeats of a key are merged in every task, and only what is left is shuffled. No
    broadcast is forced, so that a frame that isn't small is joined by shuffle.

    ``few`` is needed twice. Spark computes its shuffles once if both uses read the same columns, so
    its ORDER BY should name all columns that come out of an aggregate.
    """
    matching = table.join(few.select(key), key, "left_semi")
    return few.join(latest_per_key(matching, key, newest, attributes), key, "left")
