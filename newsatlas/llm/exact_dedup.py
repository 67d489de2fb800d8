"""Exact de-duplication that no group of copies can overload.

Copies are combined three times, each time by their full content: within a block of rows of one task, within a salted
share of a digest, and over the salts of a digest. A group that holds a third of all rows reaches the
first shuffle as one row per block, and the last one as one row per salt.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, stored

SALTS = 8

_LOCAL = "digest binary, content string, rep_id long, members array<long>, rows long"


def _combine_block(batches):
    """Group the rows of a block by content; a digest only finds the place to compare at."""
    schema = pa.schema(
        [
            ("digest", pa.binary()),
            ("content", pa.large_string()),
            ("rep_id", pa.int64()),
            ("members", pa.list_(pa.int64())),
            ("rows", pa.int64()),
        ]
    )
    for rows in chunks(batches, ["doc_id", "text"], most=16_000_000):
        places: dict[bytes, list[tuple[bytes, list]]] = {}
        for doc_id, text in rows:
            content = (text or b"").lower()  # of bytes: A-Z only
            place = places.setdefault(hashlib.sha256(content).digest(), [])
            members = next((m for c, m in place if c == content), None)
            if members is None:
                place.append((content, members := []))
            members.append(doc_id)
        found = [(d, c, m) for d, place in places.items() for c, m in place]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in found], pa.binary()),
                pa.array([c for _, c, _ in found], pa.large_binary()).cast(pa.large_string()),
                pa.array([max((x for x in m if x is not None), default=None) for _, _, m in found], pa.int64()),
                pa.array([m for _, _, m in found], pa.list_(pa.int64())),
                pa.array([len(m) for _, _, m in found], pa.int64()),
            ],
            schema=schema,
        )


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one per row of ``docs`` (doc_id long, text string).

    Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty. Of equal texts the
    row with the largest ``doc_id`` stays.

    Repeated rows with one id and one text are each reported and counted; ``kept`` holds for each of them, as nothing tells
    them apart. A null ``doc_id`` never wins against a number; a group without any number has a null ``keep_id``, and its
    rows are kept. An empty table gives no rows. Columns other than the two are not read.
    """
    local = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = local.mapInArrow(_combine_block, _LOCAL)
    # Each block's row is named by what is in it: equal names have equal members, and are met once each.
    blocks = stored(
        blocks.withColumn("block", F.xxhash64("digest", F.to_json("members"), F.lit("block"))), "exact-blocks"
    )
    # A digest of one block has nothing to be compared with. The others meet by digest and salt, where they are combined as well.
    salted = blocks.withColumn("salt", F.pmod("block", F.lit(salts)).cast("int"))
    several = blocks.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
    several = several.select("digest", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    shares = (
        salted.select("digest", "salt", "content", "rep_id", "rows", "block")
        .join(several, ["digest", "salt"])
        .groupBy("digest", "salt", "content")
        .agg(F.max("rep_id").alias("rep_id"), F.sum("rows").alias("rows"), F.collect_set("block").alias("blocks"))
    )
    groups = (
        shares.groupBy("digest", "content")
        .agg(
            F.max("rep_id").alias("keep_id"),
            F.sum("rows").alias("group_size"),
            F.flatten(F.collect_list("blocks")).alias("blocks"),
        )
        .select("digest", "keep_id", "group_size", F.explode("blocks").alias("block"))
    )
    members = blocks.select("digest", "block", "members", "rep_id", "rows")
    # Without a group a block is one of its own; groups of ids that are all null have none to keep.
    return (
        members.join(groups, ["digest", "block"], "left")
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("rep_id")).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("group_size", "rows"))
        .select(F.explode("members").alias("doc_id"), "keep_id", "group_size", "digest")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
