"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import salted_join, stored

#: Words in a block.
BLOCK = 64
#: Rows of a source that one shard has, about.
SHARD_ROWS = 20_000
#: How often a document may be taken.
MOST = 3


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for a null."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_count(plain, F.lit("[^ ]+")).cast("long")


def apportioned(rows: DataFrame, group: list[str], name: str, votes: str, seats: str, to: str) -> DataFrame:
    """Add in ``to`` the seats of each party (row) by Sainte-Laguë: the highest quotients votes / (2 n + 1) win.

    ``seats`` is a column with the group's number of seats; ties go to the earlier ``name``. With v votes of V, n parties and S seats
    a party ends between v (S - n/2) / V - 1/2 and v (S + n/2) / V + 1/2, whatever the divisor. The
    lower bound is dealt at once, and only the quotients from there to the upper bound are ranked: about three for each party.
    """
    whole = Window.partitionBy(*group)
    v, total, parties, wanted = F.col(votes), F.col("_total"), F.col("_parties"), F.col(seats)
    rows = rows.withColumns({"_total": F.sum(votes).over(whole).cast("double"), "_parties": F.count("*").over(whole)})
    share = lambda change: F.when(total > 0, v * (wanted + change * parties / 2) / total).otherwise(0.0)
    rows = rows.withColumns(
        {
            "_low": F.greatest(F.floor(share(-1) - 0.5), F.lit(0)).cast("long"),
            "_high": (F.floor(share(1) + 0.5) + 1).cast("long"),
        }
    )
    rows = rows.withColumn("_left", wanted - F.sum("_low").over(whole))
    quotient = F.col(votes) / (2 * F.col("_n") + 1)
    ranked = Window.partitionBy(*group).orderBy(quotient.desc(), F.col(name).asc_nulls_last(), "_n")
    won = (
        rows.select(*group, name, votes, "_left", F.explode(F.sequence("_low", "_high")).alias("_n"))
        .withColumn("_rank", F.row_number().over(ranked))
        .filter((F.col("_rank") <= F.col("_left")) & (F.col(votes) > 0))
        .groupBy(*dict.fromkeys([*group, name]))
        .agg(F.count("*").alias("_more"))
    )
    return (
        rows.join(won, list(dict.fromkeys([*group, name])), "left")
        .withColumn(to, F.when(F.col(votes) > 0, F.col("_low") + F.coalesce("_more", F.lit(0))).otherwise(F.lit(0)))
        .drop("_total", "_parties", "_low", "_high", "_left", "_more")
    )


def row_draw(doc_id: Column, text: Column, seed: int = 0) -> Column:
    """The seeded place of a row, which names it too."""
    return F.xxhash64(F.lit(seed), doc_id.cast("long"), text.cast("string"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Add ``weight`` and ``target`` to a row (source, source_size) per source.

    Sources in order of code points, null last, have the weights in turn. They share the sum of all sizes by weight; a target
    stops at ``most`` times its source's size, and what is left is shared again by weight until none is above.
    Sources in order of size by weight reach their stop one after the other, so that running sums give the level at
    which this ends. A row per source is sorted, and no row of data.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), rank + 1))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * F.lit(most)
    rows = rows.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
            "sharing": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # A source stops if the level of it and all after it is above what it can take; these come first in the order.
    level = F.when(cap * F.col("sharing") >= F.col("left") * F.col("weight"), F.col("left") / F.col("sharing"))
    # From the first that doesn't stop the level only falls, so that it is the highest of them.
    rows = rows.withColumn("level", F.max(level).over(everything))
    share = F.col("weight") * F.col("level")
    stopped = cap * F.col("sharing") < F.col("left") * F.col("weight")
    return rows.withColumn("target", F.when(stopped, cap.cast("double")).otherwise(share)).drop("left", "sharing", "level")


def mixed_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = MOST,
    block: int = BLOCK,
    seed: int = 0,
    shard_rows: int = SHARD_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    Returns a row per row of ``docs`` (doc_id long, text string, source string): doc_id, source, size (words),
    source_size, target, taken (words, repeats counted), times (whole repeats), draw (``row_draw``). The targets (see ``source_targets``) become
    whole blocks by Sainte-Laguë, and those become quotas of a source's shards by the same rule. In a
    shard the documents stand in a seeded order and are divided into blocks of ``block`` words, the last one shorter. Its quota is
    met by whole repeats of the shard and the first blocks of that order, so that a document may be taken in part. None is
    taken more than ``most`` times. A source's words differ from its target by rounding to blocks and by short blocks
    at the end of its shards. Columns of ``docs`` named in ``carry`` come along; they should be narrow.

    A null text has size 0, a null source is a source of its own. Repeated rows are rows of their own, ordered by
    text where ids agree. A null doc_id is allowed. Empty tables give no rows. Other columns are not read. Reruns agree, since
    every choice is a hash of ids, texts and the seed. A source is dealt over shards of about ``shard_rows`` rows,
    so that no task sorts more; the driver sees no row.
    """
    text = F.col("text").cast("string")
    source = F.col("source").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),  # differs for null and any text
        word_count(text).alias("size"),
        row_draw(F.col("doc_id"), text, seed).alias("draw"),
        *carry,
    )
    rows = stored(rows, "mix-sizes")  # without the texts, which are read once
    totals = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    totals = source_targets(totals, weights, most)
    totals = totals.withColumns(
        {
            "shards": F.ceil(F.col("n") / F.lit(shard_rows)).cast("long"),
            "seats": F.floor(F.sum("target").over(Window.partitionBy()) / F.lit(block) + 0.5).cast("long"),
        }
    )
    totals = apportioned(totals, [], "key", "target", "seats", "blocks").select(
        "key", "source_size", "target", "shards", "blocks"
    )
    # A row per source meets all rows: a broadcast where Spark finds it small, else spread over salts.
    rows = salted_join(rows, totals, ["key"], how="inner")
    rows = rows.withColumn("shard", F.pmod("draw", "shards"))
    # Shards by their sums first, then their quotas, of a row each.
    shards = rows.groupBy("key", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    shards = apportioned(shards, ["key"], "shard", "shard_size", "blocks", "quota")
    of_shard = F.nullif(F.ceil(F.col("shard_size") / F.lit(block)), F.lit(0))
    quota = F.least(F.col("quota"), of_shard * F.lit(most))
    shards = shards.select(
        "key",
        "shard",
        F.coalesce(F.floor(quota / of_shard), F.lit(0)).cast("long").alias("repeats"),
        F.coalesce((quota % of_shard) * F.lit(block), F.lit(0)).cast("long").alias("first_words"),
    )
    line = Window.partitionBy("key", "shard").orderBy("draw", "doc_id", "size")
    rows = rows.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    chosen = F.greatest(F.lit(0), F.least(F.col("end"), F.col("first_words")) - (F.col("end") - F.col("size")))
    return rows.join(shards, ["key", "shard"]).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("repeats") * F.col("size") + chosen).alias("taken"),
        F.col("repeats").alias("times"),
        "draw",
        *carry,
    )
