"""Analyses kept up to date slice by slice, from states that are merged instead of whole tables.

Of each slice the analysis needs a *part*: sums and counts by its keys, which add up, and co-moments, which can be combined. Distinct ids don't add
up; which ids a group has had is kept in a log, and a slice adds those that its group didn't have. The merged part is a row per group,
and is all that a cycle reads besides the slice and, of the log, the days of the slice.

The batch analyses are the same parts over all rows at once: :func:`whole`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from newsatlas.feed import Feed
from newsatlas.functions import combined_moments, distinct_sketch, merged_sketches, sketch_estimate

if TYPE_CHECKING:
    from newsatlas.sources.states import StateStore

#: Column of a part: the number of different ids in a group.
DISTINCT = "distinct"
_SKETCH = "sketch"


@dataclass(frozen=True)
class Part:
    """What an analysis needs of a slice.

    ``rows`` gives the rows that count, with the columns ``keys`` and, if ids are counted, ``counted``. ``sums`` builds aggregates that add up,
    ``moments`` structs of :func:`newsatlas.functions.moments`. ``finish`` turns the merged part, which has the distinct ids of each group in
    column ``distinct``, into the result. ``day`` is a key by which the log of ids is divided.
    """

    rows: Callable[[Feed], DataFrame]
    keys: Sequence[str]
    finish: Callable[..., DataFrame]
    sums: Callable[[], dict[str, Column]] = dict
    moments: Callable[[], dict[str, Column]] = dict
    counted: str | None = None
    day: str | None = None


def whole(part: Part, feed: Feed, **arguments) -> DataFrame:
    """The analysis over all rows of a feed, by one aggregate."""
    measures = [c.alias(name) for name, c in {**part.sums(), **part.moments()}.items()]
    if part.counted:
        measures.append(F.count_distinct(part.counted).alias(DISTINCT))
    return part.finish(part.rows(feed).groupBy(*part.keys).agg(*measures), **arguments)


def _merged(frames: Sequence[DataFrame], part: Part, sums: Sequence[str], sketch: bool) -> DataFrame:
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame, allowMissingColumns=True)
    measures = [F.sum(name).alias(name) for name in sums]
    # A group has at most a row of the state and one or two of the slice.
    measures += [combined_moments(F.collect_list(name)).alias(name) for name in part.moments()]
    if sketch:
        measures.append(merged_sketches(F.col(_SKETCH)).alias(_SKETCH))
    return rows.groupBy(*part.keys).agg(*measures)


def _new_ids(part: Part, rows: DataFrame, states: StateStore, name: str, batch: int) -> DataFrame:
    """Ids that a group of keys has for the first time; they are in the log afterwards."""
    ids = rows.select(*part.keys, part.counted).filter(F.col(part.counted).isNotNull()).distinct()
    log, where = f"{name}_ids", None
    if part.day:
        first, last = ids.agg(F.min(part.day), F.max(part.day)).first()
        day = F.col(part.day)
        where = day.isNull() if first is None else day.isNull() | day.between(first, last)
    known = states.log(log, batch, ids.schema, where)
    if known is not None:
        same = [ids[c].eqNullSafe(known[c]) for c in ids.columns]
        ids = ids.join(known, same, "left_anti")
    return states.append(ids, log, batch, by=part.day)


def advance(part: Part, name: str, arrived: Feed, states: StateStore, batch: int, approximate: bool = False, **arguments) -> DataFrame:
    """Merge a slice into the state of an analysis and give the analysis over everything so far.

    With ``approximate`` ids are counted by sketches, which merge like sums: no log of ids is kept, and counts may be off by a few per cent.
    """
    rows = part.rows(arrived)
    measures = [c.alias(n) for n, c in {**part.sums(), **part.moments()}.items()]
    sketch = bool(part.counted) and approximate
    sums = list(part.sums())
    if sketch:
        measures.append(distinct_sketch(F.col(part.counted)).alias(_SKETCH))
    frames = [rows.groupBy(*part.keys).agg(*measures) if measures else rows.select(*part.keys).distinct()]
    if part.counted and not approximate:
        sums.append(DISTINCT)
        new = _new_ids(part, rows, states, name, batch)
        frames.append(new.groupBy(*part.keys).agg(F.count("*").alias(DISTINCT)))
    state = f"{name}_sketched" if sketch else name
    fresh = _merged(frames, part, sums, sketch)
    before = states.version(state, batch, fresh.schema)
    merged = states.put(fresh if before is None else _merged([before, *frames], part, sums, sketch), state, batch)
    if part.counted:
        exact = sketch_estimate(F.col(_SKETCH)) if sketch else F.coalesce(DISTINCT, F.lit(0).cast("long"))
        merged = merged.withColumn(DISTINCT, exact)
    return part.finish(merged, **arguments)


@dataclass(frozen=True)
class Joined:
    """An analysis of two tables that meet in a key, each of which keeps arriving.

    ``left`` and ``right`` merge the rows of a slice to one for each key and more, with a count that adds up. New left rows meet all right ones,
    and new right rows the earlier left ones; ``combine`` gives the contribution of the pairs, which adds up by ``keys``.
    """

    left: Callable[[Feed], DataFrame]
    right: Callable[[Feed], DataFrame]
    on: str
    keys: Sequence[str]
    combine: Callable[[DataFrame], DataFrame]
    finish: Callable[..., DataFrame]


def advance_joined(join: Joined, name: str, arrived: Feed, states: StateStore, batch: int, **arguments) -> DataFrame:
    """As :func:`advance`, for a join; the merged rows of both sides are kept in logs."""
    old, new = [], []
    for side, build in (("left", join.left), ("right", join.right)):
        rows = build(arrived)
        old.append(states.log(f"{name}_{side}", batch, rows.schema))
        new.append(states.append(rows, f"{name}_{side}", batch))
    pairs = new[0].join(new[1], join.on)
    if old[1] is not None:
        pairs = pairs.unionByName(new[0].join(old[1], join.on))
    if old[0] is not None:
        pairs = pairs.unionByName(old[0].join(new[1], join.on))
    fresh = join.combine(pairs)
    measures = [F.sum(c).alias(c) for c in fresh.columns if c not in join.keys]
    before = states.version(name, batch, fresh.schema)
    if before is not None:
        fresh = before.unionByName(fresh).groupBy(*join.keys).agg(*measures)
    return join.finish(states.put(fresh, name, batch), **arguments)
