"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to few dimensions by Gaussian (2-stable) directions. The squared distance of two projections, divided by
the squared distance of the vectors, follows a chi-square law with that many degrees of freedom. So projected neighbours are
taken in order of distance and verified on the vectors, until a vector nearer than the k found so far would, with
high probability, have turned up already.

Largest inner products become least distances by one more dimension: a vector x gets sqrt(M - |x|^2), M the largest
|x|^2, and a query gets 0; then the squared distance is M + |q|^2 - 2 <q, x>.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, stored

#: Projected dimensions (even), certainty of the stopping test, vectors of an index block and of a leaf.
DIMENSIONS, CERTAINTY, BLOCK_ROWS, LEAF_ROWS = 24, 0.93, 16_384, 64
#: Vectors that the upper part of the tree is fitted to, at most. All vectors are indexed.
SAMPLE_ROWS = 50_000
#: Cells of the upper part, at most; beyond that cells have more blocks.
MOST_CELLS = 4096
#: Queries that a task compares with a block, at most about; and those it holds products of at once.
QUERY_ROWS, TOGETHER = 16_384, 256


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """The distribution function for an even number of degrees."""
    half = np.minimum(x, 1e4) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total += term
    return 1 - np.exp(-half) * total


def chi_square_point(p: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array([mid]), degrees)[0] < p else (low, mid)
    return high


def split(points: np.ndarray, most: int) -> list[np.ndarray]:
    """The leaves of a kd-tree: places of points, halved at the median of the widest dimension to at most ``most``."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        places = todo.pop()
        if len(places) <= most:
            if len(places):
                out.append(places)
            continue
        own = points[places]
        widest = (own.max(axis=0) - own.min(axis=0)).argmax()
        half = len(places) // 2
        order = np.argpartition(own[:, widest], half)
        todo += [places[order[half:]], places[order[:half]]]
    return out


def cuts(points: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The upper tree: dimension and value of each inner node, in heap order; its depth is log2 of ``cells``."""
    dims, values = np.zeros(cells, np.int64), np.zeros(cells)
    own = {1: points}
    for node in range(1, cells):
        p = own.pop(node)
        if len(p):
            dims[node] = (p.max(axis=0) - p.min(axis=0)).argmax()
            values[node] = np.median(p[:, dims[node]])
        right = p[:, dims[node]] >= values[node]
        own[2 * node], own[2 * node + 1] = p[~right], p[right]
    return dims, values


@dataclass(frozen=True)
class Projection:
    """Fixed sizes: ``directions`` (dimensions of a vector + 1, projected ones) and at most ``MOST_CELLS`` cuts."""

    directions: np.ndarray
    largest: float
    dims: np.ndarray
    values: np.ndarray
    stop: float

    def project(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        norms = (vectors * vectors).sum(axis=1)
        extra = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(self.largest - norms, 0))
        return vectors @ self.directions[:-1] + extra[:, None] * self.directions[-1]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node, cells = np.ones(len(points), np.int64), len(self.values)
        while len(node) and node[0] < cells:
            node = 2 * node + (points[np.arange(len(points)), self.dims[node]] >= self.values[node])
        return node - cells

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        cells, m = len(self.values), self.directions.shape[1]
        low, high = np.full((2 * cells, m), -np.inf), np.full((2 * cells, m), np.inf)
        for node in range(1, cells):
            for child, side in ((2 * node, high), (2 * node + 1, low)):
                low[child], high[child] = low[node], high[node]
                side[child, self.dims[node]] = self.values[node]
        return low[cells:], high[cells:]


def _distance_to(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        p = points[:, d, None]
        out += np.square(np.maximum(np.maximum(low[None, :, d] - p, p - high[None, :, d]), 0))
    return out


def _vectors(batch, ids: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a batch; all its vectors have one length."""
    column = batch.column(vector)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return batch.column(ids).to_numpy(zero_copy_only=False).astype(np.int64), flat.reshape(len(column), -1)




def _index(shared):
    def run(batches):
        """Projected rows with their cells."""
        model = shared.value
        for batch in batches:
            ids, x = _vectors(batch, "vec_id", "v")
            if len(ids):
                p = model.project(x, False)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": pa.array(ids),
                        "cell": pa.array(model.cell(p)),
                        "v": batch.column("v"),
                    }
                )

    return run


def search(
    queries: np.ndarray,
    query_ids: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    points: np.ndarray,
    projected: np.ndarray,
    bound: np.ndarray,
    k: int,
    model: Projection,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of the k best of a block for each query (-inf and -1 where there are fewer), and how many vectors were verified.

    Leaves of the block's kd-tree that the chi-square test excludes for all queries are left out. The points of the others are taken
    in order of their projected distance, more in each round, and verified on the vectors. A query stops when the test holds for
    its next point: its squared distance is at least ``model.stop`` times the squared distance of the k-th best vector so
    far (or of ``bound``, found elsewhere).
    """
    leaves = split(points, LEAF_ROWS)
    low = np.stack([points[m].min(axis=0) for m in leaves])
    high = np.stack([points[m].max(axis=0) for m in leaves])
    scores, found = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1)
    norms, verified = (queries * queries).sum(axis=1), 0
    for start in range(0, len(queries), TOGETHER):
        own = slice(start, min(start + TOGETHER, len(queries)))
        reach = np.maximum(model.largest + norms[own] - 2 * bound[own], 0)
        admitted = (_distance_to(projected[own], low, high) <= model.stop * reach[:, None]).any(axis=0)
        if not admitted.any():
            continue
        places = np.concatenate([m for m, a in zip(leaves, admitted) if a])
        near = points[places]
        near = (projected[own] ** 2).sum(axis=1)[:, None] + (near**2).sum(axis=1) - 2 * projected[own] @ near.T
        near[ids[places][None, :] == query_ids[own][:, None]] = np.inf
        verified += _verify(queries[own], norms[own], bound[own], ids, vectors, places, near, scores[own], found[own], model)
    return scores, found, verified


def _verify(queries, norms, bound, ids, vectors, places, near, scores, found, model) -> int:
    """Rounds over the points of ``places``, by their projected squared distance ``near``; fills in ``scores`` and ``found``."""
    k, verified, size = scores.shape[1], 0, 4 * scores.shape[1]
    active = np.arange(len(queries))
    while True:
        kth = np.maximum(scores[active].min(axis=1), bound[active])
        reach = np.maximum(model.largest + norms[active] - 2 * kth, 0)
        least = near[active].min(axis=1)
        active = active[(least <= model.stop * reach) & (least < np.inf)]
        if not len(active):
            return verified
        rest = near[active]
        most = min(size, rest.shape[1])
        next_ones = np.argpartition(rest, most - 1, axis=1)[:, :most] if most < rest.shape[1] else np.tile(np.arange(most), (len(active), 1))
        kth = np.maximum(scores[active].min(axis=1), bound[active])
        reach = np.maximum(model.largest + norms[active] - 2 * kth, 0)
        distance = np.take_along_axis(rest, next_ones, axis=1)
        near[active[:, None], next_ones] = np.inf
        row, column = np.nonzero((distance <= model.stop * reach[:, None]) & (distance < np.inf))
        verified += len(row)
        at = places[next_ones[row, column]]
        products = np.full(next_ones.shape, -np.inf)
        for i in range(0, len(row), 1 << 16):  # row by row in double precision, so that equal vectors have equal scores
            part = slice(i, i + (1 << 16))
            products[row[part], column[part]] = (vectors[at[part]] * queries[active[row[part]]]).sum(axis=1)
        better = np.flatnonzero((products >= scores[active].min(axis=1)[:, None]).any(axis=1) & np.isfinite(products).any(axis=1))
        who = active[better]
        names = np.where(np.isfinite(products[better]), ids[places[next_ones[better]]], -1)
        both = np.concatenate([scores[who], products[better]], axis=1)
        names = np.concatenate([found[who], names], axis=1)
        best = np.lexsort((names, -both), axis=1)[:, :k]
        scores[who] = np.take_along_axis(both, best, axis=1)
        found[who] = np.take_along_axis(names, best, axis=1)
        size *= 2


def _table_vectors(table: pa.Table, ids: str) -> tuple[np.ndarray, np.ndarray]:
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return table.column(ids).to_numpy().astype(np.int64), flat.reshape(table.num_rows, -1)


_ANSWER = "query_id long, vec_id long, score double"


def _answers(shared, k: int):
    """The answers of one block to the queries that reach it."""

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        model = shared.value
        if not block.num_rows or not asked.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({"query_id": none, "vec_id": none, "score": pa.array([], pa.float64())})
        ids, x = _table_vectors(block, "vec_id")
        q_ids, q = _table_vectors(asked, "vec_id")
        bound = asked.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
        bound = np.where(np.isnan(bound), -np.inf, bound)
        scores, found, _ = search(q, q_ids, ids, x, model.project(x, False), model.project(q, True), bound, k, model)
        good = ((found >= 0) & (scores >= bound[:, None])).ravel()
        return pa.table(
            {
                "query_id": pa.array(np.repeat(q_ids, k)[good]),
                "vec_id": pa.array(found.ravel()[good]),
                "score": pa.array(scores.ravel()[good]),
            }
        )

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    certainty: float = CERTAINTY,
    dimensions: int = DIMENSIONS,
    block_rows: int = BLOCK_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> DataFrame:
    """The k nearest of ``vectors`` (vec_id long, v array of numbers) for each of ``queries`` (of the same columns).

    Returns query_id, rank (from 1), vec_id, score: the inner product in double precision, largest first, ties to the smaller
    vec_id. A vector with the query's own id is no candidate. Scores are exact; what is approximate is which vectors are met.

    Every vector is indexed: a kd-tree over projections, whose upper part is fitted to at most ``sample_rows`` vectors and divides
    them into cells, and whose lower part is built for each block of a cell. Cells with many rows (a vector that comes very
    often) have many blocks, so that no task gets more than about ``block_rows`` at once. A query is answered in its
    own cell first; the k-th score found there is then the bound with which the stopping test chooses the other cells. Queries
    travel to the blocks, and a block only to its queries; pairs of them are never made.

    Rows of ``queries`` with one id are one query, that of the least vector. Vectors that are null, zero, or hold null or non-finite components take no part, nor do those without an id. So do not those
    whose length isn't the most common one's (the longest of these in a tie). Rows with one id are one candidate each, and
    may be named twice. No candidates give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession

    ship(spark)
    kind = vectors.schema["v"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # what a double cannot hold more exactly stays short

    def usable(frame: DataFrame) -> DataFrame:
        v = F.col("v").cast(kind)
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        frame = frame.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        return frame.filter(F.col("vec_id").isNotNull() & good & F.exists("v", lambda x: x != 0))

    rows, asked = usable(vectors), usable(queries)
    asked = asked.groupBy("vec_id").agg(F.min("v").alias("v"))
    wide = F.col("v").cast("array<double>")
    norm = F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x)
    found = (
        rows.groupBy(F.size("v").alias("d"))
        .agg(F.count("*").alias("n"), F.max(norm).alias("largest"))
        .orderBy(F.desc("n"), F.desc("d"))
        .first()
    )
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n, largest = found["d"], found["n"], found["largest"] * (1 + 1e-9)
    rows, asked = rows.filter(F.size("v") == d), asked.filter(F.size("v") == d)
    directions = np.random.default_rng(seed).standard_normal((d + 1, dimensions))
    # Enough cells for blocks of the wanted size, as a power of two.
    cells = min(MOST_CELLS, 1 << max(0, math.ceil(math.log2(max(1, n / block_rows)))))
    stop = chi_square_point(certainty, dimensions)
    model = Projection(directions, largest, np.zeros(1, np.int64), np.zeros(1), stop)
    if cells > 1:
        sample = rows.orderBy(F.xxhash64("vec_id", F.lit(seed))).limit(sample_rows).select("v").toArrow()
        points = np.array(sample.column("v").to_pylist(), np.float64)
        model = Projection(directions, largest, *cuts(model.project(points, False), cells), stop)
    shared = spark.sparkContext.broadcast(model)  # of at most MOST_CELLS cuts

    # A cell has one block for each block_rows of its rows; ids decide which.
    celled = rows.mapInArrow(_index(shared), f"vec_id long, cell long, v {kind}")
    sizes = celled.groupBy("cell").agg(F.count("*").alias("n"))
    blocks = stored(sizes.select("cell", F.ceil(F.col("n") / F.lit(block_rows)).cast("long").alias("blocks")), "blocks")
    block = F.pmod(F.xxhash64("vec_id", F.lit(seed)), "blocks") * MOST_CELLS + F.col("cell")
    index = celled.join(F.broadcast(blocks), "cell").select("cell", block.alias("block"), "vec_id", "v")  # at most MOST_CELLS rows
    index = stored(index, "index")

    def answered(wanted: DataFrame) -> DataFrame:
        """Answers to rows (vec_id, v, bound, cell), from every block of their cells.

        A block's vectors travel to its queries once, or once for each of ``parts`` shares of them where there are very many.
        """
        asking = wanted.groupBy("cell").agg(F.count("*").alias("n"))
        parts = F.broadcast(asking.select("cell", F.ceil(F.col("n") / F.lit(QUERY_ROWS)).cast("int").alias("parts")))  # at most MOST_CELLS rows
        near = index.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        each = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i * MOST_CELLS + F.col("cell")))
        share = F.pmod(F.xxhash64("vec_id", F.lit(seed + 1)), "parts").cast("int")
        asked = wanted.join(parts, "cell").join(F.broadcast(blocks), "cell").select(each.alias("block"), share.alias("part"), "vec_id", "v", "bound")
        near = near.select("block", "part", "vec_id", "v").groupBy("block", "part")
        return near.cogroup(asked.groupBy("block", "part")).applyInArrow(_answers(shared, k), _ANSWER)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = lambda frame: frame.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    homes = asked.mapInArrow(_homes(shared), f"vec_id long, v {kind}, cell long")
    at_home = stored(kth(answered(homes.withColumn("bound", F.lit(float("-inf"))))).drop("rank"), "answers-at-home")
    bounds = at_home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounds = bounds.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least")).alias("bound"))
    others = homes.join(bounds, "vec_id", "left").mapInArrow(
        _other_cells(shared), f"vec_id long, v {kind}, bound double, cell long"
    )
    everything = at_home.unionByName(answered(others))
    return kth(everything).select("query_id", "rank", "vec_id", "score")


def _homes(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            ids, x = _vectors(batch, "vec_id", "v")
            if len(ids):
                cell = model.cell(model.project(x, True))
                yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "v": batch.column("v"), "cell": pa.array(cell)})

    return run


def _other_cells(shared):
    def run(batches):
        """Each query once for every other cell that the stopping test doesn't exclude."""
        model = shared.value
        low, high = model.boxes()
        for batch in batches:
            ids, x = _vectors(batch, "vec_id", "v")
            if not len(ids):
                continue
            bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
            bound = np.where(np.isnan(bound), -np.inf, bound)
            reach = np.maximum(model.largest + (x * x).sum(axis=1) - 2 * bound, 0)
            near = _distance_to(model.project(x, True), low, high)
            wanted = ~(near > model.stop * reach[:, None])
            wanted[np.arange(len(ids)), batch.column("cell").to_numpy()] = False
            rows, cell = np.nonzero(wanted)
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": taken.column("vec_id"),
                    "v": taken.column("v"),
                    "bound": pa.array(bound[rows]),
                    "cell": pa.array(cell.astype(np.int64)),
                }
            )

    return run
