"""Records of JSON array files, each file read by many tasks.

Spark reads the files as text that ends with every closing brace, so that a file is divided into blocks like any text. No escape sequence of JSON holds a
brace, so no piece ends within one. Whether a piece starts inside a string, and how deep in objects, follows from the
quotes and braces of all pieces before it: every block is counted first, for both cases; the sums over the blocks before it
give the state it starts in; and then every block is cut into its records. A record that lies across blocks
is put together from its parts, of which there are at most two for a block.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# The functions below travel with the job, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_END = "}"
_KEPT = ["value", "file", "block"]
_STRING_OR_BRACE = re.compile(rb'"(?:[^"\\]|\\.)*(?:"|$)|\{', re.DOTALL)
_WHOLE, _END, _START = 0, 1, 2
_PARTS = "file string, block long, kind int, record string"
_PART_TYPES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("record", pa.string())])
_COUNTS = "file string, block long, quotes int, outside long, inside long"
_COUNT_TYPES = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64())]
)


def with_places(pieces: DataFrame) -> DataFrame:
    """The pieces of a text reader with the file and block of each."""
    return pieces.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of array files, in the order of their blocks within every task."""
    return with_places(spark.read.option("lineSep", PIECE_END).text(path))


def _signs(piece: bytes) -> tuple[int, int, int]:
    """The quotes of a piece, and its opening braces after an even and after an odd number of them; escaped quotes are none."""
    if b"\\" in piece:
        piece = piece.replace(b"\\\\", b"").replace(b'\\"', b"")
    first, *others = piece.split(b"{")
    quotes, opened = first.count(b'"'), [0, 0]
    for other in others:
        opened[quotes & 1] += 1
        quotes += other.count(b'"')
    return quotes, *opened


def _from_first_brace(piece: bytes, text: int) -> bytes:
    """A piece from its first brace outside strings on; ``text`` tells that it starts within one."""
    quoted = b'"' + piece if text else piece
    return next(quoted[m.start() :] for m in _STRING_OR_BRACE.finditer(quoted) if m.group() == b"{")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, str, int]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            values = part.column("value").cast(pa.binary()).to_pylist()
            yield from zip(values, part.column("file").to_pylist(), part.column("block").to_pylist())


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block whether its quotes are odd, and by how much its braces open if it starts outside or inside a string."""
    found: dict[tuple[str, int], list[int]] = {}
    for text, file, block in _rows(batches):
        now = found.setdefault((file, block), [0, 0, 0])
        quotes, even, odd = _signs(text)
        if quotes & 1:  # so does the brace after the piece count
            odd -= 1
        else:
            even -= 1
        if now[0]:
            even, odd = odd, even
        now[0] ^= quotes & 1
        now[1] += even
        now[2] += odd
    columns = zip(*[(*place, *counts) for place, counts in found.items()]) if found else [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNT_TYPES)], schema=_COUNT_TYPES)


def starts(counted: DataFrame) -> DataFrame:
    """The state at the start of each block: inside a string or not, and the number of open objects.

    Blocks are few, one for some MB of text; those of a file are added up in order.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    return (
        counted.withColumn("text", odd.cast("int"))
        .withColumn("opened", F.when(F.col("text") == 1, F.col("inside")).otherwise(F.col("outside")))
        .select("file", "block", "text", F.coalesce(F.sum("opened").over(before), F.lit(0)).alias("depth"))
    )


class _Cutter:
    """Cuts the pieces of one block into records."""

    def __init__(self, text: int, depth: int):
        self.text, self.depth = text, max(0, depth)
        self.held: list[bytes] = []
        self.begun_here = not self.depth

    def add(self, piece: bytes) -> tuple[int, bytes] | None:
        """A record, or the end of one, that is complete with this piece."""
        quotes, *opened = _signs(piece)
        before, text = self.depth, self.text
        self.text ^= quotes & 1
        closes = not self.text  # the brace after the piece stands outside strings
        self.depth = before + opened[text]
        if not before and not self.depth:
            return None  # between records, or after the last one
        if not before:
            piece, self.begun_here = _from_first_brace(piece, text), True
        self.held.append(piece + b"}")
        self.depth -= closes
        if self.depth or self.text:
            return None
        done = (_WHOLE if self.begun_here else _END), b"".join(self.held)
        self.held, self.begun_here = [], True
        return done

    def rest(self) -> tuple[int, bytes] | None:
        """What the block leaves open: the start of a record, or, if it has no end of one either, a part of its middle."""
        return ((_START if self.begun_here else _END), b"".join(self.held)) if self.held else None


def _cut(known, only_parts: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = known.value
        place, cutter, out, size = None, None, [], 0

        def give() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 4
            arrays = [pa.array(c, f.type) for c, f in zip(columns[:3], _PART_TYPES)]
            arrays.append(pa.array(columns[3], pa.binary()).cast(pa.string()))
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=_PART_TYPES)

        for text, file, block in _rows(batches):
            if (file, block) != place:
                if cutter and (found := cutter.rest()) and only_parts:
                    out.append((*place, *found))
                place, cutter = (file, block), _Cutter(*states.get((file, block), (0, 0)))
            found = cutter.add(text)
            if found and only_parts == (found[0] != _WHOLE):
                out.append((*place, *found))
                size += len(found[1])
                if size > 4_000_000:
                    yield give()
                    size = 0
        if cutter and (found := cutter.rest()) and only_parts:
            out.append((*place, *found))
        yield give()

    return run


def records(placed: DataFrame) -> DataFrame:
    """Rows (record string): every object of the arrays, as its JSON text, in any order.

    ``placed`` has the pieces of :func:`pieces`. Files may be larger than a task's memory; a record may not. What a truncated file
    leaves open is a record too, which is no JSON. Elements that are not objects are left out, as is everything between them.
    Only the starting states of blocks after a file's first one are sent to all tasks: some bytes for each block of text.
    """
    spark = placed.sparkSession
    found = starts(placed.mapInArrow(_count, _COUNTS)).filter("block > 0").collect()
    known = spark.sparkContext.broadcast({(r.file, r.block): (r.text, r.depth) for r in found})
    one = placed.mapInArrow(_cut(known, False), _PARTS).select("record")
    # A block that leaves a record open is followed by others, or the file is truncated.
    parts = placed.mapInArrow(_cut(known, True), _PARTS)
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.sum(F.when(F.col("kind") == _START, 1).otherwise(0)).over(in_order)
    joined = (
        parts.withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda p: p["record"]), "").alias("record"))
    )
    return one.unionAll(joined)
