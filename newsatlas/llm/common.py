"""What several operators of this subpackage share: tables, shared storage, words and their hashes."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

_M = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once, which may not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).parents[2]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / "newsatlas.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / "newsatlas").rglob("*.py")):
                out.write(file, file.relative_to(root))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor sees.

    Where it is unset a temporary folder serves, in local mode only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it again.

    This cuts the lineage: what was computed survives the loss of executors, and is computed once
    however often it is read. The table stays until the folder is cleared by its owner.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, as bytes; none for a null."""
    return text.split() if text else []  # bytes.split() divides at just these six bytes


def texts_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def chunks(
    batches: Iterable[pa.RecordBatch], columns: list[str], most: int = 8_000_000
) -> Iterator[list[tuple]]:
    """Rows of the columns (``text`` as bytes), in lists of at least ``most`` bytes of text, the last one less."""
    held, size = [], 0
    at = columns.index("text")
    for batch in batches:
        for start in range(0, batch.num_rows, 256):  # few rows at once, as the batch itself is held too
            part = batch.slice(start, 256)
            lists = [texts_of(part.column(c)) if c == "text" else part.column(c).to_pylist() for c in columns]
            for row in zip(*lists):
                held.append(row)
                size += len(row[at] or b"") + 64
                if size >= most:
                    yield held
                    held, size = [], 0
    if held:
        yield held
    give_back()


def give_back() -> None:
    """Return memory that a task has freed to the system, as its worker lives on."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive hashes: entry i covers i..i+n-1. Shorter input gives none."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = h[:size].copy()
    for k in range(1, n):
        out *= _M
        out += h[k : k + size]
    return mixed(out)


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], salts: int = 16, how: str = "left") -> DataFrame:
    """Join rows to at most one row per key, when one key may hold a large part of ``many``.

    The rows of a key are divided among ``salts`` tasks; each row of ``few`` is repeated for them.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int"))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
