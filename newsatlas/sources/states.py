"""Stored states of running analyses: versions that replace each other, and logs that grow.

Everything is written under the number of its batch, and read only from smaller numbers. A batch that is repeated after a failure so sees what it
saw before, and replaces what it had written; nothing counts twice. What lacks its ``_SUCCESS`` file was never finished and is not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession

_DIGITS = 12


class StateStore:
    """States below a root folder that all executors share, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")

    def _place(self, path: str):
        place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._spark._jsc.hadoopConfiguration()), place

    def _finished(self, name: str, prefix: str) -> list[str]:
        """Folders of a state that were written to the end, in order of their names."""
        system, place = self._place(f"{self._root}/{name}")
        if not system.exists(place):
            return []
        names = sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())
        done = [n for n in names if n.startswith(prefix)]
        return [n for n in done if system.exists(self._place(f"{self._root}/{name}/{n}/_SUCCESS")[1])]

    def _remove(self, name: str, folder: str) -> None:
        system, place = self._place(f"{self._root}/{name}/{folder}")
        system.delete(place, True)

    def _read(self, schema, name: str, *folders: str) -> DataFrame:
        return self._spark.read.schema(schema).parquet(*[f"{self._root}/{name}/{f}" for f in folders])

    # --- versions ---

    def version(self, name: str, before: int, schema) -> DataFrame | None:
        """The newest version that an earlier batch wrote."""
        limit = f"version={before:0{_DIGITS}d}"
        earlier = [n for n in self._finished(name, "version=") if n < limit]
        return self._read(schema, name, earlier[-1]) if earlier else None

    def put(self, frame: DataFrame, name: str, batch: int) -> DataFrame:
        """Write the version of a batch; the one before it stays, for the batch may be repeated, and older ones go."""
        folder = f"version={batch:0{_DIGITS}d}"
        frame.write.mode("overwrite").parquet(f"{self._root}/{name}/{folder}")
        for old in [n for n in self._finished(name, "version=") if n < folder][:-1]:
            self._remove(name, old)
        return self._read(frame.schema, name, folder)

    # --- logs ---

    def _parts(self, name: str, before: int) -> list[tuple[int, int, str]]:
        """Finished folders (first batch, last batch, name) below a batch, none of which lies within another."""
        found = []
        for folder in self._finished(name, "batches="):
            first, last = folder.removeprefix("batches=").split("-")
            if int(last) < before:
                found.append((int(first), int(last), folder))
        return [a for a in found if not any(b != a and b[0] <= a[0] and a[1] <= b[1] for b in found)]

    def log(self, name: str, before: int, schema, where: Column | None = None) -> DataFrame | None:
        """All rows that earlier batches appended; ``where`` over the column the log is divided by leaves out whole folders."""
        parts = self._parts(name, before)
        if not parts:
            return None
        rows = None
        for *_, folder in parts:
            part = self._read(schema, name, folder)
            part = part if where is None else part.filter(where)
            rows = part if rows is None else rows.unionByName(part)
        return rows

    def append(self, frame: DataFrame, name: str, batch: int, by: str | None = None, most_parts: int = 96) -> DataFrame:
        """Add the rows of a batch, divided by a column or not; from ``most_parts`` folders on, earlier ones are made one."""
        folder = f"batches={batch:0{_DIGITS}d}-{batch:0{_DIGITS}d}"
        self._write(frame, name, folder, by)
        parts = self._parts(name, batch)
        if len(parts) >= most_parts:
            self._fold(frame.schema, name, parts, by)
        return self._read(frame.schema, name, folder)

    def _write(self, frame: DataFrame, name: str, folder: str, by: str | None) -> None:
        writer = frame.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(f"{self._root}/{name}/{folder}")

    def _fold(self, schema, name: str, parts: list[tuple[int, int, str]], by: str | None) -> None:
        """One folder in the place of several: it is written first, hides them once it is finished, and only then they go."""
        rows = None
        for *_, folder in parts:
            part = self._read(schema, name, folder)
            rows = part if rows is None else rows.unionByName(part)
        first, last = min(p[0] for p in parts), max(p[1] for p in parts)
        self._write(rows, name, f"batches={first:0{_DIGITS}d}-{last:0{_DIGITS}d}", by)
        for *_, folder in parts:
            self._remove(name, folder)
