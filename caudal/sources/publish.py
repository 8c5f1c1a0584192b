"""Publish after success: folders are written aside, checked, and only then take the place of the old ones.

A failed write or check leaves everything as it was. The switch renames folders beside each other: the old one goes to
``_previous-…``, the new one to its place, and if any rename of a publication fails, all are undone. Readers overlook names that
begin with an underscore. A process that ends between two renames leaves the old folder under ``_previous-…``, from where
``recover`` (and the next publication of that folder) takes it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Files:
    """What publishing needs of the file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def drop(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def listing(self, folder: str) -> tuple[tuple[str, int, int], ...]:
        """Name, size and time of change of every file below a folder."""
        found, files = [], self._fs.listFiles(self._path(folder), True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return tuple(sorted(found))

    def matching(self, pattern: str) -> list[str]:
        return sorted(str(f.getPath().toString()) for f in self._fs.globStatus(self._path(pattern)) or [])


def _parts(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def recover(spark: SparkSession, path: str) -> bool:
    """Take a folder back that an interrupted publication had moved away; True if there was one."""
    files, (parent, name) = Files(spark, path), _parts(path)
    kept = files.matching(f"{parent}/_previous-*/{name}") if "=" not in name else []
    if not kept or files.exists(path):
        return False
    files.move(kept[-1], path)
    return True


def partition_folder(spark: SparkSession, values: Row | dict, keys: Sequence[str]) -> str:
    """The folder of a partition as Spark names it; the values as strings or None."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(name(k, values[k]) for k in keys)


class Publication:
    """Folders that are switched in together when the ``with`` block ends, or not at all if it fails."""

    def __init__(self, spark: SparkSession):
        self._spark, self._id = spark, uuid.uuid4().hex[:12]
        self._staged: dict[str, str | None] = {}
        self._aside: set[str] = set()

    def _place(self, path: str) -> str:
        parent, name = _parts(path)
        self._aside.add(parent)
        return f"{parent}/_staging-{self._id}/{name}"

    def stage(self, df: DataFrame, path: str, keys: Sequence[str] = (), order: Sequence[str] = (), check: Callable[[DataFrame], None] | None = None) -> int:
        """Write a folder's next contents aside; returns the rows written. ``check`` sees them as stored and may raise."""
        path = path.rstrip("/")
        recover(self._spark, path)
        counter, place = Observation(), self._place(path)
        out = df.hint("rebalance", *[F.col(k) for k in keys]) if keys else df.hint("rebalance") if order else df
        if order:
            out = out.sortWithinPartitions(*keys, *order)
        writer = out.observe(counter, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy")
        (writer.partitionBy(*keys) if keys else writer).parquet(place)
        if check is not None:
            check(self._spark.read.schema(df.schema).parquet(place))
        self._staged[path] = place
        return int(counter.get["rows"])

    def stage_partitions(self, df: DataFrame, path: str, keys: Sequence[str], touched: Sequence[Row]) -> int:
        """Write the next contents of the touched partitions aside; one of which nothing is left is taken away.

        ``touched`` has the keys as strings. Rows of another partition are an error: they may not be all of its rows.
        """
        path, wanted = path.rstrip("/"), [partition_folder(self._spark, t, keys) for t in touched]
        counter, place = Observation(), f"{path}/_staging-{self._id}"
        self._aside.add(path)
        df.hint("rebalance", *keys).observe(counter, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy").partitionBy(*keys).parquet(place)
        files = Files(self._spark, path)
        found = {"/".join(f.rstrip("/").split("/")[-len(keys):]) for f in files.matching(f"{place}/{'/'.join('*=*' for _ in keys)}")}
        if found - set(wanted):
            raise ValueError(f"rows of partitions that were not touched: {', '.join(sorted(found - set(wanted))[:5])}")
        for folder in wanted:
            self._staged[f"{path}/{folder}"] = f"{place}/{folder}" if folder in found else None
        return int(counter.get["rows"])

    def read(self, path: str, schema: T.StructType | str) -> DataFrame:
        """A folder as it will be once published."""
        path = path.rstrip("/")
        return self._spark.read.schema(schema).parquet(self._staged.get(path) or path)

    def publish(self) -> None:
        done: list[tuple[str, str | None, str | None]] = []
        try:
            for path, place in self._staged.items():
                files, (parent, name) = Files(self._spark, path), _parts(path)
                old = f"{parent}/_previous-{self._id}/{name}" if files.exists(path) else None
                self._aside.add(parent)
                if old:
                    files.move(path, old)
                done.append((path, None, old))
                if place:
                    files.move(place, path)
                    done[-1] = (path, place, old)
        except Exception:
            for path, place, old in reversed(done):
                files = Files(self._spark, path)
                if place:
                    files.move(path, place)
                if old:
                    files.move(old, path)
            raise
        finally:
            self.discard()

    def discard(self) -> None:
        """Drop what was written aside, and the old folders once others stand in their places."""
        for parent in self._aside:
            for kind in ("_staging", "_previous"):
                Files(self._spark, parent).drop(f"{parent}/{kind}-{self._id}")
        self._staged, self._aside = {}, set()

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_) -> None:
        self.publish() if kind is None else self.discard()
