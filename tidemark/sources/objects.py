"""Objects below a folder of any store that Arrow reaches: a listing as a data source, reads by key, and a sink that only ever creates.

The listing is planned one level deep, a task for each folder there, and takes filters on keys and sizes with it: a prefix decides which folders
are listed at all. Contents aren't read for it.

The sink writes a key once. Tasks put objects beside their places under names that nobody reads; the commit gives each its key by a hard link, which
fails where the key is taken, so that of two writers one wins. Where a key is there with the same bytes nothing is done; with others the whole
write fails and takes back what it created. It needs a folder with hard links that all executors share; other stores are refused.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

LISTED = "key string, size_bytes long, modified timestamp"
#: What the names of unfinished objects begin with; the listing leaves them out.
UNFINISHED = ".unfinished-"
_SIZES = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pafs.LocalFileSystem(), path)


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class _Plain(DataSourceReader):
    def __init__(self, root: str, prefix: str = ""):
        self.fs, self.root = opened(root.rstrip("/"))
        self.uri, self.prefix, self.sizes = root, prefix, []

    def partitions(self) -> list[InputPartition]:
        start = f"{self.root}/{self.prefix.rpartition('/')[0]}".rstrip("/")
        if self.fs.get_file_info(start).type != pafs.FileType.Directory:
            return []
        below = self.fs.get_file_info(pafs.FileSelector(start))
        folders = [i.path for i in below if i.type == pafs.FileType.Directory and f"{self._key(i.path)}/".startswith(self.prefix[: len(self._key(i.path)) + 1])]
        return [_Folder(start, False), *(_Folder(p, True) for p in folders)]

    def _key(self, path: str) -> str:
        return path[len(self.root) :].lstrip("/")

    def read(self, part: _Folder | None) -> Iterator[tuple]:
        if part is None:  # nothing was planned
            return
        for i in self.fs.get_file_info(pafs.FileSelector(part.path, recursive=part.deep)):
            key = self._key(i.path)
            if i.type == pafs.FileType.File and key.startswith(self.prefix) and not i.base_name.startswith(UNFINISHED) and all(_SIZES[k](i.size, v) for k, v in self.sizes):
                yield key, i.size, i.mtime

    def __getstate__(self) -> dict:
        return {"uri": self.uri, "prefix": self.prefix, "sizes": self.sizes}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.fs, self.root = opened(self.uri.rstrip("/"))


class _Listing(_Plain):
    """With filters that Spark hands over, which it does only where the session lets Python sources take them."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("key",):
                self._narrow(f.value)
            elif isinstance(f, EqualTo) and f.attribute == ("key",):
                self._narrow(f.value)
                yield f  # a prefix says less
            elif type(f) in _SIZES and f.attribute == ("size_bytes",):
                self.sizes.append((type(f), f.value))
            else:
                yield f

    def _narrow(self, prefix: str) -> None:
        if not prefix.startswith(self.prefix) and not self.prefix.startswith(prefix):
            self.sizes.append((LessThan, -1))  # no key has both
        self.prefix = max(self.prefix, prefix, key=len)


class ObjectListing(DataSource):
    """``spark.read.format("object_listing").load(folder)``: LISTED, one row for each file at any depth."""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = _Listing if self.options.get("filters") == "true" else _Plain
        return kind(self.options["path"], self.options.get("prefix", ""))


def listing(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Objects below a folder whose keys begin with ``prefix``. ``where`` on the start of a key or on sizes is done while listing if the session
    hands filters to Python sources (spark.sql.python.filterPushdown.enabled), and afterwards if not."""
    spark.dataSource.register(ObjectListing)
    filters = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("object_listing").option("prefix", prefix).option("filters", filters.lower()).load(folder)


def checked(expected: DataFrame, listed: DataFrame) -> DataFrame:
    """expected(key, size_bytes, ...) with ``found`` (the size there, null if none) and ``state``: absent, size or same. A null size asks for none."""
    there = listed.select("key", F.col("size_bytes").alias("found"))
    state = F.when(F.col("found").isNull(), "absent").when(F.coalesce(F.col("size_bytes") != F.col("found"), F.lit(False)), "size").otherwise("same")
    return expected.join(there, "key", "left").withColumn("state", state)


def content(folder: str, key: Column) -> Column:
    """The bytes of objects by key; null where there is none. A task reads the keys of its rows and nothing else."""

    @F.arrow_udf("binary")
    def run(keys: pa.Array) -> pa.Array:
        fs, root = opened(folder.rstrip("/"))
        out = []
        for k in keys.to_pylist():
            try:
                out.append(None if k is None else fs.open_input_file(f"{root}/{k}").read())
            except FileNotFoundError:
                out.append(None)
        return pa.array(out, pa.binary())

    return run(key)


@dataclass
class _Written(WriterCommitMessage):
    objects: list[tuple[str, str, int, str]]  # key, where it is until the commit, size, SHA-256


class DestinationConflict(ValueError):
    """A key is there with other bytes."""


class _Creating(DataSourceWriter):
    def __init__(self, root: str, schema: StructType):
        if "://" in root and not root.startswith("file://"):
            raise ValueError(f"{root} isn't a folder with hard links")
        if {"key", "content"} - set(schema.names):
            raise ValueError("objects need the columns key and content")
        self.root = root.removeprefix("file://").rstrip("/")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        done: list[tuple[str, str, int, str]] = []
        try:
            for row in rows:
                key, data = row["key"], bytes(row["content"])
                if not key or ".." in key.split("/") or key.startswith("/") or key.endswith("/"):
                    raise ValueError(f"{key!r} isn't a safe key")
                folder, _, base = f"{self.root}/{key}".rpartition("/")
                os.makedirs(folder, exist_ok=True)
                beside = f"{folder}/{UNFINISHED}{uuid.uuid4().hex}-{base}"[:4000]
                done.append((key, beside, len(data), hashlib.sha256(data).hexdigest()))
                with open(beside, "xb") as file:
                    file.write(data)
                    file.flush()
                    os.fsync(file.fileno())
        except BaseException:
            self._forget(done)  # an aborted task sends no message
            raise
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        objects, created, conflicts = [o for m in messages if m for o in m.objects], [], []
        try:
            for key, beside, size, digest in objects:
                place = f"{self.root}/{key}"
                try:
                    os.link(beside, place)
                    created.append(place)
                except FileExistsError:
                    pass
                with open(place, "rb") as file:  # verified as it is there, whoever wrote it
                    there = hashlib.file_digest(file, "sha256").hexdigest()
                    if (os.fstat(file.fileno()).st_size, there) != (size, digest):
                        conflicts.append(key)
            if conflicts:
                raise DestinationConflict(f"there with other bytes: {', '.join(sorted(conflicts)[:10])}")
        except BaseException:
            for place in created:
                os.unlink(place)
            raise
        finally:
            self._forget(objects)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._forget([o for m in messages if m for o in m.objects])

    @staticmethod
    def _forget(objects: list[tuple[str, str, int, str]]) -> None:
        for _, beside, _, _ in objects:
            try:
                os.unlink(beside)
            except FileNotFoundError:
                pass


class CreatedObjects(DataSource):
    """``df.write.format("created_objects").mode("append").save(folder)`` of rows with key and content; see the module's text."""

    @classmethod
    def name(cls) -> str:
        return "created_objects"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("objects are created, never replaced")
        return _Creating(self.options["path"], schema)


def create_objects(objects: DataFrame, folder: str) -> None:
    """Creates objects(key, content); fails as a whole where a key is there with other bytes."""
    objects.sparkSession.dataSource.register(CreatedObjects)
    objects.select("key", "content").write.format("created_objects").mode("append").save(folder)
