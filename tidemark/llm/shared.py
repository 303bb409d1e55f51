"""Folders for intermediate tables that every executor can reach, and small table helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, from ``spark.checkpoint.dir``. Where that is unset, a temporary one in local mode (tests),
    where driver and executors are one process; on a cluster, whose machines wouldn't see it, an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that every executor reaches")
        root = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, 1,000 rows at most go to a Python worker at once, as whole texts are long; then the session is as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(1000, int(before)) if int(before) > 0 else 1000)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """A fresh folder below the shared one; ``keep`` writes a table there and reads it back, which cuts the lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._kept: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.root}/{self._n:03d}-{name}"
        self._n += 1
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with small_batches(self.spark):
            writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._kept.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that ``keep`` returned and that nothing reads any more; others are left alone."""
        context = self.spark.sparkContext
        for path in [p for df, p in self._kept if any(df is t for t in tables)]:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        self._kept = [(df, p) for df, p in self._kept if not any(df is t for t in tables)]


#: Rows of a small table's file, and the tasks a core that write such a table at least.
FILE_ROWS, FILE_TASKS = 250_000, 2


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` narrow rows, in fewer partitions for ``Scratch.keep``: where each file's permissions are set by a process of its
    own (Hadoop's local file system), small tables in as many files as the shuffle has partitions start very many, each of the executor's size until it runs."""
    return df.coalesce(max(FILE_TASKS * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(column: str, folds: int):
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def without(columns: list[str], *own: str) -> list[str]:
    """``columns`` but those named like an operator's own result columns, which win."""
    return [c for c in columns if c.lower() not in own]
