"""The driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows over as many partitions as the session shuffles into, for work on each that is far more than its bytes in a file say."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
