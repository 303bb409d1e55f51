"""The append-only journal: latest state, attempts, what remains to do, cohorts; and target classification."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: States that end an item's processing, and the one that may be tried again.
TERMINAL = ("freed", "conflict", "quarantined")
RETRYABLE = "failed-retryable"


def latest(events: DataFrame, item: str = "item_id", seq: str = "seq") -> DataFrame:
    """(item, status, attempts): the last event in file order, and how often the item was attempted."""
    return events.groupBy(item).agg(F.max_by("status", seq).alias("status"), F.sum(F.when(F.col("status") == "attempting", 1).otherwise(0)).alias("attempts"))


def status_counts(events: DataFrame, item: str = "item_id", seq: str = "seq") -> DataFrame:
    return latest(events, item, seq).groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("items"))


def remaining(items: DataFrame, events: DataFrame, retry_only: bool = False, item: str = "item_id") -> DataFrame:
    """Items that are still to be processed: those not in a terminal state, or with ``retry_only`` those that failed retryably."""
    state = latest(events, item)
    if retry_only:
        return items.join(state.where(F.col("status") == RETRYABLE).select(item), item, "left_semi")
    return items.join(state.where(F.col("status").isin(*TERMINAL)).select(item), item, "left_anti")


def drift(items: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Items with ``state``: missing, conflict (size or etag differ; quotes don't count) or same."""
    bare = lambda c: F.trim(F.trim(c), F.lit('"'))
    there = inventory.select(key, F.col("size_bytes").alias("size2"), F.col("etag").alias("etag2"), F.lit(True).alias("there2"))
    joined = items.join(there, key, "left")
    same = (F.col("size_bytes") == F.col("size2")) & (bare(F.col("etag")) == bare(F.col("etag2")))
    state = F.when(F.col("there2").isNull(), "missing").when(F.coalesce(same, F.lit(False)), "same").otherwise("conflict")
    return joined.withColumn("state", state).drop("size2", "etag2", "there2")


def with_latest(items: DataFrame, events: DataFrame, item: str = "item_id", seq: str = "seq") -> DataFrame:
    """Items with their latest status and attempts; an item without events has a null status and no attempts."""
    return items.join(latest(events, item, seq), item, "left").na.fill(0, ["attempts"])


#: Failures that end an item at once.
CONFLICTS = ("SourceConflict", "DestinationConflict")


def failure_status(error_type: Column, attempts: Column, most: int) -> Column:
    """What a failed attempt makes of an item: conflict, quarantined once it was tried ``most`` times, else retryable."""
    return F.when(error_type.isin(*CONFLICTS), "conflict").when(attempts >= most, "quarantined").otherwise(RETRYABLE)


def retried(events: DataFrame, most: int, item: str = "item_id", seq: str = "seq") -> DataFrame:
    """events(item, seq, status, error_type) as a run would have journalled them: after an item's first terminal state nothing of it
    happens, and a failure (status ``failed``) has the state that its attempts so far give. Adds ``attempts`` so far."""
    so_far = Window.partitionBy(item).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tried = events.withColumn("attempts", F.sum(F.when(F.col("status") == "attempting", 1).otherwise(0)).over(so_far))
    state = F.when(F.col("status") == "failed", failure_status(F.col("error_type"), F.col("attempts"), most)).otherwise(F.col("status"))
    ended = F.sum(F.when(F.col("status").isin(*TERMINAL), 1).otherwise(0)).over(Window.partitionBy(item).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1))
    return tried.withColumn("status", state).withColumn("_ended", F.coalesce(ended, F.lit(0))).where("_ended = 0").drop("_ended")


def cohorts(items: DataFrame, job: str, order: str, size: str, most: int) -> DataFrame:
    """Next-fit packing of each job's items in order into cohorts of ``most`` bytes; an item above that fails the query.

    The fold depends on all items before, so a job is one stream: items are sorted by job and order and read batch by batch, with one cohort's
    number and bytes carried on. A job of any length takes no more memory than a batch.
    """
    columns = items.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, at, held = None, 0, 0
        for pdf in frames:
            out = []
            for name, n in zip(pdf[job].tolist(), pdf[size].tolist()):
                if n > most:
                    raise ValueError(f"an item of {n} bytes exceeds the cohort's {most}")
                if name != owner:
                    owner, at, held = name, 0, 0
                elif held and held + n > most:
                    at, held = at + 1, 0
                held += n
                out.append(at)
            yield pdf[columns].assign(cohort=out)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.repartition(job).sortWithinPartitions(job, order).mapInPandas(run, f"{fields}, cohort long")

