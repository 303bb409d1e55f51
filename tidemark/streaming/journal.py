"""The journal as a stream: latest state of each item, how many items are in each state, and the states of retried items.

All keep one row of state an item. Events need a ``seq`` that orders them, as arrival order says nothing after a retry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.journal import CONFLICTS, RETRYABLE, TERMINAL, latest
from tidemark.sources.journal import append_batch


def latest_states(events: DataFrame, handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Hands ``handle`` the items whose (status, attempts) changed, one batch at a time."""
    return latest(events).writeStream.outputMode("update").foreachBatch(handle)


def status_feed(events: DataFrame, handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Hands ``handle`` (status, items) over all items so far after each batch."""

    def count(states: DataFrame, batch_id: int) -> None:
        handle(states.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("items")), batch_id)

    return latest(events).writeStream.outputMode("complete").foreachBatch(count)


def journal_sink(events: DataFrame, path: str) -> DataStreamWriter:
    """Appends a stream of events to the journal at ``path``, each batch once."""
    return events.writeStream.outputMode("append").foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, path))


_RETRIED = "item_id string, seq long, status string, attempts long"


def retry_states(events: DataFrame, most: int) -> DataFrame:
    """A stream of events(item_id, seq, status, error_type) as a run journals them, see ``journal.retried``: a failure becomes conflict,
    quarantined or failed-retryable by the attempts so far, and nothing of an item follows its terminal state. The state is one
    (attempts, ended) an item. Events of an item must arrive in the order of ``seq`` over batches; within one they are sorted."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, ended = state.get if state.exists else (0, False)
        out = []
        for e in pd.concat(frames).sort_values("seq").itertuples():
            if ended:
                break
            attempts += e.status == "attempting"
            status = e.status
            if status == "failed":
                status = "conflict" if e.error_type in CONFLICTS else "quarantined" if attempts >= most else RETRYABLE
            ended = status in TERMINAL
            out.append((key[0], e.seq, status, attempts))
        state.update((attempts, ended))
        yield pd.DataFrame(out, columns=["item_id", "seq", "status", "attempts"])

    kept = events.select(F.col("item_id").cast("string").alias("item_id"), F.col("seq").cast("long").alias("seq"), "status", "error_type")
    return kept.groupBy("item_id").applyInPandasWithState(run, _RETRIED, "attempts long, ended boolean", "append", GroupStateTimeout.NoTimeout)
