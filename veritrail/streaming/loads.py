"""Streams into the store: the newest row of each key, each batch once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..sources.store import Store


def newest(stream: DataFrame, keys: Sequence[str], by: str, delay: str) -> DataFrame:
    """The rows of a stream that are newer by `by` than all of their key so far; of a batch's rows of a key only the newest.

    What was newest is state, a time a key, and goes once the watermark has passed it: rows older than that are late and dropped. A row of the
    same time as the newest does not replace it."""
    schema = StructType([stream.schema[c] for c in stream.columns])
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for rows in frames:  # one Arrow batch after another: no more than a batch and a row are held
            rows = rows if best is None else pd.concat([best, rows])
            best = rows.sort_values([by, *[c for c in rows.columns if c != by]], ascending=[False] + [True] * (rows.shape[1] - 1), kind="stable").iloc[:1]
        at = best[by].iloc[0]
        at = at.tz_localize(zone) if at.tzinfo is None else at
        micros = at.value // 1000
        if not state.exists or micros > state.get[0]:
            state.update((micros,))
            yield best
        # no sooner than the watermark is
        state.setTimeoutTimestamp(max(state.get[0] // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    late = stream.where(F.col(by).isNotNull()).withWatermark(by, delay)
    return late.groupBy(*keys).applyInPandasWithState(keep, schema, "newest long", "append", GroupStateTimeout.EventTimeTimeout)


def batch_upsert(store: Store, table: str, keys: Sequence[str], by: str, name: str, by_month: str | None = None) -> Callable[[DataFrame, int], None]:
    """What a stream does with each of its batches: an upsert that names the stream and the batch. A batch that was committed is not done
    again, so that a stream that is started anew may send it twice."""

    def load(rows: DataFrame, batch: int) -> None:
        operation = f"stream {name} {batch}"
        if store.exists(table) and store.history(table).where(F.col("operation") == operation).take(1):
            return
        store.upsert(table, rows, keys, by, by_month, operation)

    return load


def upserted(stream: DataFrame, store: Store, table: str, keys: Sequence[str], by: str, name: str, checkpoint: str, by_month: str | None = None) -> StreamingQuery:
    """Starts a stream into a table of the store, over all there is now. The checkpoint is a folder that outlives the application."""
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(batch_upsert(store, table, keys, by, name, by_month)).start()
