"""Exactly-once rows out of streams that deliver some rows several times, with bounded state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def drop_repeats(rows: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key, if repeats carry times within ``delay`` of it.

    The watermark is the newest time seen, less ``delay``. A row older than the
    watermark of the batch before its own is late: it is dropped and counted,
    see :func:`late_rows`. A key is remembered until the watermark has passed
    its time by ``delay``, so the state grows with the rate of keys, not with
    the age of the stream. A null key is a key like any other; rows without a
    time are not kept.
    """
    timed = rows.where(f"`{time}` IS NOT NULL").withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def append_once(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a Parquet table; started again it goes on where the checkpoint says."""
    return (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start(path))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late, over the batches of this run that the query still reports."""
    return sum(operator["numRowsDroppedByWatermark"] for batch in query.recentProgress for operator in batch["stateOperators"])
