"""Refreshing an index as edit notices arrive.

A file stream remembers paths, so an edited or deleted source file would never
show up in one. The stream here carries notices instead: small JSON files that
say an edit happened. However many arrive while a refresh runs, they make one
further micro-batch and so one further refresh, and the refresh finds out by
comparison what changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

NOTICE = "reason string, at_us bigint"


def notices(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of notices dropped into ``folder``."""
    return spark.readStream.schema(NOTICE).json(folder)


def refresh_on(
    stream: DataFrame,
    refresh: Callable[[], dict[str, int]],
    checkpoint: str,
    interval: str | None = None,
    done: Callable[[dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Call ``refresh`` once for every micro-batch that holds notices.

    Without ``interval`` the query handles what is there and stops. After a
    failure the batch is handed out again, which is harmless: a refresh with
    nothing to do changes nothing.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        if batch.limit(1).count():
            counters = refresh()
            if done is not None:
                done(counters)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
