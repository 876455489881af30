"""Candidates for a stream of query records against a static reference, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import add_normalized_columns
from ..operators.blocking import block_priority


def stream_candidates(
    queries: DataFrame, reference: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, cap: int = 500
) -> StreamingQuery:
    """Block every micro-batch of raw query records against normalized reference records; sink gets (pairs, batch id).

    A batch that is run again after a failure has the same id and the same pairs, so a sink that overwrites by id gives
    each pair once.
    """
    def run(batch: DataFrame, number: int) -> None:
        sink(block_priority(add_normalized_columns(batch), reference, cap), number)

    return queries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
