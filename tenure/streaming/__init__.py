"""Streaming entry points.

The reference has no streaming sources, windows or state (SURVEY L1), so no
streaming operator is built. What a user can do is feed request files as
they land (pastes, recipient sheets) through the same batch plans:
``run_per_batch`` applies a batch plan to every micro-batch of a file
stream with ``foreachBatch`` (exactly-once when the sink is idempotent,
checkpointed under the folder the session names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_per_batch(spark: SparkSession, stream: DataFrame, plan: Callable[[DataFrame], DataFrame],
                  sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True):
    """Apply ``plan`` to each micro-batch of ``stream`` and hand the result to ``sink``."""
    def each(batch: DataFrame, epoch: int) -> None:
        sink(plan(batch), epoch)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if once:
        w = w.trigger(availableNow=True)
    return w.start()
