"""Keep a by-day store filled from a landing stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eocube.plans.ingest import STEPS, add_slices
from eocube.streaming.steps import run_each


def fill_from_stream(stream: DataFrame, root: str, value: str, checkpoint: str, *, steps: int = STEPS):
    """Each micro-batch is added to the partial aggregates of its days.

    A day may land in any number of deliveries.  Besides the batch only the stored cells of its
    days are read, never what has landed before.  A slice of a cell that lands again, or in a
    batch that is replayed after a failure, is known by its step and counts once.
    """

    def send(batch: DataFrame, _id: int) -> None:
        add_slices(batch.sparkSession, root, batch, value, steps=steps)

    return run_each(send, stream, checkpoint)
