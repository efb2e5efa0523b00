"""Streaming.

The reference reads every input whole; it has no streaming sources, watermarks
or stateful operators, so none are built here.  :func:`apply_per_batch` is the
only adapter: it runs any batch operator of this package on each micro-batch
of a Structured Streaming source via ``foreachBatch`` (e.g. cleaning newly
landed files as they arrive).  Each batch owns the folder ``batch_id=<id>``
and overwrites it, so a batch that is retried is not written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def apply_per_batch(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                    fmt: str = "parquet", trigger_once: bool = False):
    """Start a query applying ``fn`` to every micro-batch and writing the result
    to ``path/batch_id=<id>`` (read back, ``batch_id`` is a partition column)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
