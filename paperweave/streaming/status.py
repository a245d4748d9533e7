"""Status snapshots as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from paperweave.operators.state import latest_per_key
from paperweave.plans.monitor import refresh_stored

REFRESH = "1 minute"


def latest_status(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key of a stream; write it in complete or update mode."""
    return latest_per_key(events, keys, order)


def write_refresh(
    snapshots: DataFrame, root: str, order: list[str], checkpoint: str, expired_is_failure: bool = False,
) -> DataStreamWriter:
    """Writer that refreshes the stored tables with every micro-batch.

    Applying a snapshot twice is the same as once, so a micro-batch that runs
    again after a failure leaves the same tables.
    """

    def refresh(batch: DataFrame, epoch: int) -> None:
        refresh_stored(batch.sparkSession, root, batch, order, expired_is_failure)

    return (snapshots.writeStream.foreachBatch(refresh)
            .option("checkpointLocation", checkpoint).trigger(processingTime=REFRESH))
