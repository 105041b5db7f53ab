"""Dimension changes that arrive as a stream, merged batch by batch into the stored warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.dimensions import Dimension, with_hash
from starloom.plans.load import load_dimension
from starloom.sources.landing import conform
from starloom.sources.store import WarehouseStore


def latest_rows(changes: DataFrame, key: str, sequence: str) -> DataFrame:
    """The last row per key within a micro-batch; an aggregate, so a busy key is combined early."""
    row = F.struct(*[c for c in changes.columns if c != key])
    return changes.groupBy(key).agg(F.max_by(row, sequence).alias("row")).select(key, "row.*")


def merge_feed(
    stream: DataFrame, store: WarehouseStore, dim: Dimension, sequence: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Start a query that applies each micro-batch as one audited Type 2 load, exactly once.

    The batch carries the checkpoint's folder and the micro-batch number. One that is delivered again
    after it was published is skipped; after a driver was lost inside it, it is loaded anew.
    """
    def apply(batch: DataFrame, number: int) -> None:
        rows = conform(latest_rows(batch, dim.natural, sequence), dim.source_schema)
        load_dimension(store, dim, with_hash(rows, dim.tracked), f"{dim.name} feed {number}", feed=checkpoint, number=number)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
