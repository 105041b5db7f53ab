"""UPDATE and DELETE of a table by predicate, expressed as the next snapshot of it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _holds(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def update_where(df: DataFrame, predicate: Column | None, changes: Mapping[str, Column]) -> DataFrame:
    """Rows where the predicate is true get the new values; unknown counts as false."""
    hit = F.lit(True) if predicate is None else _holds(predicate)
    return df.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in changes else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows where the predicate is true go away; unknown keeps the row."""
    return df.filter(~_holds(predicate))
