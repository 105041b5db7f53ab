"""Top-k shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import dense_index


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_with_ties(df: DataFrame, n: int, column: str) -> DataFrame:
    """The n largest values of `column` and every row equal to the last of them; NULLs rank last.

    The cut-off comes from a top-n over the one column; the rows are then a filtered scan, so any
    number of ties is returned without ranking the whole table.
    """
    best = df.select(column).orderBy(F.col(column).desc_nulls_last()).limit(n)
    last = best.agg(F.struct(F.min(column).alias("value"), (F.count_if(F.col(column).isNull()) > 0).alias("nulls"))).scalar()
    return df.filter((F.col(column) >= last["value"]) | last["nulls"])


def top_percent(df: DataFrame, percent: float, order: Sequence[Column | str]) -> DataFrame:
    """The first ceil(n * percent / 100) rows in a total order."""
    indexed = dense_index(df, order, "_index")
    total = indexed.agg(F.max("_index")).scalar()
    keep = F.ceil(total * F.lit(str(percent)).cast("decimal(9,4)") / 100)
    return indexed.filter(F.col("_index") <= keep).drop("_index")


