"""Dense numbering and surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import UNKNOWN_KEY
from starloom.session import materialise


def _offsets(tagged: DataFrame) -> DataFrame:
    """One row per written partition: numbers taken by the partitions before it.

    Bounded by the partition count. A partition takes as many numbers as its positions span, so a
    filtered frame still gets distinct, increasing numbers.
    """
    per_part = tagged.groupBy("_part").agg(
        F.min("_pos").alias("_first"), (F.max("_pos") - F.min("_pos") + 1).alias("_span"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", "_first", "_span", F.coalesce(F.sum("_span").over(before), F.lit(0)).alias("_before")
    )


def tag_positions(df: DataFrame) -> DataFrame:
    """Add the partition number and the position in it; the result must be written before use."""
    return df.withColumn("_part", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id()
    )


def number_tagged(tagged: DataFrame, name: str, start: int | Column = 1, step: int = 1) -> DataFrame:
    """Consecutive numbers over a written, tagged frame: partition offset + position in partition."""
    first = F.lit(start) if isinstance(start, int) else start
    offset = F.col("_before") + F.col("_pos") - F.col("_first")
    return (
        tagged.join(F.broadcast(_offsets(tagged)), "_part")
        .withColumn(name, (first + offset * step).cast("bigint"))
        .drop("_part", "_pos", "_first", "_span", "_before")
    )


def dense_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "row_index", start: int | Column = 1,
    step: int = 1, path: str | None = None,
) -> DataFrame:
    """Number rows consecutively in `order`, which must be a total order.

    The rows are range partitioned and written once; each partition then needs only the count of
    the partitions before it. No task sees more than its range, and a value shared by many rows is
    split because the order is total.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return number_tagged(materialise(tag_positions(ranged), path), name, start, step)


def assign_keys(
    new_rows: DataFrame, key: str, order: Sequence[str], max_key: int = 0, step: int = 1,
    path: str | None = None,
) -> DataFrame:
    """Give new rows the integers after `max_key`, in the order of their natural key."""
    return dense_index(new_rows, order, key, max_key + step if max_key else 1, step, path)


def fill_keys(tagged: DataFrame, key: str, is_new: Column, max_key: int) -> DataFrame:
    """Number the new rows of a written, tagged frame after `max_key`; other rows keep their key."""
    offsets = _offsets(tagged.filter(is_new))
    fresh = F.lit(max_key + 1) + F.col("_before") + F.col("_pos") - F.col("_first")
    return (
        tagged.join(F.broadcast(offsets), "_part", "left")
        .withColumn(key, F.when(is_new, fresh).otherwise(F.col(key)).cast("bigint"))
        .drop("_part", "_pos", "_first", "_span", "_before")
    )


def numbers_taken(tagged: DataFrame, is_new: Column) -> int:
    """How many numbers `fill_keys` uses up, gaps included."""
    return int(_offsets(tagged.filter(is_new)).agg(F.coalesce(F.sum("_span"), F.lit(0))).first()[0])


def highest_key(df: DataFrame, key: str) -> int:
    """Largest key in use, 0 for an empty table; the unknown member does not count."""
    top = df.agg(F.max(key)).first()[0]
    return max(int(top or 0), 0)


def unknown_row(df: DataFrame, key: str, values: Mapping[str, Any]) -> DataFrame:
    """The fixed unknown member in the schema of `df`: key -1, given values, NULL elsewhere."""
    fixed = {**values, key: UNKNOWN_KEY}
    columns = []
    for field in df.schema.fields:
        value = fixed.get(field.name)
        literal = value if isinstance(value, Column) else F.lit(value)
        columns.append(literal.cast(field.dataType).alias(field.name))
    return df.sparkSession.range(1).select(*columns)


def with_unknown(df: DataFrame, key: str, values: Mapping[str, Any]) -> DataFrame:
    return df.unionByName(unknown_row(df, key, values))


WORDS = 1024  # of 64 keys each, in a row of `key_bits`


def key_bits(df: DataFrame, key: str) -> DataFrame:
    """(_block, _bits): the keys of `df`, numbers from 0, as one bit per number and 65,536 numbers to a row.

    Of numbered keys this is a small part of what a hash table of them takes.
    """
    words = df.filter(F.col(key) >= 0).groupBy(F.expr(f"`{key}` div 64").alias("_word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(`{key}` % 64 as int)))").alias("_set"))
    blocks = words.groupBy(F.expr(f"_word div {WORDS}").alias("_block")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("_word") % WORDS).alias("at"), "_set"))).alias("_words"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(WORDS - 1).cast("bigint"))
    return blocks.select(
        "_block", F.transform(every, lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0).cast("bigint"))).alias("_bits"))


def among(rows: DataFrame, key: str, bits: DataFrame, flag: str) -> DataFrame:
    """`rows` with `flag`: whether `key` is one of the keys in `bits`, which every task gets."""
    found = F.expr(f"getbit(get(_bits, cast(`{key}` div 64 % {WORDS} as int)), cast(`{key}` % 64 as int)) = 1")
    joined = rows.join(F.broadcast(bits), F.expr(f"`{key}` >= 0 and `{key}` div {64 * WORDS} = _block"), "left")
    return joined.select(*rows.columns, F.coalesce(found, F.lit(False)).alias(flag))
