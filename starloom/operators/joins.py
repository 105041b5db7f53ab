"""Join shapes that keep a hot key splittable and never widen a scan without need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise


def key_set(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Distinct non-NULL values of a column. Duplicates fall away before the shuffle."""
    return df.select(F.col(column).alias(name or column)).filter(F.col(name or column).isNotNull()).distinct()


def semi(
    df: DataFrame, column: str, other: DataFrame, other_column: str, unique: bool = False
) -> DataFrame:
    """EXISTS: rows whose key occurs in `other`.

    The probed side is reduced to its distinct keys first. When its key is unique anyway, say so:
    both sides then come straight from a shuffle and a hot key of `df` can be split at run time.
    """
    keys = other.select(F.col(other_column).alias("_key")) if unique else key_set(other, other_column, "_key")
    return df.join(keys, F.col(column) == F.col("_key"), "left_semi")


def anti(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """NOT EXISTS: rows whose key does not occur in `other` (a NULL key is kept)."""
    keys = key_set(other, other_column, "_key")
    return df.join(keys, F.col(column) == F.col("_key"), "left_anti")


def left_outer(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """Left outer equi-join that keeps a hot key of the `many` side splittable.

    The optional side of an outer join cannot be split at run time, so it is written as the inner
    join plus the rows without a partner.
    """
    matched = one.join(many, F.col(one_key) == F.col(many_key))
    return matched.unionByName(anti(one, one_key, many, many_key), allowMissingColumns=True)


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer equi-join whose hot right-side keys can still be split at run time.

    A full outer join cannot be split on either side, so it is written as the right outer join plus
    the left rows without a partner.
    """
    matched = left.join(right, F.col(left_key) == F.col(right_key), "right")
    alone = anti(left, left_key, right, right_key)
    return matched.unionByName(alone, allowMissingColumns=True)


def dangling_keys(df: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct foreign-key values without a parent row."""
    used = key_set(df, foreign_key)
    return used.join(parent.select(F.col(key).alias("_key")), F.col(foreign_key) == F.col("_key"), "left_anti")


def rows_with_dangling(df: DataFrame, checks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows with any foreign key that is NULL or outside its parent table.

    Each key column is reduced to its distinct values, met with the parent, and what is missing is
    written out once. Normally that is nothing and the rows are only scanned; otherwise they meet
    the written keys, whose size is then known to the planner.
    """
    lost = None
    for foreign_key, (parent, key) in checks.items():
        part = dangling_keys(df, foreign_key, parent, key).select(
            F.lit(foreign_key).alias("column"), F.col(foreign_key).cast("bigint").alias("value"))
        lost = part if lost is None else lost.unionByName(part)
    lost = materialise(lost)
    # At most one row per checked column.
    affected = [r[0] for r in lost.select("column").distinct().collect()]
    return rows_meeting(df, list(checks), {k: lost.filter(F.col("column") == k).select("value") for k in affected})


def rows_meeting(df: DataFrame, columns: Sequence[str], missing: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with a NULL in any of `columns`, or a value that the one-column frame in `missing` lists once."""
    out, broken = df, F.lit(False)
    for column in columns:
        broken = broken | F.col(column).isNull()
        if column in missing:
            name = f"_missing_{column}"
            out = out.join(missing[column].toDF(name), F.col(column) == F.col(name), "left")
            broken = broken | F.col(name).isNotNull()
    return out.filter(broken).select(*df.columns)


def as_at(
    facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str, moment: Column,
    bucket: Column | None = None, buckets: Column | None = None,
) -> DataFrame:
    """Join each fact to the version valid at `moment` on the natural key.

    Periods are half open and do not overlap, so a fact meets one version at most. With `bucket`
    (of the fact) and `buckets` (array a version covers) the equi-part of the join also carries the
    time bucket, which splits an entity with very many versions and facts.
    """
    condition = (
        (F.col(fact_key) == F.col(version_key))
        & (F.col("valid_from") <= moment)
        & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )
    if bucket is None or buckets is None:
        return facts.join(versions, condition, "left")
    spread = versions.withColumn("_version_bucket", F.explode(buckets))
    return (
        facts.withColumn("_fact_bucket", bucket)
        .join(spread, condition & (F.col("_fact_bucket") == F.col("_version_bucket")), "left")
        .drop("_fact_bucket", "_version_bucket")
    )
