"""Dimension and fact merges: Type 1 upsert, Type 2 versioning, in-place refresh.

Every merge is one join on a key that is unique on both sides, which classifies each row; the new
state of the table is a projection of that classification.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import differs

INSERT, UPDATE, KEEP, ABSENT = "insert", "update", "keep", "absent"


@dataclass(frozen=True)
class LoadStats:
    inserted: int
    updated: int
    refreshed: int = 0
    rejected: int = 0

    def __add__(self, other: LoadStats) -> LoadStats:
        return LoadStats(
            self.inserted + other.inserted, self.updated + other.updated, self.refreshed + other.refreshed,
            self.rejected + other.rejected)


def classify(
    target: DataFrame, source: DataFrame, keys: Sequence[str], changed: Column, absent: bool = True
) -> DataFrame:
    """Join of target and source on a unique key: structs `t` and `s` and an `_action`.

    Without `absent`, target rows that the source lacks are left out.
    """
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    action = (
        F.when(F.col("t._in_target").isNull(), INSERT)
        .when(F.col("s._in_source").isNull(), ABSENT)
        .when(changed, UPDATE)
        .otherwise(KEEP)
    )
    return t.join(s, on, "full" if absent else "right").select(
        F.struct("t.*").alias("t"), F.struct("s.*").alias("s"), action.alias("_action")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    update: Sequence[str] | None = None,
    stamp: Mapping[str, Column] | None = None,
    stamp_insert: Mapping[str, Column] | None = None,
    pinned: Mapping[str, Column] | None = None,
    remember: Sequence[str] = (),
) -> DataFrame:
    """Target after the upsert, with the `_action` taken per row.

    A row is updated only when a compared column differs NULL-safely; then all `update` columns
    (default: every shared non-key column) take the source value. Rows absent from the source stay.
    `pinned` replaces the source value of a column by an expression over `t` and `s`; `remember`
    adds the value a column had before as `_old_<column>`.
    """
    update = list(update) if update is not None else [
        c for c in target.columns if c in source.columns and c not in keys
    ]
    stamp, stamp_insert = dict(stamp or {}), dict(stamp_insert or {})
    pinned = dict(pinned or {})

    def incoming(c: str) -> Column:
        return pinned.get(c, F.col(f"s.{c}"))

    changed = differs([F.col(f"t.{c}") for c in compare], [incoming(c) for c in compare])
    joined = classify(target, source, keys, changed)
    fresh, touched = F.col("_action") == INSERT, F.col("_action") == UPDATE
    source_columns = set(source.columns)
    columns = []
    for field in target.schema.fields:
        c = field.name
        old = F.col(f"t.{c}")
        if c in keys:
            value = F.coalesce(old, F.col(f"s.{c}"))
        else:
            on_insert = stamp_insert.get(c, stamp.get(c, F.col(f"s.{c}") if c in source_columns else F.lit(None)))
            on_update = stamp.get(c, incoming(c) if c in update else old)
            value = F.when(fresh, on_insert).when(touched, on_update).otherwise(old)
        columns.append(value.cast(field.dataType).alias(c))
    before = [F.col(f"t.{c}").alias(f"_old_{c}") for c in remember]
    return joined.select(*columns, *before, "_action")


def action_counts(classified: DataFrame) -> LoadStats:
    row = classified.agg(
        F.count_if(F.col("_action") == INSERT).alias("inserted"),
        F.count_if(F.col("_action") == UPDATE).alias("updated"),
    ).first()
    return LoadStats(row.inserted, row.updated)


def scd2_changes(
    current: DataFrame,
    source: DataFrame,
    key: str,
    hash_column: str = "row_hash",
    refresh: Sequence[str] = (),
    absent: bool = True,
) -> DataFrame:
    """Classify the current versions against the source by fingerprint.

    `refresh` columns are Type 1: for a version that stays, a difference there sets `_refresh`.
    """
    changed = differs([F.col(f"t.{hash_column}")], [F.col(f"s.{hash_column}")])
    joined = classify(current, source, [key], changed, absent)
    stale = (
        differs([F.col(f"t.{c}") for c in refresh], [F.col(f"s.{c}") for c in refresh])
        if refresh else F.lit(False)
    )
    return joined.withColumn("_refresh", (F.col("_action") == KEEP) & stale)


@dataclass(frozen=True)
class Scd2Result:
    """New state of a Type 2 dimension in the pieces that are stored apart."""

    kept: DataFrame      # current versions that stay, Type 1 columns refreshed
    closed: DataFrame    # versions closed by this load
    opened: DataFrame    # new versions, still without a surrogate key
    changes: DataFrame   # the classification, for the counts


KEPT, CLOSED, OPENED = "kept", "closed", "opened"


def scd2_versions(
    current: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str,
    effective: Column,
    batch: int | Column,
    refresh: Sequence[str] = (),
    now: Column | None = None,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Every version the load leaves or makes, with its `_piece`, in one pass over the changes.

    A changed entity gives two rows: the version closed at `effective` and the one opened there.
    Entities missing from the source stay current. Opened versions have no surrogate key yet.
    """
    now = effective if now is None else now
    batch_id = F.lit(batch) if isinstance(batch, int) else batch
    changes = scd2_changes(current, source, key, refresh=refresh) if changes is None else changes
    action = F.col("_action")

    def row(piece: str, value: Callable[[str], Column]) -> Column:
        return F.struct(
            *[value(f.name).cast(f.dataType).alias(f.name) for f in current.schema.fields],
            F.lit(piece).alias("_piece"))

    def kept(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c in refresh:
            return F.when(F.col("_refresh"), F.col(f"s.{c}")).otherwise(old)
        return F.when(F.col("_refresh"), now).otherwise(old) if c == "dw_updated_at" else old

    def closed(c: str) -> Column:
        ended = {"valid_to": effective, "is_current": F.lit(False), "dw_updated_at": now}
        return ended.get(c, F.col(f"t.{c}"))

    def opened(c: str) -> Column:
        fixed = {
            surrogate: F.lit(None), "valid_from": effective, "valid_to": F.lit(None),
            "is_current": F.lit(True), "dw_load_batch_id": batch_id, "dw_inserted_at": now,
            "dw_updated_at": now,
        }
        return fixed[c] if c in fixed else F.col(f"s.{c}")

    before = F.when(action.isin(KEEP, ABSENT), row(KEPT, kept)).when(action == UPDATE, row(CLOSED, closed))
    after = F.when(action.isin(INSERT, UPDATE), row(OPENED, opened))
    return changes.select(F.inline(F.filter(F.array(before, after), lambda r: r.isNotNull())))


def scd2_merge(
    current: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str,
    effective: Column,
    batch: int | Column,
    refresh: Sequence[str] = (),
    now: Column | None = None,
    changes: DataFrame | None = None,
) -> Scd2Result:
    """Close changed versions at `effective` and open a version per new or changed entity.

    `current` holds current versions only; history is never read. The pieces are read apart, so
    pass in `changes` already written when the join must not be repeated.
    """
    changes = scd2_changes(current, source, key, refresh=refresh) if changes is None else changes
    versions = scd2_versions(current, source, key, surrogate, effective, batch, refresh, now, changes)

    def piece(name: str) -> DataFrame:
        return versions.filter(F.col("_piece") == name).drop("_piece")

    return Scd2Result(piece(KEPT), piece(CLOSED), piece(OPENED).drop(surrogate), changes)


def scd2_stats(changes: DataFrame) -> LoadStats:
    """(opened, closed, refreshed in place): the refreshed rows are not part of `updated`."""
    row = changes.agg(
        F.count_if(F.col("_action").isin(INSERT, UPDATE)).alias("opened"),
        F.count_if(F.col("_action") == UPDATE).alias("closed"),
        F.count_if(F.col("_refresh")).alias("refreshed"),
    ).first()
    return LoadStats(row.opened, row.closed, row.refreshed)
