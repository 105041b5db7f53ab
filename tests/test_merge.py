from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions import instant, scd_hash
from starloom.operators.merge import action_counts, scd2_merge, scd2_stats, upsert
from starloom.sources.schemas import struct

SCHEMA = struct(
    "k bigint, id string, name string, stock int, valid_from timestamp_ntz, valid_to timestamp_ntz, "
    "is_current boolean, row_hash string, dw_load_batch_id bigint, dw_inserted_at timestamp_ntz, dw_updated_at timestamp_ntz")
T1, T2 = "2000-01-01 00:00:00", "2001-01-01 00:00:00"


def current(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, id string, name string, stock int")
    return df.select(
        "*", instant(T1).alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"), scd_hash("name").alias("row_hash"), F.lit(1).cast("bigint").alias("dw_load_batch_id"),
        instant(T1).alias("dw_inserted_at"), instant(T1).alias("dw_updated_at"))


def source(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, stock int").withColumn("row_hash", scd_hash("name"))


def test_changed_same_new_missing(spark):
    cur = current(spark, [(1, "A", "a", 1), (2, "B", "b", 1), (3, "C", "c", 1)])
    result = scd2_merge(cur, source(spark, [("A", "a2", 1), ("B", "b", 1), ("D", "d", 1)]), "id", "k", instant(T2), 2)
    stats = scd2_stats(result.changes)
    assert (stats.inserted, stats.updated) == (2, 1)
    assert sorted(r.id for r in result.kept.collect()) == ["B", "C"]
    closed, opened = result.closed.first(), {r.id: r for r in result.opened.collect()}
    assert closed.id == "A" and str(closed.valid_to) == T2 and not closed.is_current and closed.k == 1
    assert set(opened) == {"A", "D"} and opened["A"].valid_from == closed.valid_to and opened["A"].valid_to is None
    assert opened["A"].dw_load_batch_id == 2 and "k" not in result.opened.columns


def test_type_one_columns_refresh_without_a_version(spark):
    cur = current(spark, [(1, "A", "a", 1), (2, "B", "b", 1)])
    result = scd2_merge(cur, source(spark, [("A", "a", 9), ("B", "b", 1)]), "id", "k", instant(T2), 2, refresh=["stock"])
    stats = scd2_stats(result.changes)
    assert (stats.inserted, stats.updated, stats.refreshed) == (0, 0, 1)
    kept = {r.id: r for r in result.kept.collect()}
    assert kept["A"].stock == 9 and str(kept["A"].dw_updated_at) == T2 and str(kept["B"].dw_updated_at) == T1


def test_upsert_guard_ignores_columns_outside_it(spark):
    target = spark.createDataFrame([(1, 10, "x", 1), (2, 20, "y", 1), (3, None, "z", 1)], "id int, v int, note string, b int")
    rows = spark.createDataFrame([(1, 10, "changed"), (2, 21, "w"), (3, None, "z"), (4, 4, "n")], "id int, v int, note string")
    merged = upsert(target, rows, ["id"], ["v"], stamp={"b": F.lit(2)}, remember=["v"])
    assert (action_counts(merged).inserted, action_counts(merged).updated) == (1, 1)
    got = {r.id: (r.v, r.note, r.b, r._action, r._old_v) for r in merged.collect()}
    assert got == {1: (10, "x", 1, "keep", 10), 2: (21, "w", 2, "update", 20), 3: (None, "z", 1, "keep", None),
                   4: (4, "n", 2, "insert", None)}


def test_measures_of_one_line(spark):
    from starloom.plans.facts import line_measures

    line = spark.createDataFrame([(Decimal("18.0000"), 10, 0.25), (Decimal("40.0000"), 1, 0.15)], struct(
        "unit_price decimal(19,4), quantity smallint, discount float"))
    a, b = line_measures(line).orderBy("quantity", ascending=False).collect()
    assert (a.gross_amount, a.discount_amount, a.net_amount) == (180, 45, 135)
    assert b.discount_pct == Decimal("0.1500") and b.net_amount == 34
