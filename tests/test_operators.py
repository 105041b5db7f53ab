"""Numbering, windows and joins against brute force, with one key holding most rows."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import as_at, full_outer, left_outer, rows_with_dangling
from starloom.operators.keys import among, assign_keys, fill_keys, key_bits, tag_positions, with_unknown
from starloom.operators.ranking import top_n_with_ties, top_percent
from starloom.operators.windows import by_month, next_value, overlap_pairs, version_numbers
from starloom.session import materialise
from starloom.sources.schemas import struct

START = datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def periods():
    """(entity, opens, closes): entity 1 has two thirds of the rows; some periods are open or empty."""
    rng = random.Random(7)
    rows = []
    for i in range(240):
        entity = 1 if i % 3 else rng.randint(2, 9)
        opens = START + timedelta(hours=6 * rng.randint(0, 1500))
        length = rng.choice([0, 1, 5, 40, 200, None])
        rows.append((entity, opens, opens + timedelta(days=length) if length is not None else None))
    return rows


@pytest.fixture(scope="module")
def frame(spark, periods):
    return spark.createDataFrame(periods, struct("entity int, opens timestamp_ntz, closes timestamp_ntz"))


def test_overlap_pairs(frame, periods):
    far = datetime.max
    want = Counter()
    solid = [(e, a, b or far) for e, a, b in periods if b is None or b > a]
    for i, (e, a, b) in enumerate(solid):
        for f, c, d in solid[i + 1:]:
            want[e] += e == f and a < d and c < b
    got = {r.entity: r.overlapping_pairs for r in overlap_pairs(frame, "entity", "opens", "closes", by_month).collect()}
    assert got == {e: n for e, n in want.items() if n}


def test_next_value(frame, periods):
    want = Counter()
    by = defaultdict(list)
    for e, a, _ in periods:
        by[e].append(a)
    for e, starts in by.items():
        starts.sort()
        want.update((e, a, b) for a, b in zip(starts, [*starts[1:], None]))
    got = next_value(frame, "entity", "opens", by_month(F.col("opens")), "n")
    assert Counter((r.entity, r.opens, r.n) for r in got.collect()) == want


def test_version_numbers(frame, periods):
    got = version_numbers(frame, "entity", "opens", by_month(F.col("opens")), "v").collect()
    by = defaultdict(list)
    for r in got:
        by[r.entity].append((r.v, r.opens))
    for rows in by.values():
        rows.sort()
        assert [v for v, _ in rows] == list(range(1, len(rows) + 1))
        assert [o for _, o in rows] == sorted(o for _, o in rows)


def test_keys_are_dense_and_in_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("nk"), F.lit("same").alias("x")).repartition(7)
    got = assign_keys(rows, "k", ["nk"], max_key=100).orderBy("nk").collect()
    assert [r.k for r in got] == list(range(101, 5101))


def test_fill_keys_leaves_old_keys(spark):
    rows = spark.range(0, 1000, 1, 5).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id") + 1).alias("k"), (F.col("id") % 3 != 0).alias("fresh"))
    got = fill_keys(materialise(tag_positions(rows)), "k", F.col("fresh"), 5000).collect()
    assert all(r.k == r.id + 1 for r in got if not r.fresh)
    assert len({r.k for r in got}) == 1000 and min(r.k for r in got if r.fresh) == 5001


def test_unknown_member(spark):
    df = with_unknown(spark.createDataFrame([(1, "a")], "k bigint, name string"), "k", {"name": "Unknown"})
    assert sorted(map(tuple, df.collect())) == [(-1, "Unknown"), (1, "a")]


def clients(spark):
    left = spark.createDataFrame([(1, "Alice"), (2, "Bob"), (3, "Chris"), (4, "Donna")], "id int, name string")
    right = spark.createDataFrame([(1, 1, 10), (2, 2, 20), (3, 2, 30), (4, 3, 40), (5, 5, 50)], "o int, cid int, v int")
    return left, right


def test_outer_joins(spark):
    left, right = clients(spark)
    assert left.join(right, F.col("id") == F.col("cid")).count() == 4
    assert left_outer(left, right, "id", "cid").count() == 5
    assert left_outer(right, left, "cid", "id").count() == 5
    got = {(r.id, r.o) for r in full_outer(left, right, "id", "cid").collect()}
    assert got == {(1, 1), (2, 2), (2, 3), (3, 4), (4, None), (None, 5)}


def test_rows_with_dangling_counts_each_row_once(spark):
    df = spark.createDataFrame([(1, 1), (1, 9), (9, 9), (9, 1), (None, 1)], "a int, b int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows_with_dangling(df, {"a": (parent, "k"), "b": (parent, "k")}).count() == 4


def test_as_at_with_and_without_buckets(spark):
    versions = spark.createDataFrame(
        [(1, START, datetime(2000, 6, 1), "old"), (1, datetime(2000, 6, 1), None, "new")],
        struct("vid int, valid_from timestamp_ntz, valid_to timestamp_ntz, label string"))
    facts = spark.createDataFrame(
        [(1, datetime(1999, 1, 1)), (1, START), (1, datetime(2000, 6, 1)), (1, datetime(2001, 1, 1)), (2, START)],
        struct("id int, at timestamp_ntz"))
    want = Counter({(1999, None): 1, (2000, "old"): 1, (2000, "new"): 1, (2001, "new"): 1, (2000, None): 1})
    plain = as_at(facts, versions, "id", "vid", F.col("at"))
    assert Counter((r.at.year, r.label) for r in plain.collect()) == want
    last = F.lit(datetime(2002, 1, 1)).cast("timestamp_ntz")
    years = F.sequence(F.year("valid_from"), F.year(F.coalesce("valid_to", last)))
    split = as_at(facts, versions, "id", "vid", F.col("at"), F.year("at"), years)
    assert Counter((r.at.year, r.label) for r in split.collect()) == want


def test_top_shapes(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 8, 8, 7, 7, 7, 1, None])], "id int, v int")
    assert top_n_with_ties(df, 2, "v").count() == 3
    assert top_n_with_ties(df, 4, "v").count() == 6
    assert top_n_with_ties(df, 8, "v").count() == 8
    assert top_percent(spark.range(77), 10, ["id"]).count() == 8
    assert sorted(r.id for r in top_percent(spark.range(20), 10, [F.col("id").desc()]).collect()) == [18, 19]


def test_keys_as_bits_find_the_same_rows(spark):
    """A row of bits stands for 65,536 numbers; NULL, repeated and negative keys are no keys."""
    rng = random.Random(11)
    keys = [rng.randrange(200_000) for _ in range(3000)] + [0, 63, 64, 65_535, 65_536, 5, 5, 2**40, -1, None]
    bits = materialise(key_bits(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k"))
    assert sorted(r[0] for r in bits.select("_block").collect()) == [0, 1, 2, 3, 2**40 // 65_536]
    asked = [*range(0, 200_000, 7), 0, 1, 5, 63, 64, 65_535, 65_536, 2**40, 2**40 + 64, 2**50, -1, -64, None]
    found = among(spark.createDataFrame([(k,) for k in asked], "key bigint"), "key", bits, "has")
    assert found.columns == ["key", "has"]
    assert Counter((r.key, r.has) for r in found.collect()) == Counter((k, k is not None and k >= 0 and k in set(keys)) for k in asked)
