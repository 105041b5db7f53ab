"""SimHash fingerprints and their components under a small bit distance, by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Two fingerprints that differ in at most four bits
differ in at most two bits of one segment, so the balls of one bit around their two values of that
segment meet. Every fingerprint enters the table of each segment under the 33 values of its ball and
is fetched by the others under the same values; the full distance is then verified.

What a table entry holds decides how it is verified. Up to `LISTED` fingerprints are compared with
each other inside the entry, and only a spanning forest of their links leaves it. The fingerprints
of larger entries (families of near copies) enumerate the balls of two bits around the whole
fingerprint instead: those meet exactly if the distance is at most four, so every fingerprint links
to the smallest in each of them and no pairs are formed at all. Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.texts import pieces, shingle_hashes, utf8
from starloom.session import materialise, prepare

WIDTH = 4
DISTANCE = 4
SEED = 42
LISTED = 1024
_BLOCK = 1 << 16


def simhash(text: bytes, width: int = WIDTH) -> int:
    """Majority bits of the shingle hashes of a lower-cased text; 0 for a text without words."""
    hashes = shingle_hashes(text.lower().split(), width, SEED)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = hashes[i:i + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The other columns of `docs` and `fingerprint` (the 64 bits as a long)."""
    others = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            bits = np.array([simhash(t, width) for t in utf8(batch.column(text))], np.uint64).view(np.int64)
            columns = [batch.column(f.name) for f in others] + [pa.array(bits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in others] + ["fingerprint"])

    schema = docs.select([f.name for f in others]).schema.add("fingerprint", "long")
    return docs.mapInArrow(run, schema)


def _ball(value: Column, bits: int, radius: int) -> Column:
    """All values of `bits` bits within `radius` bits of `value`."""
    masks = [sum(1 << i for i in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.transform(F.array([F.lit(m).cast("bigint") for m in signed]), lambda m: value.bitwiseXOR(m))


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within the distance of each other."""
    links = []
    left = np.sort(values)
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(left ^ at) <= distance
            links += [(int(at), int(v)) for v in left[near]]
            reached += list(left[near])
            left = left[~near]
    return links


def _forests(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            flat = members.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(members.value_lengths().to_numpy(zero_copy_only=False))
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            pair = ends - starts == 2  # by far most entries: all compared at once
            x, y = flat[starts[pair]], flat[starts[pair] + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
            links = list(zip(x[near].tolist(), y[near].tolist()))
            for s, e in zip(starts[~pair].tolist(), ends[~pair].tolist()):
                links += _forest(flat[s:e].view(np.uint64), distance)
            ends_ = np.array(links, dtype=object).reshape(-1, 2)
            fold = [np.array([int(v) & (2 ** 64 - 1) for v in ends_[:, k]], np.uint64).view(np.int64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in fold], ["a", "b"])

    return run


def links(distinct: DataFrame, listed: int = LISTED) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints within four bits.

    Not every pair is listed; two fingerprints have a path of links exactly if they have a path of
    steps of at most four bits.
    """
    fp = F.col("fingerprint")
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = distinct.repartition(tasks, "fingerprint")  # few bytes here become many rows
    high, low = F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))
    entries = distinct.select(
        fp, F.explode(F.concat(_ball(high, 32, 1), F.transform(_ball(low, 32, 1), lambda v: -v - 1))).alias("key")
    )  # keys of the low segment are the negative ones
    shared = materialise(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    lists = (
        entries.join(shared.filter(F.col("n") <= listed).select("key"), "key")
        .groupBy("key").agg(F.collect_list("fingerprint").alias("members"))
    )
    found = lists.select("members").mapInArrow(_forests(DISTANCE), "a bigint, b bigint").distinct()
    crowded = shared.filter(F.col("n") > listed).select("key")
    if crowded.isEmpty():
        return found
    family = materialise(entries.join(crowded, "key").select("fingerprint").distinct())
    meeting = family.select(fp, F.explode(_ball(fp, 64, DISTANCE // 2)).alias("key"))
    least = meeting.groupBy("key").agg(F.min("fingerprint").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = meeting.join(least.select("key", "a"), "key").filter("a <> fingerprint")
    return found.unionByName(stars.select("a", fp.alias("b")).distinct())


def near_duplicates(docs: DataFrame, rank: list[str], text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of `docs` without the text, with `fingerprint` and `first`: the component's least row.

    `first` is a struct of the columns in `rank`, the least over all rows of the component; null
    columns rank last. Rows of equal fingerprints belong together, so repeated rows and texts
    without words (fingerprint 0) do. A null text has no words. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    marked = materialise(fingerprints(docs, text, width))
    order = F.struct(*[c for r in rank for c in (F.col(r).isNull().alias(f"no_{r}"), F.col(r).alias(r))])
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min(order).alias("first")))
    roots = materialise(components(links(distinct.select("fingerprint"))))
    linked = distinct.join(roots, F.col("fingerprint") == F.col("node")).select("fingerprint", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    moved = linked.join(least, "root").select("fingerprint", "least")
    known = distinct.join(moved, "fingerprint", "left").select("fingerprint", F.coalesce("least", "first").alias("first"))
    # written, so that both sides of the last join are plain shuffles and a hot fingerprint is split
    return marked.join(materialise(known), "fingerprint")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One whole row of each component: that of the least id, then of the least row hash.

    Rows without an id rank last, so they stay only where no row of the component has one; of
    repeated rows one stays.
    """
    key = F.xxhash64(*docs.columns)
    ids = docs.select(F.col(id_col).alias("id"), key.alias("row_key"), F.col(text).alias("text"))
    groups = near_duplicates(ids, ["id", "row_key"])
    chosen = groups.select("first.id", "first.row_key").distinct()
    chosen = chosen.select(F.coalesce("id", F.lit(0)).alias("__id"), F.col("row_key").alias("__row"))
    keyed = docs.withColumns({"__id": F.coalesce(id_col, F.lit(0)), "__row": key})
    copies = F.row_number().over(Window.partitionBy("__id", "__row").orderBy("__id"))
    kept = keyed.join(chosen, ["__id", "__row"], "left_semi").withColumn("__copy", copies).filter("__copy = 1")
    return kept.select(docs.columns)
