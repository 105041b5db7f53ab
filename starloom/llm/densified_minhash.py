"""One-permutation MinHash: shingle hashes binned once, empty bins densified, low-order bits packed.

Every word shingle is hashed once. The top bits of the hash choose one of `BINS` bins and the least
hash of a bin stands for it. An empty bin takes over the value of the first filled bin in a probing
order that is fixed for the bin and looks random (optimal densification). Of each bin's value, mixed
with the bin's number, `BITS` low-order bits are kept. Bits of unequal values agree by chance in a
share 2 ** -BITS, so the likeness of two fingerprints is (agreement - chance) / (1 - chance).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import mix64, pieces, shingle_hashes, utf8
from starloom.session import prepare

WIDTH = 5
BINS = 512
BITS = 4
SEED = 1_729
CHANCE = 2.0 ** -BITS
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)


@lru_cache(maxsize=1)
def _probes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probing order of each bin, the rank of each bin in it, and what is mixed into each bin's value."""
    draws = mix64(np.arange(1, BINS * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BINS, BINS)
    order = np.argsort(draws, axis=1, kind="stable").astype(np.int32)
    return order, np.argsort(order, axis=1, kind="stable").astype(np.int32), draws[:, 0].copy()


def fingerprint(text: bytes) -> np.ndarray | None:
    """The kept bits of each bin for a lower-cased text; None for a text without words."""
    hashes = shingle_hashes(text.lower().split(), WIDTH, SEED)
    if not len(hashes):
        return None
    hashes.sort()
    bins = (hashes >> _SHIFT).astype(np.int32)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    filled = bins[first]
    order, rank, salt = _probes()
    source = np.full(BINS, -1, np.int32)
    source[filled] = np.arange(len(filled), dtype=np.int32)
    empty = np.flatnonzero(source < 0)
    found = source.copy()
    if len(filled) < BINS // 16:
        found[empty] = rank[np.ix_(empty, filled)].argmin(1)
    else:
        for probe in order.T:
            if not len(empty):
                break
            found[empty] = source[probe[empty]]
            empty = empty[found[empty] < 0]
    return (mix64(hashes[first][found] ^ salt) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(codes: np.ndarray | None) -> str:
    """Two bins a byte, in hexadecimal digits; all zero for a text without words."""
    if codes is None:
        return "0" * (BINS * BITS // 4)
    return (codes[0::2] << 4 | codes[1::2]).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated share of common shingles, 0 to 1; texts without words are only like each other."""
    if a is None or b is None:
        return float(a is b)
    return min(max((float(np.mean(a == b)) - CHANCE) / (1 - CHANCE), 0.0), 1.0)


def edited(text: str, following: str) -> str:
    """The last half of `text`, rounded down, replaced by as many characters of the next text's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def dealt(docs: DataFrame, id_col: str, text: str, ranges: int) -> DataFrame:
    """Rows (bucket, ghost, id, text) such that each bucket, sorted, holds its rows and the row after them.

    Buckets are ranges of the id, bounded by its quantiles. The first row of every bucket also goes
    to the bucket before as a ghost, that of the first bucket to the last one. So rows move once and
    no task orders the whole table. Only the bounds and one id per bucket pass the driver.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).alias("id"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(ids.agg(F.percentile_approx("id", shares, 20 * ranges).alias("q")).first().q or [])) if shares else []
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def below(id_):
        """Number of bounds up to the id, by binary search."""
        if not bounds:
            return F.lit(0)
        known = F.array(*[F.lit(b).cast("bigint") for b in bounds])
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, step: F.when(
            F.get(known, low + step - 1) <= id_, low + step).otherwise(low))

    bucket = F.when(F.col("id").isNull(), F.lit(len(bounds) + 1)).otherwise(len(bounds) - below(F.col("id")))
    heads = ids.groupBy(bucket.alias("bucket")).agg(F.max("id").alias("head")).orderBy("bucket").collect()
    before = [(h.bucket, heads[i - 1].bucket, h.head) for i, h in enumerate(heads)]
    table = spark.createDataFrame(before, "own int, into int, head bigint")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn("bucket", bucket)
    rows = rows.join(F.broadcast(table), (F.col("bucket") == F.col("own")) & F.col("id").eqNullSafe(F.col("head")), "left")
    mine = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ghost"))
    places = F.when(F.col("own").isNull(), F.array(mine)).otherwise(
        F.array(mine, F.struct(F.col("into").alias("bucket"), F.lit(True).alias("ghost"))))
    spread = rows.select("id", "text", F.explode(places).alias("at")).select("at.bucket", "at.ghost", "id", "text")
    order = [F.col("bucket"), F.col("ghost"), F.col("id").desc_nulls_last(), F.col("text")]
    return spread.repartition("bucket").sortWithinPartitions(*order)


def edits(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, both fingerprints, likeness to the edited and the next text.

    Rows are ordered by descending id, those without an id last, equal ids by text; the last row is
    followed by the first. A null text is empty. A single row is followed by itself; an empty table
    gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that still waits for the next one: bucket, id, text, fingerprint
        for batch in pieces(batches):
            out = []
            columns = [batch.column(i).to_pylist() for i in range(3)] + [utf8(batch.column(3))]
            for bucket, ghost, id_, raw in zip(*columns):
                codes = fingerprint(raw)
                if held and held[0] == bucket:
                    text_ = held[2].decode()
                    new = edited(text_, raw.decode()).encode()
                    changed = fingerprint(new)
                    out.append((held[1], len(text_), hashlib.sha256(new).hexdigest(), packed(held[3]), packed(changed),
                                likeness(held[3], changed), likeness(held[3], codes)))
                held = None if ghost else (bucket, id_, raw, codes)
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    types = [pa.int64(), pa.int64()] + [pa.string()] * 3 + [pa.float64()] * 2
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    whole = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    found = dealt(whole, "id", "text", ranges).select("bucket", "ghost", "id", "text").mapInArrow(run, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
