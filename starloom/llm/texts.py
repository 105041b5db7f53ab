"""Reading the text tables and cutting texts into words and shingles, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII blanks that separate words, and a pattern of the words between them.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(column: str, of: int) -> Column:
    """crc32 of a column's text, modulo `of`: the fixed split into training and held-out rows.

    A null column counts as the empty text.
    """
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % of


def word_count(text: str) -> Column:
    """Number of blank-separated words; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, BLANK_RUN), lambda w: w != "")), F.lit(0)).cast("bigint")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column in UTF-8; a null text is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def shingle_hashes(words: list[bytes], width: int, seed: int) -> np.ndarray:
    """XXH64 of every run of `width` words joined by blanks, repeats included.

    Fewer words form one shingle, no word forms none.
    """
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], blanks + 1))[: max(len(words) - width + 1, 1)]
    ends = np.concatenate((blanks, [len(joined)]))[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = (digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist()))
    return np.fromiter(hashes, np.uint64, len(starts))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words; the constants are those of the splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
