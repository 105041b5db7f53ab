"""Packing token sequences by minimum bin slack.

Every document gives whole windows and one rest. Only the lengths of the rests matter for the plan,
so it is made from their histogram (at most one entry per length below the window): the longest
length left opens a window, a subset-sum table kept as bitsets finds the multiset of the remaining
lengths that comes closest to filling it, and the multiset is used as often as the counts allow,
which uses up at least one length each time. The plan then has at most one pattern per length; rests
are numbered within their length, and a number leads to its window and offset by arithmetic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from starloom.llm.texts import pieces
from starloom.session import materialise, prepare

WINDOW = 1024
VOCABULARY = "byte_bpe_50k"
END_ID = 0
BUCKETS = 4096
SLACK = 8
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _encoders(vocabulary: str) -> tuple:
    """The tokenizer of the vocabulary's json file, and the faster reader of its rank file.

    Both give the same ids except where a text holds the special token's own characters, which only
    the first one reads as that token; the tests hold them against each other.
    """
    import base64

    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")), fast


def token_ids(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    exact, fast = _encoders(vocabulary)
    if SPECIAL in text:
        return exact.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def tokenised(docs: DataFrame, carry: list[str], text: str = "text", window: int = WINDOW,
              vocabulary: str = VOCABULARY) -> DataFrame:
    """`carry`, `doc_tokens`, the crc32 of each window and of the rest, and the rest's ids (4 bytes each).

    A document is its text's ids and `END_ID`; a null text is empty, so it has one token.
    """
    fields = docs.select(carry).schema
    names = [f.name for f in fields] + ["doc_tokens", "crcs", "rest_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, crcs, rests = [], [], []
            for text_ in batch.column(batch.num_columns - 1).to_pylist():
                ids = np.array(token_ids(text_ or "", vocabulary) + [END_ID], "<u4")
                cut = memoryview(ids.tobytes())
                sizes.append(len(ids))
                crcs.append([zlib.crc32(cut[i:i + 4 * window]) for i in range(0, len(cut), 4 * window)])
                rests.append(bytes(cut[len(ids) // window * window * 4:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names) - 3)]
                + [pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())],
                names)

    schema = fields.add("doc_tokens", "long").add("crcs", ArrayType(LongType())).add("rest_ids", "binary")
    return docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)


def fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum comes closest to `room` from below.

    Bit s of `reach` tells whether sum s can be made. Counts enter as powers of two, so a length
    costs few steps; the way back reads off how often each length was used.
    """
    reach, steps, wanted = 1, [], 1 << room
    for length in sorted(counts, reverse=True):
        left, part = min(counts[length], room // length), 1
        while left > 0 and not reach & wanted:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= reach << length * part & (wanted << 1) - 1
            left, part = left - part, part * 2
    total, used = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + part
            total -= length * part
    return used


def plan(counts: dict[int, int], window: int = WINDOW, slack: int = SLACK) -> tuple[list[tuple], list[tuple], int]:
    """Whole rests by pattern, the lengths left for cutting, and how many sequences the patterns take.

    The first list has (length, first number, numbers, per sequence, first sequence, offset): rests
    of the length from the first number on, dealt out so many per sequence. A pattern that leaves
    more than `slack` tokens of a window free, and whose size is no power of two (which needs no
    padding), is not used: its rests are joined to one stream and cut at the window. The second list
    has (length, first number, start in the stream).
    """
    left = {length: n for length, n in counts.items() if n}
    given = dict.fromkeys(left, 0)
    whole, stream, sequences = [], [], 0
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        chosen = fill(window - longest, {k: n for k, n in others.items() if n and k <= window - longest})
        chosen[longest] = chosen.get(longest, 0) + 1
        uses = min(left[length] // k for length, k in chosen.items())
        size = sum(length * k for length, k in chosen.items())
        offset, kept = 0, window - size <= slack or size & (size - 1) == 0
        for length, k in sorted(chosen.items(), reverse=True):
            if kept:
                whole.append((length, given[length], uses * k, k, sequences, offset))
                offset += length * k
            else:
                stream.append((length, given[length], uses * k))
            given[length] += uses * k
            left[length] -= uses * k
            if not left[length]:
                del left[length]
        sequences += uses * kept
    at, streamed = 0, []
    for length, first, n in stream:
        streamed.append((length, first, n, at))
        at += length * n
    return whole, streamed, sequences


def _running(rows: DataFrame, within: list[str], what: str, order: list[str], name: str) -> DataFrame:
    """`rows` with the sum of `what` over the rows before, among equal `within`, in the order of (bucket, `order`).

    Running sums stay in one bucket; the buckets' totals, few per group, carry them on.
    """
    group = within + ["bucket"]
    totals = rows.groupBy(*group).agg(F.sum(what).alias("__total"))
    earlier = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__inside", F.coalesce(F.sum(what).over(inside), F.lit(0)))
    return rows.join(totals, group).withColumn(name, F.col("__start") + F.col("__inside")).drop("__start", "__inside")


def packed(docs: DataFrame, carry: list[str], text: str = "text", window: int = WINDOW,
           vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: `carry`, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Pieces of a sequence lie side by side from offset 0. Repeated rows are packed as often as they
    occur; an empty table gives no pieces. Only the histogram of the rests' lengths, at most
    `window` rows, and the plan made from it, at most `window` patterns, pass the driver.
    """
    spark = prepare(docs.sparkSession)
    named = docs.select(F.struct(*carry).alias("row"), F.col(text).alias("__text"))
    tokens = materialise(tokenised(named, ["row"], "__text", window, vocabulary))
    rest, crcs = F.col("doc_tokens") % window, F.col("crcs")
    keyed = tokens.withColumn("bucket", F.pmod(F.xxhash64("row", "crcs"), F.lit(BUCKETS)))
    order = ["key", "doc_tokens"]
    keyed = keyed.withColumn("key", F.xxhash64("crcs", "row"))
    rests = keyed.select(
        "row", "doc_tokens", "bucket", "key", F.element_at(crcs, -1).alias("ids_crc32"), rest.alias("length"),
        F.lit(1).cast("bigint").alias("one"),
    ).filter("length > 0")
    counts = {r["length"]: r["n"] for r in rests.groupBy("length").agg(F.sum("one").alias("n")).collect()}
    whole, stream, sequences = plan(counts, window)

    numbered = materialise(_running(rests, ["length"], "one", order, "number"))
    longs = "length bigint, first bigint, numbers bigint"
    rules = spark.createDataFrame(whole, f"{longs}, per bigint, sequence bigint, shift bigint")
    mine = (F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("numbers"))
    nth = F.col("number") - F.col("first")
    start = F.col("doc_tokens") - F.col("length")
    placed = numbered.join(F.broadcast(rules.withColumnRenamed("length", "l")), (F.col("length") == F.col("l")) & mine)
    placed = placed.select(
        "row", start.alias("start"), "length", "ids_crc32", "doc_tokens",
        F.floor((nth - nth % F.col("per")) / F.col("per") + F.col("sequence")).cast("bigint").alias("sequence_id"),
        (F.col("shift") + nth % F.col("per") * F.col("length")).alias("offset"),
    )
    parts = [placed]
    if stream:
        size = sum(length * n for length, _, n, _ in stream)
        cuts = spark.createDataFrame(stream, f"{longs}, at bigint")
        flow = numbered.join(F.broadcast(cuts.withColumnRenamed("length", "l")), (F.col("length") == F.col("l")) & mine)
        flow = flow.withColumn("pos", F.col("at") + nth * F.col("length")).select("row", "doc_tokens", "key", "length", "pos")
        ids = keyed.select(F.col("row").alias("__row"), F.col("key").alias("__key"), "rest_ids").dropDuplicates(["__key", "__row"])
        flow = flow.join(ids, (F.col("key") == F.col("__key")) & F.col("row").eqNullSafe(F.col("__row")))
        head = F.least(F.col("length"), window - F.col("pos") % window)
        ends = F.array(F.struct(F.lit(0).cast("bigint").alias("a"), head.alias("n")), F.struct(head.alias("a"), (F.col("length") - head).alias("n")))
        cut = flow.withColumn("cut", F.explode(ends)).filter("cut.n > 0")
        bytes_ = F.expr("substring(rest_ids, cast(4 * cut.a + 1 as int), cast(4 * cut.n as int))")
        at = F.col("pos") + F.col("cut.a")
        parts.append(cut.select(
            "row", (start + F.col("cut.a")).alias("start"), F.col("cut.n").alias("length"), F.crc32(bytes_).alias("ids_crc32"),
            "doc_tokens", F.floor((at - at % window) / window + sequences).cast("bigint").alias("sequence_id"),
            (at % window).alias("offset"),
        ))
        sequences += -(-size // window)
    full = keyed.withColumn("windows", F.floor((F.col("doc_tokens") - rest) / window).cast("bigint")).filter("windows > 0")
    full = _running(full.select("row", "doc_tokens", "bucket", "key", "crcs", "windows"), [], "windows", order, "number")
    full = full.withColumn("i", F.explode(F.expr("sequence(bigint(0), windows - 1)")))
    parts.append(full.select(
        "row", (F.col("i") * window).alias("start"), F.lit(window).cast("bigint").alias("length"),
        F.get(crcs, F.col("i").cast("int")).alias("ids_crc32"), "doc_tokens",
        (sequences + F.col("number") + F.col("i")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("row.*"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
