"""Packing whole documents into few sequences by a grouping genetic algorithm.

A document longer than the window is cut into windows behind a shorter first piece; windows fill
sequences of their own, so only pieces shorter than the window have to be packed. Pieces of equal
length can stand for each other, and a plan says how often each pattern (a multiset of lengths that
fits the window) is used: its size grows with the window, not with the documents, while it decides
about all of them.

Plans evolve on islands, one Spark group each, from best-fit packings in differently shaken orders.
A crossover injects whole well-filled sequences of one plan into another, removes the sequences that
held the same pieces, and packs what these lose again by best fit. After each epoch the best plan of
an island is copied to the next one. The fittest plan has the fewest sequences, then the largest sum
of squared fillings; evolution ends early when a plan meets the lower bound. Pieces are then numbered
within their length, and a number leads to its sequence and offset by arithmetic.
"""

from __future__ import annotations

import json
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from starloom.llm.bin_slack import BUCKETS, END_ID, VOCABULARY, _running, token_ids
from starloom.llm.texts import pieces
from starloom.session import materialise, prepare

WINDOW = 2048
ISLANDS, MEMBERS, EPOCHS, CHILDREN = 6, 6, 4, 10
PLAN = "island long, member long, sequences long, plan string"

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first
Plan = dict[Pattern, int]  # how many sequences have the pattern


def tokenised(docs: DataFrame, carry: list[str], text: str = "text", window: int = WINDOW,
              vocabulary: str = VOCABULARY) -> DataFrame:
    """`carry`, `doc_tokens` and the crc32 of each piece's ids, the shorter piece first.

    A document is its text's ids and `END_ID`; a null text is empty, so it has one token.
    """
    fields = docs.select(carry).schema
    schema = fields.add("doc_tokens", "long").add("crcs", ArrayType(LongType()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, crcs = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                ids = np.array(token_ids(value or "", vocabulary) + [END_ID], "<u4")
                rest = len(ids) % window
                ends = range(rest or window, len(ids) + 1, window)
                sizes.append(len(ids))
                crcs.append([zlib.crc32(ids[max(end - window, 0):end].tobytes()) for end in ends])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names) - 2)] + [pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], names)

    return docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)


def filling(pattern: Pattern) -> int:
    return sum(length * k for length, k in pattern)


def fitness(plan: Plan) -> tuple[int, int]:
    """Smaller is fitter."""
    return sum(plan.values()), -sum(n * filling(p) ** 2 for p, n in plan.items())


def lower_bound(counts: dict[int, int], window: int = WINDOW) -> int:
    """No plan has fewer sequences: pieces over half the window lie alone, others fill what these leave.

    For each k, pieces longer than window - k have no room for one of k tokens or more.
    """
    n, best = np.zeros(window + 1, np.int64), 0
    for length, count in counts.items():
        n[length] = count
    tokens = n * np.arange(window + 1)
    half = window // 2
    for k in range(half + 1):
        alone, large = n[window - k + 1:].sum(), n[half + 1:window - k + 1].sum()
        free = large * window - tokens[half + 1:window - k + 1].sum()
        best = max(best, int(alone + large + max(0, -((free - tokens[max(k, 1):half + 1].sum()) // window))))
    return best


def best_fit(plan: Plan, items: list[tuple[int, int]], window: int = WINDOW) -> Plan:
    """`plan` with (length, count) added in the given order, each piece where it leaves least room.

    A run of equal pieces takes a whole run of equal sequences at a time; every step uses up the one or
    the other, so the steps grow with the patterns and lengths, not with the pieces.
    """
    rooms: dict[int, Plan] = {}
    open_ = 0  # bit r tells that a sequence has room for r tokens

    def add(pattern: Pattern, n: int) -> None:
        nonlocal open_
        room = window - filling(pattern)
        same = rooms.setdefault(room, {})
        same[pattern] = same.get(pattern, 0) + n
        open_ |= 1 << room

    for pattern, n in plan.items():
        add(pattern, n)
    for length, count in items:
        while count:
            fitting = open_ >> length
            if not fitting:
                break
            room = length + (fitting & -fitting).bit_length() - 1
            pattern, n = rooms[room].popitem()
            if not rooms[room]:
                open_ &= ~(1 << room)
            per = room // length
            full = min(n, count // per)
            if full:
                add(_with(pattern, length, per), full)
            n, count = n - full, count - full * per
            if n and count:
                part = min(count, per)
                add(_with(pattern, length, part), 1)
                n, count = n - 1, count - part
            if n:
                add(pattern, n)
        if count:
            per = window // length
            if count >= per:
                add(((length, per),), count // per)
            if count % per:
                add(((length, count % per),), 1)
    return {pattern: n for same in rooms.values() for pattern, n in same.items()}


def _with(pattern: Pattern, length: int, k: int) -> Pattern:
    merged = dict(pattern)
    merged[length] = merged.get(length, 0) + k
    return tuple(sorted(merged.items(), reverse=True))


def shaken(counts: dict[int, int], draw: random.Random, by: float, window: int = WINDOW) -> Plan:
    """Best fit by falling length, the order shaken by a share of the lengths."""
    order = sorted(counts.items(), key=lambda item: -item[0] * (1 + by * draw.random()))
    return best_fit({}, order, window)


def crossover(host: Plan, donor: Plan, draw: random.Random, window: int = WINDOW) -> Plan:
    """Sequences of the donor, best filled first with gaps left by chance, in place of the host's with the same pieces."""
    share, child, twice = draw.uniform(0.1, 0.6), {}, {}
    for pattern, n in sorted(donor.items(), key=lambda g: (-filling(g[0]), g[0]))[: max(1, int(len(donor) * draw.uniform(0.2, 0.9)))]:
        if draw.random() < share:
            child[pattern] = n
            for length, k in pattern:
                twice[length] = twice.get(length, 0) + n * k
    return _without(host, child, twice, draw, window)


def mutation(plan: Plan, draw: random.Random, window: int = WINDOW) -> Plan:
    """Breaks the sequences of some patterns up, most likely the badly filled ones, and packs their pieces anew."""
    worst = sorted(plan, key=lambda p: (filling(p), p))
    gone = {p for p in worst[: max(2, int(len(worst) * draw.uniform(0.02, 0.2)))] if draw.random() < 0.8}
    gone |= {p for p in worst if draw.random() < 0.02}
    loose: dict[int, int] = {}
    for pattern in gone:
        for length, k in pattern:
            loose[length] = loose.get(length, 0) + k * plan[pattern]
    kept = {p: n for p, n in plan.items() if p not in gone}
    return best_fit(kept, sorted(loose.items(), key=lambda i: -i[0] * (1 + 0.2 * draw.random())), window)


def _without(host: Plan, child: Plan, twice: dict[int, int], draw: random.Random, window: int) -> Plan:
    """`child` joined by the host's sequences that hold none of the pieces in `twice`; the rest by best fit."""
    loose: dict[int, int] = {}
    for pattern, n in sorted(host.items(), key=lambda g: (filling(g[0]) + draw.random(), g[0])):
        gone = min(n, max(-(-twice.get(length, 0) // k) for length, k in pattern))
        if gone:
            for length, k in pattern:
                same = min(twice.get(length, 0), gone * k)
                if same:
                    twice[length] -= same
                if gone * k > same:
                    loose[length] = loose.get(length, 0) + gone * k - same
        if n > gone:
            child[pattern] = child.get(pattern, 0) + n - gone
    return best_fit(child, sorted(loose.items(), reverse=True), window)


def _text(plan: Plan) -> str:
    return json.dumps([[n, pattern] for pattern, n in plan.items()])


def read_plan(text: str) -> Plan:
    return {tuple(map(tuple, pattern)): n for n, pattern in json.loads(text)}


def evolve(members: list[Plan], counts: dict[int, int], draw: random.Random, bound: int, window: int = WINDOW,
           size: int = MEMBERS, children: int = CHILDREN) -> list[Plan]:
    """One epoch of an island: each child takes the place of the least fit member unless it is less fit.

    A plan may have 4 x window patterns at most; a best-fit packing of all pieces never has more.
    """
    if not members:
        members = [shaken(counts, draw, by, window) for by in (0, *(0.5 * n / size for n in range(1, size)))]
    ranked = sorted(((fitness(p), n, p) for n, p in enumerate(members)), key=lambda r: r[:2])[:size]
    for n in range(children):
        if ranked[0][0][0] <= bound:
            break
        (host, donor) = (min(draw.sample(ranked, 2), key=lambda r: r[0])[2] for _ in range(2))
        plan = crossover(host, donor, draw, window) if host is not donor else mutation(host, draw, window)
        if draw.random() < 0.3:
            plan = mutation(plan, draw, window)
        fit = fitness(plan)
        if len(plan) <= 4 * window and fit <= ranked[-1][0] and fit not in [r[0] for r in ranked]:
            ranked = sorted([*ranked[:-1], (fit, size + n, plan)], key=lambda r: r[:2])
    return [p for _, _, p in ranked]


def evolved(spark: SparkSession, counts: dict[int, int], window: int = WINDOW, islands: int = ISLANDS, epochs: int = EPOCHS) -> Plan:
    """The fittest plan of all islands. Each epoch's members are written, so a lost executor repeats one epoch of an island.

    Draws come from the numbers of island and epoch, so the same lengths give the same plan.
    """
    if not counts:
        return {}
    bound = lower_bound(counts, window)

    def step(epoch: int):
        def run(members: pd.DataFrame) -> pd.DataFrame:
            island = int(members["island"].iloc[0])
            plans = [read_plan(p) for p in members.sort_values("member")["plan"] if p]
            plans = evolve(plans, counts, random.Random(f"{island}:{epoch}"), bound, window)
            return pd.DataFrame({
                "island": island, "member": range(len(plans)), "sequences": [fitness(p)[0] for p in plans], "plan": [_text(p) for p in plans],
            })
        return run

    members = spark.createDataFrame([(n, 0, 0, "") for n in range(islands)], PLAN)
    for epoch in range(epochs):
        members = materialise(members.repartition(islands, "island").groupBy("island").applyInPandas(step(epoch), PLAN))
        least = members.agg(F.min("sequences")).first()[0]
        if least <= bound:
            break
        elite = members.filter("member = 0").select(((F.col("island") + 1) % islands).alias("island"), F.lit(-1).cast("bigint").alias("member"), "sequences", "plan")
        members = members.unionByName(elite)
    best = members.filter(F.col("sequences") == least).select("plan").distinct().collect()  # at most one plan per member
    return min((read_plan(r["plan"]) for r in best), key=lambda p: (fitness(p), _text(p)))


def places(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, numbers, per sequence, first sequence, offset): pieces of the length from the first number on."""
    given: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in sorted(plan.items(), reverse=True):
        offset = 0
        for length, k in pattern:
            out.append((length, given.get(length, 0), n * k, k, sequence, offset))
            given[length] = given.get(length, 0) + n * k
            offset += length * k
        sequence += n
    return out


def packed(docs: DataFrame, carry: list[str], text: str = "text", window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: `carry`, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Only documents longer than the window are cut. Repeated rows are packed as often as they occur;
    an empty table gives no pieces. The histogram of the lengths, at most `window` rows, and the plan,
    at most 4 x `window` patterns, pass the driver; nothing else does.
    """
    spark = prepare(docs.sparkSession)
    named = docs.select(F.struct(*carry).alias("row"), F.col(text).alias("__text"))
    tokens = materialise(tokenised(named, ["row"], "__text", window, vocabulary))
    rest = F.col("doc_tokens") % window
    short = tokens.filter(rest > 0).select(
        "row", "doc_tokens", rest.alias("length"), F.get("crcs", F.lit(0)).alias("ids_crc32"), F.lit(1).cast("bigint").alias("one"),
        F.pmod(F.xxhash64("row", "crcs"), F.lit(BUCKETS)).alias("bucket"), F.xxhash64("crcs", "row").alias("key"),
    )
    counts = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.sum("one").alias("n")).collect()}
    plan = evolved(spark, counts, window)
    sequences = sum(plan.values())

    longs = "l bigint, first bigint, numbers bigint, per bigint, sequence bigint, shift bigint"
    rules = spark.createDataFrame(places(plan), longs)
    numbered = materialise(_running(short, ["length"], "one", ["key", "doc_tokens"], "number"))
    nth = F.col("number") - F.col("first")
    mine = (F.col("length") == F.col("l")) & (nth >= 0) & (nth < F.col("numbers"))
    zero = F.lit(0).cast("bigint")
    packed_ = numbered.join(F.broadcast(rules), mine).select(
        "row", F.lit(0).alias("piece"), zero.alias("start"), "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor((nth - nth % F.col("per")) / F.col("per"))).cast("bigint").alias("sequence_id"),
        (F.col("shift") + nth % F.col("per") * F.col("length")).alias("offset"),
    )
    cut = tokens.select("row", "doc_tokens", F.posexplode("crcs").alias("piece", "ids_crc32"))
    late = F.when(rest > 0, rest - window).otherwise(0)
    full = cut.filter((F.col("piece") > 0) | (rest == 0)).select(
        "row", "piece", (F.col("piece") * window + late).alias("start"), F.lit(window).cast("bigint").alias("length"),
        "ids_crc32", "doc_tokens", (F.monotonically_increasing_id() + sequences).alias("sequence_id"), zero.alias("offset"),
    )
    return packed_.unionByName(full).select("row.*", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
