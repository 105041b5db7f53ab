"""Packing by the grouping genetic algorithm: every id in its place, and few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tables import documents, odd_rows, prose, saved
from tokenizers import Tokenizer

from starloom.llm import grouping_genetic as packing
from starloom.llm import queries


def plain_best_fit(lengths, window):
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = min((i for i, room in enumerate(rooms) if room >= length), key=lambda i: rooms[i], default=None)
        if at is None:
            rooms.append(window)
            at = -1
        rooms[at] -= length
    return len(rooms)


def fewest(lengths, window):
    """The true minimum, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*rooms, window - lengths[i]])

    place(0, [])
    return best


def holds(plan, counts, window):
    used = Counter()
    for pattern, n in plan.items():
        assert n > 0 and 0 < packing.filling(pattern) <= window and all(k > 0 for _, k in pattern)
        for length, k in pattern:
            used[length] += n * k
    assert used == Counter(counts)


@pytest.mark.parametrize("seed", range(8))
def test_plans(seed):
    draw = random.Random(seed)
    window = draw.choice([50, 100, 2048])
    lengths = [draw.randrange(1, window) if seed % 2 else draw.randrange(window // 5, window // 2) for _ in range(draw.choice([1, 3, 300, 5000]))]
    counts = dict(Counter(lengths))
    bound = packing.lower_bound(counts, window)
    first = packing.best_fit({}, sorted(counts.items(), reverse=True), window)
    holds(first, counts, window)
    assert len(first) <= 4 * window and bound <= sum(first.values()) <= plain_best_fit(lengths, window) + 1
    members = []
    for _ in range(3):
        members = packing.evolve(members, counts, draw, 0, window)
        for plan in members:
            holds(plan, counts, window)
        assert members == sorted(members, key=packing.fitness)
    assert packing.fitness(members[0]) <= packing.fitness(first)
    a, b = members[0], members[-1]
    for _ in range(20):
        holds(packing.crossover(a, b, draw, window), counts, window)
        holds(packing.mutation(a, draw, window), counts, window)
    assert packing.read_plan(packing._text(a)) == a


@pytest.mark.parametrize("seed", range(12))
def test_small_problems_against_search(seed):
    draw = random.Random(seed)
    lengths = [draw.randrange(2, 14) for _ in range(9)]
    counts, members = dict(Counter(lengths)), []
    least = fewest(lengths, 20)
    assert packing.lower_bound(counts, 20) <= least
    for _ in range(4):
        members = packing.evolve(members, counts, draw, least, 20)
    assert sum(members[0].values()) == least


def test_evolution_beats_best_fit(spark):
    """Triples that fill the window exactly, which packing by falling length does not find."""
    draw = random.Random(1)
    lengths = []
    for _ in range(30):
        a, b = draw.randrange(25, 40), draw.randrange(25, 40)
        lengths += [a, b, 100 - a - b]
    counts = dict(Counter(lengths))
    plan = packing.evolved(spark, counts, 100)
    holds(plan, counts, 100)
    assert 30 <= sum(plan.values()) < plain_best_fit(lengths, 100)
    assert plan == packing.evolved(spark, counts, 100)


def check(rows, got, window):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for r in rows:
        ids[r[0]].append(np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4"))
    want, sequences = Counter(), defaultdict(list)
    for doc_id, texts in ids.items():
        for t in texts:
            start, piece = 0, 0
            while start < len(t):
                end = start + ((len(t) - start) % window or window)
                want[doc_id, piece, start, end - start, zlib.crc32(t[start:end].tobytes()), len(t)] += 1
                start, piece = end, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


@pytest.mark.parametrize("clash", [False, True])
def test_op12(spark, tmp_path, clash):
    rows = odd_rows() + [(500 + i, prose(500 + i, 3 + i * 9), "en", "a", 0) for i in range(150)] + [(700 + i, "same words", "en", "a", 0) for i in range(300)]
    frame = documents(spark, rows, clash)
    if clash:
        frame = frame.withColumns({c: F.lit("!") for c in ("length", "piece", "number", "crcs", "doc_tokens", "l", "one", "sequence")})
    got = queries.op12_grouping_genetic(spark, saved(tmp_path, documents=frame))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = got.collect()
    used = check(rows, got, packing.WINDOW)
    assert used <= -(-sum(r.length for r in got) // packing.WINDOW) + 2


def test_other_window(spark):
    rows = odd_rows()
    got = packing.packed(documents(spark, rows), ["doc_id"], window=64).collect()
    check(rows, got, 64)


def test_op12_without_rows(spark, tmp_path):
    assert queries.op12_grouping_genetic(spark, saved(tmp_path, documents=documents(spark, []))).count() == 0
