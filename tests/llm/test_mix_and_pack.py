"""Mixing and packing, and the whole pipeline against plain versions of its stages."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tables import documents, odd_rows, prose, rows_of, saved, word_list
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import bin_slack, queries, source_mix

SF = "/root/testdata/sf0.001"


def plain_targets(sizes):
    """Share, cut at the limits, and share the excess again until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, fixed = dict.fromkeys(order, 0.0), set()
    rest = 1.5 * sum(sizes.values())
    while rest > 1e-9 and len(fixed) < len(order):
        free = [s for s in order if s not in fixed]
        whole = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / whole
        rest = 0.0
        for s in free:
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                fixed.add(s)
    return target


@pytest.mark.parametrize("clash", [False, True])
def test_op8(spark, tmp_path, clash):
    folder = saved(tmp_path, documents=documents(spark, clash=clash))
    got = queries.op8_source_mix(spark, folder).collect()
    rows = odd_rows()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((r[0], len(word_list(r[1])), r[3]) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(word_list(r[1]))
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert math.isclose(r.target, plain_targets(sizes)[r.source], rel_tol=1e-9)
        taken[r.source] += r.taken
    for s, t in plain_targets(sizes).items():
        assert t - 1 <= taken[s] <= t + 1e-6
    assert rows_of(queries.op8_source_mix(spark, folder)) == sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {draw.choice(["a", "B", "é", "", None, "z"]) if i < 3 else f"s{i}": int(draw.paretovariate(0.6)) * 10 for i in range(draw.randrange(1, 12))}
    rows = [(i, "", "en", s, n) for i, (s, n) in enumerate(sizes.items())]
    frame = documents(spark, rows).select(source_mix._keys("source").alias("src"), F.col("n_chars").alias("size"))
    got = {None if r.src == "" else r.src[1:]: r.target for r in source_mix.targets(frame).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in want)


def test_shards_are_draws(spark):
    """Counts of a source over the shards: the mean and variance of draws without replacement."""
    draw = random.Random(4)
    rows = [(i, prose(i, draw.randrange(300, 900), 50), "en", "abc"[min(i % 7, 2)], 0) for i in range(900)]
    sizes = documents(spark, rows).select(F.col("doc_id"), source_mix._keys("source").alias("src"), source_mix.word_count("text").alias("size"))
    plan = source_mix.schedule(source_mix.targets(sizes))
    taken = source_mix.slots(plan).withColumns({"shard": F.expr("(shard * 4096 + slot) div 64")})
    at = [r[0] for r in source_mix.slots(plan).selectExpr("shard * 4096 + slot").collect()]
    assert sorted(at) == list(range(len(at)))  # every slot once
    counts = {(r.shard, r.src): r.slots for r in source_mix.shard_counts(taken).collect()}
    shards, total = len(at) // 64, len(at)
    for r in plan.collect():
        share = r.takes / total
        found = np.array([counts.get((k, r.src), 0) for k in range(shards)])
        variance = 64 * share * (1 - share) * (total - 64) / (total - 1)
        assert abs(found.mean() - 64 * share) < 4 * (variance / shards) ** 0.5
        assert 0.5 < found.var() / variance < 1.7


def test_shards_of_documents(spark, tmp_path):
    """What a document's row tells about its slots, against the list of slots."""
    rows = odd_rows()
    frame = documents(spark, rows)
    sizes = frame.select(F.col("doc_id"), source_mix._keys("source").alias("src"), source_mix.word_count("text").alias("size")).filter("size > 0")
    taken = defaultdict(list)
    for r in source_mix.slots(source_mix.schedule(source_mix.targets(sizes))).collect():
        taken[r.src, r.block].append(r.shard)
    want = Counter()
    for r in source_mix.placed(sizes).collect():
        shards = [s for b in range(r.start // 128, (r.start + r.size - 1) // 128 + 1) for s in taken[r.src, b]]
        want[r.doc_id, r.size, len(shards), min(shards, default=None), max(shards, default=None)] += 1
    got = queries.op8_source_mix(spark, saved(tmp_path, documents=frame)).filter("size > 0")
    assert Counter((r.doc_id, r.size, r.slots, r.first_shard, r.last_shard) for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "first_slot" in plan and "first_shard" in plan


def test_a_million_sources(spark):
    sizes = spark.range(1_000_000).select(F.concat(F.lit("=s"), F.col("id")).alias("src"), (F.col("id") % 50 + 1 + F.when(F.col("id") < 3, 10**8).otherwise(0)).alias("size"))
    got = source_mix.targets(sizes)
    row = got.agg(F.count("nth"), F.max("nth"), F.sum("target"), F.max(F.col("target") / F.col("source_size")), F.sum("source_size")).first()
    assert row[0] == 1_000_000 and row[1] == 999_999 and row[3] <= 2 and math.isclose(row[2], min(1.5 * row[4], 2 * row[4]), rel_tol=1e-9)


def test_op8_without_rows_or_words(spark, tmp_path):
    assert queries.op8_source_mix(spark, saved(tmp_path / "0", documents=documents(spark, []))).count() == 0
    rows = [(1, None, "en", "a", 0), (2, " ", "en", None, 0)]
    got = queries.op8_source_mix(spark, saved(tmp_path / "1", documents=documents(spark, rows))).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 16, 97, 100, 1000, 4097, 20_011])
def test_permutations(spark, size):
    frame = spark.range(size).select(source_mix._permuted(F.col("id"), F.lit(size).cast("bigint"), F.lit(11)).alias("p"))
    got = [r.p for r in frame.collect()]
    assert sorted(got) == list(range(size)) and (size < 100 or got != sorted(got))


def test_shards_hold_sources_by_their_shares(spark):
    rows = [(i, prose(i, 2000), "en", "ab"[i % 2], 0) for i in range(120)]
    frame = documents(spark, rows).select(source_mix._keys("source").alias("src"), source_mix.word_count("text").alias("size"))
    taken = source_mix.slots(source_mix.targets(frame).coalesce(1))
    slots = taken.collect()
    assert len({(r.shard, r.slot) for r in slots}) == len(slots) and max(r.slot for r in slots) < source_mix.SHARD
    counts = source_mix.shard_counts(taken).collect()
    assert sum(r.slots for r in counts) == len(slots)
    early = [r.src for r in slots if r.shard == 0 and r.slot < 400]
    share = sum(r.src == "=a" for r in slots) / len(slots)
    assert abs(sum(s == "=a" for s in early) / len(early) - share) < 0.12


def test_mix_returns_the_words_it_took(spark):
    docs = documents(spark, clash=True)
    mixed = source_mix.mix(docs)
    assert mixed.columns == docs.columns
    words, own = Counter(), defaultdict(list)
    for r in mixed.collect():
        words[r.source] += len(word_list(r.text))
        own[r.doc_id].append(r.text)
    sizes = defaultdict(int)
    for r in odd_rows():
        sizes[r[3]] += len(word_list(r[1]))
    for s, t in plain_targets(sizes).items():
        assert t - 1 <= words[s] <= t + 1e-6
    texts = defaultdict(list)
    for r in odd_rows():
        texts[r[0]].append(r[1] or "")
    for id_, found in own.items():
        for t in found:
            assert t in texts[id_] or any(not Counter(word_list(t)) - Counter(word_list(x)) for x in texts[id_])
    assert source_mix.mix(documents(spark, [])).count() == 0


def test_mix_runs_no_python(spark):
    for frame in (source_mix.mixed(documents(spark)), source_mix.mix(documents(spark))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids + [0]


def test_both_tokenizers_give_the_same_ids():
    texts = [r[1] or "" for r in odd_rows()] + ["  \n\n x \t\r\n", "'s 'S 'll it's", "\x00\x1c\x85\xa0 x", "漢字 кириллица 🙂 ａ１", "a<|endoftext|>b"]
    texts += ["".join(f"b{chr(c)}c {chr(c)}1  {chr(c)} a" for c in range(k, k + 64)) for k in range(0x20, 0x2800, 64)]
    for t in texts:
        assert bin_slack.token_ids(t) == EXACT.encode(t, add_special_tokens=False).ids


def check_packing(rows, got, window=1024):
    """Every id lies in one piece, pieces fill sequences without gaps, and little of them is padding."""
    ids = defaultdict(list)
    for r in rows:
        ids[r[0]].append(plain_ids(r[1]))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(Counter)
    for id_, found in pieces.items():
        for start, length, crc, size in found:
            assert any(len(x) == size and zlib.crc32(np.array(x[start:start + length], "<u4").tobytes()) == crc for x in ids[id_])
            want[id_].update((size, i) for i in range(start, start + length))
    assert want == {id_: Counter((len(x), i) for x in found for i in range(len(x))) for id_, found in ids.items()}
    total = padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= window
        total += end
        padding += 0 if end & (end - 1) == 0 else window - end
    return padding, total


@pytest.mark.parametrize("clash", [False, True])
def test_op6(spark, tmp_path, clash):
    got = queries.op6_bin_slack(spark, saved(tmp_path, documents=documents(spark, clash=clash))).collect()
    padding, _ = check_packing(odd_rows(), got)
    assert padding < 1024 + 8 * len({r.sequence_id for r in got})


def test_op6_hot_length_and_no_rows(spark, tmp_path):
    text = prose(1, 260)
    rows = [(i, text, "en", "a", 0) for i in range(400)] + [(1000 + i, prose(i, 15), "en", "a", 0) for i in range(9)]
    got = queries.op6_bin_slack(spark, saved(tmp_path / "hot", documents=documents(spark, rows))).collect()
    padding, total = check_packing(rows, got)
    assert padding < 1024 + 0.01 * total
    assert queries.op6_bin_slack(spark, saved(tmp_path / "0", documents=documents(spark, []))).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_fill_is_the_best_subset_sum(seed):
    draw = random.Random(seed)
    counts = {draw.randrange(1, 60): draw.randrange(1, 5) for _ in range(draw.randrange(1, 9))}
    room = draw.randrange(1, 150)
    used = bin_slack.fill(room, counts)
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    assert all(0 < k <= counts[length] for length, k in used.items())
    assert sum(length * k for length, k in used.items()) == max(sums)


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_rest_once(seed):
    draw = random.Random(seed)
    counts = {draw.randrange(1, 1024): draw.randrange(1, 500) for _ in range(draw.randrange(1, 60))}
    whole, stream, sequences = bin_slack.plan(counts)
    given = Counter()
    for length, first, n, *_ in sorted(whole + stream, key=lambda r: (r[0], r[1])):
        assert first == given[length]
        given[length] += n
    assert given == Counter(counts) and len({r[4] for r in whole}) <= 2 * len(counts)
    assert sequences == len({r[4] + i for r in whole for i in range(r[2] // r[3])})


def test_pipeline_stages(spark, tmp_path):
    """Each stage on all that its predecessor kept, against plain versions."""
    from test_fingerprints import least_id, plain_groups
    from test_personal_data import plain as plain_spans
    from test_rules import plain as plain_rules

    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in odd_rows() if r[0] is not None]
    rows += [(300 + i, f"{prose(300 + i, 60)} mail me at a{i}@mail.example.com or 10.0.0.{i}", "en", "d", 9) for i in range(12)]
    rows += [(400 + i, " | ".join(prose(400 + i, 60).split()), "en", "d", 9) for i in range(5)]
    docs = documents(spark, rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [tuple(r) for r in docs.collect()]
        assert name == "packing" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good, unique, masked, mixed, packed = kept.values()
    assert {r[0] for r in good} == {r[0] for r in rows if not plain_rules(r)[-1] and not 400 <= r[0] < 405}
    assert sorted(r[0] for r in unique) == sorted(least_id(good, g) for g in plain_groups(good)[1])
    assert sorted(r[0] for r in masked) == sorted(r[0] for r in unique) and not any(plain_spans(r[1]) for r in masked)
    clean = {r[0]: r[1] for r in unique if not any(c in "0123456789@" for c in r[1])}
    assert all(r[1] == clean.get(r[0], r[1]) for r in masked)
    sizes, words = defaultdict(int), Counter()
    for r in masked:
        sizes[r[3]] += len(word_list(r[1]))
    for r in mixed:
        words[r[3]] += len(word_list(r[1]))
    assert all(t - 1 <= words[s] <= t + 1e-6 for s, t in plain_targets(sizes).items())
    tokens = Counter()
    for r in mixed:
        tokens[r[0]] += len(plain_ids(r[1]))
    names = docs.columns
    placed = Counter()
    for r in packed:
        placed[r[0]] += r[names.index("length")]
    assert placed == tokens


def test_pipeline_runs_on_the_given_tables(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_without_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, saved(tmp_path, documents=documents(spark, []))).count() == 0
