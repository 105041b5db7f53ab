"""Conversation repair against a search over all edits written anew."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache
from itertools import product

import pytest
from pyspark.sql import functions as F
from tables import saved

from starloom.llm import queries, role_repair

TURNS = "conv_id bigint, turn bigint, role string, text string"
# states: s: nothing read, S: a system turn read, U: a user turn read, E: whole pairs read
STEPS = {("s", "s"): "S", ("s", "u"): "U", ("S", "u"): "U", ("U", "a"): "E", ("E", "u"): "U"}


def shown(value):
    return " " if value is None else str(value)


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = shown(role), shown(text)
        out[conv]
        fault = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        if fault:
            out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(t, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, t in out.items()}


def plain_repair(turns):
    seen, faults = set(), []
    for _, role, text in turns:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    @cache
    def best(i, state, inserted):
        """(cost, audit, repaired) from turn i on; inserting three times in a row is never cheapest."""
        ways = []
        if i == len(turns):
            if state in "sE":
                ways.append((0, "", ()))
        else:
            late = faults[i] == "truncated"
            c, a, r = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, r))
            if faults[i] not in ("blank", "duplicate"):
                role, text = turns[i][1:]
                for name, cost, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    then = STEPS.get((state, name[:1]))
                    if then:
                        c, a, r = best(i + 1, then, 0)
                        ways.append((c + cost + late, letter + a, (f"{name}:{text}", *r)))
        if inserted < 3:
            for name in ("user", "assistant"):
                then = STEPS.get((state, name[:1]))
                if then:
                    c, a, r = best(i, then, inserted + 1)
                    ways.append((c + 2, "I" + a, (f"{name}:", *r)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, repaired = best(0, "s", 0)
    digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), repaired


def conversations(seed, n, longest):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "Tool", "$", "", None, "Sys", "usher"]
    texts = ["Yes.", "no", "What?", "", None, " \t", "wait!\n", "a. b", "é."]
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(1, longest)):
            number = None if draw.random() < 0.05 else turn + draw.randrange(3)
            role = ("user", "assistant")[turn % 2] if draw.random() < 0.6 else draw.choice(roles)
            text = f"Text {draw.randrange(40)}." if draw.random() < 0.6 else draw.choice(texts)
            rows += [(conv, number, role, text)] * draw.choice((1, 1, 1, 1, 2, 3))
    return rows + [(None, 1, "user", "Hm."), (None, None, None, None), (None, 2, "assistant", "Yes.")]


def got_of(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("clash", [False, True])
def test_op13(spark, tmp_path, clash):
    rows = conversations(1, 300, 14)
    frame = spark.createDataFrame(rows, TURNS)
    if clash:
        frame = frame.withColumns({c: F.lit("!") for c in ("conv", "copies", "part", "seq", "audit", "cost", "n", "gaps", "place")})
    got = queries.op13_role_repair(spark, saved(tmp_path, conversations=frame))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = {c: plain_repair(t)[0] for c, t in plain_damage(rows).items()}
    assert got.count() == len(want) and got_of(got) == want


@pytest.mark.parametrize("long", [1, 3, 50])
def test_segments_change_nothing(spark, long):
    rows = conversations(2, 40, 60) + [(7, i, "user", "Again." if i % 3 else f"Number {i}") for i in range(400)]
    turns = role_repair.damaged(spark.createDataFrame(rows, TURNS).repartition(5))
    want = {c: plain_repair(t) for c, t in plain_damage(rows).items()}
    got = got_of(role_repair.repair(turns, copies=F.col("copies"), long=long))
    assert got == {c: w[0] for c, w in want.items()}
    left = role_repair.repaired(turns, copies=F.col("copies"), long=long).collect()
    by = defaultdict(list)
    for r in sorted(left, key=lambda r: r.n):
        by[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: tuple(v) for c, v in by.items()} == {c: w[1] for c, w in want.items() if w[1]}


def test_all_short_role_sequences(spark):
    rows = [(n, i, {"s": "system", "u": "user", "a": "assistant"}[x], f"{i}.") for n, word in
            enumerate(w for size in range(1, 6) for w in product("sua", repeat=size)) for i, x in enumerate(word)]
    by = defaultdict(list)
    for conv, *turn in rows:
        by[conv].append(tuple(turn))
    got = got_of(role_repair.repair(spark.createDataFrame(rows, TURNS)))
    assert got == {c: plain_repair(t)[0] for c, t in by.items()}
    assert all(re.fullmatch("[DIKR]*", g[6]) for g in got.values())


def test_one_conversation_of_equal_rows(spark):
    turns = spark.range(30_000).select(F.lit(1).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    (row,) = role_repair.repair(turns, long=100).collect()
    assert (row.duplicate, row.illegal, row.cost, row.gaps) == (29_999, 29_999, 3 * 29_999 + 2, 0)
    assert row.audit == "K" + "D" * 29_999 + "I"
    assert row.repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()


def test_no_conversations(spark, tmp_path):
    assert queries.op13_role_repair(spark, saved(tmp_path, conversations=spark.createDataFrame([], TURNS))).count() == 0


def test_only_dropped_rows(spark):
    turns = spark.createDataFrame([(5, None, "", "", 0)], TURNS + ", copies bigint")
    (row,) = role_repair.repair(turns, copies=F.col("copies")).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
