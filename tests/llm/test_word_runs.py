"""Runs of words against a search over all periods and starts."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import documents, odd_rows, prose, saved, word_list

from starloom.llm import queries, word_runs


def plain_runs(words):
    """All periods up to a quarter, all maximal stretches, periods that are not the smallest left out."""
    found = {}
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([codes[w] for w in words])
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate(([False], ids[:-q] == ids[q:], [False])).astype(int)
        turns = np.flatnonzero(np.diff(same)).tolist()
        for x, y in zip(turns[::2], turns[1::2]):
            if y - x + q >= max(6, 4 * q):
                found.setdefault((x, y - x + q), q)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_edit(doc_id, words):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = plain_edit(doc_id, word_list(text))
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda value: hashlib.sha256(value.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)), len(words))


def periodic(draw, sigma):
    out = []
    while len(out) < 60:
        root = [draw.randrange(sigma) for _ in range(draw.randrange(1, 6))]
        out += (root * draw.randrange(1, 9))[: draw.randrange(1, 40)]
    return [b"%d" % w for w in out]


@pytest.mark.parametrize("sigma", [1, 2, 3, 5, 9])
def test_runs(sigma):
    draw = random.Random(sigma)
    for _ in range(150):
        words = periodic(draw, sigma)
        assert word_runs.find_runs(words) == plain_runs(words)
        words = [b"%d" % draw.randrange(sigma) for _ in range(draw.randrange(80))]
        assert word_runs.find_runs(words) == plain_runs(words)


def test_runs_of_nested_periods():
    x = [b"a", b"a", b"b"]
    for _ in range(4):
        x = x * 4 + [b"c"]
    x = x[:2000]
    assert word_runs.find_runs(x) == plain_runs(x)


def test_common_prefixes():
    draw = random.Random(5)
    symbols = [draw.randrange(2) for _ in range(200)] + [-1]
    common = word_runs.CommonPrefixes(symbols)
    assert sorted(range(201), key=lambda i: symbols[i:]) == sorted(range(201), key=lambda i: common.rank[i])
    pairs = [(a, b) for a in range(200) for b in range(a + 1, 201)]
    a, b = (np.array(x) for x in zip(*pairs))
    want = [next(k for k in range(201) if symbols[i + k] != symbols[j + k]) for i, j in pairs]
    assert common.of(a, b).tolist() == want


@pytest.mark.parametrize("clash", [False, True])
def test_op11(spark, tmp_path, clash):
    rows = odd_rows() + [(1000 + i, " \n".join(w.decode() for w in periodic(random.Random(i), 4)), "en", "a", 0) for i in range(120)]
    rows += [(2000, "la " * 3000, "en", "a", 0), (2001, "x y " * 5 + prose(8, 40) + " z" * 6 + " z" * 5, "en", "a", 0)]
    rows += [(3000 + i, prose(i, 200), "en", "a", 0) for i in range(60)]
    frame = documents(spark, rows, clash)
    if clash:
        frame = frame.withColumns({c: F.lit("!") for c in ("runs", "collapsed", "period", "length", "best")})
    got = queries.op11_word_runs(spark, saved(tmp_path, documents=frame))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_row(r[0], r[1]) for r in rows), key=repr)


def test_op11_without_rows(spark, tmp_path):
    assert queries.op11_word_runs(spark, saved(tmp_path, documents=documents(spark, []))).count() == 0
