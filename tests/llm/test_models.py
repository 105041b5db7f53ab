"""Quality classifier, byte model and licence classifier."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tables import documents, lower, odd_rows, prose, saved, word_list

from starloom.llm import licence_paragraphs as lp
from starloom.llm import nb_svm, ppm, queries

SF = "/root/testdata/sf0.01"


def test_op4_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op4_nb_svm(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    good, bad = ([r.score for r in held if labels[r.doc_id] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def labelled_rows():
    good = [(1000 + i, prose(i, 60), "en", "a", 0) for i in range(60)]
    bad = [(2000 + i, "### ".join(prose(i, 40).split()), "en", "a", 0) for i in range(60)]
    return odd_rows() + good + bad


def quality_labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("clash", [False, True])
def test_op4_odd_rows(spark, tmp_path, clash):
    labels = [(r[0], int(r[0] < 2000), 0) for r in labelled_rows() if r[0] and r[0] >= 1000]
    labels += [(1, 1, 0), (1, 0, 0), (2, None, 1), (None, 1, 1), (77_777, 1, 0), (3, 5, 0)]
    folder = saved(tmp_path, documents=documents(spark, labelled_rows(), clash), labels=quality_labels(spark, labels))
    got = queries.op4_nb_svm(spark, folder).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in labelled_rows())
    held = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 1000]
    assert held and all((r.score > 0.5) == (r.doc_id < 2000) for r in held)
    again = {(r.doc_id, r.score) for r in queries.op4_nb_svm(spark, folder).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


@pytest.mark.parametrize("quality", [None, 0, 1])
def test_op4_with_one_class_or_none(spark, tmp_path, quality):
    labels = [] if quality is None else [(i, quality, 0) for i in range(100, 120)]
    folder = saved(tmp_path, documents=documents(spark), labels=quality_labels(spark, labels))
    scores = {r.score for r in queries.op4_nb_svm(spark, folder).collect()}
    assert scores == {0.5} if quality is None else all(abs(s - quality) < 1e-6 for s in scores)


def test_held_out_labels_are_not_learnt(spark, tmp_path):
    labels = [(r[0], int(r[0] < 2000), 0) for r in labelled_rows() if r[0] and r[0] >= 1000]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    scores = []
    for name, rows in (("a", labels), ("b", turned)):
        folder = saved(tmp_path / name, documents=documents(spark, labelled_rows()), labels=quality_labels(spark, rows))
        scores.append({(r.doc_id, r.score) for r in queries.op4_nb_svm(spark, folder).collect()})
    assert scores[0] == scores[1]


def test_dual_descent_reaches_the_primal_optimum():
    draw = np.random.RandomState(1)
    rows = [np.flatnonzero(draw.rand(6) < 0.5) for _ in range(40)]
    rows = [r if len(r) else np.array([0]) for r in rows]
    signs = np.where(draw.rand(40) < 0.5, 1, -1)
    scale, cost = np.zeros(nb_svm.SIZE), np.full(40, 0.5)
    scale[:6] = draw.normal(size=6)
    w, bias = nb_svm.descend(rows, signs, scale, cost)
    x = np.zeros((40, 7))
    for i, r in enumerate(rows):
        x[i, r], x[i, 6] = nb_svm.scaled(r, scale), 1

    def loss(v):
        return v @ v / 2 + 0.5 * np.maximum(1 - signs * (x @ v), 0).sum()

    best = loss(np.append(w[:6], bias))
    assert all(loss(np.append(w[:6], bias) + 0.05 * draw.normal(size=7)) >= best - 1e-2 for _ in range(300))


def plain_base(rows):
    tokens = [[*word_list(lower(r[1])), None] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    counts = Counter(itertools.chain.from_iterable(t for t, h in zip(tokens, held) if not h))
    n, v = sum(counts.values()), len(counts)
    return [(r[0], h, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
            for r, t, h in zip(rows, tokens, held)]


@pytest.mark.parametrize("head", [1 << 17, 7])
@pytest.mark.parametrize("clash", [False, True])
def test_op5(spark, tmp_path, monkeypatch, head, clash):
    monkeypatch.setattr(ppm, "HEAD", head)
    got = queries.op5_ppm(spark, saved(tmp_path, documents=documents(spark, clash=clash))).collect()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]

    def order(r):
        return repr(r[:4]), r[5]

    mine = sorted((tuple(r[n] for n in names) + (r.base_score,) for r in got), key=order)
    want = sorted(plain_base(odd_rows()), key=order)
    assert [m[:5] for m in mine] == [w[:5] for w in want]
    assert all(abs(m[5] - w[5]) <= 1e-9 * max(1, abs(w[5])) for m, w in zip(mine, want))
    assert all(r.score < 0 for r in got)


def test_op5_without_rows_and_without_training(spark, tmp_path):
    assert queries.op5_ppm(spark, saved(tmp_path / "0", documents=documents(spark, []))).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = queries.op5_ppm(spark, saved(tmp_path / "1", documents=documents(spark, [(held, "ab", "", "", 0)]))).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (2, 0, 0, 0.0)
    assert abs(row.score + 3 * math.log10(256)) < 1e-9


def trie(texts):
    found = Counter(int(c) for t in texts for block in ppm.codes(t) for c in block)
    nodes = []
    for depth in range(1, ppm.ORDER + 2):
        short = Counter()
        for code, n in found.items():
            short[code & (1 << 8 * depth) - 1] += n
        keys = np.array(sorted(short), np.int64)
        nodes.append((keys, np.array([short[k] for k in keys.tolist()], np.int64)))
    return ppm.Trie(nodes)


def plain_ppm(texts, text):
    """Prediction by partial matching, symbol by symbol, from the definition."""
    follows = {}
    for t in texts:
        whole = b"\xff" * ppm.ORDER + t + b"\xff"
        for i in range(ppm.ORDER, len(whole)):
            for k in range(ppm.ORDER + 1):
                follows.setdefault(whole[i - k:i], Counter())[whole[i]] += 1
    whole, total = b"\xff" * ppm.ORDER + text + b"\xff", 0.0
    for i in range(ppm.ORDER, len(whole)):
        out = set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in follows.get(whole[i - k:i], {}).items() if s not in out}
            if not seen:
                continue
            size = sum(seen.values()) + len(seen)
            if whole[i] in seen:
                total += math.log10(seen[whole[i]] / size)
                break
            total += math.log10(len(seen) / size)
            out |= set(seen)
        else:
            total -= math.log10(256 - len(out))
    return total


def test_byte_model_follows_the_definition():
    texts = [prose(i, 30).encode() for i in range(6)] + [b"", "é ü".encode(), b"aaaa"]
    model = trie(texts)
    for text in [*texts, prose(50, 20).encode(), b"zzz 9", b"", "ñ".encode(), b"aaaaaaaaab"]:
        assert abs(model.score(text) - plain_ppm(texts, text)) < 1e-6


@pytest.mark.parametrize("bits", [0, 5, 20])
def test_op5_drops_no_context(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(ppm, "NODE_BITS", bits)
    rows = [(i, prose(i, 25) + " é 日本" * (i % 3), "en", "a", 0) for i in range(40)]
    rows += [(40 + i, f"q{i}# ~ÿ é日 the w1 {chr(913 + i)}", "en", "a", 0) for i in range(20)]
    rows += [(60, None, "en", "a", 0), (61, "ab ab", "en", "a", 0), (61, "ab ab", "en", "a", 0)]
    held = [zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    texts = [lower(r[1]).encode() for r, h in zip(rows, held) if not h]
    got = sorted((r.doc_id, r.score) for r in ppm.corpus_scores(documents(spark, rows)).collect())
    want = sorted((r[0], plain_ppm(texts, lower(r[1]).encode())) for r in rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert max(abs(g[1] - w[1]) for g, w in zip(got, want)) < 1e-6


def test_byte_model_is_a_distribution():
    model = trie([prose(i, 30).encode() for i in range(6)])
    for context in (b"the ", b"zzzz", b"w1x ", b"\xff\xff\xff\xff", b" q t"):
        base = int.from_bytes(context, "big") << 8
        assert abs(float((10 ** model.logs(base + np.arange(256))).sum()) - 1) < 1e-9


def test_byte_model_prefers_what_it_knows():
    model = trie([prose(i, 200).encode() for i in range(20)])
    text = prose(99, 100)
    scrambled = "".join(sorted(text))
    assert model.score(text.encode()) > model.score(scrambled.encode())


NOTICES = {
    "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache",
    "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "all-rights-reserved",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc", "SPDX-License-Identifier: MPL-2.0": "mpl",
    "Copyright 2019 Foo Inc. ALL RIGHTS RESERVED": "all-rights-reserved", "distributed*** under### the&&& MIT%%% license": "mit",
    "licensed under the GNU Affero General Public License, version 2": "agpl", "Licensed under CC BY-SA 3.0": "cc-by-sa",
}


@pytest.mark.parametrize("clash", [False, True])
def test_op10(spark, tmp_path, clash):
    plain = ["the public version of this work", "general license plates", "mit der und die", "rights", "source form subject"]
    rows = [(700 + i, f"{prose(i, 30)}\n{n}", "en", "a", 0) for i, n in enumerate(NOTICES)]
    rows += [(800 + i, f"{n}\n{prose(i, 30)}\n\n{p}", "en", "a", 0) for i, (n, p) in enumerate(zip(NOTICES, plain))]
    rows += [(900 + i, f"{prose(i, 500)} {n} {prose(i + 1, 500)}", "en", "a", 0) for i, n in enumerate(NOTICES)]
    rows += [(950 + i, p, "en", "a", 0) for i, p in enumerate(plain)]
    got = {r.doc_id: r for r in queries.op10_licence_paragraphs(
        spark, saved(tmp_path, documents=documents(spark, odd_rows() + rows, clash))).collect()}
    for i, family in enumerate(NOTICES.values()):
        assert got[700 + i].notices == f"1:{family}" and got[900 + i].families == family
        if i < len(plain):
            assert got[800 + i].notices == f"0:{family}"
    for i in range(len(plain)):
        assert got[950 + i].families == ""
    for r in odd_rows():
        lines = [x for x in re.split("\n", r[1] or "") if word_list(x)]
        assert got[r[0]].families == "" and (r[0] in (9, 10, None) or got[r[0]].n_paragraphs == len(lines))


WRAPPED = {
    """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""": "mit",
    """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:""": "bsd",
    """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or""": "gpl",
    """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation.""": "agpl",
}


def test_op10_wrapped_and_dual(spark, tmp_path):
    dual = {"Licensed under the Apache License, Version 2.0. Released under the MIT License.": "apache,mit",
            "SPDX-License-Identifier: MIT OR Apache-2.0": "apache,mit"}
    rows = [(700 + i, f"{prose(i, 60)}\n\n{n}\n{prose(i + 9, 60)}", "en", "a", 0) for i, n in enumerate(WRAPPED)]
    rows += [(800 + i, f"{prose(i, 30)}\n{n}", "en", "a", 0) for i, n in enumerate(dual)]
    rows += [(900, "\n\n".join(WRAPPED), "en", "a", 0)]
    got = {r.doc_id: r for r in queries.op10_licence_paragraphs(spark, saved(tmp_path, documents=documents(spark, rows))).collect()}
    # of the third notice the second line is one by itself
    assert [got[700 + i].notices for i in range(len(WRAPPED))] == ["2:mit", "2:bsd", "3:gpl", "2:agpl"]
    assert [got[800 + i].families for i in range(len(dual))] == list(dual.values())
    assert got[900].families == ",".join(sorted(WRAPPED.values()))


def test_op10_without_rows(spark, tmp_path):
    assert queries.op10_licence_paragraphs(spark, saved(tmp_path, documents=documents(spark, []))).count() == 0


def test_weights_are_sparse():
    model = lp.fit([prose(i, 20).encode().split() for i in range(50)])
    assert (model.weights[:-1] != 0).mean() < 0.2
