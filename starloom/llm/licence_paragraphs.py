"""Licence notices: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line with a word; a longer line is read in overlapping windows of `SPAN` words.
Words are lower-cased runs of letters and digits, each digit read as 0, so versions do not matter.
Features are the word n-grams of one to three words that occur in the templates and are not made of
stop words alone. A multinomial logistic regression with an L1 penalty, which leaves most weights at
zero, tells the licence families and the class `unknown` apart. It is fitted on variants of the
templates, on fragments and shuffles of them (unknown), and on a bounded sample of corpus paragraphs
(unknown): the lines of the `SAMPLE` documents of least id hash that look like no template. Its
probabilities are calibrated by one temperature on variants that were not fitted. A family is
accepted from `ACCEPT`, and confirmed if a template of that family has at least `CONFIRM` of its word
pairs in the paragraph; what is accepted and not confirmed is counted apart. A paragraph may give
further families: those it tells from `unknown` as surely and confirms, if it has a template pair of
theirs that no family found before has. Lines that follow each other without a blank line are read
once more as one paragraph, so that a notice broken over lines is found too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import pieces, utf8
from starloom.session import prepare

SPAN = 80
ACCEPT = 0.9
CONFIRM = 0.6
SAMPLE = 500
SAMPLE_LINES = 40
VARIANTS = 24
PENALTY = 2e-4

# Usual short notices of the families.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation.",
    ),
    "apache": (
        "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright (c) 2020. All rights reserved. No part of this work may be reproduced without written permission.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl": (
        "GNU General Public License, version 3",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "isc": ("Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "mit": (
        "The MIT License",
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ),
}
STOP = frozenset(b"a an and are as be by can for from has have in is it no not of on or part the this to under use you with".split())
OPENINGS = ("Licensed", "Released", "Distributed", "Published", "This work is licensed", "This file is licensed", "Available")

FAMILIES = ("unknown", *TEMPLATES)
_READ = bytes(
    48 if 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_READ).split()


def grams(found: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(found[i:i + n]) for n in (1, 2, 3) for i in range(len(found) - n + 1)}


@dataclass
class Model:
    features: dict[tuple[bytes, ...], int]
    weights: np.ndarray  # features + 1 (the bias) x families
    temperature: float
    content: frozenset[bytes] = field(default_factory=frozenset)
    pairs: list[list[set[tuple[bytes, ...]]]] = field(default_factory=list)

    def probabilities(self, found: list[bytes]) -> np.ndarray:
        rows = [self.features[g] for g in grams(found) if g in self.features]
        scores = (self.weights[rows].sum(0) + self.weights[-1]) / self.temperature
        p = np.exp(scores - scores.max())
        return p / p.sum()

    def similarity(self, family: int, found: list[bytes]) -> float:
        """The largest share of a template's word pairs that the paragraph has."""
        have = set(zip(found, found[1:]))
        return max((len(t & have) / len(t) for t in self.pairs[family]), default=0.0)

    def judge(self, found: list[bytes]) -> tuple[int, float, float] | None:
        """(family, probability, similarity) of an accepted paragraph.

        Without any content word of the templates there is no feature, and the bias says unknown.
        """
        if self.content.isdisjoint(found):
            return None
        p = self.probabilities(found)
        best = int(p.argmax())
        if best == 0 or p[best] < ACCEPT:
            return None
        return best, float(p[best]), self.similarity(best, found)

    def families(self, found: list[bytes]) -> list[tuple[int, float, set[tuple[bytes, ...]]]]:
        """(family, probability, its template pairs in the paragraph) of each accepted and confirmed family.

        The most probable one comes first. The probability of a further one is against `unknown` alone.
        """
        if self.content.isdisjoint(found):
            return []
        have = set(zip(found, found[1:]))
        matched = {k: max((t & have for t in self.pairs[k] if len(t & have) >= CONFIRM * len(t)), key=len, default=None)
                   for k in range(1, len(FAMILIES))}
        matched = {k: m for k, m in matched.items() if m}
        if not matched:
            return []
        p, listed = self.probabilities(found), []
        taken: set[tuple[bytes, ...]] = set()
        for k in sorted(matched, key=lambda k: (p[k] < ACCEPT, -len(matched[k]), -p[k])):
            sure = float(p[k] if p[k] >= ACCEPT else p[k] / (p[k] + p[0]))
            if sure >= ACCEPT and not matched[k] <= taken:
                listed.append((k, sure, matched[k]))
                taken = taken.union(*self.pairs[k])
        return listed


def _pairs(found: list[bytes]) -> set[tuple[bytes, ...]]:
    return set(zip(found, found[1:])) or {(w,) for w in found}


def _variants(template: str, draw: np.random.RandomState) -> Iterator[list[bytes]]:
    """The template's words with other openings, a few words lost, and stray words around them."""
    plain = words(template.encode())
    yield plain
    for i in range(VARIANTS):
        found = plain
        if re.match(r"Licensed|Released|This work is licensed", template) and i % 2:
            rest = re.sub(r"^(This work is licensed|Licensed|Released)", "", template)
            found = words((OPENINGS[draw.randint(len(OPENINGS))] + rest).encode())
        if len(found) > 4 and i % 3 == 2:
            found = [w for w in found if draw.rand() > 0.1 or w not in STOP]
        stray = [b"x%d" % draw.randint(50) for _ in range(draw.randint(4))]
        yield stray + found + stray[::-1]


def _fragments(template: str, draw: np.random.RandomState) -> Iterator[list[bytes]]:
    """Single words, and short or shuffled parts, which are no notice."""
    plain = words(template.encode())
    for _ in range(6):
        yield [plain[draw.randint(len(plain))], b"x1", plain[draw.randint(len(plain))]]
        if len(plain) > 5:
            yield [plain[i] for i in draw.permutation(len(plain))[: max(len(plain) // 2, 2)]]


def fit(corpus: list[list[bytes]], seed: int = 7, steps: int = 300, rate: float = 4.0) -> Model:
    draw = np.random.RandomState(seed)
    examples: list[tuple[list[bytes], int]] = []
    for k, name in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[name]:
            examples += [(v, k) for v in _variants(template, draw)]
            examples += [(v, 0) for v in _fragments(template, draw)]
    known = sorted({g for k in TEMPLATES.values() for t in k for g in grams(words(t.encode())) if not STOP.issuperset(g)})
    model = Model({g: i for i, g in enumerate(known)}, np.zeros((len(known) + 1, len(FAMILIES))), 1.0)
    model.content = frozenset(w for g in known for w in g if w not in STOP)
    model.pairs = [[]] + [[_pairs(words(t.encode())) for t in TEMPLATES[name]] for name in FAMILIES[1:]]
    templates = [t for family in model.pairs for t in family]
    for line in corpus:
        have = set(zip(line, line[1:]))
        if not any(len(t & have) >= CONFIRM / 2 * len(t) for t in templates):
            examples.append((line, 0))
    x = np.zeros((len(examples), len(known) + 1))
    for row, (found, _) in enumerate(examples):
        x[row, [model.features[g] for g in grams(found) if g in model.features]] = 1
    x[:, -1] = 1
    y = np.array([k for _, k in examples])
    held = np.arange(len(y)) % 5 == 4
    weight = (len(y) / np.bincount(y, minlength=len(FAMILIES)).clip(1))[y] ** 0.5
    weight /= weight[~held].sum()
    gold, fitted = np.eye(len(FAMILIES))[y], x[~held]

    def shares(z: np.ndarray) -> np.ndarray:
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    w, ahead, momentum = model.weights, model.weights.copy(), 1.0
    for _ in range(steps):  # accelerated proximal gradient: a step, then every weight moves towards zero
        slope = fitted.T @ ((shares(fitted @ ahead) - gold[~held]) * weight[~held, None])
        new = ahead - rate * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * PENALTY, 0)
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    model.weights = w
    z, wanted = x[held] @ w, y[held]

    def loss(temperature: float) -> float:
        return -float(np.log(shares(z / temperature)[np.arange(len(wanted)), wanted] + 1e-12).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.5, 5, 60)), key=loss)
    return model


def paragraphs(text: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(line number, words) of every line with a word; a long line gives overlapping windows."""
    for number, line in enumerate(text.split(b"\n")):
        found = words(line)
        if found:
            for start in range(0, max(len(found) - SPAN // 2, 1), SPAN // 2):
                yield number, found[start:start + SPAN]


def blocks(text: bytes) -> Iterator[tuple[list[int], list[bytes]]]:
    """(line number of each word, words) of overlapping windows over lines that follow each other.

    A line without a word ends a block; a block of one line is left out, as `paragraphs` has it.
    """
    numbers: list[int] = []
    found: list[bytes] = []
    for number, line in enumerate([*text.split(b"\n"), b""]):
        more = words(line)
        numbers += [number] * len(more)
        found += more
        if not more:
            if found and numbers[0] < numbers[-1]:
                for start in range(0, max(len(found) - SPAN // 2, 1), SPAN // 2):
                    yield numbers[start:start + SPAN], found[start:start + SPAN]
            numbers, found = [], []


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Model:
    """Fit with up to `SAMPLE_LINES` lines of each of the `SAMPLE` documents of least id hash."""
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    sample = ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lines = [b" ".join(w) for t in utf8(batch.column(0)) for _, w in list(paragraphs(t))[:SAMPLE_LINES]]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["line"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    rows = chosen.select("text").mapInArrow(run, "line binary").collect()
    return fit([line.split() for line in sorted(bytes(r.line) for r in rows)])


def scan(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """Per row of `docs`: `carry`, n_paragraphs, families, notices, n_unconfirmed, least_probability.

    `families` lists the confirmed families, `notices` line:family of each confirmed paragraph, both
    comma-joined and in order, empty if there are none. `least_probability` is that of the least sure
    confirmed notice, else null. A null or empty text has no paragraphs.
    """
    schema = docs.select(carry).schema
    for name, kind in (("n_paragraphs", "long"), ("families", "string"), ("notices", "string"),
                       ("n_unconfirmed", "long"), ("least_probability", "double")):
        schema = schema.add(name, kind)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the templates' n-grams

    def judged(text_: bytes) -> tuple:
        model = shared.value
        lines = sum(1 for line in text_.split(b"\n") if line.strip())
        notices: dict[tuple[int, str], float] = {}
        loose: set[int] = set()
        if not model.content.isdisjoint(words(text_)):
            for number, found in paragraphs(text_):
                for family, sure, _ in model.families(found):
                    key = (number, FAMILIES[family])
                    notices[key] = max(notices.get(key, 0.0), sure)
                result = model.judge(found)
                if result and result[2] < CONFIRM:
                    loose.add(number)
            for numbers, found in blocks(text_):
                for family, sure, pairs in model.families(found):
                    own = [n for n, pair in zip(numbers, zip(found, found[1:])) if pair in pairs and not STOP.issuperset(pair)]
                    if not any(f == FAMILIES[family] and numbers[0] <= n <= numbers[-1] for n, f in notices):
                        notices[own[0] if own else numbers[0], FAMILIES[family]] = sure
                    loose.difference_update(own)
        listed = sorted(notices)
        return (lines, ",".join(sorted({f for _, f in listed})), ",".join(f"{n}:{f}" for n, f in listed),
                len(loose - {n for n, _ in listed}), min(notices.values(), default=None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64()]
        for batch in pieces(batches):
            found = zip(*map(judged, utf8(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(carry))] + [pa.array(c, t) for c, t in zip(found, kinds)], schema.names)

    return docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)


def notices(docs: DataFrame) -> DataFrame:
    """`scan` of the rows with a model trained on them; an empty table gives an empty result."""
    prepare(docs.sparkSession)
    return scan(docs, train(docs), ["doc_id"])
