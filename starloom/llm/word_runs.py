"""Periodic runs of words by suffix trees: Lyndon roots as candidates, extended both ways.

A run is a maximal stretch of consecutive words with smallest period q and at least
max(`LEAST`, `TIMES` q) words. Every run contains a Lyndon word of q words that is the longest one
starting at its place, in the order of the words or in the reverse order. These come from the next
smaller and next greater suffix; how far such a root repeats to both sides is the longest common
prefix of two suffixes of the document and of two of its reversal. Both are trees built by
Ukkonen's algorithm; an Euler tour, kept as the least depth between neighbouring leaves, and a table
of minima over powers of two answer each question in constant time.

All `GRAM` words running that lie in a run occur in it at least twice, a period apart, so a run lies
where these grams come again. Words elsewhere enter neither tree: the document's other stretches
are joined with separators that equal nothing. That loses no run and leaves out most prose.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from starloom.llm.texts import BLANK_RUN, mix64, pieces, utf8

LEAST, TIMES, GRAM = 6, 4, 5


def suffix_tree(symbols: list[int]) -> tuple[list, list, list]:
    """Ukkonen's tree of a sequence whose last symbol occurs once: first places, ends and children of the nodes.

    A leaf has no children and ends at the sequence's end; node 0 is the root.
    """
    size = len(symbols)
    first, end, child, link = [0], [0], [{}], [0]
    node = edge = length = waiting = 0
    for at, symbol in enumerate(symbols):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                edge = at
            below = child[node].get(symbols[edge])
            if below is None:
                child[node][symbols[edge]] = len(first)
                first.append(at)
                end.append(size)
                child.append(None)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                start = first[below]
                span = end[below] - start
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if symbols[start + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                middle = len(first)
                child[node][symbols[edge]] = middle
                first += (start, at)
                end += (start + length, size)
                child += ({symbols[start + length]: below, symbol: middle + 1}, None)
                link += (0, 0)
                first[below] = start + length
                if unlinked:
                    link[unlinked] = middle
                unlinked = middle
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = at - waiting + 1
    return first, end, child


class CommonPrefixes:
    """Ranks of all suffixes, and the longest common prefixes of pairs of them in constant time each."""

    def __init__(self, symbols: list[int]):
        size = len(symbols)
        first, end, child = suffix_tree(symbols)
        order, least = [], []
        todo, low = [(0, 0, 0)], 0
        while todo:
            node, above, branch = todo.pop()
            if branch:  # the tour comes back to a node at this depth before it goes on
                low = above
            inner = child[node]
            if inner is None:
                order.append(size - (above + size - first[node]))
                least.append(low)
                continue
            depth = above + end[node] - first[node]
            children = sorted(inner.items(), reverse=True)
            todo += [(n, depth, 1) for _, n in children]
            todo[-1] = (children[-1][1], depth, 0)
        self.rank = np.empty(size, np.int32)
        self.rank[order] = np.arange(size, dtype=np.int32)
        self.minima = [np.array(least, np.int32)]
        step = 1
        while 2 * step <= size:
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at a and b, which differ."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << int(k)) + 1])
        return out


def _next_below(values: list[int]) -> list[int]:
    """For every place the next one with a smaller value; the length where there is none."""
    out, open_ = [len(values)] * len(values), []
    for at, value in enumerate(values):
        while open_ and values[open_[-1]] > value:
            out[open_.pop()] = at
        open_.append(at)
    return out


def _stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stretches of words whose grams all occur again."""
    n = len(ids) - GRAM + 1
    if n < LEAST - GRAM + 1:
        return []
    grams = np.zeros(n, np.uint64)
    for k in range(GRAM):
        grams = mix64(grams ^ ids[k:n + k])
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(n + 2, np.int8)
    again[order[1:][same] + 1] = 1
    again[order[:-1][same] + 1] = 1
    turns = np.flatnonzero(np.diff(again))
    return [(a, b + GRAM - 1) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()) if b - a > LEAST - GRAM]


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.uint64, len(words))
    stretches = _stretches(ids)
    if not stretches:
        return []
    symbols, places = [], []
    for n, (a, b) in enumerate(stretches):
        symbols += [*ids[a:b].tolist(), -1 - n]
        places += range(a, b + 1)
    size = len(symbols)
    ahead = CommonPrefixes(symbols)
    ranks = ahead.rank.tolist()
    # the reversal, closed by a symbol of its own; its suffix at size - i reads what lies before place i
    behind = CommonPrefixes(symbols[::-1] + [-1 - len(stretches)])
    lyndon = np.array([_next_below(ranks), _next_below([-r for r in ranks])], np.int64)
    at = np.tile(np.arange(size), 2)
    then = lyndon.ravel()
    inside = then < size
    at, then = at[inside], then[inside]
    period = then - at
    right = ahead.of(at, then)
    left = behind.of(size - at, size - then)
    length = left + period + right
    held = length >= np.maximum(LEAST, TIMES * period)
    start = np.array(places)[(at - left)[held]]
    return sorted(set(zip(start.tolist(), length[held].tolist(), period[held].tolist())), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run contains after its first period."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        start, length, period = np.array(runs).T
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        words = compress(words, (np.cumsum(edge[:-1]) == 0).tolist())
    return b" ".join(words)


def word_runs(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """`carry`, n_words, runs (start, length, period; by start, then period) and the collapsed text.

    Every row is read by itself, whole and without a shuffle; memory grows with the longest text. A
    null text is empty; a text without words has no runs and collapses to the empty text. Repeated
    rows and rows without an id are kept as they are.
    """
    run = StructType().add("start", "long").add("length", "long").add("period", "long")
    fields = docs.select(F.struct(*carry).alias("row")).schema
    schema = StructType(list(fields)).add("n_words", "long").add("runs", ArrayType(run)).add("collapsed", "string")
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in run.names]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            sizes, found, texts = [], [], []
            for value in utf8(batch.column(1)):
                words = value.split()
                runs = find_runs(words)
                sizes.append(len(words))
                found.append([dict(zip(run.names, r)) for r in runs])
                texts.append(collapsed(words, runs).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(texts, pa.string())], schema.names)

    named = docs.select(F.struct(*carry).alias("row"), F.col(text).alias("text"))
    return named.mapInArrow(read, schema).select("row.*", "n_words", "runs", "collapsed")


def repeated_tails(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents, every tenth one (by the crc32 of its doc_id) ending in a repeated passage.

    A null id counts as the empty text.
    """
    words = F.filter(F.split(text, BLANK_RUN), lambda w: w != "")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def tailed(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        times = F.ceil((n - a) / p)
        part = F.slice(w, (a + 1).cast("int"), p.cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(part, times.cast("int"))), F.lit(1), (n - a).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")).otherwise(F.lit(""))

    # the one-element array names the words, which the expression reads several times
    edited = F.get(F.transform(F.array(words), tailed), F.lit(0))
    return docs.withColumn(text, F.when(h % 10 == 0, edited).otherwise(F.col(text)))


def digests(runs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length over period, and digests of all runs and of the collapsed text.

    Exponents are compared by cross products, exactly; the smallest start and then period wins a tie.
    """
    best = F.reduce(
        F.col("runs"), F.get("runs", F.lit(0)),
        lambda kept, r: F.when(r["length"] * kept["period"] > kept["length"] * r["period"], r).otherwise(kept))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = runs.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words",
    )
