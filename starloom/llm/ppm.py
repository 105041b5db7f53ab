"""Language-model scores by prediction by partial matching over bytes, beside a unigram word score.

The byte model is a trie of contexts of up to `ORDER` bytes with the counts of what follows, learnt
from all training texts. A symbol is predicted from the longest context; where it was never seen
there, the model escapes to the next shorter one with the probability d / (n + d) (n symbols seen, d
of them distinct) and excludes the symbols it has just ruled out, down to an even choice among the
bytes that were never seen at all. Byte 255, which UTF-8 never uses, stands before the start and at
the end of a text. No count is dropped: the trie is a written table of all strings. What a symbol costs
depends on it and its context alone, so at most 2 ** NODE_BITS frequent strings of full length reach
every task with their logarithms; the other strings of the documents, and those that were never seen
in training, are counted per document and meet the table in joins.

The word score needs the count of every word. Words are counted per task and summed by Spark. The
`HEAD` most frequent ones reach every task; the others, none of which can be frequent, meet the
documents that hold them in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import pieces, remainder, utf8
from starloom.session import materialise, prepare

ORDER = 4
NODE_BITS = 20
HEAD = 1 << 17
BLOCK = 1 << 20
FLUSH_WORDS = 200_000
FLUSH_CODES = 1 << 22
_EDGES = b"\xff" * ORDER
_DEPTH = 40  # bits of a string in a node's number; its length stands above them
_STATS = ("seen", "kinds", "x_seen", "x_kinds")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def codes(text: bytes) -> Iterator[np.ndarray]:
    """`ORDER` bytes of context and the symbol after them as one number, for every byte and the end, in blocks."""
    whole = _EDGES + text + b"\xff"
    for start in range(0, len(whole) - ORDER, BLOCK):
        a = np.frombuffer(whole, np.uint8, min(BLOCK + ORDER, len(whole) - start), start).astype(np.int64)
        code = a[: len(a) - ORDER]
        for i in range(1, ORDER + 1):
            code = code << 8 | a[i: len(a) - ORDER + i]
        yield code


class _Places:
    """Where each of some distinct numbers stands, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(int(2 * len(keys)).bit_length(), 4)
        self.keys, self.at = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]  # of several the last one stays
            placed = self.keys[slot] == keys[left]
            self.at[slot[placed]] = left[placed]
            left, slot = left[~placed], (slot[~placed] + 1) & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the numbers, -1 for those that are not there."""
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.at[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.keys[slot] >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & (1 << self.bits) - 1
            held = self.keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self.at[slot[hit]]
            go = ~hit & (held >= 0)
            open_, slot = open_[go], slot[go]
        return out


class Trie:
    """The model in one process: per context length the nodes, and per context what an escape from it leads to.

    `trie_table` and `unseen_logs` give the same numbers from tables of any size.
    """

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]]):
        """`nodes[k]`: the strings of k + 1 bytes, as sorted numbers, and their counts."""
        self.levels, upper = [], None
        for keys, counts in nodes:
            contexts, first = np.unique(keys >> 8, return_index=True)
            counts = counts.astype(np.float64)
            distinct = np.diff(np.append(first, len(keys))).astype(np.float64)
            seen = np.add.reduceat(counts, first) if len(keys) else np.zeros(0)
            owner = np.searchsorted(contexts, keys >> 8)
            norm = np.log10(seen + distinct)
            level = {"keys": keys, "logs": np.log10(counts), "own": np.log10(counts) - norm[owner], "contexts": contexts,
                     "escape": np.log10(distinct) - norm, "x_norm": np.zeros(len(contexts)), "x_escape": np.zeros(len(contexts))}
            if upper is not None and len(keys):
                # the shorter context without its symbols that follow the longer one
                short_keys, short_counts, short_contexts, short_seen, short_distinct = upper
                mask = (1 << 8 * len(self.levels)) - 1
                again = np.searchsorted(short_keys, keys & mask)
                out = np.add.reduceat(short_counts[again], first)
                at = np.searchsorted(short_contexts, (contexts & mask >> 8))
                left, kinds = short_seen[at] - out, short_distinct[at] - distinct
                some = kinds > 0
                level["x_norm"][some] = np.log10(left[some] + kinds[some])
                level["x_escape"][some] = np.log10(kinds[some]) - level["x_norm"][some]
            upper = (keys, counts, contexts, seen, distinct)
            self.levels.append(level)
        self.fresh = -float(np.log10(max(256 - len(nodes[0][0]), 1)))
        self.places = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"places": None}

    def logs(self, code: np.ndarray) -> np.ndarray:
        """log10 of the probability of each symbol after its context."""
        if self.places is None:
            self.places = [(_Places(level["keys"]), _Places(level["contexts"])) for level in self.levels]
        total = np.zeros(len(code))
        left = np.arange(len(code))
        excluded = np.zeros(len(code), bool)
        x_norm, x_escape = np.zeros(len(code)), np.zeros(len(code))
        for k in reversed(range(len(self.levels))):
            level, (nodes, contexts) = self.levels[k], self.places[k]
            key = code[left] & (1 << 8 * (k + 1)) - 1
            node = nodes.find(key)
            hit = node >= 0
            at, place = left[hit], node[hit]
            total[at] += np.where(excluded[hit], level["logs"][place] - x_norm[hit], level["own"][place])
            left, key, excluded, x_escape = left[~hit], key[~hit], excluded[~hit], x_escape[~hit]
            if not len(left):
                return total
            context = contexts.find(key >> 8)
            known = context >= 0
            own = np.zeros(len(left))
            own[known] = level["escape"][context[known]]
            total[left] += np.where(excluded, x_escape, own)
            x_norm, x_escape = np.zeros(len(left)), np.zeros(len(left))
            x_norm[known], x_escape[known] = level["x_norm"][context[known]], level["x_escape"][context[known]]
            excluded = known
        total[left] += self.fresh
        return total

    def score(self, text: bytes) -> float:
        return float(sum(self.logs(block).sum() for block in codes(text)))


def counted(texts: DataFrame) -> DataFrame:
    """Partial counts (word, code, n) of the texts: of each word, or, where word is null, of each code.

    The code -1 counts the texts. A task holds `FLUSH_WORDS` words and `FLUSH_CODES` codes at most
    (and those of one text).
    """
    schema = pa.schema([("word", pa.binary()), ("code", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        waiting, held, texts_seen = [], 0, 0

        def word_rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(words.values(), pa.int64())],
                schema=schema)

        def code_rows() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(found), pa.binary()), pa.array(found), pa.array(n, pa.int64())], schema=schema)

        for batch in pieces(batches):
            for text in utf8(batch.column(0)):
                text = text.lower()
                texts_seen += 1
                words.update(text.split())
                for block in codes(text):
                    waiting.append(block)
                    held += len(block)
                    if held >= FLUSH_CODES:
                        yield code_rows()
                        waiting, held = [], 0
                if len(words) >= FLUSH_WORDS:
                    yield word_rows()
                    words.clear()
        if words:
            yield word_rows()
        if waiting:
            yield code_rows()
        if texts_seen:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.binary()), pa.array([-1], pa.int64()), pa.array([texts_seen], pa.int64())], schema=schema)

    return texts.mapInArrow(run, "word binary, code bigint, n bigint")


def learn(texts: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The words' counts (word, c), the strings' counts (code, n), and the number of texts."""
    partial = materialise(counted(texts))
    words = materialise(partial.filter("word is not null").groupBy("word").agg(F.sum("n").alias("c")))
    strings = materialise(partial.filter("word is null").groupBy("code").agg(F.sum("n").alias("n")))
    seen = strings.filter("code < 0").agg(F.sum("n").alias("texts")).first()
    return words, strings.filter("code >= 0"), int(seen.texts or 0)


def _node(depth: int, key: Column) -> Column:
    """One number for a string of `depth` bytes, the last ones of `key`."""
    return key.bitwiseAND(F.lit((1 << 8 * depth) - 1)).bitwiseOR(F.lit(depth << _DEPTH))


def trie_table(strings: DataFrame) -> DataFrame:
    """The trie, a row per string of up to ORDER + 1 bytes: node, n, seen, kinds, x_seen, x_kinds.

    `n` counts the string. As a context it was followed by `seen` symbols, `kinds` of them distinct;
    the shorter context without those has `x_seen` and `x_kinds`. Each is null where the string never
    stood so. No join has more than 256 rows a key on either side.
    """
    all_depths = F.array(*[_node(d, F.col("code")) for d in range(1, ORDER + 2)])
    counts = materialise(strings.select(F.explode(all_depths).alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n")))

    def cut(column: str) -> Column:  # the string without its first byte
        return F.expr(f"shiftleft(cast(shiftright({column}, {_DEPTH}) - 1 as bigint), {_DEPTH}) | "
                      f"({column} & (shiftleft(1L, cast(8 * (shiftright({column}, {_DEPTH}) - 1) as int)) - 1))")

    owner = F.expr(f"shiftleft(cast(shiftright(node, {_DEPTH}) - 1 as bigint), {_DEPTH}) | "
                   f"shiftright(node & {(1 << _DEPTH) - 1}L, 8)")
    short = counts.select(F.col("node").alias("short"), F.col("n").alias("short_n"))
    contexts = materialise(
        counts.select(owner.alias("context"), cut("node").alias("short"), "n").join(short, "short", "left")
        .groupBy("context").agg(F.sum("n").alias("seen"), F.count(F.lit(1)).alias("kinds"), F.sum("short_n").alias("again")))
    shorter = contexts.select(F.col("context").alias("short"), F.col("seen").alias("short_seen"), F.col("kinds").alias("short_kinds"))
    # the empty context has no shorter one
    inner = contexts.withColumn("short", F.when(F.col("context") > 0, cut("context"))).join(shorter, "short", "left")
    blank = F.lit(None).cast("bigint")
    rows = counts.select("node", "n", *[blank.alias(c) for c in _STATS]).unionByName(inner.select(
        F.col("context").alias("node"), blank.alias("n"), "seen", "kinds", (F.col("short_seen") - F.col("again")).alias("x_seen"),
        (F.col("short_kinds") - F.col("kinds")).alias("x_kinds")))
    return materialise(rows.groupBy("node").agg(*[F.max(c).alias(c) for c in ("n", *_STATS)]))


def seen_logs(trie: DataFrame) -> DataFrame:
    """(code, n, log) of every string of full length: log10 of its last symbol's probability."""
    whole = trie.filter(F.shiftright("node", _DEPTH) == ORDER + 1).select(
        F.col("node").bitwiseAND(F.lit((1 << _DEPTH) - 1)).alias("code"), "n")
    contexts = trie.filter((F.shiftright("node", _DEPTH) == ORDER) & F.col("seen").isNotNull()).select(
        F.col("node").alias("context"), "seen", "kinds")
    return whole.withColumn("context", _node(ORDER, F.shiftright("code", 8))).join(contexts, "context").select(
        "code", "n", (F.log10("n") - F.log10(F.col("seen") + F.col("kinds"))).alias("log"))


def unseen_logs(found: DataFrame, trie: DataFrame) -> DataFrame:
    """(code, log) of distinct codes that are not in the trie at full length.

    Strings of up to two bytes are at most 65,793 rows and are broadcast.
    """
    root = trie.filter("node = 0").first()
    fresh = F.lit(-float(np.log10(max(256 - (root.kinds if root else 0), 1))))
    for depth in range(1, ORDER + 1):
        part = trie.filter(F.shiftright("node", _DEPTH) == depth)
        symbol = part.filter("n is not null").select(F.col("node").alias("at"), F.col("n").alias(f"n{depth}"))
        context = part.filter("seen is not null").select(F.col("node").alias("at"), *[F.col(c).alias(f"{c}{depth}") for c in _STATS])
        for side, key in ((symbol, F.col("code")), (context, F.shiftright("code", 8))):
            side = F.broadcast(side) if depth <= 2 else side
            found = found.withColumn("at", _node(depth, key)).join(side, "at", "left").drop("at")
    if root:
        found = found.withColumns({f"{c}0": F.lit(root[c]).cast("bigint") for c in _STATS})
    else:
        found = found.withColumns({f"{c}0": F.lit(None).cast("bigint") for c in _STATS})
    # `plain`: the symbol's log after the context of k bytes; `rest`: what follows an escape from it
    plain = rest = None
    for k in range(ORDER + 1):
        seen, kinds = F.col(f"seen{k}"), F.col(f"kinds{k}")
        known, norm = seen.isNotNull(), F.log10(seen + kinds)
        if k == 0:
            rest = fresh
        else:
            x_norm = F.log10(F.col(f"x_seen{k}") + F.col(f"x_kinds{k}"))
            hit = F.col(f"n{k}").isNotNull()
            escaped = F.when(F.col(f"x_kinds{k}") > 0, F.log10(f"x_kinds{k}") - x_norm).otherwise(0.0) + rest
            rest = F.when(known, F.when(hit, F.log10(f"n{k}") - x_norm).otherwise(escaped)).otherwise(plain)
        missed = F.when(known, F.log10(kinds) - norm).otherwise(0.0) + rest
        n = F.col(f"n{k + 1}") if k < ORDER else F.lit(None).cast("bigint")
        plain = F.when(n.isNotNull(), F.log10(n) - norm).otherwise(missed)
        found = found.withColumns({f"plain{k}": plain, f"rest{k}": rest})
        plain, rest = F.col(f"plain{k}"), F.col(f"rest{k}")
    return found.select("code", plain.alias("log"))


def frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows from some count on, at most `most` of them.

    The count is found among steps of 4 % by a histogram of at most some thousand rows, so that the
    driver gets no more than the rows chosen.
    """
    step = F.floor(F.log2(F.col(column).cast("double")) * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    ends = np.cumsum([r.n for r in sizes])
    chosen = [r.step for r, end in zip(sizes, ends) if end <= most]
    return counts.filter(step >= chosen[-1] if chosen else F.lit(False))


def most_frequent(words: DataFrame, most: int) -> dict[bytes, int]:
    """The words that `frequent` chooses and their counts."""
    found = frequent(words, "c", most).toPandas()
    return {bytes(w): int(c) for w, c in zip(found["word"], found["c"])}


def scored(docs: DataFrame, training, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte per row of `docs`.

    `training` is the condition on `docs` that picks the training rows. A null text is empty and has
    one token, its end. Without training rows every byte is equally likely and no word is known.
    Repeated rows count as often in training and are scored alike; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    words, strings, texts = learn(docs.filter(training).select(text))
    trie = trie_table(strings)
    costs = materialise(seen_logs(trie))
    total = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    tokens, distinct = total.n + texts, total.v + (texts > 0)
    head = most_frequent(words, HEAD)
    near = frequent(costs, "n", 1 << NODE_BITS).toArrow()
    near = near["code"].to_numpy(), near["log"].to_numpy()
    shared = spark.sparkContext.broadcast((head, *near))  # HEAD words and 2 ** NODE_BITS strings at most
    whole = len(head) == total.v  # then no other word is known either

    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("word", pa.binary()), ("code", pa.int64()), ("k", pa.int64()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, near, costs = shared.value
        logs, places = {w: (c, float(np.log10(c + 1))) for w, c in head.items()}, _Places(near)

        def at_hand(text: bytes) -> tuple[float, np.ndarray, np.ndarray]:
            """The sum over the strings at hand, and the other strings with their counts."""
            total, others = 0.0, []
            for block in codes(text):
                at = places.find(block)
                there = at >= 0
                total += float(costs[at[there]].sum())
                if not there.all():
                    others.append(block[~there])
            return total, *np.unique(np.concatenate(others or [np.empty(0, np.int64)]), return_counts=True)

        for batch in pieces(batches):
            keys, ids, rows, tails = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], []
            for key, id_, text_ in zip(keys, ids, utf8(batch.column(2))):
                lowered = text_.lower()
                found = Counter(lowered.split())
                known, sum_, n = int(texts > 0), float(np.log10(texts + 1)), 1
                for word, k in found.items():
                    n += k
                    entry = logs.get(word)
                    if entry:
                        known += k
                        sum_ += k * entry[1]
                    elif not whole:
                        tails.append((key, id_, word, None, k))
                near_score, others, counts = at_hand(lowered)
                tails += [(key, id_, None, code, k) for code, k in zip(others.tolist(), counts.tolist())]
                rows.append((key, id_, n, known, sum_, near_score, len(lowered)))
            key, id_, n, known, sum_, score, size = zip(*rows)
            m = len(tails)
            tail = list(zip(*tails)) or [(), (), (), (), ()]
            blank = [None] * m
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(
                    (key + tail[0], id_ + tail[1], *[[None] * len(key) + list(tail[i]) for i in (2, 3)], [0] * len(key) + list(tail[4]),
                     list(n) + blank, list(known) + blank, list(sum_) + blank, list(score) + blank, list(size) + blank), schema)],
                schema=schema)

    columns = ("key bigint, id bigint, word binary, code bigint, k bigint, n_tokens bigint, n_known bigint, logs double, score double, "
               "n_bytes bigint")
    row_key = F.xxhash64(id_col, text)
    kind = docs.schema[id_col].dataType
    found = materialise(docs.select(row_key.alias("key"), F.col(id_col).cast("bigint").alias("id"), F.col(text)).mapInArrow(run, columns))
    rows = found.filter("n_bytes is not null").withColumn("id0", F.coalesce("id", F.lit(0))).drop("word", "code", "k")
    tail = found.filter("word is not null").select("key", F.coalesce("id", F.lit(0)).alias("id0"), "word", "k")
    met = tail.join(words, "word").groupBy("key", "id0").agg(
        F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more_logs"))
    # equal rows have equal keys: their tails were summed over all of them
    copies = rows.groupBy("key", "id0").agg(F.count(F.lit(1)).alias("copies"))
    others = found.filter("code is not null").select("key", F.coalesce("id", F.lit(0)).alias("id0"), "code", "k")
    asked = materialise(others.select("code").distinct().join(costs.select("code", "log"), "code", "left"))
    asked_logs = materialise(asked.filter("log is not null").unionByName(
        unseen_logs(asked.filter("log is null").select("code"), trie)))
    met_codes = others.join(asked_logs, "code").groupBy("key", "id0").agg(F.sum(F.col("k") * F.col("log")).alias("more_score"))
    met = met.join(met_codes, ["key", "id0"], "full").join(copies, ["key", "id0"])
    out = rows.join(met, ["key", "id0"], "left")
    more = F.coalesce(F.col("more") / F.col("copies"), F.lit(0.0))
    more_logs = F.coalesce(F.col("more_logs") / F.col("copies"), F.lit(0.0))
    score = F.col("score") + F.coalesce(F.col("more_score") / F.col("copies"), F.lit(0.0))
    return out.select(
        F.col("id").cast(kind).alias("doc_id"), "n_tokens", (F.col("n_known") + more.cast("bigint")).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more_logs - F.col("n_tokens") * float(np.log10(tokens + distinct + 1))).alias("base_score"),
        score.alias("score"), (-score / float(np.log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def corpus_scores(docs: DataFrame) -> DataFrame:
    """`scored` with the fixed split: rows whose remainder modulo 7 is 2 are held out of training."""
    held = remainder("doc_id", 7) == 2
    return scored(docs, ~held).withColumn("held_out", held)
