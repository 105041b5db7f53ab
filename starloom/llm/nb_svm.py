"""Quality classifier: naive Bayes support vectors over the n-grams of a text's bytes.

Features are indicators of byte n-grams of one to three bytes (the longest ones hashed), and of
8-grams over the words once each word is replaced by whether it repeats the one before. Each is
scaled by the log ratio of its smoothed shares in the two classes, counted over all labelled
training rows. A linear hinge-loss model on the scaled indicators is fitted by dual coordinate
descent on a bounded sample of those rows: the `SAMPLE` of least id hash in each class. Its margin
becomes a probability by a logistic curve fitted on margins of sample rows that the model of the
other half of the sample gives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import pieces, remainder, utf8
from starloom.session import prepare

HASH_BITS = 17
PAIRS = 256
TRIPLES = PAIRS + (1 << 16)
DITTO = 8
DITTOS = TRIPLES + (1 << HASH_BITS)
SIZE = DITTOS + (1 << DITTO)
SAMPLE = 3000
SMOOTH = 1.0
C = 10.0
EPOCHS = 30
MIX = 0.25
KEEP_AT = 0.7
BLOCK = 1 << 20


def indicators(text: bytes, scratch: np.ndarray) -> np.ndarray:
    """Sorted numbers of the n-grams that occur; `scratch` is a cleared boolean array of `SIZE`.

    Bytes are read in overlapping blocks, so that their n-grams take bounded memory.
    """
    for start in range(0, len(text), BLOCK):
        a = np.frombuffer(text, np.uint8, min(BLOCK + 2, len(text) - start), start).astype(np.uint32)
        scratch[a] = True
        pair = a[:-1] << 8 | a[1:]
        scratch[pair + np.uint32(PAIRS)] = True
        triple = (pair[:-1] << 8 | a[2:]) * np.uint32(2654435761) >> np.uint32(32 - HASH_BITS)
        scratch[triple + np.uint32(TRIPLES)] = True
    words = text.split()
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), np.uint8, max(len(words) - 1, 0))
    if len(same) >= DITTO:
        windows = np.lib.stride_tricks.sliding_window_view(same, DITTO)
        scratch[DITTOS + np.unique(np.packbits(windows, axis=1)[:, 0]).astype(np.int64)] = True
    return scratch


def _present(texts: list[bytes]) -> Iterator[np.ndarray]:
    scratch = np.zeros(SIZE, bool)
    for text in texts:
        found = np.flatnonzero(indicators(text, scratch)).astype(np.int32)
        scratch[found] = False
        yield found


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per class and n-gram the rows (text, label) that hold it, and the rows of each class.

    Each task adds up its rows; at most one row per n-gram and task is shuffled, and at most one per
    n-gram reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, totals = np.zeros((2, SIZE), np.int64), np.zeros(2, np.int64)
        for batch in pieces(batches):
            labels = batch.column("label").to_pylist()
            for label, found in zip(labels, _present(utf8(batch.column("text")))):
                sums[label, found] += 1
                totals[label] += 1
        seen = np.flatnonzero(sums.any(0))
        gram = np.concatenate([seen, [-1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64())] + [pa.array(np.append(sums[k, seen], totals[k]), pa.int64()) for k in (0, 1)],
            ["gram", "n0", "n1"])

    found = rows.select("text", "label").mapInArrow(run, "gram bigint, n0 bigint, n1 bigint")
    summed = found.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts, totals = np.zeros((2, SIZE)), np.zeros(2)
    grams, values = summed["gram"].to_numpy(np.int64), summed[["n0", "n1"]].to_numpy(np.float64)
    counts[:, grams[grams >= 0]] = values[grams >= 0].T
    if (grams < 0).any():
        totals = values[grams < 0][0]
    return counts, totals


def scaled(grams: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A text's indicators times the ratios, as a vector of length 1, so that short texts count alike."""
    v = scale[grams]
    return v / max(float(np.sqrt(v @ v)), 1e-9)


def descend(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model, by dual coordinate descent.

    A row's dual variable stays between 0 and its cost; each step solves for one of them exactly
    while the weights follow. Rows have length 1 and the bias is one more feature, hence the 2. Rows are visited in a new random order each epoch, until no projected
    gradient exceeds 0.01 or after `EPOCHS` epochs.
    """
    w, bias = np.zeros(SIZE), 0.0
    dual = np.zeros(len(rows))
    values = [scaled(r, scale) for r in rows]
    draw = np.random.RandomState(seed)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            r, v, y = rows[i], values[i], signs[i]
            slope = y * (float(w[r] @ v) + bias) - 1
            if (slope > 0 and dual[i] == 0) or (slope < 0 and dual[i] == cost[i]):
                continue
            worst = max(worst, abs(slope))
            step = min(max(dual[i] - slope / 2, 0.0), cost[i]) - dual[i]
            if step:
                dual[i] += step
                w[r] += step * y * v
                bias += step * y
        if worst < 0.01:
            break
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by damped Newton steps."""
    hits = labels.sum()
    goal = np.where(labels == 1, (hits + 1) / (hits + 2), 1 / (len(labels) - hits + 2))
    slope, shift = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ [slope, shift], -30, 30)))
        pull = x.T @ (p - goal)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        slope, shift = np.array([slope, shift]) - np.linalg.solve(curve, pull)
    return max(float(slope), 1e-3), float(shift)


@dataclass
class Model:
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        margins = np.array([self.weights[g] @ scaled(g, self.scale) + self.bias for g in _present(texts)])
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def train(docs: DataFrame, known: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the rows of `docs` (id, text) with labels 0 or 1 in `known` (id, label).

    The texts are shuffled once, for the counts over all labelled rows; the sample's ids go to the
    texts. Without rows of both classes every score is 0.5 or that of the only label.
    """
    counts, totals = class_counts(docs.join(known.hint("merge"), "id"))
    if not totals.all():
        sure = 0.0 if not totals.any() else 30.0 if totals[1] else -30.0
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, 1.0, sure)
    shares = (counts + SMOOTH) / (totals[:, None] + 2 * SMOOTH)
    ratio = np.log(shares[1] / shares[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [f.tobytes() for f in _present(utf8(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.binary())], ["label", "grams"])

    least = [known.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(sample) for k in (0, 1)]
    chosen = least[0].unionByName(least[1])
    picked = docs.join(F.broadcast(chosen), "id").select("text", "label").mapInArrow(run, "label int, grams binary")
    found = sorted(picked.collect(), key=lambda r: (bytes(r.grams), r.label))
    labels = np.array([r.label for r in found])
    grams = [np.frombuffer(r.grams, np.int32) for r in found]
    signs = 2 * labels - 1
    cost = C * len(labels) / (2 * np.where(labels == 1, labels.sum(), (1 - labels).sum()).clip(1))

    def fitted(part: np.ndarray) -> tuple[np.ndarray, float]:
        w, bias = descend([grams[i] for i in part], signs[part], ratio, cost[part])
        # the hinge weights are drawn part of the way to their mean size, as usual for this model
        mean = np.abs(w).sum() / max(np.count_nonzero(w), 1)
        return (1 - MIX) * w + MIX * mean * np.sign(w), bias

    halves = np.arange(len(found)) % 2
    margins = np.zeros(len(found))
    for half in (0, 1):
        w, bias = fitted(np.flatnonzero(halves != half))
        for i in np.flatnonzero(halves == half):
            margins[i] = w[grams[i]] @ scaled(grams[i], ratio) + bias
    slope, shift = logistic(margins, labels)
    # the sample holds as many rows of either class; the curve is moved to the classes' true odds
    shift += np.log(totals[1] / totals[0]) - np.log(max(labels.sum(), 1) / max(len(labels) - labels.sum(), 1))
    w, bias = fitted(np.arange(len(found)))
    return Model(ratio, w, bias, slope, float(shift))


def training_labels(labels: DataFrame) -> DataFrame:
    """(id, label): labels of 0 or 1 outside the held-out remainder.

    A row without an id, or a label without a document, is no training row; a document that is
    labelled twice counts twice.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    return known.filter("id is not null and label in (0, 1)").filter(remainder("id", 4) != 2)


def scored(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """`carry`, `score` and `predicted` per row of `docs`; a null text is empty."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # `SIZE` weights, whatever the input
    schema = docs.select(carry).schema.add("score", "double")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = shared.value.scores(utf8(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(carry))] + [pa.array(scores, pa.float64())], names)

    found = docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)
    return found.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of `docs`, learnt from the rows that are not held out."""
    prepare(docs.sparkSession)
    model = train(docs.select(F.col("doc_id").alias("id"), "text"), training_labels(labels))
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
