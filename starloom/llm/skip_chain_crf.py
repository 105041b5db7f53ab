"""Personal data: exact patterns, and a skip-chain conditional random field that adds to them.

Base spans come from the four patterns. The field labels the candidate tokens of a document (blank
separated words with a digit or an @; all other words can only be outside, so they cut the chain).
Neighbouring candidates share a chain potential. Repeated and similar tokens (the same word with an @
or seven digits, numbers with the same last seven or ten digits, addresses with the same name and host)
share a hub, a variable that is tied to each of them by a skip potential, however far apart and
however many they are. Marginals come from loopy message passing over tokens and hubs. Base spans are
certain: their tokens, and the hubs of these, are observed, so one formal mention decides about every
less formal one. A token that the field labels with a probability of at least `CERTAIN`, and that no
base span touches, is an added span.

The field is fitted by pseudo-likelihood on a bounded sample of documents (the `SAMPLE_DOCS` of least
id hash, of them those with at most `SAMPLE_TOKENS` candidates). The base labels of a document teach
what the patterns see. To teach what they do not, each document with base spans comes twice more: with
a second mention written less formally (`informal`), which carries the kind, and with the like of a
stranger that the document does not name, which carries none. Only the hub tells these two apart.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import pieces

# The kinds in the order in which equal starts are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE_DOCS = 8000
SAMPLE_TOKENS = 64
CERTAIN = 0.9
ROUNDS = 200  # ends messages that go round in circles; others settle long before
OBSERVED = 40.0
UNNAMED = 8.0  # odds, as a logarithm, against a kind for a hub that no base span names
LABELS = 1 + len(KINDS)
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|"
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_MARK = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: what precedes it is the longest run of local characters."""
    low, at = 0, text.find("@")
    while at >= 0:
        domain = EMAIL_DOMAIN.match(text, at + 1)
        start = low + len(text[low:at].rstrip(EMAIL_LOCAL))
        low = at + 1
        if domain and start < at:
            yield start, domain.end()
            low = domain.end()
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every match that passes its check, in code points, by start."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if _octets(m[0])]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(spans)


@dataclass
class Tokens:
    """Candidate tokens of one document: spans, whether the one before is its neighbour, features, keys."""

    spans: list[tuple[int, int]]
    joined: list[bool]
    features: list[int]
    keys: list[set[str]]


def candidates(text: str) -> Tokens:
    spans: list[tuple[int, int]] = []
    joined: list[bool] = []
    low = 0
    while mark := _MARK.search(text, low):
        start = max([low, *(text.rfind(b, low, mark.start()) + 1 for b in " \t\n\x0b\f\r")])
        blank = _BLANK.search(text, mark.end())
        end = blank.start() if blank else len(text)
        joined.append(bool(spans) and start - low == 1 and low > 0)
        spans.append((start, end))
        low = end
    words = [text[a:b] for a, b in spans]
    core = [(a + len(w) - len(w.lstrip(_EDGE)), b - len(w) + len(w.rstrip(_EDGE))) for (a, b), w in zip(spans, words)]
    core = [c if c[0] < c[1] else s for c, s in zip(core, spans)]
    words = [text[a:b] for a, b in core]
    numbers = [_digits(w) for w in words]
    runs = _runs(joined)
    features = [_features(words, numbers, i, *runs[i]) for i in range(len(words))]
    return Tokens(core, joined, features, _keys(words, numbers, joined))


def _keys(words: list[str], numbers: list[str], joined: list[bool]) -> list[set[str]]:
    """What a token is known by: itself, its name and host, and the last seven and ten digits of the
    numbers that end with it or with one of the next seven neighbours, as far as it is part of them."""
    keys: list[set[str]] = []
    for word, digits in zip(words, numbers):
        word = word.lower()
        local, _, domain = word.partition("@")
        host = domain.split(".")[0]
        keys.append({f"w{word}"} if "@" in word or len(digits) >= 7 else set())
        if local and host:
            keys[-1].add(f"e{local}@{host}")
    plain = [bool(d) and not any(c.isalpha() or c == "@" for c in w) for w, d in zip(words, numbers)]
    for i, digits in enumerate(numbers):
        if not plain[i]:
            continue
        first = i
        while len(digits) < 10 and joined[first] and i - first < 7 and plain[first - 1]:
            first -= 1
            digits = numbers[first] + digits
        for size in (7, 10):
            k, held = i, 0
            while len(digits) >= size and held < size:
                keys[k].add(f"n{digits[-size:]}")
                held += len(numbers[k])
                k -= 1
    return keys


def _runs(joined: list[bool]) -> list[tuple[int, int]]:
    """First and last index of the run of neighbours that each token is in."""
    firsts = [i for i, j in enumerate(joined) if not j]
    out: list[tuple[int, int]] = []
    for a, b in zip(firsts, firsts[1:] + [len(joined)]):
        out += [(a, b - 1)] * (b - a)
    return out


def _features(words: list[str], numbers: list[str], i: int, first: int, last: int) -> int:
    """Binary features of a token as the bits of one integer; runs are looked at up to 8 tokens away."""
    w, n = words[i], numbers[i]
    near = range(max(first, i - 8), min(last, i + 8) + 1)
    run = sum(len(numbers[k]) for k in near)
    local, _, domain = w.partition("@")
    letters = any(c.isalpha() for c in w)
    opened = next((words[k] for k in range(i, max(first, i - 8) - 1, -1) if words[k][:1] == "+"), "")
    dots = w.count(".")
    facts = [
        True, "@" in w, bool(local) and "." in domain.strip("."), "@" in w and not local, letters, not letters,
        w[:1] == "+", bool(opened), "(" in w or ")" in w, "-" in w, dots == 3 and not letters,
        dots == 3 and not letters and all(p.isdigit() for p in w.split(".")) and _octets(w), dots == 1, dots in (2, 4),
        12 <= len(n) <= 19 and luhn(n), 12 <= len(n) <= 19 and not letters, letters and len(n) >= 8,
        i == first, i == last, first == last, "=" in w or ":" in w or "/" in w,
        *(a <= len(n) <= b for a, b in ((0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 6), (7, 7), (8, 9), (10, 12), (13, 16), (17, 10 ** 9))),
        *(a <= run <= b for a, b in ((0, 3), (4, 8), (9, 11), (12, 15), (16, 19), (20, 10 ** 9))),
        bool(opened) and 9 <= run <= 15,
    ]
    return sum(1 << k for k, fact in enumerate(facts) if fact)


N_FEATURES = 39


def chain_links(tokens: Tokens) -> list[tuple[int, int]]:
    return [(i - 1, i) for i, j in enumerate(tokens.joined) if j]


def hubs(tokens: Tokens) -> list[list[int]]:
    """The tokens of each key that several tokens have: as many entries as tokens and keys."""
    members: dict[str, list[int]] = {}
    for i, keys in enumerate(tokens.keys):
        for key in sorted(keys):
            members.setdefault(key, []).append(i)
    return [m for m in members.values() if len(m) > 1]


def truth(tokens: Tokens, base: list[tuple[int, int, int]]) -> list[int]:
    """The label that the base spans give each token: the kind of the first span that overlaps it."""
    labels, k = [], 0
    for a, b in tokens.spans:
        while k < len(base) and base[k][2] <= a and all(s[2] <= a for s in base[k:k + 4]):
            k += 1
        labels.append(next((1 + kind for s, kind, e in base[k:k + 8] if s < b and e > a), 0))
    return labels


@dataclass
class Field:
    node: np.ndarray  # features x labels
    chain: np.ndarray  # label of the left token x label of the right one
    skip: np.ndarray  # label of the hub x label of the token


def _bits(features: np.ndarray) -> np.ndarray:
    return (features[:, None] >> np.arange(N_FEATURES) & 1).astype(np.float64)


def fit(features: np.ndarray, labels: np.ndarray, chain: np.ndarray, far: np.ndarray, free: np.ndarray,
        steps: int = 600, rate: float = 0.5, weight_decay: float = 0.05) -> Field:
    """Pseudo-likelihood by full-batch Adam: each label given its features, its neighbours' labels and
    `far`, how many of its hubs have each label. Tokens that are not `free` are observed wherever the
    field is used, so they count as neighbours only."""
    n, x = len(labels), _bits(features)
    gold = np.eye(LABELS)[labels]
    around = np.zeros((n, 2 * LABELS))  # labels of left and right neighbours
    for column, (to, of) in enumerate(((chain[:, 1], chain[:, 0]), (chain[:, 0], chain[:, 1]))):
        np.add.at(around[:, column * LABELS:(column + 1) * LABELS], to, gold[of])
    weights = [np.zeros((N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    left, right = (around[:, k * LABELS:(k + 1) * LABELS] for k in range(2))
    open_ = np.where(possible(features), 0.0, -OBSERVED) if n else np.zeros((0, LABELS))
    for step in range(1, steps + 1 if n else 1):
        scores = open_ + x @ weights[0] + left @ weights[1] + right @ weights[1].T + far @ weights[2]
        p = np.exp(scores - scores.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - gold) * free[:, None]
        slopes = [x.T @ error, left.T @ error + error.T @ right, far.T @ error]
        for w, m, v, g in zip(weights, first, second, slopes):
            g = (g + weight_decay * w) / n
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate / step ** 0.5 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return Field(*weights)


def possible(features: np.ndarray) -> np.ndarray:
    """Which labels a token can carry at all: an email needs an @, an address three dots, numbers no letters."""
    has = _bits(features) > 0
    number = has[:, 5] & ~has[:, 1]
    return np.stack([has[:, 0], has[:, 1], has[:, 10], number, number & ~has[:, 31]], 1)


def marginals(field: Field, features: np.ndarray, chain: np.ndarray, ties: np.ndarray, hub_labels: list[set[int]],
              observed: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of every token by sum-product messages along the chain and through hubs.

    `ties` are (hub, token); a hub with labels is observed to have one of them, and so are tokens with
    a label above 0 in `observed`. What a hub hears from its tokens is averaged, so that a thousand
    equal mentions say no more than one. Messages are damped by half and pass until none changes by
    more than 1e-4, `ROUNDS` times at most.
    """
    n = len(features)
    scores = np.where(possible(features), _bits(features) @ field.node, -OBSERVED)
    if observed is not None:
        known = observed > 0
        scores[known] = np.where(np.arange(LABELS) == observed[known, None], 0.0, -OBSERVED)
    unnamed = [0.0] + [-UNNAMED] * (LABELS - 1)
    hub_scores = [[0.0 if y in seen else -OBSERVED for y in range(LABELS)] if seen else unnamed for seen in hub_labels]
    hub_scores = np.array(hub_scores, float).reshape(-1, LABELS)
    scores = np.concatenate([scores, hub_scores])
    left = np.concatenate([chain[:, 0], n + ties[:, 0]]).astype(int)
    right = np.concatenate([chain[:, 1], ties[:, 1]]).astype(int)
    table = np.concatenate([np.broadcast_to(field.chain, (len(chain), LABELS, LABELS)),
                            np.broadcast_to(field.skip, (len(ties), LABELS, LABELS))])
    to_right, to_left = np.zeros((len(left), LABELS)), np.zeros((len(left), LABELS))
    share = np.ones((len(left), 1))
    share[len(chain):, 0] = 1 / np.bincount(ties[:, 0], minlength=1)[ties[:, 0]]

    def beliefs() -> np.ndarray:
        total = scores.copy()
        np.add.at(total, right, to_right)
        np.add.at(total, left, to_left * share)
        return total

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis)
        out = top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))
        return out - out.max(1, keepdims=True)

    for _ in range(ROUNDS if len(left) else 0):
        total = beliefs()
        new_right = log_sum(table + (total[left] - to_left * share)[:, :, None], 1)
        new_left = log_sum(table + (total[right] - to_right)[:, None, :], 2)
        change = max(np.abs(new_right - to_right).max(), np.abs(new_left - to_left).max())
        to_right, to_left = (to_right + new_right) / 2, (to_left + new_left) / 2
        if change < 1e-4:
            break
    total = beliefs()[:n]
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(field: Field, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Per text the spans that the field adds; neighbours with one label form one span."""
    documents = [candidates(t) if _MARK.search(t) else None for t in texts]
    features: list[int] = []
    observed: list[int] = []
    chain: list[tuple[int, int]] = []
    ties: list[tuple[int, int]] = []
    seen: list[set[int]] = []
    for d, spans in zip(documents, base):
        if d:
            offset = len(features)
            covered = truth(d, spans)
            chain.extend((offset + a, offset + b) for a, b in chain_links(d))
            for members in hubs(d):
                ties.extend((len(seen), offset + i) for i in members)
                seen.append({covered[i] for i in members} - {0})
            features.extend(d.features)
            observed.extend(covered)
    if not features:
        return [[] for _ in texts]
    p = marginals(field, np.array(features, np.int64), np.array(chain, int).reshape(-1, 2), np.array(ties, int).reshape(-1, 2),
                  seen, np.array(observed))
    best, sure, at, out = p.argmax(1).tolist(), (p.max(1) >= CERTAIN).tolist(), 0, []
    for d, spans in zip(documents, base):
        more: list[tuple[int, int, int]] = []
        if d:
            covered = truth(d, spans)
            before = 0
            for i, (a, b) in enumerate(d.spans):
                label = best[at + i] if sure[at + i] and not covered[i] else 0
                if label and label == before and d.joined[i]:
                    more[-1] = (more[-1][0], label - 1, b)
                elif label:
                    more.append((a, label - 1, b))
                before = label
            at += len(d.spans)
        out.append(more)
    return out


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def informal(text: str, kind: int, draw: random.Random) -> str | None:
    """A span as somebody writes it who mentions it again: no plus sign, other separators, no domain ending.

    An address in numbers has no such form.
    """
    if kind == 0:
        local, _, domain = text.partition("@")
        short = f"{local}@{domain.split('.')[0]}"
        return draw.choice([short, short.upper(), short.lower()])
    digits = _digits(text)
    if kind == 2:
        return draw.choice("._").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        own = digits[-10:] if len(digits) > 10 else digits
        parts = [own[:-7], own[-7:-4], own[-4:]]
        return draw.choice([digits, own, "-".join(parts), ".".join(parts), " ".join(parts)]).strip(" -.")
    return None


def stranger(text: str, kind: int, draw: random.Random) -> str | None:
    """A span of the same shape that names somebody else."""
    if kind == 0:
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") if c.isalnum() else c for c in text)
    return "".join(draw.choice("0123456789") if c.isdigit() else c for c in text)


def lessons(text: str) -> list[tuple[str, list[int], list[tuple[int, int, int]]]]:
    """(text, label per candidate, base spans): the text itself, and with a second mention of its own and of a stranger's."""
    base, draw = base_spans(text), random.Random(zlib.crc32(text.encode()))
    out = [(text, truth(candidates(text), base), base)]
    if not base:
        return out
    start, kind, end = draw.choice(base)
    for named in (text[start:end], stranger(text[start:end], kind, draw)):
        mention = informal(named, kind, draw)
        longer = f"{text} again {mention} " + " ".join(["and", "so", "on"][: draw.randrange(4)])
        if mention is None or base_spans(longer) != base:
            continue
        tokens = candidates(longer)
        own = 1 + kind if named == text[start:end] else 0
        labels = [own if a > len(text) else label for (a, _), label in zip(tokens.spans, truth(tokens, base))]
        out.append((longer, labels, base))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Field:
    """Fit the field on the bounded sample named in the module's head."""
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    sample = ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)

    def example(text: str, labels: list[int], base: list[tuple[int, int, int]]) -> dict[str, list]:
        """What the fit needs of a text; a hub has the kinds that base spans give its members, or none."""
        tokens = candidates(text)
        covered, far = truth(tokens, base), [[0] * LABELS for _ in tokens.spans]
        for members in hubs(tokens):
            for i in members:
                for kind in {covered[k] for k in members} - {0} or {0}:
                    far[i][kind] += 1
        return {"features": tokens.features, "labels": labels, "chain": [v for e in chain_links(tokens) for v in e],
                "far": [v for row in far for v in row], "free": [int(not label) for label in covered]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [t for t in _texts(batch.column("text")) if _MARK.search(t) and len(candidates(t).spans) <= SAMPLE_TOKENS]
            yield pa.RecordBatch.from_pylist([example(*lesson) for t in found for lesson in lessons(t)], schema=arrow)

    longs = pa.list_(pa.int64())
    arrow = pa.schema([("features", longs), ("labels", longs), ("chain", longs), ("far", longs), ("free", longs)])
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    rows = chosen.select("text").mapInArrow(
        run, "features array<bigint>, labels array<bigint>, chain array<bigint>, far array<bigint>, free array<bigint>"
    ).collect()
    rows = sorted(rows, key=lambda r: hashlib.sha256(repr(tuple(r)).encode()).digest())  # the order of tasks varies
    offsets = np.concatenate(([0], np.cumsum([len(r.features) for r in rows]))).astype(int)

    def flat(name: str, shift: bool = False) -> np.ndarray:
        parts = [np.array(r[name], np.int64) + (o if shift else 0) for r, o in zip(rows, offsets)]
        return np.concatenate([np.empty(0, np.int64), *parts])

    return fit(flat("features"), flat("labels"), flat("chain", True).reshape(-1, 2), flat("far").reshape(-1, LABELS).astype(float), flat("free"))


def find(docs: DataFrame, carry: list[str], field: Field, text: str = "text") -> DataFrame:
    """`carry` and, per row, `n_<kind>` and `base` of the base spans, and `spans`: base and added ones.

    Span lists are texts `kind:start:end`, comma-joined, by start and kind; ends are exclusive, in
    code points. A null text counts as empty and has no spans.
    """
    fields = docs.select(carry).schema
    names = [f.name for f in fields]

    def listed(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = _texts(batch.column(batch.num_columns - 1))
            base = [base_spans(t) for t in texts]
            more = added_spans(field, texts, base)
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            lists = [pa.array([listed(b) for b in base], pa.string()),
                     pa.array([listed(sorted(b + m)) for b, m in zip(base, more)], pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))] + counts + lists,
                names + [f"n_{k}" for k in KINDS] + ["base", "spans"])

    for k in KINDS:
        fields = fields.add(f"n_{k}", "long")
    return docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, fields.add("base", "string").add("spans", "string"))


def mask(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; texts without spans stay as they are.

    Overlapping spans become one, of the kind that starts first. A column `n_chars` follows the new
    length. A null text stays null.
    """
    schema = docs.schema
    place = docs.columns.index(text)
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def masked(t: str, spans: list[tuple[int, int, int]]) -> str:
        out, end = [], 0
        for a, k, b in spans:
            if a >= end:
                out += [t[end:a], f"[{KINDS[k].upper()}]"]
            end = max(end, b)
        return "".join(out) + t[end:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            own = batch.column(place).to_pylist()
            texts = [t or "" for t in own]
            base = [base_spans(t) for t in texts]
            spans = [sorted(b + m) for b, m in zip(base, added_spans(field, texts, base))]
            new = [masked(t, s) if s else o for t, s, o in zip(texts, spans, own)]
            columns = list(batch.columns)
            columns[place] = pa.array(new, columns[place].type)
            if length is not None:
                kept = columns[length].to_pylist()
                sizes = [len(t) if s else k for t, s, k in zip(new, spans, kept)]
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, schema)
