"""Small text tables with the odd cases, and plain versions of what the operators share."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = (
    "fingerprint", "component_id", "size", "kept", "bucket", "id", "row", "spans", "n_words", "score", "label", "key",
    "word", "first", "root", "start", "taken", "payload", "digest", "page", "code", "src", "held_out", "words", "h", "i",
)


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    stop = ["the", "of", "and", "to", "in"]
    return " ".join(draw.choice(stop) if draw.random() < 0.3 else f"w{draw.randrange(vocabulary):x}x" for _ in range(n))


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, near copies, and blanks of every kind."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    rows = [
        (1, base, "en", "a", len(base)), (2, None, "en", "a", None), (3, "", None, None, 0), (4, base, "en", "b", len(base)),
        (5, near, "en", "b", len(near)), (6, "one two", "en", None, 7), (7, "\t\n  \x0b", "en", "c", 5),
        (8, prose(2, 30_000), "en", "a", None), (9, "é ü ñ " * 30, "fr", "", None), (9, "other text of a repeated id", "fr", "", 27),
        (10, prose(3, 300), "en", "a", 1), (10, prose(3, 300), "en", "a", 1), (None, prose(4, 80), "de", "c", 2),
        (None, prose(5, 90), "de", "c", 2), (11, "a" * 5000, "en", "b", 5000), (12, "MiXed CASE Words And <|endoftext|> more 1.2.3.4", "en", "b", 0),
    ]
    return rows + [(100 + i, prose(100 + i, 20 + 7 * i), "en", "abc"[i % 3], i) for i in range(20)]


def documents(spark, rows=None, clash=False):
    docs = spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)
    return docs.withColumns({c: F.lit(f"{c}!") for c in CLASHES}) if clash else docs


def saved(folder, **tables):
    """Write the tables as <folder>/<name>.parquet."""
    for name, frame in tables.items():
        frame.repartition(3).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
