"""Quality rules: a table of thresholds compiled into one projection over the text.

Everything is a Spark expression. Counts that need the words as a list are bound once to a lambda
variable (`_let`), so that no expression is evaluated again for each word that refers to it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.texts import BLANK_RUN, BLANKS

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are or an not at from but have "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es "
    "de la le et les en un du une que pour est dans qui par au sur pas plus ne se ce il "
    "el y los las del por con no su para lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """`low` <= 100 * part / whole <= `high`, either bound may be missing; a whole of 0 passes."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        part, whole, holds = 100 * F.col(self.part), F.col(self.whole), F.lit(True)
        if self.low is not None:
            holds &= part >= self.low * whole
        if self.high is not None:
            holds &= part <= self.high * whole
        return (whole == 0) | holds


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=250, high=1200),
    Rule("symbol_ratio", "n_symbols", "n_words", high=10),
    Rule("exclamation_ratio", "n_exclamations", "n_words", high=30),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=2),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=50),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def _covered(windows: Column) -> Column:
    """Words inside the windows (hashes by position) that occur at least twice."""

    def count(ranked: Column) -> Column:
        def repeats(x: Column, i: Column) -> Column:
            same = [F.coalesce(F.get(ranked, i + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
            return same[0] | same[1]

        places = F.array_sort(F.transform(F.filter(ranked, repeats), lambda x: x["i"]))
        return _let(places, lambda p: F.aggregate(
            F.transform(p, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - at, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        ))

    return _let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), count)


def _repeated_words(words: Column) -> Column:
    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def count(hashes: Column) -> Column:
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(_covered(hashes))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(_let(_let(hashed, windows), count))


def _long(c: Column) -> Column:
    return c.cast("bigint")


def measures(text: Column) -> Column:
    """A struct of every count the rules use; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    of_words = _let(_words(text), lambda words: F.struct(
        _long(F.size(words)).alias("n_words"),
        _long(_repeated_words(words)).alias("n_repeat_words"),
        _long(F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))).alias("n_stop_words"),
    ))
    of_lines = _let(lines, lambda x: F.struct(
        _long(F.size(x)).alias("n_lines"), _long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
    ))

    def occurrences(characters: str) -> Column:
        return _long(F.length(text) - F.length(F.translate(text, characters, "")))

    return F.struct(
        of_words.alias("words"), of_lines.alias("lines"),
        _long(F.length(F.translate(text, BLANKS, ""))).alias("word_chars"),
        occurrences(SYMBOLS).alias("n_symbols"), occurrences("!").alias("n_exclamations"),
    )


def judged(docs: DataFrame, carry: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`carry`, the measures, one `passes_<rule>` per rule, `base_failed` and `kept`, per row.

    A null or empty text has no words and is not kept. Rows are judged one by one: repeated rows
    get equal verdicts, an empty table gives an empty result.
    """
    wide = docs.select(*carry, measures(F.col(text)).alias("m"))
    flat = wide.select(
        *carry, "m.words.n_words", "m.words.n_repeat_words", "m.words.n_stop_words",
        "m.lines.n_lines", "m.lines.n_dup_lines", "m.word_chars", "m.n_symbols", "m.n_exclamations",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    verdicts = {f"passes_{r.name}": r.holds() for r in rules}
    flat = flat.withColumns(verdicts | {"base_failed": failed})
    passes = ~F.col("base_failed")
    for name in verdicts:
        passes &= F.col(name)
    return flat.withColumn("kept", passes)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that every rule keeps, with their own columns only, whatever their names."""
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("__text"))
    return judged(whole, ["row"], "__text", rules).filter("kept").select("row.*")


def sql(table: str = "documents") -> str:
    """The verdict as DuckDB SQL: doc_id, the base counts, base_failed and kept."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    rules = " and ".join(
        f"({r.whole} = 0 or (" + " and ".join(
            ([f"100 * {r.part} >= {r.low} * {r.whole}"] if r.low is not None else [])
            + ([f"100 * {r.part} <= {r.high} * {r.whole}"] if r.high is not None else [])
        ) + "))" for r in RULES
    )
    blanks = "[\\x20\\x09-\\x0D]"
    return f"""
    with texts as (
        select row_number() over () as r, doc_id, coalesce(text, '') as t from {table}
    ), cut as (
        select *, list_filter(string_split_regex(t, '{blanks}+'), lambda w: w <> '') as words,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
        from texts
    ), windows as (
        select r, unnest(range(1, len(words) - {WINDOW - 2})) as i,
               unnest(list_transform(range(1, len(words) - {WINDOW - 2}),
                   lambda i: array_to_string(words[i : i + {WINDOW - 1}], ' '))) as w
        from cut where len(words) >= {WINDOW}
    ), places as (
        select r, i from windows qualify count(*) over (partition by r, w) > 1
    ), steps as (
        select r, least({WINDOW}, coalesce(lead(i) over (partition by r order by i) - i, {WINDOW})) as step from places
    ), repeats as (
        select r, cast(sum(step) as bigint) as n from steps group by r
    ), measured as (
        select doc_id, cast(len(words) as bigint) as n_words,
               cast(length(regexp_replace(t, '{blanks}', '', 'g')) as bigint) as word_chars,
               cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
               cast(length(regexp_replace(t, '[^!]', '', 'g')) as bigint) as n_exclamations,
               cast(len(lines) as bigint) as n_lines,
               cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
               cast(len(list_filter(words, lambda w: lower(w) in ({stop}))) as bigint) as n_stop_words,
               coalesce(n, 0) as n_repeat_words
        from cut left join repeats using (r)
    ), based as (
        select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed
        from measured
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and {rules} as kept
    from based"""
