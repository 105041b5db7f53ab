"""Repair of conversations by a generalised LR parse of their roles with weighted edits.

The role grammar is `GRAMMAR`: a system turn at most, then pairs of user and assistant turns, or
nothing. Its SLR tables are built once. A parse holds several stacks at a time, one for each way of
editing the turns read so far; stacks share their lower part, and of the stacks with equal tops only
the one of least (cost, audit) goes on. What may follow depends on the top alone in this grammar, and
two audits of equal cost over the same turns never are prefixes of each other, so nothing cheaper or
smaller is lost.

Spark sorts the turns by ranges of (conversation, turn, role, text), so a conversation of any size is
split over tasks. One that lies whole inside a task and has at most `LONG` turns is parsed there.
The turns of any other are written, cut into segments, and each segment is parsed from every top;
the segments' costs are then put together in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from starloom.session import materialise, prepare

# The grammar over role initials, the legal neighbours, the costs of the edits.
GRAMMAR = (("S", ""), ("S", "sT"), ("S", "T"), ("T", "TP"), ("T", "P"), ("P", "ua"))
NEIGHBOURS = {"su", "ua", "au"}
INSERT, REROLE, DELETE, LATE = 2, 2, 3, 1
ROLES = {"u": "user", "a": "assistant"}
INITIALS = {"s", "u", "a"}

LONG = 8192
BLANK = " \t\n\x0b\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _tables(grammar: tuple) -> tuple[dict, dict]:
    """SLR tables: (state, symbol) to the next state, (state, symbol ahead) to (left side, length).

    No symbol on a right side may vanish; the first rule's left side is the start, `$` the end.
    """
    heads = {left for left, _ in grammar}
    first, follow = {x: set() for x in heads}, {x: set() for x in heads}
    follow[grammar[0][0]].add("$")
    for _ in range(len(grammar) ** 2):
        for left, right in grammar:
            first[left] |= first.get(right[:1], set(right[:1]))
            for x, after in zip(right, [*right[1:], None]):
                if x in heads:
                    follow[x] |= follow[left] if after is None else first.get(after, {after})

    def closed(items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            ahead = grammar[rule][1][dot:dot + 1]
            more = {(n, 0) for n, (left, _) in enumerate(grammar) if left == ahead} - items
            items |= more
            todo += more
        return frozenset(items)

    begin = closed({(n, 0) for n, (left, _) in enumerate(grammar) if left == grammar[0][0]})
    states, goto, reduce = [begin], {}, {}
    for state in states:
        for symbol in sorted({grammar[r][1][d] for r, d in state if d < len(grammar[r][1])}):
            then = closed({(r, d + 1) for r, d in state if grammar[r][1][d:d + 1] == symbol})
            if then not in states:
                states.append(then)
            goto[states.index(state), symbol] = states.index(then)
        for rule, dot in state:
            left, right = grammar[rule]
            if dot == len(right):
                for ahead in follow[left]:
                    reduce.setdefault((states.index(state), ahead), []).append((left, len(right)))
    return goto, reduce


GOTO, REDUCE = _tables(GRAMMAR)
START = (0, None)


@lru_cache(maxsize=4096)
def _advance(stack: tuple, symbol: str) -> tuple:
    """The stacks after all reductions that `symbol` calls for and its shift; `$` gives the accepted ones."""
    todo, out = [stack], []
    while todo:
        top = todo.pop()
        for left, length in REDUCE.get((top[0], symbol), ()):
            below = top
            for _ in range(length):
                below = below[1]
            if symbol == "$" and left == GRAMMAR[0][0] and below == START:
                out.append(below)
            elif (below[0], left) in GOTO:
                todo.append((GOTO[below[0], left], below))
        if (top[0], symbol) in GOTO:
            out.append((GOTO[top[0], symbol], top))
    return tuple(out)


# One stack for every top a parse can stand on between two turns.
TOPS = {s[0]: s for s in (START, *_advance(START, "s"), *_advance(START, "u"), *_advance(_advance(START, "u")[0], "a"))}


def _put(tops: dict, cost: int, audit: str, stack: tuple) -> bool:
    """Merge into the stack with the same top; the lesser (cost, audit) stays."""
    known = tops.get(stack[0])
    if known is None or (cost, audit) < known[:2]:
        tops[stack[0]] = (cost, audit, stack)
        return True
    return False


def _inserted(tops: dict) -> dict:
    todo = list(tops)
    while todo:
        cost, audit, stack = tops[todo.pop()]
        for symbol in ROLES:
            for then in _advance(stack, symbol):
                if _put(tops, cost + INSERT, audit + "I", then):
                    todo.append(then[0])
    return tops


def _read(tops: dict, initial: str, late: int) -> dict:
    """All edits of one turn, then all insertions."""
    out: dict = {}
    for cost, audit, stack in tops.values():
        _put(out, cost + DELETE, audit + "D", stack)
        for then in _advance(stack, initial) if initial in INITIALS else ():
            _put(out, cost + late, audit + "K", then)
        for symbol in ROLES:
            for then in _advance(stack, symbol):
                _put(out, cost + REROLE + late, audit + "R", then)
    return _inserted(out)


def _deleted(tops: dict, times: int) -> dict:
    """Forced deletions; an insertion behind them gives a smaller audit than one before."""
    return _inserted({top: (cost + DELETE * times, audit + "D" * times, stack) for top, (cost, audit, stack) in tops.items()})


def _opening() -> dict:
    return _inserted({START[0]: (0, "", START)})


def _best(tops: dict) -> tuple[int, str]:
    return min((cost, audit) for cost, audit, stack in tops.values() if _advance(stack, "$"))


class _Segment:
    """Consecutive turns of a conversation: their counts, and the parse from each of the given tops."""

    def __init__(self, parses: dict):
        self.parses = parses
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.turn_a = self.turn_z = self.initial_a = self.initial_z = None

    def add(self, turn, role: str, text: str, copies: int, repeated: bool) -> None:
        initial = role[:1]
        if self.initial_z is None:
            self.initial_a = initial
        else:
            self.illegal += self.initial_z + initial not in NEIGHBOURS
        self.illegal += copies - 1
        self.initial_z = initial
        if turn is not None and turn != self.turn_z:
            self.turns += 1
            self.turn_a, self.turn_z = turn if self.turn_a is None else self.turn_a, turn
        late = 0
        if not _WORD.search(text):
            self.blank += copies
            gone = copies
        else:
            gone = copies - (not repeated)
            self.duplicate += gone
            if not repeated:
                late = LATE * (text.rstrip(BLANK)[-1] not in ".!?")
                self.truncated += late
        for start, tops in self.parses.items():
            tops = _read(tops, initial, late) if gone < copies else tops
            self.parses[start] = _deleted(tops, gone) if gone else tops

    def gaps(self) -> int:
        return 0 if self.turn_a is None else self.turn_z - self.turn_a + 1 - self.turns

    def append(self, other: "_Segment") -> None:
        """The segment that follows, parsed from every top."""
        if other.initial_a is not None:
            self.illegal += self.initial_z is not None and self.initial_z + other.initial_a not in NEIGHBOURS
            self.initial_a = other.initial_a if self.initial_a is None else self.initial_a
            self.initial_z = other.initial_z
        if other.turn_a is not None:
            self.turns -= other.turn_a == self.turn_z
            self.turn_a = other.turn_a if self.turn_a is None else self.turn_a
            self.turn_z = other.turn_z
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        for start, tops in self.parses.items():
            joined: dict = {}
            for top, (cost, audit, _) in tops.items():
                for c, a, stack in other.parses[top].values():
                    _put(joined, cost + c, audit + a, stack)
            self.parses[start] = joined


def _every_top() -> dict:
    return {top: {top: (0, "", stack)} for top, stack in TOPS.items()}


def edited(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that the edits leave, in order; `turns` are (role, text)."""
    turns, wanted = iter(turns), "u"
    for edit in audit:
        role, text = ROLES[wanted], ""
        if edit != "I":
            known, text = next(turns)
            role = known if edit == "K" else role
        if edit != "D":
            yield edit, role, text
            wanted = "a" if role[:1] == "u" else "u"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 4096).columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _mapped(frame: DataFrame, schema: StructType, make: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """`make` from an iterator of rows to an iterator of rows, inside Spark's tasks."""
    arrow = to_arrow_schema(schema)
    return frame.mapInArrow(lambda batches: _batches(make(_rows(batches)), arrow), schema)


def _schema(conversation: DataType, turn: DataType, text: str) -> StructType:
    return StructType([StructField("conv", conversation), StructField("turn", turn)]).add("role", "string").add(text, "string")


def _parts(turns: DataFrame, long: int, want_turns: bool) -> tuple[DataFrame, list[str], list[str]]:
    """The parsed conversations and, with `part` set, the turns of those that one task cannot close."""
    kind = {f.name: f.dataType for f in turns.schema}
    given = _schema(kind["conv"], kind["turn"], "text").add("copies", "long")
    schema = StructType(list(given.fields)).add("part", "long").add("seq", "long")
    result = ["n", "edit"] if want_turns else [*COUNTS, "audit", "repaired_sha256"]
    for name in result:
        schema = schema.add(name, "string" if name in ("edit", "audit", "repaired_sha256") else "long")

    def closed(rows: list[tuple]) -> Iterator[tuple]:
        conv, scan, seen = rows[0][0], _Segment({START[0]: _opening()}), set()
        for _, turn, role, text, copies in rows:
            if copies:
                scan.add(turn, role, text, copies, (role, text) in seen)
                seen.add((role, text))
        cost, audit = _best(scan.parses[START[0]])
        flat = ((role, text) for _, _, role, text, copies in rows for _ in range(copies))
        if want_turns:
            for n, (edit, role, text) in enumerate(edited(audit, flat)):
                yield (conv, None, role, text, None, None, None, n, edit)
        else:
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in edited(audit, flat)).encode()).hexdigest()
            yield (conv, None, None, None, None, None, None, scan.gaps(), scan.blank, scan.duplicate, scan.truncated,
                   scan.illegal, cost, audit, digest)

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        part, seq, held, is_open = TaskContext.get().partitionId(), 0, [], True
        current = unread = object()

        def opened() -> Iterator[tuple]:
            nonlocal seq
            for row in held:
                yield (*row, part, seq, *(None,) * len(result))
                seq += 1
            held.clear()

        for row in rows:
            if current is not unread and row[0] != current:
                yield from opened() if is_open else closed(held)
                held.clear()
                is_open = False
            current = row[0]
            held.append(row)
            if len(held) > long:
                is_open = True
                yield from opened()
        yield from opened()  # the task after this one may hold the rest

    return _mapped(turns, schema, make), given.names, result


def _long(open_turns: DataFrame, names: list[str], result: list[str], long: int, want_turns: bool) -> DataFrame:
    """Conversations in segments: repeated turns by a join, segments parsed apart, then put together in order."""
    kind = {f.name: f.dataType for f in open_turns.schema}
    place = F.struct("part", "seq")
    known = open_turns.filter("copies > 0").groupBy("conv", "role", "text").agg(F.min(place).alias("place"), F.count("seq").alias("places"))
    known = known.filter("places > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "place")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    flagged = materialise(open_turns.select(*names, "part", "seq").join(known, same, "left").select(
        *names, "part", "seq", (F.col("place").isNotNull() & (F.col("place") != place)).alias("repeated")))

    piece = F.floor(F.col("seq") / long).cast("bigint")
    parse = ArrayType(StructType().add("a", "integer").add("z", "integer").add("cost", "long").add("audit", "string"))
    segment = StructType([StructField("conv", kind["conv"])]).add("part", "long").add("piece", "long")
    for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
        segment = segment.add(name, "long")
    segment = segment.add(StructField("turn_a", kind["turn"])).add(StructField("turn_z", kind["turn"]))
    segment = segment.add("initial_a", "string").add("initial_z", "string").add("parse", parse)

    def grouped(rows: Iterator[tuple], width: int) -> Iterator[tuple]:
        key, held = None, []
        for row in rows:
            if key is not None and row[:width] != key:
                yield key, held
                held = []
            key = row[:width]
            held.append(row[width:])
        if key is not None:
            yield key, held

    def segments(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, held in grouped(rows, 3):
            scan = _Segment(_every_top())
            for turn, role, text, copies, repeated, _ in held:
                if copies:
                    scan.add(turn, role, text, copies, repeated)
            yield (*key, scan.blank, scan.duplicate, scan.truncated, scan.illegal, scan.turns, scan.turn_a, scan.turn_z,
                   scan.initial_a, scan.initial_z,
                   [{"a": a, "z": z, "cost": c, "audit": s} for a, tops in scan.parses.items() for z, (c, s, _) in tops.items()])

    cut = flagged.select("conv", "part", piece.alias("piece"), "turn", "role", "text", "copies", "repeated", "seq")
    cut = cut.repartition("conv", "part", "piece").sortWithinPartitions("conv", "part", "piece", "seq")
    parsed = _mapped(cut, segment, segments)

    totals = StructType([StructField("conv", kind["conv"])])
    for name in COUNTS:
        totals = totals.add(name, "long")
    totals = totals.add("audit", "string")

    def folded(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, whole = None, None

        def done():
            cost, audit = _best(whole.parses[START[0]])
            return (conv[0], whole.gaps(), whole.blank, whole.duplicate, whole.truncated, whole.illegal, cost, audit)

        for row in rows:
            if whole is not None and row[0] != conv[0]:
                yield done()
                whole = None
            if whole is None:
                conv, whole = (row[0],), _Segment({START[0]: _opening()})
            step = _Segment(_every_top())
            (step.blank, step.duplicate, step.truncated, step.illegal, step.turns, step.turn_a, step.turn_z,
             step.initial_a, step.initial_z, parse_) = row[3:]
            step.parses = {top: {} for top in TOPS}
            for p in parse_:
                step.parses[p["a"]][p["z"]] = (p["cost"], p["audit"], TOPS[p["z"]])
            whole.append(step)
        if whole is not None:
            yield done()

    summary = materialise(_mapped(parsed.repartition("conv").sortWithinPartitions("conv", "part", "piece"), totals, folded))

    # the edits of a conversation come before its turns, which are then read once, in order
    heads = summary.withColumn("part", F.lit(-1).cast("bigint")).withColumn("seq", F.lit(0).cast("bigint"))
    stream = heads.unionByName(flagged, allowMissingColumns=True).select("conv", *COUNTS, "audit", "part", "role", "text", "copies", "seq")
    stream = stream.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    out = StructType(list(totals.fields)).add("repaired_sha256", "string")
    if want_turns:
        out = StructType([StructField("conv", kind["conv"])]).add("role", "string").add("text", "string").add("n", "long").add("edit", "string")

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        ahead = next(rows, None)
        while ahead is not None:
            head, ahead = ahead, next(rows, None)

            def turns():
                nonlocal ahead
                while ahead is not None and ahead[8] >= 0:
                    row, ahead = ahead, next(rows, None)
                    yield from repeat(row[9:11], row[11])

            left = turns()
            digest = hashlib.sha256()
            for n, (edit, role, text) in enumerate(edited(head[7], left)):
                if want_turns:
                    yield (head[0], role, text, n, edit)
                else:
                    digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
            for _ in left:  # turns of no copies behind the last edit
                pass
            if not want_turns:
                yield (*head[:8], digest.hexdigest())

    return _mapped(stream, out, read)


def _repair(turns: DataFrame, conversation: str, turn: str, role: str, text: str, copies: Column | None, long: int,
            want_turns: bool) -> DataFrame:
    prepare(turns.sparkSession)
    named = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("bigint").alias("copies"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    rows = named.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts, names, result = _parts(rows, long, want_turns)
    parts = materialise(parts)
    columns = ["conv", "role", "text", *result] if want_turns else ["conv", *result]
    whole = parts.filter("part is null").select(columns)
    rest = _long(parts.filter("part is not null"), names, result, long, want_turns)
    return whole.unionByName(rest).withColumnRenamed("conv", conversation)


def repair(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: Column | None = None, long: int = LONG) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are taken by number (nulls first), then role and text, so ties have one order. A row
    stands for `copies` equal turns; one of 0 only names its conversation, and a conversation with
    no other rows has zeros, an empty audit and the digest of the empty string. A null role or text
    is one blank, rows without a conversation form one, an empty role cannot be kept, and an empty
    table gives no rows. `long` bounds what a task holds of a conversation, not the result; the audit,
    a letter per edit, and the running digest over the repaired turns are single values.
    """
    return _repair(turns, conversation, turn, role, text, copies, long, False)


def repaired(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             copies: Column | None = None, long: int = LONG) -> DataFrame:
    """The repaired turns: conversation, role, text, n (place from 0), edit (K, R or I). See `repair`."""
    return _repair(turns, conversation, turn, role, text, copies, long, True)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults set by crc32 of `conv_id:turn` modulo 20, and `copies` (0: dropped, 2: repeated).

    Nulls are one blank there and in role and text; a null turn stays null.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    gone = fault == 0
    return turns.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(fault == 4, "user").otherwise(shown("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"),
        F.when(gone, 0).when(fault == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )
