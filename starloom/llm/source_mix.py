"""Mix sources to target weights, with Spark expressions only.

The words of a source form one stream, its documents ordered by (hash bucket, id, size), and the
stream is cut into blocks of `BLOCK` words; what is left over is its tail. A source takes its whole
stream as often as its target holds it, then blocks in the order of a pseudorandom permutation
(an alternating additive network over a grid just larger than the block count, walked until it
lands inside), and the last block is cut so that the words taken are the target rounded down.

These takes are the slots of the mix. A second permutation deals all slots out to output shards of
`SHARD` slots. So the sources' counts in each shard are multinomial draws given the sources' totals
(drawn without replacement): independent draws per shard would let the totals drift off their
targets and beyond twice a source's size. Every row of the result tells which shards its document's
blocks went to, and the pipeline stage writes its rows in the order of the shards.

Sources are numbered in a range-partitioned table and summed in buckets of neighbouring numbers, so
there may be as many as there are web domains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.bin_slack import _running
from starloom.llm.texts import BLANK_RUN, BLANKS, word_count
from starloom.operators.keys import dense_index
from starloom.session import materialise, prepare

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 128
SHARD = 4096
BUCKETS = 1024
CHUNK = 4096
SEED = 20_023


def _permuted(value: Column, size: Column, key: Column) -> Column:
    """The place of `value` in a permutation of 0 .. size - 1 that depends on `key`.

    The grid has a rows and b columns, a * b - size < a. Each step adds a hash of one coordinate to
    the other, which can be undone, so it permutes the grid; places outside are walked on until
    they fall inside. At most a steps are outside: 64 always reach the end for sizes up to 4,096,
    and beyond that miss with a probability below 64 ** -64.
    """
    size = F.greatest(size, F.lit(1))
    a = F.ceil(F.sqrt(size.cast("double"))).cast("bigint")
    b = F.ceil(size / a).cast("bigint")

    def once(x: Column) -> Column:
        row, column = F.floor(x / b).cast("bigint"), x % b
        for step in range(3):
            row = (row + F.pmod(F.xxhash64(column, key, F.lit(2 * step)), a)) % a
            column = (column + F.pmod(F.xxhash64(row, key, F.lit(2 * step + 1)), b)) % b
        return row * b + column

    first = once(value)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(64)), first, lambda x, _: F.when(x < size, x).otherwise(once(x)))
    return F.when(first < size, first).otherwise(walked)


def _keys(source: str) -> Column:
    """A source as a text that is never null: null is the empty text, any other starts with '='."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _in_order() -> list[Column]:
    """Code point order, null last."""
    return [F.col("src") == "", F.col("src")]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(src, nth, source_size, target) for every source key of `sizes` (src, size), a written table.

    Targets share `share` of all words by weight, none above `most` times its source's size. The words
    that sources at their limit leave are shared again among the others until none is above its limit:
    each round is one aggregation, raises the level that a weight of one gets, and ends when it no
    longer rises. `nth` numbers the sources by code point, null last.
    """
    total = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    rows = dense_index(total, _in_order(), "nth", 0)
    turn = (F.col("nth") % len(weights) + 1).cast("int")
    rows = materialise(rows.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)))
    limit = F.col("source_size").cast("double") * most
    level, before = 0.0, -1.0
    while level > before:
        below = limit / F.col("weight") < level if before >= 0 else F.lit(False)
        row = rows.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(below, limit)).alias("taken"),
            F.sum(F.when(~below, F.col("weight"))).alias("open")).first()
        before, level = level, ((row.words or 0) * share - (row.taken or 0.0)) / row.open if row.open else float("inf")
    target = F.least(limit, F.lit(level) * F.col("weight"))
    return materialise(rows.select("src", "nth", "source_size", target.alias("target")))


def placed(sizes: DataFrame) -> DataFrame:
    """`sizes` (src, doc_id, size) with `start`: the words of the source's stream before the row.

    Running sums stay inside (source, bucket), so that no source has to fit into one task.
    """
    group = ["src", "bucket"]
    rows = sizes.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(BUCKETS)))
    sums = rows.groupBy(*group).agg(F.sum("size").alias("bucket_size"))
    above = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, F.coalesce(F.sum("bucket_size").over(above), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy(*group).orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, group)
    return rows.withColumn("start", F.col("bucket_start") + F.col("inside")).select("src", "doc_id", "size", "start")


def schedule(goal: DataFrame) -> DataFrame:
    """Per source with takes: rounds, rest, blocks, per_round, takes, and which slots are its own.

    Slots are numbered through the sources: running sums stay among neighbouring sources, and the
    buckets' totals, one row for each `CHUNK` sources, carry them on.
    """
    size, blocks = F.col("source_size"), F.col("blocks")
    rows = goal.filter("source_size > 0").withColumn("blocks", F.expr(f"source_size div {BLOCK}"))
    rows = rows.withColumn("want", F.floor("target").cast("bigint"))
    rows = rows.withColumn("rounds", F.expr("want div source_size")).withColumn("rest", F.col("want") % size)
    rows = rows.withColumn("per_round", blocks + (size % BLOCK > 0).cast("bigint"))
    rows = rows.withColumn("takes", F.col("rounds") * F.col("per_round") + F.ceil(F.col("rest") / BLOCK).cast("bigint"))
    rows = rows.withColumn("bucket", F.expr(f"nth div {CHUNK}"))
    rows = _running(rows, [], "takes", ["nth"], "first_slot").filter("takes > 0")
    rows = materialise(rows.drop("bucket", "want"))
    return rows.withColumn("all_slots", F.lit(rows.agg(F.sum("takes")).first()[0]).cast("bigint"))


def _place(take: Column) -> Column:
    """Where among all slots the permutation puts a source's take."""
    return _permuted(F.col("first_slot") + take, F.col("all_slots"), F.lit(SEED))


def slots(rows: DataFrame) -> DataFrame:
    """One row per take of the schedule: src, block, `words` (null: the whole block), output shard and slot.

    `rows` are a schedule, or the targets that one is made from.
    """
    rows = rows if "takes" in rows.columns else schedule(rows)
    blocks = F.col("blocks")
    # a large source becomes many rows before its takes are listed, and those rows are dealt out
    chunks = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(takes - 1) div {CHUNK}"))))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(tasks, "src", "chunk")  # a stated number: few bytes here become many rows
    last = F.least((F.col("chunk") + 1) * CHUNK, F.col("takes")) - 1
    takes = chunks.withColumn("take", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    takes = takes.withColumn("nth", F.col("take") - F.col("rounds") * F.col("per_round"))
    takes = takes.withColumn("key", F.xxhash64("src", F.lit(SEED)))
    drawn = F.when(F.col("nth") < blocks, _permuted(F.col("nth"), blocks, F.col("key"))).otherwise(blocks)
    left = F.col("rest") - F.col("nth") * BLOCK
    return takes.select(
        "src", F.when(F.col("nth") < 0, F.col("take") % F.col("per_round")).otherwise(drawn).alias("block"),
        F.when((F.col("nth") >= 0) & (left < BLOCK), left).alias("words"), _place(F.col("take")).alias("at"),
    ).select("src", "block", "words", F.expr(f"at div {SHARD}").alias("shard"), (F.col("at") % SHARD).alias("slot"))


def shard_counts(taken: DataFrame) -> DataFrame:
    """(shard, src, slots): how many slots of each output shard each source fills."""
    return taken.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("slots"))


def _met(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """A row per row of `rows` and block that it touches: the words `low` .. `high` of the stream it
    holds there, `full` (how often the block is taken whole), `part_end`, where a cut take ends, and of
    the block's takes their number, first and last shard, and a digest of their slots."""
    uses = taken.groupBy("src", "block").agg(
        F.sum(F.col("words").isNull().cast("bigint")).alias("full"), F.coalesce(F.max("words"), F.lit(0)).alias("part"),
        F.count(F.lit(1)).alias("slots"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"),
        F.bit_xor(F.xxhash64("shard", "slot")).alias("slot_digest"), F.min(F.struct("shard", "slot")).alias("place"),
    )
    touched = F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))
    # the planner cannot see that the blocks' uses, exploded from a row per source, are a large table
    met = rows.withColumn("block", F.explode(touched)).join(uses.hint("merge"), ["src", "block"], "left")
    first, end = F.col("block") * BLOCK, F.col("start") + F.col("size")
    return met.withColumns({
        "low": F.greatest("start", first), "high": F.least(end, first + BLOCK), "full": F.coalesce("full", F.lit(0)),
        "part_end": F.least(end, first + F.coalesce("part", F.lit(0))),
    })


def taken_words(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """`rows` (src, doc_id, size, start), `taken`: the words taken of each row, repeats counted, and of
    all takes of its blocks: `slots`, `first_shard`, `last_shard`, `slot_digest` (exclusive or of hashes)."""
    words = F.col("full") * (F.col("high") - F.col("low")) + F.greatest(F.col("part_end") - F.col("low"), F.lit(0))
    return _met(rows, taken).groupBy("src", "doc_id", "size", "start").agg(
        F.sum(words).alias("taken"), F.coalesce(F.sum("slots"), F.lit(0)).alias("slots"), F.min("first_shard").alias("first_shard"),
        F.max("last_shard").alias("last_shard"), F.coalesce(F.bit_xor("slot_digest"), F.lit(0)).cast("bigint").alias("slot_digest"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken, slots, first_shard, last_shard, slot_digest per row of `docs`.

    A null text has size 0; documents of size 0 take nothing and are in no shard. A null source is a
    source of its own, the last. Repeated rows are further words of their source and each gets its
    own share. Without any words every target is 0. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    sizes = materialise(docs.select(
        F.col(id_col).alias("doc_id"), _keys(source).alias("src"), word_count(text).alias("size")
    ))
    goal = targets(sizes)
    shards = ["slots", "first_shard", "last_shard", "slot_digest"]
    counted = taken_words(placed(sizes.filter("size > 0")), slots(schedule(goal))).select("doc_id", "src", "size", "taken", *shards)
    zero, unknown = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    none = sizes.filter("size = 0").withColumns(
        {"taken": zero, "slots": zero, "first_shard": unknown, "last_shard": unknown, "slot_digest": zero})
    return counted.unionByName(none).join(goal, "src").select(
        "doc_id", "size", F.expr("if(src = '', null, substring(src, 2))").alias("source"), "source_size", "target", "taken", *shards
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as rows of `docs`: a whole copy for each round that its source makes, and one row with
    the words of its blocks that are drawn beyond those, in order, with the blanks between them.

    The rows come in the order of output shards and slots, a row at the first slot that its blocks
    take in its round, so each part of the result mixes the sources as the whole does. A document
    without words is not in the mix. A column `n_chars` follows the text's length.
    """
    prepare(docs.sparkSession)
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(*docs.columns).alias("hash"))
    sizes = materialise(docs.select(row.alias("doc_id"), _keys(source).alias("src"), word_count(text).alias("size")))
    plan = schedule(targets(sizes))
    rounds = plan.select("src", "rounds", "per_round", "first_slot", "all_slots")
    met = _met(placed(sizes.filter("size > 0")), slots(plan)).join(rounds, "src")
    end = F.when(F.col("full") > F.col("rounds"), F.col("high")).otherwise(F.col("part_end"))
    drawn = F.struct((F.col("low") - F.col("start") + 1).cast("int").alias("a"), (end - F.col("low")).cast("int").alias("n"))
    shares = met.groupBy("src", "doc_id", "start", "rounds", "per_round", "first_slot", "all_slots").agg(
        F.array_sort(F.collect_list(F.when(end > F.col("low"), drawn))).alias("drawn"),
        F.min(F.when(end > F.col("low"), F.col("place.shard") * SHARD + F.col("place.slot"))).alias("drawn_at"),
    ).filter("rounds > 0 or size(drawn) > 0")
    own = F.expr(f"start div {BLOCK}")
    rounds_at = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("rounds")), lambda r: _place(r * F.col("per_round") + own))
    shares = shares.select("doc_id.id", "doc_id.hash", "rounds", "drawn", "drawn_at", rounds_at.alias("rounds_at"))

    # equal rows meet all their shares, so one of them is enough
    whole = docs.select(F.struct(*docs.columns).alias("row"), row.alias("key"))
    whole = whole.select("row", "key.hash", F.coalesce(F.col("key.id").cast("string"), F.lit("")).alias("name"))
    one = F.row_number().over(Window.partitionBy("hash", "name").orderBy("hash"))
    whole = whole.withColumn("nth", one).filter("nth = 1").drop("nth")
    shares = shares.select("hash", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name"), "rounds", "drawn", "drawn_at", "rounds_at")
    blank = BLANK_RUN[:-1]
    words = F.split(F.ltrim(F.col(f"row.{text}"), F.lit(BLANKS)), f"(?<={blank})(?=[^{blank[1:]})")
    rest = F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform("drawn", lambda r: F.slice(w, r["a"], r["n"]))), ""))[0]
    versions = F.concat(
        F.transform(F.slice("rounds_at", F.lit(1), F.col("rounds").cast("int")), lambda at: F.struct(F.lit(None).cast("string").alias("cut"), at.alias("at"))),
        F.filter(F.array(F.struct(rest.alias("cut"), F.col("drawn_at").alias("at"))), lambda v: v["at"].isNotNull()),
    )
    out = whole.join(shares, ["hash", "name"]).select("row", F.explode(versions).alias("version"))
    out = out.select("row", "version.cut", "version.at").repartitionByRange("at").sortWithinPartitions("at")
    columns = {c: F.col(f"row.{c}") for c in docs.columns}
    columns[text] = F.coalesce("cut", F.col(f"row.{text}"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("cut").isNull(), columns["n_chars"]).otherwise(F.length("cut").cast(docs.schema["n_chars"].dataType))
    return out.select(*[c.alias(n) for n, c in columns.items()])
