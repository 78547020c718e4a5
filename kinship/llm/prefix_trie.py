"""Prefix trie of conversations with a depth-band rollup.

Conversations are rebuilt so that many share their first turns: conversation c
begins with the first h original turns of conversation c - c % group, then
come its own turns after its first h (h = unsigned crc32 of c in decimal, modulo
``heads``). A node is a distinct sequence of turns from the beginning.

* **Places without a gathered conversation.** Rows are sorted over the tasks by
  (conv_id, turn, turn's digest); a task's run of a conversation is contiguous,
  so a turn's place follows from the counts of the runs before it. A
  conversation of any length is spread over tasks; texts stay behind after
  their digests and word counts are taken.
* **Nodes.** A node's key is its depth and 128 bits: the exclusive or of two
  64-bit hashes of (place, SHA-256 of the turn) over its turns, summed up by
  blocks of places, so it too needs no gathered conversation. Members are
  counted by a partial aggregate, so a node that holds most conversations
  reaches the shuffle as one row from each task.
* **Rollup.** Depths are cut in bands of fixed height. Within a band a node's
  value goes to each of its ancestors in that band (at most ``height`` rows a
  node) and is summed there; then the totals of the band's top nodes are
  complete when the bands below are, and go to the ancestors of their parents
  in the band above. Bands are taken from the deepest up, each written, so
  there are depth / height rounds, and no row explodes by more than the height. By
  default the height is the root of the greatest depth, 4 at least, which
  bounds both.
* **Parents.** The few nodes that have more than a ``HOT``-th of all nodes as
  children (fewer than ``HOT`` by that) are broadcast to their children; other
  nodes meet their parent by a shuffle, with no key above that share.
* **Members that end at a node** are digested as a text of unbounded length:
  ids are joined in spans of ``SPAN`` consecutive numbers first, then a task
  streams a node's spans in order through one digest.

Defined results: a null role or text counts as empty; turns are ordered by
turn (null first), equal ones by the SHA-256 of role and text; rows without a
conversation id belong to no conversation; repeated rows are turns of their
own. A conversation id is a whole number. An empty table has no nodes, not even
a root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinship.llm.common import written

HEADS = 4
GROUP = 20
LEAST_HEIGHT = 4
BLOCK = 1024
HOT = 1000
SPAN = 4096

KEY = ("depth", "x", "y")
EMPTY = hashlib.sha256(b"").hexdigest()


def digested(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, said, words) of the turns of all conversations: ``said`` stands for role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The role's length keeps role and text apart.
    said = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    known = rows.where(F.col("conv_id").isNotNull())
    return known.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("said"), words.alias("words"))


def placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with their original place (from 1), and (conv_id, n_turns)."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("said")]
    # Numbers grow along the order inside a task: task << 33 | row.
    sorted_rows = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(sorted_rows.select("conv_id", "said", "words", F.monotonically_increasing_id().alias("row")), "trie-turns")
    task = F.shiftright("row", 33)
    runs = ranged.groupBy("conv_id", task.alias("task")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "trie-runs")
    lengths = runs.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))
    starts = runs.select("conv_id", "task", (F.col("before") - F.col("first") + 1).alias("shift"))
    rows = ranged.withColumn("task", task).join(starts, ["conv_id", "task"])
    return rows.select("conv_id", (F.col("row") + F.col("shift")).alias("place"), "said", "words"), lengths


def rebuilt(rows: DataFrame, heads: int = HEADS, group: int = GROUP) -> DataFrame:
    """Turns of the rebuilt conversations: conv_id, depth, said, words, last.

    Depth 0 is a conversation's beginning, without a turn; ``last`` marks the
    depth at which it ends.
    """
    turns, lengths = placed(digested(rows))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads))
    plan = lengths.select("conv_id", "n_turns", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % group).alias("from"))
    source = lengths.select(F.col("conv_id").alias("from"), F.col("n_turns").alias("n_from"))
    plan = plan.join(source, "from", "left").withColumn("taken", F.least("head", F.coalesce("n_from", F.lit(0))))
    total = F.col("taken") + F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))
    plan = written(plan.select("conv_id", "from", "head", "taken", total.alias("total")), "trie-plan")
    # A conversation's own rows keep their place behind the borrowed ones.
    own = turns.join(plan, "conv_id").where(F.col("place") > F.col("head"))
    own = own.withColumn("depth", F.col("place") - F.col("head") + F.col("taken"))
    # At most ``heads`` - 1 rows for each of the conversations of a group.
    lent = turns.where(F.col("place") < heads).withColumnRenamed("conv_id", "from")
    borrowed = lent.join(plan, "from").where(F.col("place") <= F.col("head")).withColumn("depth", F.col("place"))
    last = F.col("depth") == F.col("total")
    columns = ("conv_id", "depth", "said", "words", last.alias("last"))
    roots = plan.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("said"), F.lit(0).cast("long").alias("words"), (F.col("total") == 0).alias("last"))
    return own.select(*columns).unionByName(borrowed.select(*columns)).unionByName(roots)


def _keyed(turns: DataFrame, height: int) -> DataFrame:
    """Adds the node's bits x, y and ``up``: the bits of its ancestors in its parent's band, from the band's top down.

    A conversation is taken in blocks of depths; a block's first row is the
    last one of the block before it once more, which gives its ancestors.
    """
    size = height * math.ceil(BLOCK / height)
    block = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / size)
    nothing = F.lit(0).cast("long")
    bits = [F.when(F.col("depth") == 0, nothing).otherwise(F.xxhash64(F.lit(salt), "depth", "said")) for salt in (1, 2)]
    rows = turns.select("conv_id", "depth", "words", "last", block.alias("block"), bits[0].alias("a"), bits[1].alias("b"))
    rows = written(rows, "trie-rows")
    sums = rows.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    later = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations of several blocks have blocks after the first.
    before = sums.select("conv_id", "block", F.bit_xor("a").over(later).alias("a0"), F.bit_xor("b").over(later).alias("b0"))
    before = before.where(F.col("block") > 0)
    opening = rows.where((F.col("depth") > 0) & (F.col("depth") % size == 0))
    # Its own bits are among those of the block before.
    opening = opening.withColumns({"block": F.col("block") + 1, "a": nothing, "b": nothing})
    both = rows.withColumn("opens", F.lit(False)).unionByName(opening.withColumn("opens", F.lit(True)))
    along = Window.partitionBy("conv_id", "block").orderBy("depth")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    above = along.rowsBetween(-height, -1)
    joined = both.join(before, ["conv_id", "block"], "left")
    joined = joined.withColumn("x", F.bit_xor("a").over(upto).bitwiseXOR(F.coalesce("a0", nothing)))
    joined = joined.withColumn("y", F.bit_xor("b").over(upto).bitwiseXOR(F.coalesce("b0", nothing)))
    joined = joined.withColumn("up", F.collect_list(F.struct("x", "y")).over(above))
    # Of the last ``height`` ancestors, those in the parent's band: one row more for each step below its top.
    own = F.when(F.col("depth") == 0, 0).otherwise((F.col("depth") - 1) % height + 1).cast("int")
    up = F.slice("up", F.greatest(F.size("up") - own + 1, F.lit(1)), own)
    return joined.where(~F.col("opens")).select("conv_id", *KEY, "words", "last", up.alias("up"))


def nodes_of(turns: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """The nodes (key, up, words, conv_id, n_convs, n_ends), and the members' ends (key, conv_id)."""
    rows = written(_keyed(turns, height), "trie-members")
    nodes = rows.groupBy(*KEY, "up", "words").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("last").alias("n_ends")
    )
    return written(nodes, "trie-nodes"), rows.where("last").select(*KEY, "conv_id")


def rollup(nodes: DataFrame, deepest: int, height: int) -> DataFrame:
    """(key, conv_id, n_convs, px, py, n_children, n_leaves, saved_tokens), by bands from the deepest up."""
    nothing = F.lit(0).cast("long")
    parent = F.try_element_at("up", F.lit(-1))
    own = nodes.withColumns(
        {
            "leaves": (F.col("n_convs") == F.col("n_ends")).cast("long"),
            "saved": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    sums = [F.sum(name).alias(name) for name in ("children", "leaves", "saved")]
    # A node's own row alone has these; the others are null.
    facts = [F.max(name).alias(name) for name in ("conv_id", "n_convs", "px", "py")]

    def lifted(rows: DataFrame) -> DataFrame:
        """A row for each ancestor in the parent's band: its key and what it gains."""
        each = rows.select("depth", "leaves", "saved", F.size("up").alias("n"), F.posexplode("up").alias("at", "node"))
        return each.select(
            (F.col("depth") - F.col("n") + F.col("at")).alias("depth"),
            F.col("node.x").alias("x"),
            F.col("node.y").alias("y"),
            (F.col("at") == F.col("n") - 1).cast("long").alias("children"),
            "leaves",
            "saved",
        )

    done: DataFrame | None = None
    below: DataFrame | None = None
    for band in range(deepest // height, -1, -1):
        top = band * height
        mine = own.where((F.col("depth") >= top) & (F.col("depth") < top + height))
        # The band's top nodes give their totals to the band above when they are complete.
        inside = lifted(mine.where(F.col("depth") > top))
        gained = inside if below is None else inside.unionByName(lifted(below))
        selves = mine.select(
            *KEY, nothing.alias("children"), "leaves", "saved", "conv_id", "n_convs", parent["x"].alias("px"), parent["y"].alias("py")
        )
        totals = selves.unionByName(gained, allowMissingColumns=True).groupBy(*KEY).agg(*sums, *facts)
        totals = written(totals, f"trie-band-{band}")
        done = totals if done is None else done.unionByName(totals)
        if band:
            tops = own.where(F.col("depth") == top).select(*KEY, "up")
            below = totals.where(F.col("depth") == top).join(tops, list(KEY))
    return done


def _with_parents(totals: DataFrame) -> DataFrame:
    """Adds parent_conv_id."""
    n_nodes = totals.count()
    above = totals.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"), "children")
    at = ["depth", "px", "py"]
    hot = F.col("children") * HOT > n_nodes
    # Fewer than HOT rows: together they have no more children than there are nodes.
    near = totals.join(F.broadcast(above.where(hot).drop("children")), at, "left")
    found = F.col("parent_conv_id").isNotNull() | (F.col("depth") == 0)
    far = near.where(~found).drop("parent_conv_id").join(above.where(~hot).drop("children"), at, "left")
    return near.where(found).unionByName(far)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): the SHA-256 of the ids that end at a node, ascending and comma-joined."""
    span = F.floor(F.col("conv_id") / SPAN)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    spans = ends.groupBy(*KEY, span.alias("span")).agg(joined.alias("ids"))
    dealt = spans.repartition(*KEY).sortWithinPartitions(*KEY, "span")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[], [], [], []]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*KEY, "ends_sha256"])

        for batch in batches:
            for *key, ids in zip(*(batch.column(name).to_pylist() for name in (*KEY, "ids"))):
                if key != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if now is not None:
            out.append((*now, digest.hexdigest()))
        yield batch_of(out)

    return dealt.mapInArrow(run, "depth long, x long, y long, ends_sha256 string")


def trie(rows: DataFrame, height: int | None = None, heads: int = HEADS, group: int = GROUP) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = written(rebuilt(rows, heads, group), "trie-rebuilt")
    deepest = turns.agg(F.max("depth")).first()[0] or 0
    height = height or max(LEAST_HEIGHT, math.isqrt(deepest))
    nodes, ends = nodes_of(turns, height)
    whole = _with_parents(rollup(nodes, deepest, height)).join(ends_digest(ends), list(KEY), "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
