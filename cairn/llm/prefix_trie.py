"""A prefix trie of conversations, built level by level.

Each depth groups the live conversations by (parent node, next turn) and names
a node by its smallest conversation.  A conversation that shares its node with
no other leaves the loop: all nodes below are its own, and its remaining turns
give them at once, so the rounds follow the longest prefix that two
conversations share and not the longest conversation.  Children, leaves and
savings are then rolled up from the deepest level to the root, one join a level.

A turn is (role, text), carried as the SHA-256 of both with the role's length
before them; texts are read once.  Groups are counted before rows move, and
every join has one row per key on one side, so a hot turn, node or
conversation is a side that Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import runtime
from cairn.llm.scratch import Scratch

#: Ids in one piece of the list that a node's hash is taken of.
PIECE_IDS = 4096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Conversations of one family share its first one's head; a head has fewer turns than HEADS.
FAMILY = 20
HEADS = 4

_NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def numbered_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn_key``, ``words``: the turns of each conversation in order.

    Order is by turn, null first, ties by the turn's key; null roles and texts count as
    empty; equal rows are turns of their own; rows without conv_id belong to no
    conversation and are left out.  Rows are dealt by ranges of their order, so a long
    conversation lies in several parts, and a place is counted from its parts' sizes.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = scratch.cut(turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("turn_key"), n_words(text).alias("words")), "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_key"), F.col("at")]
    placed = scratch.cut(
        rows.withColumn("at", F.monotonically_increasing_id())
        .repartitionByRange(runtime.partitions_for(turns.sparkSession), *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33)).drop("at", "turn"), "placed")
    parts = placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(before, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("place") - F.col("first") + 1).alias("pos"), "turn_key", "words")


def with_family_heads(turns: DataFrame, scratch: Scratch, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % family, then has its own after its first h.

    h is the CRC-32 of c in decimals modulo ``heads``.  turns: a result of ``numbered_turns``,
    returned in the same form.  A head's turns that are not there are left out.  A family's
    first conversation meets fewer than twice ``family`` others.
    """
    turns = scratch.cut(turns, "numbered")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base, h = F.col("conv_id") - F.col("conv_id") % family, (F.crc32(F.col("conv_id").cast("string")) % heads).cast("long")
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    known = scratch.cut(
        sizes.select("conv_id", base.alias("base"), h.alias("h")).join(first, "base", "left")
        .select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("given")), "families")
    begun = turns.where(F.col("pos") < heads).withColumnRenamed("conv_id", "base").join(
        known.where("h > 0").select("conv_id", "base", "h"), "base").where("pos <= h")
    own = turns.join(known.select("conv_id", "h", "given"), "conv_id").where("pos > h").withColumn(
        "pos", F.col("pos") - F.col("h") + F.col("given"))
    # a conversation without a turn of its own left and without a head is one of no turns: its row has no key
    bare = known.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("long").alias("words"))
    columns = ["conv_id", "pos", "turn_key", "words"]
    return begun.select(*columns).unionByName(own.select(*columns)).unionByName(bare)


def prefix_trie(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 1, turn_key, words).

    ``conv_id``: smallest member; ``depth``; ``parent_conv_id`` (root: null); ``n_convs``:
    members; ``n_children``; ``n_leaves``: childless nodes of the subtree, its top included;
    ``saved_tokens``: words that the subtree's nodes save by being held once;
    ``ends_sha256``: SHA-256 of the ids of the conversations that end here, ascending,
    joined by commas.

    Rows of pos 0 stand for conversations that may have no turns.  No conversations give no
    nodes; one conversation gives a chain.
    """
    spark = turns.sparkSession
    runtime.prepare(spark)
    turns = scratch.cut(turns.sortWithinPartitions("pos"), "rebuilt")  # a level then reads its own pages
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("length"))
    live = scratch.cut(lengths, "live")
    root = live.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()
    if not root["n"]:
        return spark.createDataFrame([], _NODES)
    live = live.withColumn("node", F.lit(root["conv_id"]).cast("long"))
    top = spark.range(1).select(
        F.lit(root["conv_id"]).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("parent"), F.lit(root["n"]).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("length"))
    levels, ends = [top], [_ending(live, 0)]
    while True:
        depth = len(levels)
        step = scratch.cut(
            live.where(F.col("length") >= depth).join(turns.where(F.col("pos") == depth).select("conv_id", "turn_key", "words"), "conv_id"), "step")
        groups = scratch.cut(step.groupBy("node", "turn_key").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("length").alias("length")), "level")
        shared = groups.where("n_convs > 1").select("node", "turn_key", F.col("conv_id").alias("child"))
        live = scratch.cut(step.join(shared, ["node", "turn_key"]).select("conv_id", "length", F.col("child").alias("node")), "live")
        scratch.drop(step)
        # alone: its own chain ends it
        levels.append(groups.select("conv_id", F.col("node").alias("parent"), "n_convs", "words", F.when(F.col("n_convs") == 1, F.col("length")).alias("length")))
        if live.isEmpty():
            break
        ends.append(_ending(live, depth))
    rolled = _rolled_up(levels, scratch)
    hashes = _ends_hashes(_union(ends))
    alone = F.col("length").isNotNull()
    tops = rolled.join(hashes, (F.col("conv_id") == F.col("node")) & (F.col("depth") == F.col("end_depth")), "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.when(alone & (F.col("length") == F.col("depth")), _hash_of_one()).otherwise(F.coalesce("sha", F.lit(EMPTY_SHA256))).alias("ends_sha256"))
    chains = rolled.where(alone & (F.col("length") > F.col("depth"))).select("conv_id", F.col("depth").alias("from_depth"), "length")
    last = F.col("pos") == F.col("length")
    below = turns.join(chains, "conv_id").where("pos > from_depth").select(
        "conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(last, _hash_of_one()).otherwise(F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    return tops.unionByName(below)


def _hash_of_one() -> Column:
    return F.sha2(F.col("conv_id").cast("string"), 256)


def _ending(live: DataFrame, depth: int) -> DataFrame:
    return live.where(F.col("length") == depth).select(F.lit(depth).cast("long").alias("end_depth"), "node", "conv_id")


def _union(tables: list[DataFrame]) -> DataFrame:
    """Union by halves, so that the plan of many levels stays flat."""
    while len(tables) > 1:
        tables = [a.unionByName(b) for a, b in zip(tables[::2], tables[1::2])] + ([tables[-1]] if len(tables) % 2 else [])
    return tables[0]


def _rolled_up(levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """Nodes of all levels with children, leaves and savings, from the deepest level up."""
    done: list[DataFrame] = []
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth].withColumn("depth", F.lit(depth).cast("long"))
        own = (F.col("n_convs") - 1) * F.col("words")
        alone = F.col("length").isNotNull()
        if done:
            kids = done[-1].groupBy(F.col("parent").alias("top")).agg(
                F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            level = level.join(kids, F.col("conv_id") == F.col("top"), "left")
        else:
            level = level.withColumns({c: F.lit(None).cast("long") for c in ("kids", "leaves", "saved")})
        # a node that is alone at its depth has no group below it; its chain is known
        level = level.select(
            "conv_id", "depth", "parent", "n_convs", "length",
            F.when(alone, (F.col("length") > depth).cast("long")).otherwise(F.coalesce("kids", F.lit(0))).alias("n_children"),
            F.when(alone, 1).otherwise(F.coalesce("leaves", F.lit(1))).cast("long").alias("n_leaves"),
            F.when(alone, 0).otherwise(own + F.coalesce("saved", F.lit(0))).cast("long").alias("saved_tokens"))
        done.append(scratch.cut(level, "rolled"))
    return _union(done)


_PIECES = "end_depth long, node long, first long, ids string"
_PIECES_ARROW = pa.schema([("end_depth", pa.int64()), ("node", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_HASHES_ARROW = pa.schema([("end_depth", pa.int64()), ("node", pa.int64()), ("sha", pa.string())])


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """``end_depth``, ``node``, ``sha``: the hash of each node's ending ids in order.

    Ids are joined into pieces where ranges of the order lie, so a node with very many ends is
    spread; then one task streams a node's pieces through its hash, a piece at a time, since a
    hash of one text can be taken in one place only.
    """
    parts = runtime.partitions_for(ends.sparkSession)
    order = ["end_depth", "node", "conv_id"]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            depth, node, conv = (runtime.numbers(b.column(i)) for i in range(3))
            new = np.flatnonzero((depth[1:] != depth[:-1]) | (node[1:] != node[:-1])) + 1
            cuts = np.union1d(np.append(new, [0, len(conv)]), np.arange(0, len(conv), PIECE_IDS))
            at = cuts[:-1]
            texts = [",".join(map(str, conv[i:j].tolist())) for i, j in zip(at, cuts[1:])]
            yield runtime.batch(_PIECES_ARROW, end_depth=depth[at], node=node[at], first=conv[at], ids=texts)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for b in batches:
            found = []
            for depth, node, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if (depth, node) != current:
                    if current:
                        found.append((*current, state.hexdigest()))
                    current, state = (depth, node), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _hash_rows(found)
        if current:
            yield _hash_rows([(*current, state.hexdigest())])

    pieces = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(join_ids, _PIECES)
    return pieces.repartition(parts, "end_depth", "node").sortWithinPartitions("end_depth", "node", "first").mapInArrow(
        digest, "end_depth long, node long, sha string")


def _hash_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    depth, node, sha = zip(*rows) if rows else ((), (), ())
    return runtime.batch(_HASHES_ARROW, end_depth=list(depth), node=list(node), sha=list(sha))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of whole conversations as they are (conv_id, turn, role, text).

    Null roles and texts count as empty, null turns come first, rows without conv_id are left
    out, repeated rows are turns of their own; an empty table gives no nodes; further columns,
    whatever their names, are not read.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    return prefix_trie(numbered_turns(conversations, scratch), scratch)


def family_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``conversation_trie`` after each conversation took over its family's head (``with_family_heads``)."""
    scratch = Scratch(conversations.sparkSession, "trie")
    return prefix_trie(with_family_heads(numbered_turns(conversations, scratch), scratch, family, heads), scratch)
