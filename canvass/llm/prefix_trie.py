"""Operator 11: the trie of conversation prefixes, by prefix doubling.

Every distinct turn gets a dense number.  Blocks of 2, 4, 8, ... turns, each at a multiple of its size, get the
number of their pair of halves, so equal blocks have equal numbers after a logarithmic number of rounds and
linear work.  A prefix is a chain of such blocks, one for each binary digit of its length: from the highest
digit down, a prefix and the block that follows it get the number of this pair.  Prefixes of one number are one
node.  Sums over subtrees double likewise: in round k each node hands what it has to the ancestor 2**k above.

No conversation and no node is ever gathered: rows are (conversation, place), dealt out by both, and numbers
that many rows share meet them by broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import SMALL_ROWS, spread_join
from ..storage import discard, saved

#: A conversation takes the first turns of conversation c - c % FAMILY, crc32(c) % HEADS of them.
FAMILY, HEADS = 5, 9
#: Prefix numbers are spread so that each round has its own: number * ROUNDS + round.
ROUNDS = 64
ROOT = 0


def _place_in_part():
    return F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))


def numbered(rows: DataFrame, *same: str, known_small: bool | None = None) -> DataFrame:
    """``rows`` with ``name`` in place of the columns ``same``: rows that agree in these have one number, 1, 2, ...

    Distinct values are counted where they lie; a value's number is the count of those in earlier partitions
    plus its place in its own, so nothing is sorted and no task sees all.  The table of counts has a row a
    partition.  Nulls are values like others.
    """
    paired = saved(rows.withColumn("_same", F.struct(*same)).drop(*same), "paired")
    distinct = saved(paired.groupBy("_same").agg(F.count("*").alias("_n")).withColumn("_at", F.monotonically_increasing_id()), "distinct")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = distinct.groupBy(part.alias("_part")).agg(F.count("*").alias("_held"))
    first = parts.select("_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_first"))
    names = distinct.withColumn("_part", part).join(F.broadcast(first), "_part").select("_same", "_n", (F.col("_first") + _place_in_part() + 1).alias("name"))
    if not known_small:
        names = saved(names, "names")
    done = saved(spread_join(paired, names, "_same", known_small=known_small, counted="_n").drop("_same", "_n"), "named")
    discard(paired, distinct, names)
    return done


def placed(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, name, bytes): each conversation's turns in order, numbered from 1, equal turns with one name.

    Order is by turn (null first), ties by role and a digest of role and text; repeated rows are turns of their
    own.  Null roles and texts become empty; rows without a conversation belong to none and are left out.
    Rows are dealt by ranges of (conversation, turn), so a conversation of any length spreads over tasks; its
    turns in earlier partitions are counted, not moved.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    order = ["conv_id", "turn", "role", "digest"]
    sorted_rows = saved(saved(rows, "turns").repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "bytes", F.monotonically_increasing_id().alias("_at")), "sorted")
    sorted_rows = sorted_rows.withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = sorted_rows.groupBy("conv_id", "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    runs = runs.select("conv_id", "_part", "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    pos = F.col("_at") - F.col("_start") + F.col("_before") + 1
    return numbered(sorted_rows.join(runs, ["conv_id", "_part"]).select("conv_id", pos.alias("pos"), "digest", "bytes"), "digest")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count("*").alias("n"))


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Saved turns (conv_id, pos, name, bytes) and conversations (conv_id, n), each with the head of its family.

    Conversation c has the first h turns of conversation c - c % family (all if there are fewer, none if it is
    not there), then its own after its first h; h = crc32 of c's decimal digits % heads.  It may have none.
    Remainders of negative ids are negative, as in SQL.
    """
    c = F.col("conv_id")
    own = saved(lengths(turns).select(c, "n", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("h")), "own")
    bases = own.select(c.alias("base"), F.col("n").alias("base_n"))
    convs = saved(own.join(bases, "base", "left").select("conv_id", "n", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "convs")
    head = turns.where(F.col("pos") < heads).withColumnRenamed("conv_id", "base").join(convs.where("h > 0").select("conv_id", "base", "h"), "base").where("pos <= h")
    tail = spread_join(turns, convs.select("conv_id", "h", "taken", "n"), "conv_id", counted="n").where("pos > h").withColumn("pos", F.col("taken") + F.col("pos") - F.col("h"))
    names = ["conv_id", "pos", "name", "bytes"]
    done = saved(head.select(*names).unionByName(tail.select(*names)), "rebuilt")
    discard(own)
    return done, convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def prefixes(turns: DataFrame, convs: DataFrame, longest: int, few: bool | None) -> DataFrame:
    """Saved (conv_id, depth, name) of every prefix with a turn; equal prefixes have one name."""
    blocks = [turns.select("conv_id", (F.col("pos") - 1).alias("at"), "name")]
    top = longest.bit_length() - 1
    for k in range(1, top + 1):
        half = F.shiftright("at", k - 1).bitwiseAND(F.lit(1))
        pairs = blocks[-1].groupBy("conv_id", F.shiftleft(F.shiftright("at", k), k).alias("_block"))
        pairs = pairs.agg(F.max(F.when(half == 0, F.col("name"))).alias("left"), F.max(F.when(half == 1, F.col("name"))).alias("right"))
        whole = pairs.where(F.col("right").isNotNull()).withColumnRenamed("_block", "at")
        blocks.append(numbered(whole, "left", "right", known_small=few))
    found: list[DataFrame] = []
    for k in range(top, -1, -1):
        start = convs.where(F.col("n") >= 1 << k).select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).cast("long").alias("prefix"))
        known = reduce(DataFrame.unionByName, [f.withColumnRenamed("name", "prefix") for f in found], start)
        longer = known.join(blocks[k].select("conv_id", F.col("at").alias("depth"), F.col("name").alias("block")), ["conv_id", "depth"])
        step = numbered(longer.withColumn("depth", F.col("depth") + (1 << k)), "prefix", "block", known_small=few)
        found.append(step.select("conv_id", "depth", (F.col("name") * ROUNDS + k).alias("name")))
        if k:
            discard(blocks[k])
    if not found:
        return turns.select("conv_id", F.col("pos").alias("depth"), "name").limit(0)
    return saved(reduce(DataFrame.unionByName, found), "prefixes")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node that stand together, as one text; rows come sorted by node and id."""
    for batch in batches:
        if not batch.num_rows:
            continue
        name, ids = batch.column(0).to_numpy(), batch.column(2).to_pylist()
        first = np.concatenate([[0], np.flatnonzero(np.diff(name)) + 1])
        texts = [",".join(ids[a:b]) for a, b in zip(first, [*first[1:], len(ids)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(name[first]), batch.column(1).take(pa.array(first)), pa.array(texts, pa.string())], names=["name", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of a node's texts in order, comma-joined, as a stream: a node's ids are never held together."""
    last, digest = None, None

    def made(done: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["name", "ends_sha256"])

    for batch in batches:
        done = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if name != last:
                if digest:
                    done.append((last, digest.hexdigest()))
                last, digest = name, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield made(done)
    if digest:
        yield made([(last, digest.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of ``ends`` (name, conv_id): the ids of a node, ascending, comma-joined, hashed.

    Ranges of (node, id) join runs of ids in parallel; then a node's runs pass one task as a stream, since the
    digest is sequential by its definition.
    """
    order = ["name", "conv_id"]
    kind = ends.schema["conv_id"].dataType.simpleString()
    runs = ends.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, F.col("conv_id").cast("string").alias("id")).mapInArrow(_joined, f"name long, first {kind}, ids string")
    return runs.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_hashed, "name long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row a node of the conversations ``convs`` (conv_id, n) with ``turns`` (conv_id, pos, name, bytes), both saved.

    conv_id: smallest member; depth; parent_conv_id; n_convs, members; n_children; n_leaves, childless nodes of
    the subtree; saved_tokens, summed over the subtree, (n_convs - 1) times the bytes of a node's last turn;
    ends_sha256, digest of the ids that end here.  The root has depth 0, no turn and no parent.  Without
    conversations there are no nodes.
    """
    size = convs.agg(F.max("n").alias("longest"), F.sum("n").alias("n")).first()
    longest = size["longest"] or 0
    few = True if (size["n"] or 0) <= SMALL_ROWS else None  # distinct names are no more than turns
    found = prefixes(turns, convs, longest, few)
    nodes = found.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = nodes.unionByName(root.select(F.lit(ROOT).cast("long").alias("name"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs"))
    above = found.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = nodes.join(turns.select("conv_id", F.col("pos").alias("depth"), "bytes"), ["conv_id", "depth"], "left").join(above, ["conv_id", "depth"], "left")
    nodes = saved(nodes.withColumn("parent", F.when(F.col("depth") == 1, F.lit(ROOT).cast("long")).otherwise(F.col("parent"))), "nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    state = saved(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0))}), "nodes")
    up = 1
    while up <= longest:
        below = state.where(F.col("depth") >= up).select("conv_id", (F.col("depth") - up).alias("depth"), "n_leaves", "saved_tokens")
        to = below.join(found, ["conv_id", "depth"], "left").withColumn("name", F.coalesce("name", F.lit(ROOT)))
        more = to.groupBy("name").agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_tokens"))
        grown = state.join(more, "name", "left").withColumns({"n_leaves": F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)), "saved_tokens": F.col("saved_tokens") + F.coalesce("_tokens", F.lit(0))})
        grown = saved(grown.drop("_leaves", "_tokens"), "nodes")
        discard(state)
        state, up = grown, 2 * up
    full = convs.where("n > 0").join(found.withColumnRenamed("depth", "n"), ["conv_id", "n"]).select("name", "conv_id")
    digests = end_digests(saved(full.unionByName(convs.where("n = 0").select(F.lit(ROOT).cast("long").alias("name"), "conv_id")), "ends"))
    parents = state.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    rows = spread_join(state, parents, "parent", "left", counted="_n").join(digests, "name", "left")
    empty = hashlib.sha256(b"").hexdigest()
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    return rows.select("conv_id", "depth", "parent_conv_id", *counts, F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def tree(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text) as they are."""
    turns = placed(conversations)
    return trie(turns, saved(lengths(turns), "lengths"))


def report(conversations: DataFrame) -> DataFrame:
    """The contract's rows: the trie of all conversations, each rebuilt with the head of its family.

    Null turns come first, ties go by role and a digest of role and text, repeated rows are turns of their own;
    null roles and texts are empty, rows without a conversation are left out, texts of any length count whole
    (as a digest), other columns are not read, no rows give no nodes.
    """
    turns = placed(conversations)
    return trie(*rebuilt(turns))
