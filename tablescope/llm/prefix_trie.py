"""Prefix trie of conversations by a van Emde Boas recursion.

A subproblem is a node (its root) and what sequences hold in the next 2^(j+1)
turns below it. It is cut at half its depth: sequences that agree in the upper
2^j turns are given one name, the node there. The upper half is left with one
sequence per name, the lower halves with the names as their roots, and both are
subproblems of the next round, whose rounds take all of them side by side. So
the depth of the trie costs as many rounds as its logarithm:

1. Turns are numbered in their conversations; digests of aligned blocks of
   2^j turns come from those of their halves.
2. From the largest j down, ``root, digest of the upper block`` is a node's
   name, found with the smallest conversation and the number of those through
   it by one aggregation a round. A sequence enters at the round of its own
   length. A sequence that ends with a known node below keeps that node's name,
   so every round also gives the edges from a lower half's root to its end.
3. Totals are grafted upward: first each node at a cut gathers what lies within
   its window of turns, smallest windows first; then, largest first, a node
   adds the whole totals of the ends of its window.

A conversation, a turn or a node may hold a third of all rows: turns of one
conversation are numbered and paired over many tasks, equal turns and the
children of one node meet in map-side aggregates only, and ids are joined to
text for their digest in ranges. The last digest of a node is one pass over
its texts of ids, as SHA-256 takes them one after the other.

Defined results: turns are ordered by their order column, nulls first, equal
ones by the digest of role and text; repeated rows are turns each. A null role
or text is empty. Rows without a conversation id belong to none and are left
out. Turns are equal if the SHA-256 of role and text is. Other columns are
ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescope.llm.skew import join_by_group
from tablescope.session import materialize, materialize_observed, scratch

#: Ids joined to one text at most before they are digested.
CHUNK = 1 << 14


def _root_name() -> Column:
    return F.lit("").cast("binary")


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _in_order(rows: DataFrame, *by: str) -> DataFrame:
    """Tasks of neighbouring rows, in order; equal rows are spread over tasks."""
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    return rows.repartitionByRange(*by, "tie").sortWithinPartitions(*by, "tie").drop("tie")


# ---------------------------------------------------------------------------
# Turns
# ---------------------------------------------------------------------------

def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's place among its task's rows of the same conversation."""
    task, last, n = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        at = []
        for conv in batch.column("conv").to_pylist():
            n = n + 1 if conv == last else 0
            last = conv
            at.append(n)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "dig", "chars")),
                                          pa.array([task] * len(at), pa.int64()), pa.array(at, pa.int64())],
                                         names=["conv", "dig", "chars", "task", "at"])


def numbered_turns(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 0), ``dig`` (of role and text) and ``chars``
    (code points of the text) of every turn; two written tables."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = materialize(turns.where(F.col(id_col).cast("long").isNotNull())
                       .select(F.col(id_col).cast("long").alias("conv"), F.col(order_col).alias("turn"),
                               _digest(F.sha2(role, 256), F.sha2(text, 256)).alias("dig"),
                               F.length(text).cast("long").alias("chars")))
    placed = materialize(_in_order(rows, "conv", "turn", "dig")
                         .mapInArrow(_place, "conv long, dig binary, chars long, task long, at long"))
    counts = placed.groupBy("conv", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # Only the conversation that a task begins with can have rows before it: one per task.
    before = materialize(counts.select("conv", "task", F.sum("n").over(earlier).alias("before")).where("before > 0"))
    return (placed.join(F.broadcast(before), ["conv", "task"], "left")
            .select("conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "dig", "chars"))


def shared_openings(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Every conversation c of ``turns`` (see :func:`numbered_turns`) with the
    first h turns of conversation c - c % ``group`` in place of its own, h =
    crc32(decimal c) % ``most``: all of them if there are fewer, none if there
    is no such conversation. Returns the new turns and ``(conv, len)`` of all
    conversations, also those left without a turn."""
    turns = materialize(turns)
    sizes, seen = materialize_observed(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), rows=F.sum("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = sizes.select("conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"), h.alias("h"))
    base = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    # A base has at most 2 * group conversations, so no base is a hot key.
    convs = materialize(convs.join(base, "base", "left").select(
        "conv", "n", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")))
    heads = turns.where((F.col("conv") % group == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    opening = (convs.where("conv != base and taken > 0").select("conv", "base", "taken").join(heads, "base")
               .where("pos < taken").select("conv", "pos", "dig", "chars"))
    own = (join_by_group(turns, convs, "conv", "n", seen["rows"] or 0).where("conv = base or pos >= h")
           .select("conv", F.when(F.col("conv") == F.col("base"), F.col("pos"))
                   .otherwise(F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "dig", "chars"))
    size = F.when(F.col("conv") == F.col("base"), F.col("n")).otherwise(
        F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    return own.unionByName(opening), convs.select("conv", size.alias("len"))


# ---------------------------------------------------------------------------
# Naming: cuts at half depth
# ---------------------------------------------------------------------------

def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """``conv, i, dig`` of every whole block i of 2^j turns, per level j."""
    out = [turns.select("conv", F.col("pos").alias("i"), "dig")]
    for _ in range(1, levels):
        left, right = (F.max(F.when(F.col("i") % 2 == side, F.col("dig"))) for side in (0, 1))
        pairs = (out[-1].groupBy("conv", F.shiftright("i", 1).alias("up")).agg(left.alias("l"), right.alias("r"))
                 .where("l is not null and r is not null"))
        out.append(materialize(pairs.select("conv", F.col("up").alias("i"), _digest(F.col("l"), F.col("r")).alias("dig"))))
    return out


def _named(blocks: list[DataFrame], members: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per level j the sequences cut there (``root, base, conv, w, upto, end,
    node, next``: ``w`` conversations run from depth ``base`` below ``root`` to
    depth ``upto``, where ``end`` is the node if it is known; ``node`` is the
    cut, ``next`` the level of what lies below it), and the nodes named there
    (``node, root, base, conv, n``). ``level`` of an extent is that of its
    highest bit."""
    def level(extent: Column) -> Column:
        return F.length(F.bin(extent)) - 1

    no_end = F.lit(None).cast("binary")
    start = members.where("len > 0").select(
        _root_name().alias("root"), F.lit(0).cast("long").alias("base"), "conv", F.lit(1).cast("long").alias("w"),
        F.col("len").alias("upto"), no_end.alias("end"), level(F.col("len")).alias("next"))
    columns = ["root", "base", "conv", "w", "upto", "end"]
    cut, nodes = [None] * len(blocks), [None] * len(blocks)
    for j in reversed(range(len(blocks))):
        half = 1 << j
        waiting = [start] + [_lower(cut[k], k) for k in range(j + 1, len(blocks))]
        if j + 1 < len(blocks):
            waiting.append(nodes[j + 1].select("root", "base", "conv", F.col("n").alias("w"),
                                               (F.col("base") + 2 * half).alias("upto"), F.col("node").alias("end"),
                                               F.lit(j).alias("next")))
        rows = _union([w.where(F.col("next") == j).select(columns) for w in waiting])
        block = blocks[j].withColumnRenamed("conv", "c")
        named = rows.join(block, (F.col("conv") == F.col("c")) & (F.shiftright("base", j) == F.col("i")))
        below = F.col("upto") - F.col("base") - half
        cut[j] = materialize(named.select(
            *columns, _digest(F.col("root"), F.col("dig")).alias("node"),
            F.when(F.col("end").isNotNull(), j - 1).when(below > 0, level(below)).otherwise(-1).alias("next")))
        nodes[j] = materialize(cut[j].groupBy("node", "root", "base")
                               .agg(F.min("conv").alias("conv"), F.sum("w").alias("n")))
    return cut, nodes


def _lower(cut: DataFrame, j: int) -> DataFrame:
    """What lies below the cuts of level j."""
    return cut.select(F.col("node").alias("root"), (F.col("base") + (1 << j)).alias("base"), "conv", "w", "upto", "end",
                      "next").where("upto > base")


# ---------------------------------------------------------------------------
# Totals, grafted upward
# ---------------------------------------------------------------------------

def _totals(values: DataFrame, cut: list[DataFrame]) -> DataFrame:
    """``node, leaves, saved`` summed over each node's subtree; ``values`` has
    them per node, with its ``level`` and the ``root`` at its window's top."""
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    levels = len(cut)
    windows, current = [], values
    for j in range(levels):  # what lies within 2^j turns below each node
        own = current.where(F.col("level") == j)
        windows.append(own.select("node", "leaves", "saved"))
        up = own.select(F.col("root").alias("node"), F.lit(None).cast("binary").alias("root"),
                        F.lit(None).cast("int").alias("level"), "leaves", "saved")
        current = materialize(current.where(F.col("level") > j).unionByName(up)
                              .groupBy("node").agg(F.max("root").alias("root"), F.max("level").alias("level"), *sums))
    done = [current.select("node", "leaves", "saved")]
    for j in reversed(range(levels)):  # the whole totals of the windows' ends
        ends = cut[j].where("end is not null").select(F.col("node").alias("top"), F.col("end").alias("node"))
        below = ends.join(_union(done), "node").select(F.col("top").alias("node"), "leaves", "saved")
        done.append(materialize(windows[j].unionByName(below).groupBy("node").agg(*sums)))
    return _union(done)


# ---------------------------------------------------------------------------
# Digests of members
# ---------------------------------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list]]:
    """Neighbouring ids of one node, at most CHUNK of them."""
    node, ids = None, []
    for batch in batches:
        for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (key != node or len(ids) == CHUNK):
                yield node, ids
                ids = []
            node = key
            ids.append(conv)
    if ids:
        yield node, ids


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = _runs(batches)
    while some := list(islice(runs, 1024)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([node for node, _ in some], pa.binary()), pa.array([ids[0] for _, ids in some], pa.int64()),
             pa.array([",".join(map(str, ids)) for _, ids in some])], names=["node", "first", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([d for _, d in done])],
                                          names=["node", "ends_sha256"])

    last, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest is not None and node == last:
                digest.update(b",")
            else:
                if digest is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield out(done)
    if digest is not None:
        yield out([(last, digest.hexdigest())])


def _ends_digest(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the conversations that end at each node."""
    joined = (ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").select("node", "conv")
              .mapInArrow(_join_ids, "node binary, first long, ids string"))
    return (joined.repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(_hash_ids, "node binary, ends_sha256 string"))


# ---------------------------------------------------------------------------

def build(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie of ``turns`` (``conv, pos, dig, chars``, positions without
    gaps) of ``members`` (``conv, len``), one row per node: ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Runs its rounds when it is called; their tables are deleted at the end, and
    the result is a table in the checkpoint folder."""
    with scratch(members.sparkSession):
        return materialize(_build(materialize(turns), materialize(members)), keep=True)


def _build(turns: DataFrame, members: DataFrame) -> DataFrame:
    all_of = members.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.max("len").alias("most")).first()
    levels = (all_of["most"] or 0).bit_length()
    top = members.sparkSession.range(1 if all_of["n"] else 0).select(
        _root_name().alias("node"), F.lit(None).cast("binary").alias("root"), F.lit(None).cast("binary").alias("parent"),
        F.lit(levels).alias("level"), F.lit(0).cast("long").alias("depth"), F.lit(all_of["conv"]).cast("long").alias("conv"),
        F.lit(all_of["n"]).cast("long").alias("n"))
    ends = members.where("len = 0").select(_root_name().alias("node"), "conv")
    if not levels:
        nodes = top.withColumns({"chars": F.lit(0).cast("long"), "n_children": F.lit(0).cast("long")})
        return _result(nodes, nodes.select("node", F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")),
                       ends, 0)
    cut, named = _named(_blocks(turns, levels), members)
    # The parent of a node is its window's top at level 0, else the lower root of its last turn.
    last = cut[0].where("end is not null").select(F.col("end").alias("node"), F.col("node").alias("parent"))
    nodes = _union([n.select("node", "root", F.lit(j).alias("level"), (F.col("base") + (1 << j)).alias("depth"), "conv", "n")
                    for j, n in enumerate(named)])
    nodes = nodes.join(last, "node", "left").withColumn("parent", F.coalesce("parent", "root"))
    length = turns.select("conv", (F.col("pos") + 1).alias("depth"), "chars")
    nodes = nodes.join(length, ["conv", "depth"]).unionByName(top.withColumn("chars", F.lit(0).cast("long")))
    nodes, seen = materialize_observed(nodes, rows=F.count(F.lit(1)))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, "node", "left").fillna(0, ["n_children"]))
    values = nodes.select("node", "root", "level", (F.col("n_children") == 0).cast("long").alias("leaves"),
                          ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    ends = _union([ends] + [c.where(f"end is null and upto = base + {1 << j}").select("node", "conv")
                            for j, c in enumerate(cut)])
    return _result(nodes, _totals(values, cut), ends, seen["rows"])


def _result(nodes: DataFrame, totals: DataFrame, ends: DataFrame, rows: int) -> DataFrame:
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"),
                                                   F.col("n_children").alias("below"))
    plain = nodes.drop("root", "level", "chars")
    known = (join_by_group(plain.where("parent is not null"), parents, "parent", "below", rows).drop("below")
             .unionByName(plain.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))))
    nothing = hashlib.sha256(b"").hexdigest()
    return (known.join(totals, "node").join(_ends_digest(ends), "node", "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, group: int = 100, most: int = 6, **columns: str) -> DataFrame:
    """:func:`build` over the conversations of a table, rebuilt by
    :func:`shared_openings`; ``columns`` go to :func:`numbered_turns`."""
    with scratch(conversations.sparkSession):
        turns, members = shared_openings(numbered_turns(conversations, **columns), group, most)
        return materialize(_build(materialize(turns), materialize(members)), keep=True)
