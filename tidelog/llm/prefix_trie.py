"""A trie of conversation prefixes, without a row per conversation and prefix.

Identical conversations collapse into one weighted sequence with the list of those that
end there. A sequence that is a proper prefix of another one is found by an anti-join;
the others are the leaves. Only different sequences are spread out into their prefixes,
and the weighted prefixes are aggregated into nodes.

A prefix is known by two 64-bit numbers: the exclusive or, over its turns, of hashes of
place, role and MD5 of the text, so that all prefixes of a conversation come from one
running aggregate. Sums over subtrees need no pairs of nodes either. The node values
``(members - 1) * bytes`` add up to the members' bytes below a node, which each sequence
knows from its own turns, less the bytes of the different nodes below; every node
belongs to the sequence with the smallest member through it, and a sequence owns a
suffix of its path, so that each sequence adds its own part at each of its prefixes.

A common prefix is never gathered: its row comes from partial aggregates, parents with
many children are broadcast (fewer than ``HOT_PARENTS``, whatever the data), and the
list of a node's ends is hashed as a stream of blocks that are joined before. The turns
of one conversation are sorted in one task, with spill, and never collected.

Cases: null turns come first, equal turn numbers are ordered by role and MD5 of the
text, so repeated rows are repeated turns; null role or text becomes empty; rows
without a conversation id take no part; a conversation without turns is a member of the
root; an empty table has no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialize
from tidelog.storage import ship_package

# Parents that are broadcast; ids that are joined into one text before they are hashed.
HOT_PARENTS, BLOCK = 1000, 4096

NODE = ["fp1", "fp2", "depth"]
# Order of the rows of a conversation: a mark that it is there, borrowed turns, own turns.
MARK, BORROWED, OWN = 0, 1, 2


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos`` (from 1), ``role, digest, n_bytes`` of every turn of ``conversations``
    (``conv_id, turn, role, text``). The texts themselves are not shuffled."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "role", "digest", "n_bytes")


def rebuild(turns: DataFrame, group: int, folds: int) -> DataFrame:
    """Rows of rebuilt conversations, from :func:`ordered_turns`: the first ``h`` turns of the
    conversation ``c - c % group``, then those of ``c`` after its own first ``h``, with
    ``h = crc32(decimal c) % folds``. Every conversation has a mark, turns or not."""
    turns = materialize(turns, "trie-turns")
    borrowed_turns = F.crc32(F.col("conv_id").cast("string").cast("binary")) % folds
    columns = ["conv_id", "kind", "pos", "role", "digest", "n_bytes"]
    nothing = [F.lit(MARK).alias("kind"), F.lit(0).alias("pos"), F.lit("").alias("role"), F.lit("").alias("digest"),
               F.lit(0).cast("long").alias("n_bytes")]
    marks = turns.filter("pos = 1").select("conv_id", *nothing)
    own = turns.filter(F.col("pos") > borrowed_turns).withColumn("kind", F.lit(OWN)).select(*columns)
    # Ids of one base are neighbours: below it for negative ones, above it else.
    base = F.col("conv_id")
    step = F.when(base < 0, F.sequence(F.lit(1 - group), F.lit(0))).when(
        base > 0, F.sequence(F.lit(0), F.lit(group - 1))).otherwise(F.sequence(F.lit(1 - group), F.lit(group - 1)))
    lent = (
        turns.filter((base % group == 0) & (F.col("pos") < folds))
        .withColumn("step", F.explode(step)).withColumn("conv_id", F.col("conv_id") + F.col("step"))
        .filter(F.col("pos") <= borrowed_turns).withColumn("kind", F.lit(BORROWED)).select(*columns)
    )
    return marks.unionByName(lent).unionByName(own)


def _paths(rows: DataFrame) -> DataFrame:
    """Every prefix of every conversation: its key and its parent's, bytes of the last turn and
    of the prefix, and whether the conversation ends there."""
    order = Window.partitionBy("conv_id").orderBy("kind", "pos")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({
        "depth": (F.row_number().over(order) - 1).cast("long"),
        "is_there": F.first("kind").over(running) == MARK,
        "is_last": F.lead("kind").over(order).isNull(),
        "total": F.sum("n_bytes").over(running),
    }).filter("is_there")

    def key(salt: int) -> Column:
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(salt), "depth", "role", "digest"))

    hashed = placed.withColumns({"h1": key(1), "h2": key(2)})
    return hashed.withColumns({"fp1": F.bit_xor("h1").over(running), "fp2": F.bit_xor("h2").over(running)}).select(
        "conv_id", *NODE, F.col("fp1").bitwiseXOR(F.col("h1")).alias("up1"), F.col("fp2").bitwiseXOR(F.col("h2")).alias("up2"),
        "n_bytes", "total", "is_last",
    )


# --- hashes of the ends -----------------------------------------------------------


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted members of nodes to comma-joined texts of at most ``BLOCK`` ids."""
    key, first, ids, out = None, None, [], []

    def flush() -> None:
        if ids:
            out.append((*key, first, ",".join(map(str, ids))))

    for batch in batches:
        for f1, f2, depth, c in zip(*(column.to_pylist() for column in batch.columns)):
            if (f1, f2, depth) != key or len(ids) == BLOCK:
                flush()
                key, first, ids = (f1, f2, depth), c, []
            ids.append(c)
        if out:
            yield _table(out, [pa.int64()] * 4 + [pa.string()], [*NODE, "first", "ids"])
            out = []
    flush()
    if out:
        yield _table(out, [pa.int64()] * 4 + [pa.string()], [*NODE, "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks of nodes to one SHA-256 per node, kept over batches."""
    key, state, out = None, None, []

    def flush() -> None:
        if key is not None:
            out.append((*key, state.hexdigest()))

    for batch in batches:
        for f1, f2, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if (f1, f2, depth) != key:
                flush()
                key, state = (f1, f2, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _table(out, [pa.int64()] * 3 + [pa.string()], [*NODE, "ends_sha256"])
            out = []
    flush()
    if out:
        yield _table(out, [pa.int64()] * 3 + [pa.string()], [*NODE, "ends_sha256"])


def _table(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _ends(paths: DataFrame) -> DataFrame:
    """``ends_sha256`` of every node at which a conversation ends. Ids are spread by range, so
    the members of a common node are joined by many tasks; its blocks are hashed in order."""
    members = paths.filter("is_last").select(*NODE, "conv_id")
    blocks = (
        members.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
        .mapInArrow(_joined, "fp1 long, fp2 long, depth long, first long, ids string")
    )
    return (
        blocks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
        .mapInArrow(_hashed, "fp1 long, fp2 long, depth long, ends_sha256 string")
    )


# --- the trie ---------------------------------------------------------------------


def prefix_trie(rows: DataFrame) -> DataFrame:
    """Nodes of the trie of the conversations in ``rows`` (see :func:`rebuild`)."""
    ship_package(rows.sparkSession)
    paths = materialize(_paths(rows), "trie-paths")

    sequences = paths.filter("is_last").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.min("total").alias("all_bytes")
    )
    sequences = materialize(sequences, "trie-sequences")
    own = paths.select("conv_id", *NODE, "up1", "up2", "n_bytes", "total", "is_last")
    spread = materialize(own.join(sequences.select("conv_id", "weight", "all_bytes"), "conv_id"), "trie-spread")
    inner = spread.filter("NOT is_last").select(*NODE).distinct()
    leaves = sequences.join(inner, NODE, "left_anti").select("conv_id", F.lit(1).alias("is_leaf"))

    # The sequence with the smallest member owns a node, and with it all deeper ones of its path.
    owners = (
        spread.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.min("n_bytes").alias("n_bytes"))
        .groupBy("conv_id").agg(F.min("depth").alias("own_from"), F.sum("n_bytes").alias("own_bytes"))
    )
    facts = sequences.select("conv_id").join(leaves, "conv_id", "left").join(owners, "conv_id", "left")
    below = F.col("all_bytes") - F.col("total") + F.col("n_bytes")
    counted = (
        spread.join(facts, "conv_id")
        .withColumn("own_below", F.when(F.col("own_from") <= F.col("depth"), below).otherwise(F.coalesce("own_bytes", F.lit(0))))
        .withColumn("saved", F.col("weight") * below - F.col("own_below"))
    )
    nodes = counted.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.min("up1").alias("up1"), F.min("up2").alias("up2"),
        F.sum(F.coalesce("is_leaf", F.lit(0))).cast("long").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    nodes = materialize(nodes, "trie-nodes")

    children = (
        nodes.filter("depth > 0").groupBy(F.col("up1").alias("fp1"), F.col("up2").alias("fp2"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = materialize(
        nodes.join(children, NODE, "left").join(_ends(paths), NODE, "left").withColumns({
            "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
        }), "trie-full",
    )
    return _with_parents(nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``. Fewer than ``HOT_PARENTS`` nodes have over a
    ``HOT_PARENTS``-th of all children; these are broadcast, the others joined by key."""
    many = nodes.count() / HOT_PARENTS
    parents = nodes.filter("n_children > 0").select(
        F.col("fp1").alias("up1"), F.col("fp2").alias("up2"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    keys = ["up1", "up2", "depth"]
    hot = parents.filter(F.col("n_children") > many).drop("n_children")
    cold = parents.filter(F.col("n_children") <= many).drop("n_children")
    below = nodes.filter("depth > 0")
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        root.unionByName(below.join(F.broadcast(hot), keys).select(*root.columns))
        .unionByName(below.join(F.broadcast(hot), keys, "left_anti").join(cold, keys).select(*root.columns))
    )
