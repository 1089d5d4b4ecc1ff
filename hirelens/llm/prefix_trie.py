"""The trie of conversation prefixes, built by van Emde Boas recursion.

A conversation is a sequence of turns; each distinct sequence of first turns is a node. The height
is cut at half depth: the prefix above the cut is named, which gives the upper trie its leaves and
the forest below the cut its roots, and both halves are cut again. All tries of a height are worked
on in one round of joins, so a trie of height H takes log2(H) rounds, not H.

* **Name.** In the round of size s, each conversation contributes one row for every block of 2s
  turns it reaches the middle of: the name of the node at the start of the block and a 128-bit hash
  of the s turns from there. Conversations that agree in both share the prefix; the smallest of
  them is the name of the node. The hash is an ``xor`` over turns that depends on their places, so
  Spark combines it before the shuffle, however long a conversation is.
* **Graft.** Totals of subtrees are built the other way round, from the smallest blocks to the whole
  height: a tree of the lower forest adds its root's totals to that root's ancestors in the upper
  trie, which are found as the nodes of the conversation that names the root.

Turns are numbered by a range sort over (conversation, turn) with one offset per partition, so a
conversation that holds a third of all rows is spread over tasks. The digest of the conversations
that end in a node is made of chunks put together in parallel; SHA-256 itself reads them in order,
as a stream.

Defined results: a null role or text is empty, a null turn comes first, turns with equal numbers
are ordered by a hash of role and text, and repeated rows are turns of their own. Rows without a
conv_id belong to no conversation. Without conversations there is no node, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools
from hirelens.operators.keys import dense_key

#: Conversations whose numbers make one chunk of a digest.
CHUNK = 4096
SHARED_EVERY, SHARED_MOST = 100, 6


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 0), a and b (hashes of role and text) and chars of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"), F.length(text).cast("long").alias("chars")
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    rows = tools.staged(dense_key(rows, "place", order).drop("turn"), "turns")
    starts = rows.groupBy("conv").agg(F.min("place").alias("start"))
    return rows.join(starts, "conv").select("conv", (F.col("place") - F.col("start")).alias("pos"), "a", "b", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their hundred does: their turns, and (conv, length).

    Conversation c takes the first h turns of conversation c - c % 100, h being the CRC-32 of its
    number modulo 6, in the place of its own first h. The remainder is that of SQL: of -7 it is -7.
    """
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    sizes = sizes.withColumns({"base": F.expr(f"conv - conv % {SHARED_EVERY}"), "h": F.expr(f"crc32(cast(conv as string)) % {SHARED_MOST}")})
    of_base = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = sizes.join(of_base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = tools.staged(plan.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    own = turns.join(plan.select("conv", "h", "taken"), "conv").filter("pos >= h").withColumn("pos", F.expr("pos - h + taken"))
    heads = turns.filter(F.col("pos") < SHARED_MOST - 1).withColumnRenamed("conv", "base")
    lent = heads.join(plan.select("conv", "base", "taken"), "base").filter("pos < taken")
    columns = ["conv", "pos", "a", "b", "chars"]
    return own.select(*columns).union(lent.select(*columns)), plan.select("conv", "length")


def named(turns: DataFrame, root: int, height: int) -> DataFrame:
    """conv, depth, name (the smallest conversation of the node) and chars of the node's last turn, for depth 1 and more."""
    names = None
    for j in reversed(range(height.bit_length())):
        size = 1 << j
        offset = F.col("pos").bitwiseAND(size - 1)
        runs = (
            turns.filter(F.col("pos").bitwiseAND(size) == 0)
            .groupBy("conv", F.shiftright("pos", j + 1).alias("block"))
            .agg(
                F.bit_xor(F.xxhash64(offset, "a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a", offset)).alias("y"),
                F.count("*").alias("n"), F.max(F.struct("pos", "chars")).getField("chars").alias("chars"),
            )
            .filter(F.col("n") == size)
            .drop("n")
        )
        if names is None:
            runs = runs.withColumn("above", F.lit(root).cast("long"))
        else:
            starts = names.filter(F.col("depth").bitwiseAND(2 * size - 1) == 0)
            starts = starts.select("conv", F.shiftright("depth", j + 1).alias("block"), F.col("name").alias("above"))
            runs = runs.join(starts, ["conv", "block"], "left").withColumn("above", F.coalesce("above", F.lit(root)))
        prefix = ["block", "above", "x", "y"]
        # written, so that a prefix of a third of all conversations can be split in the join below
        found = tools.staged(runs.groupBy(*prefix).agg(F.min("conv").alias("name")), f"found-{j}")
        depth = F.shiftleft("block", j + 1) + size
        new = tools.staged(runs.join(found, prefix).select("conv", depth.alias("depth"), "name", "chars"), f"names-{j}")
        names = new if names is None else names.union(new)
    return names


def grafted(totals: DataFrame, places: DataFrame, height: int, columns: list[str]) -> DataFrame:
    """Sums over subtrees: totals has depth, name and own values; places has conv, depth and name of every prefix."""
    for j in range(height.bit_length()):
        block = F.shiftright("depth", j + 1).alias("block")
        roots = totals.filter(F.col("depth").bitwiseAND((2 << j) - 1) == 1 << j).select(F.col("name").alias("conv"), block, *columns)
        upper = places.filter(F.col("depth").bitwiseAND(1 << j) == 0).select("conv", block, "depth", "name")
        added = upper.join(roots, ["conv", "block"]).select("depth", "name", *columns)
        totals = totals.union(added).groupBy("depth", "name").agg(*(F.sum(c).alias(c) for c in columns))
        totals = tools.staged(totals, f"totals-{j}")
    return totals


def _ends(ends: DataFrame) -> DataFrame:
    """ends_sha256 by depth and name: of the conversations' numbers, ascending and comma-joined."""
    key = ["depth", "name"]

    def chunked(batches):
        held: list[int] = []
        node = None

        def out(rows):
            return pa.RecordBatch.from_pylist(rows, pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("first", pa.int64()), ("text", pa.string())]))

        for batch in batches:
            rows = []
            for depth, name, conv in zip(*(batch[c].to_pylist() for c in ("depth", "name", "conv")), strict=True):
                if held and ((depth, name) != node or len(held) == CHUNK):
                    rows.append({"depth": node[0], "name": node[1], "first": held[0], "text": ",".join(map(str, held))})
                    held = []
                node = (depth, name)
                held.append(conv)
            yield out(rows)
        if held:
            yield out([{"depth": node[0], "name": node[1], "first": held[0], "text": ",".join(map(str, held))}])

    def digested(batches):
        node, state = None, None
        for batch in batches:
            rows = []
            for depth, name, text in zip(*(batch[c].to_pylist() for c in ("depth", "name", "text")), strict=True):
                if (depth, name) != node:
                    if node is not None:
                        rows.append((*node, state.hexdigest()))
                    node, state = (depth, name), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], [*key, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*node, state.hexdigest()), (pa.int64(), pa.int64(), pa.string()), strict=True)], [*key, "ends_sha256"])

    chunks = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").mapInArrow(chunked, "depth long, name long, first long, text string")
    return chunks.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digested, "depth long, name long, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv, pos (from 0 without gaps), a, b (hashes of the turn) and chars; ``lengths``
    has conv and length of every conversation, also of those without turns.
    """
    spark = turns.sparkSession
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    some = lengths.agg(F.min("conv"), F.max("length"), F.count("*")).first()
    root, height, n = some
    if root is None:
        return spark.createDataFrame([], schema)
    at_root = lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("name"))
    key = ["depth", "name"]
    top = spark.range(1).select(*(F.lit(x).cast("long").alias(c) for c, x in (("depth", 0), ("name", root), ("n_convs", n), ("chars", 0), ("parent", None))))
    if height:
        names = named(turns, root, height)
        places = names.select("conv", "depth", "name").union(at_root)
        counted = names.groupBy(*key).agg(F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
        above = places.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
        nodes = tools.staged(top.unionByName(counted.join(above, key)), "nodes")
    else:
        places, nodes = at_root, top
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = tools.staged(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    own = nodes.select(*key, (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.expr("(n_convs - 1) * chars").alias("saved_tokens"))
    totals = grafted(own, places, height, ["n_leaves", "saved_tokens"])
    ends = _ends(lengths.withColumnRenamed("length", "depth").join(places, ["conv", "depth"]).select(*key, "conv"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    found = nodes.join(totals, key).join(ends, key, "left")
    return found.select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table with conv_id, turn, role and text."""
    turns, lengths = rebuilt(tools.staged(turns_of(conversations), "numbered"))
    return trie(tools.staged(turns, "rebuilt"), lengths)
