"""Near-duplicate groups from bottom-k sketches.

One hash function gives every shingle a value; a document's sketch holds its k smallest. Documents
with equal shingle sets become one node first. Inverted lists of retained values then propose
pairs, the sketch of the union estimates their similarity, and the full sets decide.

Two sets at the threshold share, with all but negligible probability, ``needed`` of k retained
values, so each needs to be listed only under its ``k - needed + 1`` rarest ones. Values that no
other node retains are the rarest, so most documents are in no list, and values that many documents
hold drop out unless they make up most of a document.

Lists are worked off in rounds, and a pair is looked at only while its ends lie in different
components. First each node meets one, then up to four of the nodes that lead its lists, those with
the least of their own; large groups of copies are one component by then. The members of lists that
still hold several components are compared in a last round, by inverted lists of their full sets: a
set is listed under its rarest shingles, one more than it may miss, and a pair counts only where enough
shingles are left behind the shared one and their parity maps allow it. A parity map has a bit for each
of ``PARITY`` classes of shingles, flipped by every shingle of its class, so two maps differ in no more
bits than the sets in shingles: versions of a text that are too far apart never become a row, and no
link is left out.

Defined results: a null or wordless text has an empty set, no links, and is kept. Equal texts are
always linked. Rows that repeat a doc_id stay rows of their own; a null doc_id is never smaller
than another and can only lead a group that has no other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm import tools

COUNTERS = 1 << 18
PARITY = 2048
#: Stands for a null doc_id where rows are looked up by it.
NO_ID = -(2**63)


def shingle_sets(texts: list[str | None], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position, sorted distinct shingle hashes) of each text; only A-Z are lower-cased."""
    raw = [(t or "").encode().lower() for t in texts]
    for part in tools.chunks([len(t) for t in raw]):
        for i, words in enumerate(tools.word_hashes(raw[part])):
            yield part.start + i, tools.shingles(words, size)


def node_of(shingle_set: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingle_set.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity(shingle_set: np.ndarray) -> np.ndarray:
    """The parity map of a set, as longs."""
    flips = np.bincount((shingle_set >> np.uint64(32)) & np.uint64(PARITY - 1), minlength=PARITY) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def needed(k: int, num: int, den: int, miss: float = 1e-9) -> int:
    """The largest s that Binomial(k, num/den) falls short of with a probability of ``miss`` at most."""
    p, below = num / den, 0.0
    for s in range(k + 1):
        below += math.comb(k, s) * p**s * (1 - p) ** (k - s)
        if below > miss:
            return max(1, s)
    return k


def _sketches(docs: DataFrame, size: int, k: int) -> DataFrame:
    schema = "doc_id long, text_key long, n_shingles long, node long, sketch array<long>"

    def run(batches):
        for batch in batches:
            rows = [(len(s), node_of(s) if len(s) else None, tools.plain_long(s[:k])) for _, s in shingle_sets(batch["text"].to_pylist(), size)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                ["doc_id", "text_key", "n_shingles", "node", "sketch"],
            )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key")).mapInArrow(run, schema)


def _postings(nodes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(value, node, n, own) for the rarest retained values of each node that others retain too.

    ``own`` counts the values that no other node retains. They are the rarest, so they come first
    among the places a node is listed under; a node with too few shared values is not listed at all.
    """
    held = nodes.select("node", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("value"))
    shared = held.groupBy("value").agg(F.count("*").alias("holders")).filter("holders > 1")
    whole, least = num * k // den, needed(k, num, den)
    share = F.expr(f"if(n <= {whole}, cast(ceil({num} * n / {den}) as int), {least})")
    each = held.join(shared, "value").groupBy("node", "n", "held").agg(F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("values"))
    each = each.withColumns({"own": F.col("held") - F.size("values"), "share": share}).filter("size(values) >= share")
    return each.select("node", "n", "own", F.explode(F.expr("slice(values, 1, held - share + 1 - own)")).alias("kept")).select("kept.value", "node", "n", "own")


def _mixed(postings: DataFrame, parts: DataFrame | None) -> DataFrame:
    """The lists that hold more than one component, with the component as ``part``."""
    if parts is None:
        listed = postings.withColumn("part", F.col("node"))
    else:
        listed = postings.join(parts.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = listed.groupBy("value").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("value")
    return listed.join(mixed, "value")


def _pairs(postings: DataFrame, parts: DataFrame | None, leaders: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b): each node with up to ``leaders`` of those that lead a list it stands in.

    A list is led by the first members of up to ``leaders`` of its components.
    """
    listed = _mixed(postings, parts)
    close = F.expr(f"{den} * least(n, n_a) >= {num} * greatest(n, n_a)")
    heads = listed.groupBy("value", "part").agg(F.min(F.struct("own", "node", "n")).alias("head"))
    place = F.row_number().over(Window.partitionBy("value").orderBy("head.own", "head.node"))
    heads = heads.withColumn("place", place).filter(F.col("place") <= leaders)
    ahead = heads.select("value", F.col("head.node").alias("a"), F.col("head.own").alias("own_a"), F.col("head.n").alias("n_a"), F.col("part").alias("part_a"))
    found = listed.join(ahead, "value").filter(close & F.expr("part_a <> part"))
    best = found.groupBy("node").agg(F.slice(F.sort_array(F.collect_set(F.struct("own_a", "a"))), 1, leaders).alias("best"))
    found = best.select("node", F.explode("best.a").alias("a"))
    return found.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def _estimated(pairs: DataFrame, nodes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs whose union sketch holds enough shared values; their texts' keys come along."""
    known = nodes.select("node", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "n", "sketch")
    for side in "ab":
        pairs = pairs.join(known.select(*(F.col(c).alias(f"{side}_{c}" if c != "node" else side) for c in known.columns)), side)
    shared = F.array_intersect("a_sketch", "b_sketch")
    union = F.slice(F.sort_array(F.array_union("a_sketch", "b_sketch")), 1, k)
    enough = F.expr(f"least({needed(k, num, den)}, cast(ceil({num} * greatest(a_n, b_n) / {den}) as int))")
    return pairs.filter(F.size(F.array_intersect(union, shared)) >= enough).select("a", "b", "a_doc_id", "b_doc_id")


def _texts(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, text) of the documents whose ids are wanted, and of a few others."""
    shared = docs.sparkSession.sparkContext.broadcast(tools.bitmap(wanted))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(tools.in_bitmap(shared.value, batch["slot"].to_numpy())))
            if batch.num_rows:
                nodes = [node_of(s) if len(s) else None for _, s in shingle_sets(batch["text"].to_pylist(), size)]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch["text"]], ["node", "text"])

    rows = docs.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).alias("slot"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "node long, text string").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def run(batches):
        for batch in batches:
            left, right = batch["a_text"].to_pylist(), batch["b_text"].to_pylist()
            keep = np.zeros(len(left), bool)
            for part in tools.chunks([len(x) + len(y) for x, y in zip(left, right, strict=True)]):
                one, two = shingle_sets(left[part], size), shingle_sets(right[part], size)
                for (i, x), (_, y) in zip(one, two, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[part.start + i] = den * both >= num * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    for side in "ab":
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"{side}_text")), side)
    return pairs.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def _rest(docs: DataFrame, nodes: DataFrame, postings: DataFrame, parts: DataFrame | None, size: int, num: int, den: int) -> DataFrame:
    """The links between members of different components that share a list."""
    left = _mixed(postings, parts).select("node", "part").distinct()
    left = tools.staged(left.join(nodes.select("node", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")), "node"), "left")
    texts = tools.staged(_texts(docs, left.select("doc_id"), size).join(left.drop("doc_id"), "node"), "left-texts")
    counters = tools.summed(
        texts.select("text"), lambda batch: sum((np.bincount(s & np.uint64(COUNTERS - 1), minlength=COUNTERS) for _, s in shingle_sets(batch["text"].to_pylist(), size)), np.zeros(COUNTERS)), COUNTERS
    )
    shared = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches):
        for batch in batches:
            for i, s in shingle_sets(batch["text"].to_pylist(), size):
                n = len(s)
                rare = s[np.lexsort((s, shared.value[s & np.uint64(COUNTERS - 1)]))][: n - -(-num * n // den) + 1]
                columns = [pa.array(tools.plain_long(rare)), *(pa.array(np.full(len(rare), x)) for x in (batch["node"][i].as_py(), batch["part"][i].as_py(), n)), pa.array(np.arange(len(rare)))]
                yield pa.RecordBatch.from_arrays(columns, ["value", "node", "part", "n", "at"])

    listed = texts.select("node", "part", "text").mapInArrow(run, "value long, node long, part long, n long, at long")
    sizes = listed.groupBy("value", "part").count().groupBy("value").agg(F.max_by("part", F.struct("count", "part")).alias("major"), F.count("*").alias("parts"))
    listed = tools.staged(listed.join(sizes.filter("parts > 1").drop("parts"), "value"), "lists")

    def maps(batches):
        for batch in batches:
            rows = [parity(s) for _, s in shingle_sets(batch["text"].to_pylist(), size)]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(rows, pa.list_(pa.int64()))], ["node", "map"])

    listed = tools.staged(listed.join(texts.select("node", "text").mapInArrow(maps, "node long, map array<long>"), "node"), "mapped")
    apart = "aggregate(zip_with(map, map_a, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    # members of a list's largest component are not compared with each other
    minor = listed.filter("part <> major").select("value", F.col("node").alias("a"), F.col("part").alias("part_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("map").alias("map_a"))
    pairs = minor.join(listed, "value").filter(
        F.expr(f"part <> part_a and (part = major or part_a < part) and {den} * least(n, n_a) >= {num} * greatest(n, n_a) and {num + den} * least(n - at, n_a - at_a) >= {num} * (n + n_a) and {num + den} * {apart} <= {den - num} * (n + n_a)")
    )
    pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    return _confirmed(pairs, texts.select("node", "text"), size, num, den)


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, k: int = 32) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key (xxhash64 of the text) for every row of docs."""
    return _grouped(docs, size, num, den, k).drop("leads")


def _grouped(docs: DataFrame, size: int, num: int, den: int, k: int = 32) -> DataFrame:
    """What near_duplicates returns, and ``leads``: the row, or one equal to it, is the first of its group by (doc_id, text_key), nulls last."""
    spark = docs.sparkSession
    tools.small_batches(spark)
    sketched = tools.staged(_sketches(docs, size, k), "sketches")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    nodes = sketched.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(own).alias("lead"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    nodes = tools.staged(nodes, "nodes")
    postings = _postings(nodes, k, num, den)
    shared = postings.groupBy("value").count().filter("count > 1").select("value")
    postings = tools.staged(postings.join(shared, "value"), "postings")
    links, parts = None, None
    for leaders in (1, 4):
        pairs = tools.staged(_estimated(_pairs(postings, parts, leaders, num, den), nodes, k, num, den), "pairs")
        if pairs.isEmpty():
            continue
        wanted = pairs.select(F.explode(F.array("a_doc_id", "b_doc_id")).alias("doc_id"))
        found = tools.staged(_confirmed(pairs.select("a", "b"), _texts(docs, wanted, size), size, num, den), "links")
        links = found if links is None else links.union(found)
        parts = tools.components(links)
    found = tools.staged(_rest(docs, nodes, postings, parts, size, num, den), "links")
    if not found.isEmpty():
        parts = tools.components(found if links is None else links.union(found))
    if parts is None:
        parts = spark.createDataFrame([], "node long, component long")
    labelled = nodes.select("node", "doc_id", "lead").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min("lead").alias("lead"))
    labelled = labelled.drop("lead").join(smallest, "component").select("node", "component_id", "lead")
    named = sketched.join(labelled, "node", "left").withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return spark.createDataFrame([], "doc_id long, n_shingles long, component_id long, kept boolean, text_key long, leads boolean").union(
        named.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")), "text_key", own.eqNullSafe(F.col("lead")))
    )


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs without all but one of each group; columns as they are.

    The first by doc_id and text hash stays, a null doc_id last; of rows equal in both, the first by
    a hash of all columns. Documents without words are in no group and stay.
    """
    groups = tools.staged(_grouped(docs, size, num, den).filter("n_shingles > 0").select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key"), "leads"), "groups")
    gone = groups.filter(~F.col("leads")).select("__gone", "__key").distinct()
    repeated = groups.filter("leads").groupBy("__gone", "__key").count().filter("count > 1").select("__gone", "__key")
    repeated = tools.staged(repeated, "repeated")

    def among(rows: DataFrame) -> Column:
        return rows["doc_id"].cast("long").eqNullSafe(F.col("__gone")) & (F.xxhash64(rows["text"].cast("string")) == F.col("__key"))

    if repeated.isEmpty():
        return docs.join(gone, among(docs), "left_anti")
    bits = docs.sparkSession.sparkContext.broadcast(tools.bitmap(repeated.select(F.xxhash64("__gone", "__key").alias("slot")), hashed=True))

    def near(batches):
        for batch in batches:
            yield batch.filter(pa.array(tools.in_bitmap(bits.value, batch["__slot"].to_numpy())))

    # few rows besides the repeated ones pass; a window's limit leaves one of equal rows in each task before the shuffle
    key = F.xxhash64(F.col("text").cast("string"))
    some = docs.withColumn("__slot", F.xxhash64(F.col("doc_id").cast("long"), key))
    some = some.mapInArrow(near, some.schema).drop("__slot")
    sortable = [c for c, kind in docs.dtypes if "map<" not in kind]
    place = F.row_number().over(Window.partitionBy(F.col("doc_id").cast("long"), key).orderBy(F.xxhash64(*sortable)))
    some = some.withColumn("__place", place).filter("__place = 1").drop("__place")
    some = some.join(repeated, among(some), "left_semi")
    return docs.join(gone.union(repeated), among(docs), "left_anti").union(some)
