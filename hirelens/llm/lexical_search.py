"""Ranked lexical search by dual trees: the best documents of every item, exactly.

An item's score of a document sums, over the item's terms, an integer weight times an integer
contribution of the document's term count. Both are never negative, so a node of a tree can stand
for all its leaves by the largest value in each coordinate:

* the **item tree** keeps, for each term, the largest weight below a node;
* the **document tree** keeps, for each term, the largest contribution below a node.

The product of a pair of nodes bounds every score between their leaves. A pair whose bound stays
below the weakest k-th best score of its items is dropped with all that is below it; any other pair
is split, items or documents, whichever stands higher. Pairs of leaves are scores. Equal bounds are
not dropped, so ties by doc_id come out right, and no document is left out.

The corpus is read once into term counts, restricted to the terms of the items (a bitmap of fixed
size passes a few more, which match no item). Items are worked off in blocks of bounded size: a
block is sent to all tasks, each of which builds document trees over bounded runs of its rows and
keeps k documents per item. Before that, the trees over the first rows of every partition give each
item a k-th best score to start from; it may come from any documents, as it only bounds from below.

Terms are equal if their 64-bit hashes are. Defined results: a null text has no terms; an item
without a term that occurs has no row; items that repeat an item_id are ranked each on its own, and
so are documents that repeat a doc_id (equal scores then stand side by side); a null doc_id comes
after all others of its score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm import tools

#: Distinct terms of the items of a block, all items together, on average.
BLOCK = 1 << 16
#: Children of a node in either tree.
FAN = 8
#: Cells of the lowest level of a document tree.
CELLS = 1 << 22
#: Sorts after every doc_id; stands for none.
NO_ID = 2**63 - 1


def _counted(rows: DataFrame, keep: np.ndarray | None, ids: list[str]) -> DataFrame:
    """ids, n (all terms), terms (distinct hashes) and counts of every text; terms in the bitmap ``keep`` only."""
    shared = None if keep is None else rows.sparkSession.sparkContext.broadcast(keep)

    def run(batches):
        for batch in batches:
            raw = [(t or "").encode().lower() for t in batch["text"].to_pylist()]
            n, terms, counts = [], [], []
            for part in tools.chunks([len(t) for t in raw]):
                for words in tools.word_hashes(raw[part], tools.NOT_ALNUM):
                    n.append(len(words))
                    if shared is not None:
                        words = words[tools.in_bitmap(shared.value, words)]
                    term, count = np.unique(words, return_counts=True)
                    terms.append(tools.plain_long(term))
                    counts.append(count.astype(np.int32))
            ends = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x or [np.empty(0, t)]), pt)) for x, t, pt in ((terms, np.int64, pa.int64()), (counts, np.int32, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ids), pa.array(n, pa.int64()), *lists], [*ids, "n", "terms", "counts"])

    schema = ", ".join(f"{c} long" for c in ids) + ", n long, terms array<long>, counts array<int>"
    return rows.mapInArrow(run, schema)


class Block:
    """Items of a block as a tree over the sorted terms of all of them."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]]):
        """rows: (item, terms, weights) with weights above 0."""
        self.terms = np.unique(np.concatenate([r[1] for r in rows]))
        found = [(item, np.searchsorted(self.terms, terms), weights) for item, terms, weights in rows]
        # items whose heaviest term is the same stand together
        found.sort(key=lambda r: (int(r[1][np.argmax(r[2])]), r[0]))
        self.items = [r[0] for r in found]
        # a node: columns, weights, first and last item, children
        level = [(columns, weights, i, i + 1, ()) for i, (_, columns, weights) in enumerate(found)]
        self.height = 0
        while len(level) > 1:
            level = [self._joined(level[i : i + FAN]) for i in range(0, len(level), FAN)]
            self.height += 1
        self.root = level[0]

    @staticmethod
    def _joined(nodes: list[tuple]) -> tuple:
        columns, place = np.unique(np.concatenate([n[0] for n in nodes]), return_inverse=True)
        weights = np.zeros(len(columns), np.int64)
        np.maximum.at(weights, place, np.concatenate([n[1] for n in nodes]))
        return columns, weights, nodes[0][2], nodes[-1][3], tuple(nodes)


class Best:
    """The k best documents of each item so far, and the score a document must reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.least, self.k = np.maximum(floor, 1), k
        self.held = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in floor]

    def offer(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = (np.concatenate(x) for x in zip(self.held[item], (scores, docs), strict=True))
        best = np.lexsort((docs, -scores))[: self.k]
        self.held[item] = scores[best], docs[best]
        if len(best) == self.k:
            self.least[item] = max(self.least[item], scores[best[-1]])


def contributions(counts: np.ndarray, n: np.ndarray, total: int, documents: int) -> np.ndarray:
    """What a term's count adds to a document of n terms, per unit of the term's weight."""
    size = 75 + (25 * n * documents) // total
    return (10**9 * counts) // (1000 * counts + 12 * size)


def search(block: Block, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, best: Best) -> None:
    """Offer all documents (ids) to the block's items. rows, columns and values are the filled cells."""
    # documents whose largest contribution is to the same term stand together
    first = np.full(len(ids), len(block.terms))
    top = np.zeros(len(ids), np.int64)
    np.maximum.at(top, rows, values)
    lead = values == top[rows]
    np.minimum.at(first, rows[lead], columns[lead])
    order = np.argsort(first, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    ids = ids[order]
    levels = [np.zeros((len(ids), len(block.terms)), np.int32)]
    levels[0][place[rows], columns] = values
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), FAN), axis=0))

    def visit(node: tuple, height: int, level: int, at: np.ndarray) -> None:
        columns, weights, low, high, children = node
        bound = levels[level][at[:, None], columns].astype(np.int64) @ weights
        near = bound >= best.least[low:high].min()
        if not near.any():
            return
        at = at[near]
        if not height and not level:
            best.offer(low, bound[near], ids[at])
        elif height and height >= level:
            for child in children:
                visit(child, height - 1, level, at)
        else:
            # the most promising first, in batches that double: what they find prunes the rest
            order = np.argsort(-bound[near], kind="stable")
            at, hope, size = at[order], bound[near][order], 1
            while len(at) and hope[0] >= best.least[low:high].min():
                below = (at[:size, None] * FAN + np.arange(FAN)).ravel()
                visit(node, height, level - 1, below[below < len(levels[level - 1])])
                at, hope, size = at[size:], hope[size:], 2 * size

    visit(block.root, block.height, len(levels) - 1, np.zeros(1, np.int64))


def _searched(counted: DataFrame, block: Block, floor: np.ndarray, k: int, total: int, documents: int, seeds: bool) -> DataFrame:
    """item, doc_id and score of the k best documents of each item in each partition, none below the floor.

    With ``seeds``, of the first run of documents of each partition only.
    """
    shared = counted.sparkSession.sparkContext.broadcast((block, floor))
    names = ["item", "doc_id", "score"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        block, floor = shared.value
        best = Best(floor, k)
        at_once = max(FAN, min(4096, CELLS // len(block.terms)))
        seen = False
        for batch in batches:
            for low in range(0, batch.num_rows, at_once):
                part = batch.slice(low, at_once)
                terms, counts = part["terms"].flatten().to_numpy(), part["counts"].flatten().to_numpy().astype(np.int64)
                rows = np.repeat(np.arange(part.num_rows), np.diff(part["terms"].offsets.to_numpy()))
                columns = np.minimum(np.searchsorted(block.terms, terms), len(block.terms) - 1)
                hit = block.terms[columns] == terms
                rows, columns, counts = rows[hit], columns[hit], counts[hit]
                if not len(rows):
                    continue
                values = contributions(counts, part["n"].to_numpy()[rows], total, documents)
                search(block, part["doc_id"].to_numpy(), rows, columns, values, best)
                seen = True
                if seeds:
                    break
            if seeds and seen:
                break
        for i, (scores, docs) in enumerate(best.held):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), block.items[i])), pa.array(docs), pa.array(scores)], names)

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (score above 0) of every item."""
    spark = docs.sparkSession
    tools.small_batches(spark)
    text = F.col("text").cast("string").alias("text")
    asked = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), text)
    asked = tools.staged(_counted(asked, None, ["item", "item_id"]), "items")
    each = asked.select("item", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("item", F.col("x.terms").alias("term"), F.col("x.counts").alias("count"))
    wanted = tools.bitmap(each.select("term"), hashed=True)
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text)
    counted = tools.staged(_counted(own, wanted, ["doc_id"]), "counted")

    schema = "item_id long, rank int, doc_id long, score long"
    documents, total = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not documents:
        return spark.createDataFrame([], schema)
    holders = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000) * F.ln(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weighted = each.join(holders, "term").withColumn("weight", F.col("count") * weight).filter("weight > 0")
    weighted = weighted.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    weighted = tools.staged(weighted, "weighted")
    blocks = -(-(weighted.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK)

    found = []
    for number in range(blocks):
        rows = weighted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        block = Block([(r.item, np.array([t.term for t in r.terms]), np.array([t.weight for t in r.terms])) for r in rows])
        floor = np.zeros(len(block.items), np.int64)
        seeds = _ranked(_searched(counted, block, floor, k, total, documents, True), k).filter(F.col("rank") == k)
        known = {r.item: r.score for r in seeds.select("item", "score").collect()}
        floor = np.array([known.get(i, 0) for i in block.items], np.int64)
        found.append(tools.staged(_ranked(_searched(counted, block, floor, k, total, documents, False), k), f"found-{number}"))
    if not found:
        return spark.createDataFrame([], schema)
    tops = found[0]
    for more in found[1:]:
        tops = tops.union(more)
    return tops.join(asked.select("item", "item_id"), "item").select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
