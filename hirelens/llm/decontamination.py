"""Benchmark decontamination with spaced seeds.

A mask names the positions of a short span of words that are hashed; a substituted word at any
other position leaves the hash as it is. Hashes of documents and of benchmark items meet in a join,
and around every hit the aligned words are compared: an overlap counts if some run of
``min(region, item length)`` aligned words agrees in ``agree`` of 100 words at least.

Words are maximal runs without ASCII punctuation or blanks, lower-cased. Document hashes pass a
bitmap of the benchmark's hashes before the join; the bitmap's size is fixed, and a larger
benchmark only lets more rows through to the join, which is exact.

``MASKS`` meet every overlap of 13 words and more in which two words may differ. Runs of another
length or with more differing words (short items, another ``region`` or ``agree``) have masks of their
own: the run is cut into parts, two more than words may differ, and each mask keeps two parts whole.

Defined results: null or empty texts on either side overlap with nothing. Items without an id are named
null. Documents that repeat a doc_id are compared each on its own and reported under that id.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools

#: Together they meet every 13 aligned words of which up to two are substituted; see the tests.
MASKS = ("1111011", "10010001111")
#: The words and substitutions that MASKS cover.
COVERED, ALLOWED = 13, 2


def masks_of(window: int, agree: int) -> tuple[str, ...]:
    """Masks one of which at least meets only agreeing words in every overlap of ``window`` words."""
    return MASKS if window >= COVERED and window * (100 - agree) // 100 <= ALLOWED else tuple(short_masks(window, agree))


def short_masks(window: int, agree: int) -> list[str]:
    """Masks of ``window`` words, one of which at least meets only agreeing words of every overlap."""
    allowed = window * (100 - agree) // 100
    n = min(window, allowed + 2)
    parts = [window * (i + 1) // n - window * i // n for i in range(n)]
    return ["".join(str(int(i in kept)) * size for i, size in enumerate(parts)) for kept in itertools.combinations(range(n), n - allowed)]


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    return tools.word_hashes([(t or "").lower().encode() for t in texts], tools.NOT_ALNUM)


def seeds(words: np.ndarray, lengths: np.ndarray, masks: tuple[str, ...] | list[str] = MASKS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of all masks over concatenated documents of the given lengths."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    found, places = [], []
    for number, used in enumerate(masks):
        at = np.flatnonzero(np.arange(len(words)) + len(used) <= ends)
        h = np.full(len(at), 31 * number + len(used) + 1, np.uint64)
        for offset, bit in enumerate(used):
            if bit == "1":
                h = tools.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at + offset])
        found.append(h)
        places.append(at)
    return np.concatenate([*found, np.empty(0, np.uint64)]), np.concatenate([*places, np.empty(0, np.int64)])


def _item_seeds(items: DataFrame, region: int, agree: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for item, words in zip(batch["item_id"].to_pylist(), words_of(batch["text"].to_pylist()), strict=True):
                if not len(words):
                    continue
                window = min(region, len(words))
                h, at = seeds(words, np.array([len(words)]), masks_of(window, agree))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tools.plain_long(h)), pa.array([item] * len(h), pa.int64()), pa.array(at), pa.array([window] * len(h), pa.int64())], ["seed", "item_id", "item_at", "item_window"]
                )

    return items.mapInArrow(run, "seed long, item_id long, item_at long, item_window long")


def _doc_seeds(docs: DataFrame, bits: np.ndarray, kinds: list[tuple[str, ...]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            texts, ids, keys = batch["text"].to_pylist(), batch["doc_id"], batch["text_key"]
            for part in tools.chunks([len(t or "") for t in texts]):
                words = words_of(texts[part])
                lengths = np.array([len(w) for w in words])
                row = np.repeat(np.arange(len(words)), lengths)
                begins = np.cumsum(lengths) - lengths
                joined = np.concatenate(words)
                for masks in kinds:
                    h, at = seeds(joined, lengths, masks)
                    hit = tools.in_bitmap(shared.value, h)
                    h, at = h[hit], at[hit]
                    if len(h):
                        take = pa.array(part.start + row[at])
                        yield pa.RecordBatch.from_arrays([pa.array(tools.plain_long(h)), ids.take(take), keys.take(take), pa.array(at - begins[row[at]])], ["seed", "doc_id", "text_key", "doc_at"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, "seed long, doc_id long, text_key long, doc_at long")


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, region: int, agree: int) -> tuple[int, int, int] | None:
    """(first word in the document, words, agreeing words) of the overlap at this alignment."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    window = min(region, len(item))
    if high - low < window:
        return None
    same = np.concatenate(([0], np.cumsum(doc[shift + low : shift + high] == item[low:high])))
    good = np.flatnonzero(100 * (same[window:] - same[:-window]) >= agree * window)
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + window
    return shift + low + first, last - first, int(same[last] - same[first])


def contaminated(docs: DataFrame, items: DataFrame, region: int = 13, agree: int = 80) -> DataFrame:
    """One row for each document and item that overlap: doc_id, text_key, item_id and the best overlap.

    Columns start_word, n_words and n_matched describe it; text_key is xxhash64 of the text.
    """
    spark = docs.sparkSession
    tools.small_batches(spark)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
    item_seeds = tools.staged(_item_seeds(items, region, agree), "item-seeds")
    # at most ``region`` windows, so as many kinds of masks
    kinds = sorted({masks_of(r.item_window, agree) for r in item_seeds.select("item_window").distinct().collect()})
    bits = tools.bitmap(item_seeds.select("seed"), 26, hashed=True)
    hits = _doc_seeds(docs, bits, kinds).join(item_seeds, "seed")
    hits = tools.staged(hits.select("doc_id", "text_key", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct(), "hits")

    wanted = spark.sparkContext.broadcast(tools.bitmap(hits.select("text_key")))

    def near(batches):
        for batch in batches:
            batch = batch.filter(pa.array(tools.in_bitmap(wanted.value, batch["slot"].to_numpy())))
            yield batch.select(["doc_id", "text_key", "text"])

    texts = docs.withColumn("slot", F.xxhash64("text_key")).mapInArrow(near, "doc_id long, text_key long, text string")
    one = texts.dropDuplicates(["text_key"]).select("text_key", "text")
    # equal texts have equal hits, so one text and one alignment of each kind are compared
    named = items.filter("text is not null").dropDuplicates(["item_id", "text"]).select("item_id", F.col("text").alias("item_text"))
    aligned = hits.select("text_key", "item_id", "shift").distinct().join(named.withColumnRenamed("item_id", "id"), F.col("item_id").eqNullSafe(F.col("id"))).drop("id")
    aligned = aligned.groupBy("text_key", "item_id", "item_text").agg(F.collect_list("shift").alias("shifts"))

    def compare(batches):
        for batch in batches:
            rows = []
            texts, others = batch["text"].to_pylist(), batch["item_text"].to_pylist()
            for part in tools.chunks([len(t) for t in texts]):
                docs_words, item_words = words_of(texts[part]), words_of(others[part])
                for i, doc, item in zip(range(part.start, part.stop), docs_words, item_words, strict=True):
                    found = [x for s in batch["shifts"][i].as_py() if (x := overlap(doc, item, s, region, agree))]
                    if found:
                        start, n, same = max(found, key=lambda x: (x[2], -x[0]))
                        rows.append((batch["text_key"][i].as_py(), batch["item_id"][i].as_py(), start, n, same))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], ["text_key", "item", "start_word", "n_words", "n_matched"])

    schema = "text_key long, item long, start_word long, n_words long, n_matched long"
    found = aligned.join(one, "text_key").select("text_key", "item_id", "text", "item_text", "shifts").mapInArrow(compare, schema)
    best = found.groupBy("text_key", "item").agg(F.max_by(F.struct("start_word", "n_words", "n_matched"), F.struct("n_matched", -F.col("start_word"))).alias("best"))
    owners = hits.select("doc_id", "text_key", "item_id").distinct().withColumnRenamed("text_key", "key")
    return best.join(owners, (F.col("text_key") == F.col("key")) & F.col("item").eqNullSafe(F.col("item_id"))).select("doc_id", "text_key", "item_id", "best.*")


def keep_clean(docs: DataFrame, items: DataFrame, region: int = 13, agree: int = 80) -> DataFrame:
    """The rows of docs that overlap with no item; columns as they are."""
    gone = contaminated(docs, items, region, agree).select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__gone")) & (F.xxhash64(docs["text"].cast("string")) == F.col("__key"))
    return docs.join(gone, same, "left_anti")
