"""Helpers that several operators share: staged tables, bounded bitmaps, word hashes, components.

Word hashes are polynomial sums over random byte codes, finished with a 64-bit mixer. Everything
here works on one chunk of a partition at a time; chunks are bounded in bytes, not in rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import fresh_folder

CHUNK_BYTES = 1 << 18
#: ASCII white space: blank and the codes 9 to 13.
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
#: Anything in ASCII that is neither letter nor digit.
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

_random = np.random.Generator(np.random.PCG64(20240917))
_CODES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_random.integers(1, 2**62, dtype=np.uint64)) * 2 + 1
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base modulo 2^64, and their inverses."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            column = np.full(size, base, np.uint64)
            column[0] = 1
            _powers[name] = np.cumprod(column, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(buffer: np.ndarray) -> np.ndarray:
    """prefix[i] is the weighted sum of the bytes before i."""
    prefix = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_CODES[buffer] * powers(len(buffer))[0], out=prefix[1:])
    return prefix


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end), the same wherever the bytes stand."""
    down = powers(len(prefix))[1]
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes], separators: np.ndarray = WHITE) -> list[np.ndarray]:
    """For each text, the hash of each of its words, in order."""
    if not texts:
        return []
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], separators[joined], [True]))))
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):  # pieces keep the arrays small when one text is very long
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + 2 * CHUNK_BYTES, "right")))
        first = starts[low]
        prefix = prefix_sums(joined[first : ends[high - 1]])
        hashes[low:high] = span_hashes(prefix, starts[low:high] - first, ends[low:high] - first)
        low = high
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return np.split(hashes, np.searchsorted(starts, begins[1:-1]))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; all words as one run if fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    runs = mix(words[: len(words) - size + 1] + np.uint64(size))
    for i in range(1, size):
        runs = mix(runs * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - size + 1 + i])
    return np.unique(runs)


def chunks(lengths: list[int], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of consecutive rows with about ``limit`` bytes, one row at least."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield slice(start, len(lengths))


#: Bytes of a batch for Python workers; Spark's own bound is 16 times that, in the JVM and in the worker of every task.
BATCH_BYTES = 1 << 22


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers a thousand at a time, or fewer long ones: larger batches fill their memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: lineage ends, nothing is computed twice."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key is hot when it holds more than one in HOT of the counted rows, so fewer than HOT keys are.
HOT, SPREAD = 2000, 4096


def of_shared_keys(found: DataFrame, counts: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """The rows of ``found`` whose key is in ``counts`` (key and count, one row a key).

    Both are shuffled by the key but for the hot keys, of which there are fewer than HOT: these are
    broadcast, and their rows are dealt out by ``spread_by``.
    """
    counts = staged(counts, "shared")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("count") > total / HOT).select(F.col(key), F.col(key).alias("__hot"))
    marked = found.join(F.broadcast(hot), key, "left")
    cold = F.col("__hot").isNull()
    salt = F.when(cold, 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int") + 1)
    marked = marked.withColumns({"__salt": salt, key: F.when(cold, F.col(key))})
    shared = counts.select(F.col(key), F.lit(0).alias("__salt"), F.lit(True).alias("__shared"))
    joined = marked.join(shared.hint("shuffle_hash"), [key, "__salt"], "left").filter("__shared or __hot is not null")
    return joined.withColumn(key, F.coalesce("__hot", key)).select(*found.columns)


def plain_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def bitmap(values: DataFrame, bits: int = 24, hashed: bool = False) -> np.ndarray:
    """A bitmap of 2^bits bits with one bit set for each value of the only (long) column.

    Its size does not grow with the data. Spark combines the words with ``bit_or``; at most
    2^(bits-6) words reach the driver. Membership errs only towards yes, so whatever uses it as a
    filter must be followed by an exact join. Values that are ``hashed`` already are not hashed again.
    """
    (name,) = values.columns
    own = f"`{name}`" if hashed else f"xxhash64(`{name}`)"
    slot = F.expr(own).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr(f"shiftleft(1L, cast({own} & 63 as int))")
    rows = (
        values.filter(F.col(name).isNotNull())
        .groupBy(F.shiftright(slot, 6).alias("word"))
        .agg(F.bit_or(bit).alias("set"))
        .toPandas()
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
    return words


def in_bitmap(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of the hashed values (``xxhash64`` of the value) may be members."""
    slots = slots.view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def summed(rows: DataFrame, terms, size: int) -> np.ndarray:
    """The sum of terms(batch), an array of ``size`` numbers, over all Arrow batches of the rows.

    Partitions are summed where they are, then in a few groups, so the driver adds a bounded number.
    """

    def partition(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += terms(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    def group(batches):
        total = np.zeros(size)
        for batch in batches:
            for part in batch["total"].to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    parts = rows.mapInArrow(partition, "total binary").repartition(8)
    return sum((np.frombuffer(r.total) for r in parts.mapInArrow(group, "total binary").collect()), np.zeros(size))


#: Edges that one task joins in its memory; more are first made fewer by star steps.
IN_ONE_TASK = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all nodes of the edges (a, b) that one task reads."""
    edges = [np.empty((0, 2), np.int64), *(np.column_stack([batch["a"].to_numpy(), batch["b"].to_numpy()]) for batch in batches)]
    nodes, place = np.unique(np.concatenate(edges), return_inverse=True)
    a, b = place.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while len(a):  # each root takes the smallest root it is linked with; all then look up their root's root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, root[root]):
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Alternating large-star and small-star steps, until the edges no longer change or are few enough
    for one task. Every step is two aggregations and joins over the edges; the edges of a step are a
    written table, so a lost executor repeats one step at most.
    """
    spark = edges.sparkSession
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first()
        if now[0] <= IN_ONE_TASK:
            return staged(edges.coalesce(1).mapInArrow(_forest, "node long, component long"), "components")
        if now == before:
            break
        before = now
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(low.filter("low < a").select("a", F.col("low").alias("b"))).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.union(lowest.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        edges = staged(small, "edges")
    return spark.createDataFrame([], "node long, component long").union(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("b"))).distinct()
    )
