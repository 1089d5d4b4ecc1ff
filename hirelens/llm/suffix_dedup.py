"""Removal of repeated byte strings: column-wise construction over sampled anchors.

A byte goes if a string of ``length`` bytes that covers it also starts earlier, in a smaller
document or before it in the same one. Inserting a symbol of every document in each round would take
as many rounds over the whole collection as the longest document has bytes. Three steps before it
leave short strings only:

1. Each window of ``length`` bytes is owned by its anchor, the k-gram with the smallest hash in it
   (the leftmost of equals). Equal windows have equal anchors at equal places, so only anchors that
   occur twice or more matter. Neighbouring windows of one anchor are one slice of text.
2. Equal slices are settled by their first occurrence: all others go, whole.
3. Of anchors with several different slices, the first occurrence of each slice goes on.

These slices, at most ``3 * length`` bytes long, are the documents of the construction. They lie with
their anchors above each other; each round, from the last column to the first, inserts one symbol of
every slice, which re-orders the slices by the suffix that starts there (a stable sort by the symbol
before it, as in a Burrows-Wheeler transform) and updates the common prefixes of neighbours. Where a
common prefix reaches ``length`` the windows are equal, and all but the earliest go. A task streams
its sorted part and holds a bounded collection at a time; anchors with many slices are dealt over
several collections, whose classes of equal windows then meet by a 128-bit digest.

Rows with the same doc_id and text are one document; rows with the same doc_id and different texts
are ordered by a hash of the text. A null doc_id comes before all others; a null text is empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools

GRAM = 16
#: Window starts handled at once; below 2^20 so that a place fits beside a hash.
STRIDE = 1 << 19
#: Slices of one anchor in one collection, and slices in a task's memory.
PER_COLLECTION, IN_MEMORY = 16_384, 16_384
NO_ID = -(2**63)
#: A document is its id (doc) and a 64-bit hash of its text (tie); a place is a byte offset in it.
KEY = ("doc", "tie")


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by block-wise prefix and suffix minima."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def slices(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Slices of a buffer of documents that end at ``ends``: start, windows, anchor offset, anchor hash, slice hash."""
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    prefix = tools.prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = tools.span_hashes(prefix, at, at + GRAM)
    place = np.uint64((1 << 20) - 1)
    lowest = sliding_minimum((grams & ~place) | at.astype(np.uint64), length - GRAM + 1)
    anchor = (lowest & place).astype(np.int64)
    start = np.arange(len(anchor))
    document = np.searchsorted(ends, start, "right")
    inside = np.flatnonzero(start + length <= ends[document])
    if not len(inside):
        return none
    anchor, document = anchor[inside], document[inside]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(inside)))
    begin, mark = inside[first], anchor[first]
    whole = tools.span_hashes(prefix, begin, begin + count + length - 1)
    return begin, count, mark - begin, tools.plain_long(grams[mark]), tools.plain_long(tools.mix(whole ^ (mark - begin).astype(np.uint64)))


def _sliced(docs: DataFrame, length: int, hashes_only: bool) -> DataFrame:
    """anchor, slice, doc, tie, place and shape (windows above the anchor's offset, 16 bits) of every slice."""
    names = ["anchor"] if hashes_only else ["anchor", "slice", "doc", "tie", "place", "shape"]
    kinds = {"shape": "int"}

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"].to_pylist()]
            ids, ties = batch["doc"].to_numpy(), batch["tie"].to_numpy()
            for part in tools.chunks([len(t) for t in texts], STRIDE):
                sizes = np.array([len(t) for t in texts[part]])
                ends = np.cumsum(sizes)
                begins = ends - sizes
                data = np.frombuffer(b"".join(texts[part]), np.uint8)
                for low in range(0, max(1, len(data)), STRIDE):  # more than one round for a long document only
                    piece = data[low : low + STRIDE + length - 1]
                    cut = np.minimum(ends - low, len(piece))
                    begin, count, offset, anchor, own = slices(piece, cut[cut > 0], length)
                    if not len(begin):
                        continue
                    if hashes_only:
                        yield pa.RecordBatch.from_arrays([pa.array(anchor)], names)
                        continue
                    row = np.searchsorted(ends, begin + low, "right")
                    where = begin + low - begins[row]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, own, ids[part.start + row], ties[part.start + row], where, (count << 16 | offset).astype(np.int32))], names)

    return docs.select("doc", "tie", "text").mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))


def construct(table: np.ndarray, lengths: np.ndarray, group: np.ndarray, length: int):
    """Insert the columns of a table of aligned strings, from the last to the first.

    table holds symbols (0 to 255) and -1 around the strings, group the anchor of each row. Yields
    (column, order, common): the rows sorted by (group, suffix from this column), and the common
    prefix of each with the one before it, up to ``length``.
    """
    order = np.argsort(group, kind="stable")
    common = np.zeros(len(order), np.int16)
    base = group.astype(np.int64) * 257 + 1
    for column in range(table.shape[1] - 1, -1, -1):
        symbols = table[order, column]
        keys = base[order] + symbols
        step = np.argsort(keys, kind="stable")
        keys = keys[step]
        equal = np.flatnonzero((keys[1:] == keys[:-1]) & (symbols[step][1:] >= 0)) + 1
        renewed = np.zeros(len(order), np.int16)
        if len(equal):
            spans = np.column_stack([step[equal - 1] + 1, step[equal] + 1]).ravel()
            shared = np.minimum.reduceat(np.append(common, 0), spans)[::2]
            renewed[equal] = np.minimum(shared + 1, length)
        order, common = order[step], renewed
        yield column, order, common


def repeated_windows(strings: list[bytes], offsets: np.ndarray, group: np.ndarray, rank: np.ndarray, length: int, split: np.ndarray):
    """Which windows of the strings repeat a window of a lower rank.

    Returns a table of booleans (string, window), and the (string, window) of the earliest of each
    class in groups marked as split.
    """
    sizes = np.array([len(s) for s in strings])
    lead = offsets.max() - offsets
    width = int((lead + sizes).max())
    table = np.full((len(strings), width), -1, np.int16)
    joined = np.frombuffer(b"".join(strings), np.uint8)
    row = np.repeat(np.arange(len(strings)), sizes)
    table[row, np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lead, sizes)] = joined
    repeated = np.zeros((len(strings), int(sizes.max()) - length + 1), bool)
    heads: list[np.ndarray] = []
    for column, order, common in construct(table, sizes, group, length):
        window = column - lead[order]
        valid = (window >= 0) & (window + length <= sizes[order])
        if not valid.any():
            continue
        first = np.flatnonzero(common < length)
        ranks = rank[order]
        least = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, len(order))))
        late = valid & (ranks != least)
        repeated[order[late], window[late]] = True
        head = valid & ~late & split[order]
        if head.any():
            heads.append(np.column_stack([order[head], window[head]]))
    return repeated, np.concatenate(heads) if heads else np.empty((0, 2), np.int64)


def _digests(strings: list[bytes], heads: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each window (string, window)."""
    sizes = np.array([len(s) for s in strings])
    start = (np.cumsum(sizes) - sizes)[heads[:, 0]] + heads[:, 1]
    prefix = tools.prefix_sums(np.frombuffer(b"".join(strings), np.uint8))
    half = tools.span_hashes(prefix, start, start + length // 2)
    return tools.plain_long(tools.span_hashes(prefix, start, start + length)), tools.plain_long(half)


RUNS = "doc long, tie long, place long, windows int, digest long, half long"


def _constructed(contested: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows (digest null), and the windows of split anchors that lead their class."""

    def settle(rows: list[tuple]):
        anchors, salts, docs, ties, places, offsets, spread, strings = zip(*rows, strict=True)
        strings = list(strings)
        group = np.unique(np.array(list(zip(anchors, salts, strict=True))), axis=0, return_inverse=True)[1].ravel()
        docs, ties, places = np.array(docs), np.array(ties), np.array(places)
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((places, ties, docs))] = np.arange(len(rows))
        repeated, heads = repeated_windows(strings, np.array(offsets), group, rank, length, np.array(spread) > 1)
        edge = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1]
        out = [docs[row], ties[row], places[row] + low, (high - low).astype(np.int32)]
        blank = np.zeros(len(row), bool)
        one, two = _digests(strings, heads, length) if len(heads) else (np.empty(0, np.int64),) * 2
        arrays = [np.concatenate(x) for x in zip(out, (docs[heads[:, 0]], ties[heads[:, 0]], places[heads[:, 0]] + heads[:, 1], np.ones(len(heads), np.int32)), strict=True)]
        known = np.concatenate([blank, np.ones(len(heads), bool)])
        digests = [pa.array(np.concatenate([np.zeros(len(row), np.int64), x]), mask=~known) for x in (one, two)]
        return pa.RecordBatch.from_arrays([*(pa.array(x) for x in arrays), *digests], [f.split()[0] for f in RUNS.split(", ")])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("anchor", "salt", "doc", "tie", "place", "offset", "salts", "bytes")]
            for row in zip(*columns, strict=True):
                if len(held) >= IN_MEMORY and row[:2] != held[-1][:2]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    dealt = contested.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    return dealt.mapInArrow(run, RUNS)


def _near(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row (doc, tie, text) of each document that is wanted, and of a few others."""
    shared = docs.sparkSession.sparkContext.broadcast(tools.bitmap(wanted.select(F.xxhash64(*KEY).alias("slot")), hashed=True))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(tools.in_bitmap(shared.value, batch["slot"].to_numpy()))).select(["doc", "tie", "text"])

    near = docs.select(*KEY, "text", F.xxhash64(*KEY).alias("slot")).mapInArrow(run, "doc long, tie long, text string")
    # repeated rows meet in their tasks first, so that one row of each moves
    return near.dropDuplicates(list(KEY))


def repeated(docs: DataFrame, length: int = 100) -> DataFrame:
    """Runs of window starts to remove: doc, tie, start, windows. docs has doc, tie and text."""
    found = _sliced(docs, length, False)
    shared = _sliced(docs, length, True).groupBy("anchor").count().filter("count > 1")
    kept = tools.staged(tools.of_shared_keys(found, shared, "anchor", [*KEY, "place"]), "slices")
    where = F.struct(*KEY, "place")
    firsts = kept.groupBy("anchor", "slice").agg(F.min(where).alias("first"), F.min("shape").alias("shape"))
    firsts = tools.staged(firsts, "firsts")
    late = kept.join(firsts.select("anchor", "slice", "first"), ["anchor", "slice"]).filter(where != F.col("first"))
    late = late.select(*KEY, "place", F.shiftright("shape", 16).alias("windows"))

    many = firsts.groupBy("anchor").count().filter("count > 1")
    contested = firsts.join(many, "anchor").select(
        "anchor", F.col("first.doc").alias("doc"), F.col("first.tie").alias("tie"), F.col("first.place").alias("place"), "shape", F.ceil(F.col("count") / PER_COLLECTION).cast("int").alias("salts")
    )
    contested = contested.withColumn("salt", F.pmod(F.xxhash64(*KEY, "place"), "salts").cast("int"))
    by_doc = contested.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "salt", "salts", "place", "shape")).alias("cuts"))
    by_doc = tools.staged(by_doc, "cuts")

    def cut(batches):
        names = ["anchor", "salt", "doc", "tie", "place", "offset", "salts", "bytes"]
        for batch in batches:
            for doc, tie, text, cuts in zip(batch["doc"].to_pylist(), batch["tie"].to_pylist(), batch["text"].to_pylist(), batch["cuts"], strict=True):
                data, flat = text.encode(), cuts.values
                places, shapes = flat.field("place").to_numpy(), flat.field("shape").to_numpy()
                parts = [data[s : s + n] for s, n in zip(places, (shapes >> 16) + length - 1, strict=True)]
                yield pa.RecordBatch.from_arrays([flat.field("anchor"), flat.field("salt"), *(pa.array([x] * len(parts), pa.int64()) for x in (doc, tie)), flat.field("place"), pa.array(shapes & 0xFFFF), flat.field("salts"), pa.array(parts, pa.binary())], names)

    one_each = _near(docs, by_doc.select(*KEY)).join(by_doc, list(KEY))
    strings = one_each.select(*KEY, "text", "cuts").mapInArrow(cut, "anchor long, salt int, doc long, tie long, place long, offset int, salts int, bytes binary")
    built = tools.staged(_constructed(strings, length), "windows")

    heads = built.filter("digest is not null")
    earliest = heads.groupBy("digest", "half").agg(F.min(where).alias("first"))
    across = heads.join(earliest, ["digest", "half"]).filter(where != F.col("first"))
    runs = late.union(built.filter("digest is null").select(*KEY, "place", "windows")).union(across.select(*KEY, "place", "windows"))
    return runs.select(*KEY, F.col("place").alias("start"), "windows")


def deduplicated(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, text_key, n_bytes, n_removed, n_spans, kept (the bytes that stay, null if all do) and kept_sha256."""
    tools.small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.withColumns({"doc": F.coalesce("doc_id", F.lit(NO_ID)), "tie": F.xxhash64("text")})
    runs = tools.staged(repeated(docs, length).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "windows")).alias("runs")), "runs")

    def remove(batches):
        for batch in batches:
            rows = []
            for text, runs in zip(batch["text"].to_pylist(), batch["runs"], strict=True):
                data = text.encode()
                start, windows = runs.values.field("start").to_numpy(), runs.values.field("windows").to_numpy()
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, start + windows + length - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                rows.append((int(gone.sum()), int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum()), kept, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["tie"], *columns], ["doc", "tie", "n_removed", "n_spans", "kept", "sha"])

    cut = _near(docs, runs.select(*KEY)).join(runs, list(KEY))
    done = cut.select("doc", "tie", "text", "runs").mapInArrow(remove, "doc long, tie long, n_removed long, n_spans long, kept binary, sha string")
    plain = docs.select("doc_id", "doc", "tie", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own"))
    return plain.join(done, ["doc", "tie"], "left").select(
        "doc_id", "n_bytes", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")), "kept", F.coalesce("sha", "own").alias("kept_sha256")
    )
