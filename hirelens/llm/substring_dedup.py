"""Removal of repeated word runs: a compacted de Bruijn graph of the corpus.

A word goes if a window of ``k`` words that covers it also starts earlier, in a smaller document or
before it in the same one. Windows are the edges of the graph; an edge that occurs twice is a repeat.
Few of them ever become rows:

1. **Fragments.** Neighbouring windows whose smallest gram (of GRAM words) stands at the same place
   are one fragment of a path. Equal windows have equal grams at equal offsets, so only fragments
   with a shared gram matter, and equal fragments are one path of the graph that occurs several
   times: all occurrences but the first repeat it.
2. **Edges.** Where a gram has several different fragments the graph branches. The first occurrence
   of each of those fragments is cut into its edges, by a 128-bit hash, and repeated edges are found.
3. **Compaction.** An edge continues the path of the edge before its first occurrence if all of its
   occurrences follow one and the same edge, and that edge occurs as often. A join of the edges with
   the edges one place before says so; what it does not say so of heads a path. A nonbranching path
   lies in one piece at its first occurrence, so a running sum over heads gives its length, and the
   occurrences of its head, one join, are the occurrences of all of it.
4. **Coordinates.** Repeats that are neighbours in their document and at their source are glued to
   long spans, each with the coordinates it repeats. The words at both coordinates are read again
   and their digests compared; a span that differs (a collision of hashes) is not removed.

Rows with the same doc_id and text are one document; rows with the same doc_id and different texts
are ordered by a hash of the text. A null doc_id comes before all others; a null text has no words.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm import tools
from hirelens.llm.suffix_dedup import sliding_minimum

GRAM = 4
#: Window starts handled at once; below 2^20 so that a place fits beside a hash.
STRIDE = 1 << 18
NO_ID = -(2**63)
#: A document is its id (doc) and a 64-bit hash of its text (tie); a place counts its words.
KEY = ("doc", "tie")
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def prefix_sums(words: np.ndarray) -> np.ndarray:
    """For ``tools.span_hashes`` over places in a sequence of word hashes."""
    prefix = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * tools.powers(len(words))[0], out=prefix[1:])
    return prefix


def edges(words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each window of k words."""
    at = np.arange(len(words) - k + 1)
    return tuple(tools.plain_long(tools.span_hashes(prefix_sums(w), at, at + k)) for w in (words, tools.mix(words + np.uint64(1))))


def fragments(words: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Fragments of texts that end at ``ends``: start, windows, offset of the gram, its hash, hash of all."""
    if len(words) < k:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    prefix = prefix_sums(words)
    at = np.arange(len(words) - GRAM + 1)
    grams = tools.span_hashes(prefix, at, at + GRAM)
    place = np.uint64((1 << 20) - 1)
    lowest = sliding_minimum((grams & ~place) | at.astype(np.uint64), k - GRAM + 1)
    mark = (lowest & place).astype(np.int64)
    start = np.arange(len(mark))
    text = np.searchsorted(ends, start, "right")
    inside = np.flatnonzero(start + k <= ends[text])
    mark, text = mark[inside], text[inside]
    first = np.flatnonzero(np.concatenate(([True], (mark[1:] != mark[:-1]) | (text[1:] != text[:-1])))) if len(inside) else inside
    count = np.diff(np.append(first, len(inside)))
    begin, mark = inside[first], mark[first]
    whole = tools.span_hashes(prefix, begin, begin + count + k - 1)
    return begin, count, mark - begin, tools.plain_long(grams[mark]), tools.plain_long(tools.mix(whole ^ (mark - begin).astype(np.uint64)))


def _fragments(docs: DataFrame, k: int, grams_only: bool) -> DataFrame:
    """gram, path, doc, tie, place and shape (windows above the gram's offset, 16 bits) of every fragment."""
    names = ["gram"] if grams_only else ["gram", "path", "doc", "tie", "place", "shape"]

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"].to_pylist()]
            ids, ties = batch["doc"].to_numpy(), batch["tie"].to_numpy()
            for part in tools.chunks([len(t) for t in texts]):
                each = tools.word_hashes(texts[part])
                words, ends = np.concatenate(each), np.cumsum([len(w) for w in each])
                begins = np.append(0, ends[:-1])
                for low in range(0, max(1, len(words)), STRIDE):  # more than one round for a long text only
                    piece = words[low : low + STRIDE + k - 1]
                    cut = np.minimum(ends - low, len(piece))
                    begin, count, offset, gram, path = fragments(piece, cut[cut > 0], k)
                    if not len(begin):
                        continue
                    columns = [gram]
                    if not grams_only:
                        row = np.searchsorted(ends, begin + low, "right")
                        columns += [path, ids[part.start + row], ties[part.start + row], begin + low - begins[row], (count << 16 | offset).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    return docs.select(*KEY, "text").mapInArrow(run, ", ".join(f"{n} {'int' if n == 'shape' else 'long'}" for n in names))


def _texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of ``asked``, one per document, with the text; others are held back by a bitmap of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(tools.bitmap(asked.select(F.xxhash64(*KEY).alias("slot")), hashed=True))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(tools.in_bitmap(shared.value, batch["slot"].to_numpy()))).select([*KEY, "text"])

    near = docs.select(*KEY, "text", F.xxhash64(*KEY).alias("slot")).mapInArrow(run, "doc long, tie long, text string")
    return near.dropDuplicates(list(KEY)).join(asked, list(KEY))  # repeated rows meet in their tasks first


def _edges(docs: DataFrame, cuts: DataFrame, k: int) -> DataFrame:
    """e1, e2, doc, tie, place and before (e1 of the edge before it) of the edges of the fragments in ``cuts``."""

    def run(batches):
        for batch in batches:
            for doc, tie, text, cut in zip(batch["doc"].to_pylist(), batch["tie"].to_pylist(), batch["text"].to_pylist(), batch["cuts"], strict=True):
                one, two = edges(tools.word_hashes([text.encode()])[0], k)
                place, count = cut.values.field("place").to_numpy(), cut.values.field("windows").to_numpy()
                head = np.repeat(np.cumsum(count) - count, count)
                at = np.repeat(place, count) + np.arange(count.sum()) - head
                first = np.arange(len(at)) == head
                before = pa.array(one[np.maximum(at - 1, 0)], mask=first)
                yield pa.RecordBatch.from_arrays([pa.array(one[at]), pa.array(two[at]), *(pa.array(np.full(len(at), x)) for x in (doc, tie)), pa.array(at), before], ["e1", "e2", *KEY, "place", "before"])

    return _texts(docs, cuts).select(*KEY, "text", "cuts").mapInArrow(run, "e1 long, e2 long, doc long, tie long, place long, before long")


def _where(alias: str = "place") -> Column:
    return F.struct(*KEY, F.col(alias).alias("place"))


def compacted(found: DataFrame) -> DataFrame:
    """Nonbranching paths of repeated edges: e1 and e2 of the head, first (its coordinates) and length.

    ``found`` has e1, e2, doc, tie, place and before of every occurrence.
    """
    repeated = (
        found.groupBy("e1", "e2")
        .agg(F.count("*").alias("n"), F.min(_where()).alias("first"), F.min("before").alias("x"), F.max("before").alias("y"), F.count("before").alias("preceded"))
        .filter("n > 1")
        .select("e1", "e2", "n", "first.*", F.expr("preceded = n and x = y").alias("one_before"))
    )
    repeated = tools.staged(repeated, "repeated-edges")
    ahead = repeated.select(*KEY, (F.col("place") + 1).alias("place"), F.col("n").alias("n_before"))
    linked = repeated.join(ahead, [*KEY, "place"], "left").withColumn("head", ~F.coalesce(F.col("one_before") & (F.col("n") == F.col("n_before")), F.lit(False)))
    path = F.sum(F.col("head").cast("long")).over(Window.partitionBy(*KEY).orderBy("place"))
    paths = linked.withColumn("path", path).groupBy(*KEY, "path")
    return paths.agg(F.min(F.struct("place", "e1", "e2")).alias("head"), F.count("*").alias("length")).select(
        "head.e1", "head.e2", F.struct(*KEY, "head.place").alias("first"), "length"
    )


def repeats(docs: DataFrame, k: int = 20) -> DataFrame:
    """Long spans to remove: doc, tie, place, windows and source (the coordinates they repeat). docs has doc, tie and text."""
    shared = _fragments(docs, k, True).groupBy("gram").count().filter("count > 1")
    kept = tools.staged(tools.of_shared_keys(_fragments(docs, k, False), shared, "gram", [*KEY, "place"]), "fragments")
    firsts = tools.staged(kept.groupBy("gram", "path").agg(F.min(_where()).alias("first"), F.min("shape").alias("shape")), "paths")
    late = kept.join(firsts.select("gram", "path", F.col("first").alias("source")), ["gram", "path"]).filter(_where() != F.col("source"))
    late = late.select(*KEY, "place", F.shiftright("shape", 16).cast("long").alias("windows"), "source")

    branching = firsts.groupBy("gram").count().filter("count > 1").select("gram")
    cuts = firsts.join(branching, "gram").select("first.*", F.shiftright("shape", 16).cast("long").alias("windows"))
    cuts = tools.staged(cuts.groupBy(*KEY).agg(F.collect_list(F.struct("place", "windows")).alias("cuts")), "cuts")
    found = tools.staged(_edges(docs, cuts, k), "edges")
    paths = compacted(found).select("e1", "e2", F.col("first").alias("source"), F.col("length").alias("windows"))
    again = found.join(paths, ["e1", "e2"]).filter(_where() != F.col("source")).select(*KEY, "place", "windows", "source")

    spans = late.union(again).withColumn("shift", F.col("source.place") - F.col("place"))
    line = [*KEY, "source.doc", "source.tie", "shift"]
    before = Window.partitionBy(*line).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("new", F.coalesce(F.col("place") > F.max(F.col("place") + F.col("windows")).over(before), F.lit(True)))
    spans = spans.withColumn("span", F.sum(F.col("new").cast("long")).over(Window.partitionBy(*line).orderBy("place")))
    glued = spans.groupBy(*KEY, F.col("source.doc").alias("source_doc"), F.col("source.tie").alias("source_tie"), "shift", "span")
    ends = glued.agg(F.min("place").alias("place"), F.max(F.col("place") + F.col("windows")).alias("end"))
    source = F.struct(F.col("source_doc").alias("doc"), F.col("source_tie").alias("tie"), (F.col("place") + F.col("shift")).alias("place"))
    return ends.select(*KEY, "place", (F.col("end") - F.col("place")).alias("windows"), source.alias("source"))


def _cut(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """For each document with ``spans`` (place, words, own): a digest of each span, and the text without its own ones."""
    digest, result = [("place", pa.int64()), ("words", pa.int64()), ("digest", pa.binary())], [("n_removed", pa.int64()), ("kept", pa.string()), ("sha", pa.string())]

    def run(batches):
        for batch in batches:
            rows = []
            for doc, tie, text, spans in zip(batch["doc"].to_pylist(), batch["tie"].to_pylist(), batch["text"].to_pylist(), batch["spans"], strict=True):
                words = _WORDS.findall(text.encode())
                places, sizes, owns = (spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("place", "words", "own"))
                change = np.zeros(len(words) + 1, np.int64)
                for place, size, own in zip(places.tolist(), sizes.tolist(), owns, strict=True):
                    rows.append((doc, tie, place, size, hashlib.blake2b(b" ".join(words[place : place + size]), digest_size=16).digest(), None, None, None))
                    if own:
                        change[place] += 1
                        change[place + size] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x)
                if owns.any():
                    rows.append((doc, tie, None, None, None, int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
            fields = [("doc", pa.int64()), ("tie", pa.int64()), *digest, *result]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

    schema = "doc long, tie long, place long, words long, digest binary, n_removed long, kept string, sha string"
    return _texts(docs, asked).select(*KEY, "text", "spans").mapInArrow(run, schema)


def _asked(spans: DataFrame) -> DataFrame:
    """One row per document: its own spans, and those of it that others repeat."""
    own = spans.select(*KEY, "place", "words", F.lit(True).alias("own"))
    lent = spans.select("source.*", "words").distinct().select(*KEY, "place", "words", F.lit(False).alias("own"))
    return own.union(lent).groupBy(*KEY).agg(F.collect_list(F.struct("place", "words", "own")).alias("spans"))


def deduplicated(docs: DataFrame, k: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, null if all do) and kept_sha256."""
    tools.small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.withColumns({"doc": F.coalesce("doc_id", F.lit(NO_ID)), "tie": F.xxhash64("text")})
    spans = tools.staged(repeats(docs, k).select(*KEY, "place", (F.col("windows") + k - 1).alias("words"), "source"), "spans")
    read = tools.staged(_cut(docs, tools.staged(_asked(spans), "asked")), "cut")

    digests = read.filter("digest is not null").select(*KEY, "place", "words", "digest").distinct()
    there = digests.select(F.struct(*KEY, "place").alias("source"), "words", F.col("digest").alias("expected"))
    wrong = tools.staged(spans.join(digests, [*KEY, "place", "words"]).join(there, ["source", "words"]).filter("digest <> expected").drop("digest", "expected"), "wrong")
    done = read.filter("sha is not null")
    if not wrong.isEmpty():
        right = spans.join(wrong.select(*KEY).distinct(), list(KEY), "left_semi").join(wrong, [*KEY, "place", "words", "source"], "left_anti")
        again = _cut(docs, tools.staged(_asked(right).filter("exists(spans, x -> x.own)"), "asked")).filter("sha is not null")
        done = done.join(wrong.select(*KEY).distinct(), list(KEY), "left_anti").union(again)

    plain = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    own = docs.select("doc_id", *KEY, plain.alias("plain"))
    n_words = F.when(F.col("plain") == "", 0).otherwise(F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1)
    own = own.select("doc_id", *KEY, n_words.cast("long").alias("n_words"), F.sha2("plain", 256).alias("own"))
    found = own.join(done.select(*KEY, "n_removed", "kept", "sha"), list(KEY), "left")
    return found.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), "kept", F.coalesce("sha", "own").alias("kept_sha256"))
