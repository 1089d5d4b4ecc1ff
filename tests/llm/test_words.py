"""Near duplicates, decontamination and byte removal against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import decontamination, near_duplicates, suffix_dedup, tools

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def word_set(text, size):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_components(rows, size, num, den):
    sets = [word_set(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * len(sets[i] | sets[j]):
            parent[find(j)] = find(i)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return sorted(
        ((r[0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i, r in enumerate(rows)),
        key=str,
    )


def family(seed, n, length=60, edits=6):
    """A text and versions of it with up to so many words replaced."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    versions = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        versions.append(" ".join(words))
    return versions


@pytest.mark.parametrize(("size", "num", "den"), [(3, 85, 100), (5, 80, 100)])
def test_components(docs, size, num, den):
    texts = family(1, 40) + family(2, 30, 30, 3) + ["the same line " * 4] * 5 + ["", None, " \n ", "One", "one", "two words", "Two  Words\n", "A b c", "ä Ä b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (7, "an id used twice " + texts[50]), (None, texts[0]), (None, "alone with no id at all")]
    got = near_duplicates.near_duplicates(docs(*rows), size, num, den).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows, size, num, den)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_parity_maps_never_exceed_the_difference():
    rng = random.Random(9)
    for _ in range(200):
        common, one, two = ([rng.getrandbits(64) for _ in range(rng.randrange(1, 300))] for _ in range(3))
        a, b = (np.unique(np.array(x, np.uint64)) for x in (common + one, common + two))
        bits = np.bitwise_count((near_duplicates.parity(a) ^ near_duplicates.parity(b)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2


def test_a_large_family_makes_few_pairs(docs, monkeypatch):
    """Versions of one text, most of them too far apart: the last round compares few of all pairs."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in base) for share in [rng.choice([0.01, 0.03, 0.06, 0.1]) for _ in range(240)]]
    rows = list(enumerate(texts))
    pairs = []
    real = near_duplicates._confirmed
    monkeypatch.setattr(near_duplicates, "_confirmed", lambda found, *rest: (pairs.append(found.count()), real(found, *rest))[1])
    found = near_duplicates.near_duplicates(docs(*rows))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert got == brute_components(rows, 5, 80, 100)
    assert sum(pairs) < 240 * 239 // 2 // 5


def test_keep_one_keeps_columns_and_unrelated_rows(docs):
    rows = docs((1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "quite another text with this id"), (3, None), (None, ""))
    kept = near_duplicates.keep_one(rows, 3, 85, 100)
    assert kept.columns == rows.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text) == [("1", "a b c d e f g h"), ("2", "quite another text with this id")]
    assert kept.count() == 4


def test_keep_one_leaves_one_row_of_a_group(docs):
    a, b, c = ([f"{x}{i}" for i in range(40)] for x in "abc")
    near = lambda words: " ".join([*words[:-1], "changed"])
    rows = docs(
        *[(1, " ".join(a))] * 5, (1, near(a)), (2, " ".join(a)), *[(None, " ".join(a))] * 3, *[(None, " ".join(b))] * 4, (None, near(b)), (None, " ".join(c)), (None, near(c)), (None, "alone with no id"),
        (3, "alone with an id"), (4, "a repeated row alone"), (4, "a repeated row alone"), (None, ""), (None, ""), (5, None),
    )
    kept = near_duplicates.keep_one(rows, 3, 80, 100)
    assert kept.columns == rows.columns
    got = sorted(((str(r.doc_id), (r.text or "")[:1]) for r in kept.collect()))
    assert got == sorted([("1", "a"), ("None", "b"), ("None", "c"), ("None", "a"), ("3", "a"), ("4", "a"), ("None", ""), ("None", ""), ("5", "")])


def test_no_documents(docs, spark):
    empty = docs((1, "a")).limit(0)
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert near_duplicates.near_duplicates(empty).count() == 0
    assert decontamination.contaminated(empty, items).count() == 0
    assert decontamination.contaminated(docs((1, "some words")), items.limit(0)).count() == 0
    assert suffix_dedup.deduplicated(empty).count() == 0


@pytest.mark.parametrize("in_one_task", [tools.IN_ONE_TASK, 0])
def test_component_labels(spark, monkeypatch, in_one_task):
    monkeypatch.setattr(tools, "IN_ONE_TASK", in_one_task)
    assert tools.components(spark.createDataFrame([], "a long, b long")).count() == 0
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in tools.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: y for x, y in label.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_masks_meet_two_substitutions_in_thirteen():
    offsets = [(len(m), [i for i, b in enumerate(m) if b == "1"]) for m in decontamination.MASKS]
    for gone in itertools.combinations(range(13), 2):
        assert any(all(s + i not in gone for i in o) for n, o in offsets for s in range(13 - n + 1))


@pytest.mark.parametrize("window, agree", [*((n, 80) for n in range(1, 21)), (13, 70), (13, 60), (15, 80), (17, 90), (16, 50), (30, 95)])
def test_masks_meet_all_allowed_substitutions(window, agree):
    masks = decontamination.masks_of(window, agree)
    places = [{s + i for i, b in enumerate(m) if b == "1"} for m in masks for s in range(window - len(m) + 1)]
    allowed = max(n for n in range(window) if 100 * (window - n) >= agree * window)
    for gone in itertools.combinations(range(window), allowed):
        assert any(p.isdisjoint(gone) for p in places), gone


def test_decontamination_by_another_region(docs, spark):
    """16 of 20 words agree, in a pattern that the masks of 13 words miss."""
    item = [f"i{n}" for n in range(20)]
    rows = [(k, " ".join(f"x{n}" if n in gone else w for n, w in enumerate(item))) for k, gone in enumerate([(3, 7, 11, 15), (3, 8, 11, 16), (4, 7, 10, 13), (2, 7, 12, 17), (1, 5, 9, 13, 17)])]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontamination.contaminated(docs(*rows), items, region=20, agree=80)
    assert {r.doc_id: r.n_matched for r in found.collect()} == {0: 16, 1: 16, 2: 16, 3: 16}


def test_decontamination_by_short_items(docs, spark):
    rows, items, expect = [], [], set()
    for length in range(1, 14):
        words = [f"t{length}i{i}" for i in range(length)]
        items.append((length, " ".join(words)))
        allowed = length // 5
        for gone in [c for n in range(allowed + 2) for c in itertools.combinations(range(length), n)][:150]:
            expect |= {(len(rows), length)} if len(gone) <= allowed else set()
            rows.append((len(rows), "before it " + " ".join("other" if i in gone else w for i, w in enumerate(words)) + " and after"))
    found = decontamination.contaminated(docs(*rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expect
    region = decontamination.contaminated(docs((1, "x a b c other e y")), spark.createDataFrame([(1, "a b c d e " + "f " * 20)], "item_id long, text string"), region=5)
    assert region.count() == 1


def test_decontamination(docs, spark):
    rng = random.Random(3)
    item = [f"q{i}" for i in range(30)]
    changed = item[5:20]
    changed[4], changed[9] = "other", "words"
    noise = " ".join(f"n{rng.randrange(10**6)}" for _ in range(50))
    rows = [
        (1, f"{noise}. {' '.join(item).upper()}! {noise}"), (2, noise + " " + ", ".join(changed)), (3, noise), (4, None), (5, ""), (6, " ".join(item[:12])),
        (7, "short Question, here"), (8, "short question"), (1, noise), (None, " ".join(item)), (9, " ".join(item[i] if i % 2 else "z" for i in range(30))),
    ]
    items = spark.createDataFrame([(10, " ".join(item)), (11, "Short question here?"), (12, None), (13, ""), (10, " ".join(item)), (None, "n0 of no id " + " ".join(item[:3]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs(*rows), items).collect()}
    assert set(got) == {(1, 10), (2, 10), (None, 10), (7, 11)}
    assert (got[1, 10].n_words, got[1, 10].n_matched, got[1, 10].start_word) == (30, 30, 50)
    assert got[2, 10].n_matched == 13
    kept = decontamination.keep_clean(docs(*rows), items)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "8", "9"]


def brute_bytes(rows, length):
    """Removed bytes of documents in the order given."""
    seen, out = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé \n") for _ in range(rng.randrange(90, 260))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(shared)[: rng.randrange(60, 300)] if rng.random() < 0.5 else "".join(rng.choice("uvwxyzß ") for _ in range(rng.randrange(120))) for _ in range(rng.randrange(5))]
        texts.append("".join(parts))
    return [*texts, "x" * 450, "xy" * 130, "x" * 99, "x" * 100, None, "", texts[4], "😀" * 70, "a" + "😀" * 60]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup(docs, seed, monkeypatch):
    rows = list(enumerate(passages(seed)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduplicated(docs(*rows)).collect()}
    assert [got[i] for i in range(len(rows))] == brute_bytes(rows, 100)


def test_split_collections(docs, monkeypatch):
    """Anchors with many slices are dealt over several collections and meet again by digest."""
    monkeypatch.setattr(suffix_dedup, "PER_COLLECTION", 3)
    rng = random.Random(9)
    tail = "".join(rng.choice("abc ") for _ in range(150))
    rows = [(i, "".join(rng.choice("uvwxyz") for _ in range(rng.randrange(80))) + tail[: rng.randrange(100, 150)]) for i in range(60)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduplicated(docs(*rows)).collect()}
    assert [got[i] for i in range(len(rows))] == brute_bytes(rows, 100)


def test_repeated_rows_are_one_document(docs):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(300))
    got = suffix_dedup.deduplicated(docs((1, text), (1, text), (None, text), (2, text))).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 300), ("1", 300), ("2", 300), ("None", 0)]


def test_texts_without_id_are_told_apart(docs, spark):
    """Texts whose hashes agree in their low 23 bits, all without an id or with the same one."""
    found = spark.range(40_000).selectExpr("concat('n', id, ' ') AS t", "xxhash64(concat('n', id, ' ', repeat('abcdefghij', 12))) & 8388607 AS low")
    groups = found.groupBy("low").agg({"t": "collect_list"}).toDF("low", "ts").filter("size(ts) > 1").collect()
    texts = [t + "abcdefghij" * 12 for g in groups for t in g.ts]
    assert len(texts) > 20
    for key in (None, 7):
        got = suffix_dedup.deduplicated(docs(*((key, t) for t in texts), (key, texts[0]))).collect()
        ordered = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").orderBy(F.xxhash64("t")).collect()]
        expect = brute_bytes([(key, t) for t in ordered], 100)
        again = expect[ordered.index(texts[0])]
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted([*expect, again])


def test_long_text_is_worked_off_in_pieces(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRIDE", 500)
    rng = random.Random(4)
    block = "".join(rng.choice("abcdefgh") for _ in range(700))
    rows = [(1, block + "".join(rng.choice("klm") for _ in range(900)) + block), (2, "z" * 30 + block[100:650])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduplicated(docs(*rows)).collect()}
    assert [got[i] for i in (1, 2)] == brute_bytes(rows, 100)


def test_rows_of_shared_keys(spark, monkeypatch):
    """A hot key is broadcast and spread, the others meet in the shuffle; the rows are those of a plain join."""
    monkeypatch.setattr(tools, "HOT", 10)
    rows = [(0, i) for i in range(500)] + [(1 + i // 3, i) for i in range(60)] + [(1000 + i, i) for i in range(40)]
    found = spark.createDataFrame(rows, "k long, x long")
    kept = tools.of_shared_keys(found, found.groupBy("k").count().filter("count > 1"), "k", ["x"])
    assert sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[0] < 1000) and kept.columns == ["k", "x"]
    assert tools.of_shared_keys(found.limit(0), found.groupBy("k").count(), "k", ["x"]).count() == 0


def test_batches_for_workers_are_bounded_in_bytes(spark):
    """A thousand long texts, or pairs of them, are many megabytes."""
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "rows"])

    tools.small_batches(spark)
    texts = spark.range(0, 1200, 1, 1).select(F.repeat(F.lit("é"), 20_000).alias("text"))
    found = texts.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in found) == 1200
    assert max(r["bytes"] for r in found) < 2 * tools.BATCH_BYTES
