"""Prefix trie, ranked search and repeated word runs against brute force."""

import random

import numpy as np
import pytest
from brute_force import brute_runs, brute_search, brute_trie
from pyspark.sql import functions as F

from hirelens.llm import lexical_search, prefix_trie, substring_dedup


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- prefix trie ------------------------------------------------------------------------------


@pytest.fixture
def talks(spark):
    """conversations from tuples, with columns that clash with helpers."""

    def build(rows):
        table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
        return table.selectExpr("*", "1 AS conv", "2 AS pos", "3 AS place", "'x' AS a", "4 AS depth", "5 AS name")

    return build


def test_trie_equals_brute_force(talks):
    rng = random.Random(11)
    rows = []
    for conv in [*range(0, 12), *range(95, 112), -7, -100, 400]:
        rows += [(conv, t, rng.choice(["user", "bot"]), rng.choice(["hi", "a longer reply", "é😀", ""])) for t in range(rng.choice([0, 1, 2, 3, 6, 9]))]
    rows += [(200, t, "user", f"t{t % 5}") for t in range(70)]  # far deeper than all others
    rows += [(203, t, "user", f"t{t % 5}") for t in range(67)]
    rng.shuffle(rows)
    assert rows_of(prefix_trie.report(talks(rows))) == sorted(brute_trie(rows), key=repr)


def test_trie_of_nulls_ties_and_turnless_conversations(talks):
    rows = [(1, None, "a", "x"), (1, 2, None, None), (None, 1, "a", "b"), (100, 0, "u", "hé"), (100, 1, "u", "b"), (100, 1, "u", "b"), (101, 0, "q", "z"), (102, 0, "u", "hé"), (150, 0, "z", None)]
    found = rows_of(prefix_trie.report(talks(rows)))
    assert found == sorted(brute_trie(rows), key=repr)
    assert (1, 0, None) in [r[:3] for r in found]


def test_trie_orders_equal_turns_by_content(talks):
    rows = [(300, 5, "u", f"text {i}") for i in range(6)] + [(306, 1, "u", "own")]
    assert rows_of(prefix_trie.report(talks(rows))) == rows_of(prefix_trie.report(talks(rows[::-1])))


def test_trie_without_conversations(talks):
    assert prefix_trie.report(talks([])).collect() == []
    assert prefix_trie.report(talks([(None, 1, "u", "x")])).collect() == []


def test_one_conversation_node_holds_most_ends(talks):
    """More conversations end in one node than a chunk of its digest has."""
    rows = [(c, 0, "u", "same") for c in range(1, 2 * prefix_trie.CHUNK + 500, 100)] + [(c, t, "u", "x") for c in range(7, 90) for t in range(6)]
    assert rows_of(prefix_trie.report(talks(rows))) == sorted(brute_trie(rows), key=repr)


def test_digest_of_several_chunks(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    ends = spark.range(100).select(F.lit(3).cast("long").alias("depth"), (F.col("id") % 3).alias("name"), F.col("id").alias("conv"))
    found = {r.name: r.ends_sha256 for r in prefix_trie._ends(ends).collect()}
    assert found == {m: hashlib.sha256(",".join(str(i) for i in range(100) if i % 3 == m).encode()).hexdigest() for m in range(3)}


# --- ranked search ----------------------------------------------------------------------------


@pytest.fixture
def table(spark):
    def build(rows, key):
        return spark.createDataFrame(rows, f"{key} long, text string").selectExpr("*", "1 AS item", "2 AS n", "'x' AS terms", "3 AS counts", "4 AS doc", "5 AS tie", "6 AS place", "7 AS plain")

    return build


def texts(rng, n, longest):
    """Texts whose words are drawn with very different frequencies."""
    words = [f"w{i}" for i in range(60)] + ["Ünï", "ab-cd", "X1y", "..."]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("block", [lexical_search.BLOCK, 16])
def test_search_equals_brute_force(table, monkeypatch, block):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "CELLS", 4000)  # several document trees per partition
    rng = random.Random(12)
    docs = [*enumerate(texts(rng, 400, 40)), *((1000 + i, "w1 w2 w2 w50 same copy") for i in range(90))]
    docs += [(3, "w1 w59 again"), (None, "w1 w2 w50"), (2000, None), (2001, ""), (2002, "w3 " * 5000)]
    items = [*enumerate(texts(rng, 30, 12)), (90, None), (91, "no such words"), (92, "w1 w2 w50 copy"), (92, "w59"), (None, "w58 w58")]
    found = rows_of(lexical_search.ranked(table(docs, "doc_id"), table(items, "item_id")))
    assert found == sorted(brute_search(docs, items), key=repr)


def test_search_of_empty_tables(table):
    some = [(1, "a b")]
    assert lexical_search.ranked(table([], "doc_id"), table(some, "item_id")).collect() == []
    assert lexical_search.ranked(table(some, "doc_id"), table([], "item_id")).collect() == []
    assert lexical_search.ranked(table([(1, None)], "doc_id"), table(some, "item_id")).collect() == []


def test_bounds_prune_whole_batches(monkeypatch):
    """A node pair whose bound is below the weakest k-th best score never reaches its leaves."""
    rng = np.random.default_rng(1)
    block = lexical_search.Block([(i, np.array([i, 100]), np.array([1000, 1])) for i in range(16)])
    rows, columns = np.arange(4096), np.searchsorted(block.terms, rng.integers(0, 16, 4096))
    best = lexical_search.Best(np.zeros(16, np.int64), 3)
    offered = []
    take = best.offer
    monkeypatch.setattr(best, "offer", lambda item, scores, docs: (offered.append(len(docs)), take(item, scores, docs)))
    values = rng.integers(1, 1000, 4096) * 1000
    lexical_search.search(block, np.arange(4096), rows, columns, values, best)
    for item in range(16):
        expected = sorted((-int(v) * 1000, int(d)) for d, c, v in zip(rows, columns, values, strict=True) if block.terms[c] == block.items[item])[:3]
        assert [(-int(s), int(d)) for s, d in zip(*best.held[item], strict=True)] == expected
    assert sum(offered) < 2000  # of 4,096 scores above 0 and 65,536 pairs of leaves


# --- repeated word runs -----------------------------------------------------------------------


def test_runs_equal_brute_force(table, monkeypatch):
    monkeypatch.setattr(substring_dedup, "STRIDE", 64)  # long texts are cut anywhere
    rng = random.Random(13)
    line = " ".join(f"q{i}" for i in range(30))
    rows = [(None, f"{line} {line}"), (0, None), (1, " \n\t"), (2, line), (3, line + " end"), (4, "a " * 500), (5, "a " * 40)]
    for i in range(6, 200):
        parts = [rng.choice([line, line.replace("q7 ", "q7b "), "a b", rng.choice("abc"), "x\ny\x0bz", "é ü"]) for _ in range(rng.choice([0, 2, 12, 40]))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    found = substring_dedup.deduplicated(table(rows, "doc_id"), 8)
    assert rows_of(found.drop("kept")) == sorted(brute_runs(rows, 8), key=repr)


def test_runs_of_repeated_rows_and_ids(table):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, text), (1, text), (2, text), (3, "only " + text), (3, text + " other"), (4, "")]
    found = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.deduplicated(table(rows, "doc_id")).collect()}
    assert found[1, 25] == 0 and found[2, 25] == 25 and found[4, 0] == 0
    assert sorted(found[3, n] for n in (26,)) == [25]
    assert substring_dedup.deduplicated(table([], "doc_id")).collect() == []


def test_nonbranching_paths_compact(spark):
    """c d e always follow each other; f is entered from e and from g, so it heads a path."""
    lines = ["abcdef", "xcdef", "gf", "cde"]
    rows = [(i, 0, p, ord(s[p]), ord(s[p]), ord(s[p - 1]) if p else None) for i, s in enumerate(lines) for p in range(len(s))]
    found = spark.createDataFrame(rows, "doc long, tie long, place long, e1 long, e2 long, before long")
    paths = {chr(r.e1): (r.first.doc, r.first.place, r.length) for r in substring_dedup.compacted(found).collect()}
    assert paths == {"c": (0, 2, 3), "f": (0, 5, 1)}


def test_a_span_that_differs_from_its_source_stays(table, monkeypatch):
    line = " ".join(f"w{i}" for i in range(30))
    rows = [(1, line), (2, line + " and more words"), (3, " ".join(f"v{i}" for i in range(30)))]
    real = substring_dedup.repeats

    def with_collision(docs, k):
        three = docs.filter("doc = 3").select("doc", "tie", F.lit(2).cast("long").alias("place"), F.lit(4).cast("long").alias("windows"))
        one = docs.filter("doc = 1").select(F.struct("doc", "tie", F.lit(0).cast("long").alias("place")).alias("source"))
        return real(docs, k).union(three.crossJoin(one))

    monkeypatch.setattr(substring_dedup, "repeats", with_collision)
    found = rows_of(substring_dedup.deduplicated(table(rows, "doc_id")).drop("kept"))
    assert found == sorted(brute_runs(rows, 20), key=repr)
