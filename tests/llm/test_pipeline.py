"""The pipeline stage by stage against brute force, and the queries over the smallest tables."""

import re

import numpy as np
import pytest
from conftest_llm import brute_groups, brute_pii_spans

import corpus_pipeline
from hirelens.llm import decontamination, entries, quality_classifier, sentencepiece_codec

SMALL = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, the documents first."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        table = stage(spark, found[-1], SMALL)
        found.append(spark.createDataFrame(table.collect(), table.schema))
    return found


def rows_of(table):
    return {r.doc_id: r for r in table.collect()}


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "pii", "sentencepiece_codec"]
    assert all(table.columns == DOCUMENT for table in stages[:-1])


def test_quality(spark, stages):
    stats = quality_classifier.statistics_of(stages[0])
    model = quality_classifier.train(stats, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in quality_classifier.score(stats, model).collect() if r.predicted == 1}
    assert set(rows_of(stages[1])) == good and 0.8 * 200 < len(good) < 200


def test_near_copies(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    group = brute_groups(before, 5, 80, 100)
    assert set(rows_of(stages[2])) == {i for i, _ in before if group[i] == i}


def test_benchmark(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    words = decontamination.words_of(items)
    clean = set()
    for row in stages[2].collect():
        (doc,) = decontamination.words_of([row.text])
        places = {}
        for i, h in enumerate(doc.tolist()):
            places.setdefault(h, []).append(i)
        hit = False
        for item in words:
            shifts = {i - j for j, h in enumerate(item.tolist()) for i in places.get(h, ())}
            hit = hit or any(decontamination.overlap(doc, item, s, 13, 80) for s in shifts)
        if not hit:
            clean.add(row.doc_id)
    assert set(rows_of(stages[3])) == clean < set(rows_of(stages[2]))


def test_redaction(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert set(before) == set(after)
    changed = 0
    for i, row in before.items():
        text, at = "", 0
        for start, end, kind in brute_pii_spans(row.text):
            if start >= at:
                text, at = text + row.text[at:start] + f"[{kind.upper()}]", end
        assert after[i].text == text + row.text[at:]
        assert after[i].n_chars == len(after[i].text)
        changed += after[i].text != row.text
    assert changed > 0


def test_tokens(stages):
    judge = sentencepiece_codec.reference(open(entries.MODEL_PATH, "rb").read())
    before, after = rows_of(stages[4]), rows_of(stages[5])
    assert set(before) == set(after)
    for i, row in after.items():
        assert row.text == before[i].text and row.round_trip and row.n_tokens == len(row.ids)
        assert row.ids == judge.encode(row.text)


def test_run_returns_the_last_stage(spark, stages):
    assert {tuple(r.ids) for r in corpus_pipeline.run(spark, SMALL).collect()} == {tuple(r.ids) for r in stages[-1].collect()}


def test_every_operator_has_a_query():
    assert [re.match(r"op(\d+)_", name)[1] for name in entries.QUERIES] == [str(n) for n in range(1, 14)]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = entries.op10_quality_classifier(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = scored[scored.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and np.mean(held.predicted == held.quality) > 0.95
