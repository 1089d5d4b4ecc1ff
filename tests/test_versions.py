"""Versions: what readers see while builds run, end, die or race."""

import pytest
from pyspark.sql import functions as F

from hirelens.sources.versions import WHOLE, Conflict, Store


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder("versions"))


def rows(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def part():
    return F.col("id") % 4


def ids(store, version, parts=None):
    schema = store.spark.range(0).schema
    return sorted(r.id for r in store.read(version, "t", schema, parts).collect())


def first(store):
    draft = store.draft()
    draft.replace("t", rows(store.spark, *range(8)), part(), ["0", "1", "2", "3"])
    return draft.publish()


def test_nothing_is_there_before_a_publish(store):
    assert store.current().number == 0 and ids(store, store.current()) == []
    draft = store.draft()
    draft.replace("t", rows(store.spark, 1), part(), ["1"])
    assert store.current().number == 0


def test_only_touched_parts_get_new_folders(store):
    one = first(store)
    draft = store.draft()
    draft.replace("t", rows(store.spark, 5, 9), part(), ["1", "2"])
    two = draft.publish()
    assert ids(store, two) == [0, 3, 4, 5, 7, 9] and ids(store, one) == list(range(8))
    assert [p for p in "013" if two.tables["t"][p] == one.tables["t"][p]] == ["0", "3"]
    assert "2" not in two.tables["t"]
    read = store.read(two, "t", store.spark.range(0).schema, ["1"])
    assert all("_part=1" in f for f in read.inputFiles()) and ids(store, two, ["1"]) == [5, 9]


def test_rows_outside_the_touched_parts_are_refused(store):
    with pytest.raises(ValueError, match="not read"):
        store.draft().replace("t", rows(store.spark, 1, 2), part(), ["1"])


def test_the_second_of_two_builds_is_refused(store):
    base = first(store)
    fast, slow = store.draft(base), store.draft(base)
    for draft, i in ((fast, 100), (slow, 200)):
        draft.replace("t", rows(store.spark, i), part(), ["0"])
    fast.publish()
    with pytest.raises(Conflict):
        slow.publish()
    assert ids(store, store.current(), ["0"]) == [100]


def test_an_unfinished_folder_is_not_published(store):
    draft = store.draft(first(store))
    draft.put("t", "t/never-written")
    with pytest.raises(FileNotFoundError):
        draft.publish()
    assert store.current().number == 1


def test_a_whole_table_replaces_all_parts_and_rows_append(store):
    one = first(store)
    draft = store.draft(one)
    rows(store.spark, 42).write.parquet(f"{store.root}/{draft.folder('t')}")
    draft.put("t")
    two = draft.publish()
    assert list(two.tables["t"]) == [WHOLE] and ids(store, two) == [42]
    draft = store.draft()
    draft.append("t", rows(store.spark, 43))
    assert ids(store, draft.publish()) == [42, 43]


def test_expiry_keeps_what_newer_versions_name(store):
    one = first(store)
    for i in (4, 8):
        draft = store.draft()
        draft.replace("t", rows(store.spark, i), part(), ["0"])
        draft.publish()
    gone = store.expire(keep=1)
    assert len(gone) == 2 and one.tables["t"]["0"] in gone and one.tables["t"]["1"] not in gone
    assert ids(store, store.current()) == [1, 2, 3, 5, 6, 7, 8]
    assert store.expire(keep=1) == []
