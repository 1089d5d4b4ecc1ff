"""De-duplication, keys, lookups, filters, inserts and the split."""

from helpers import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens.operators import dedup, insert, keys, lookup, split, wildcard


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dense_key_equals_global_row_number_with_a_hot_value(spark):
    df = spark.range(20_000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("d"),
        F.concat(F.lit("J"), F.col("id")).alias("j"),
    )
    order = [F.col("d").asc_nulls_first(), F.col("j")]
    expected = df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    found = keys.dense_key(df, "k", order).select("d", "j", "k")
    assert bag(found) == bag(expected)


def test_dense_key_splits_a_hot_value_over_tasks(spark):
    df = spark.range(40_000, numPartitions=4).select(F.lit("same").alias("d"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        staged = keys.staged_in_order(df, [F.col("d"), F.col("id")])
        sizes = staged.groupBy("_part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8
    assert max(row["count"] for row in sizes) < 10_000


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert keys.dense_key(empty, "k", [F.col("id")]).count() == 0


def lookup_case(spark):
    rows = spark.range(9_000).select(
        F.col("id").cast("string").alias("job"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("c"), F.col("id") % 700))
        .alias("name"),
    )
    dim = (
        rows.filter("name IS NOT NULL")
        .groupBy("name")
        .agg(F.count("*").alias("refs"))
        .withColumn("key", F.xxhash64("name"))
    )
    return rows, dim


def test_large_dimension_gives_the_same_join(spark):
    rows, dim = lookup_case(spark)
    small = lookup.attach(rows, dim, ["name"], "refs", "job")
    large = lookup.attach(rows, dim, ["name"], "refs", "job", broadcast_rows=0, hot_share=50)
    assert bag(small.select("job", "name", "key")) == bag(large.select("job", "name", "key"))
    assert small.count() == 9_000


def test_hot_rows_spread_in_the_shuffled_join(spark):
    rows, dim = lookup_case(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = lookup.attach(rows, dim, ["name"], "refs", "job", broadcast_rows=0, hot_share=50)
        plan = plan_of(large)
        sizes = large.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "_salt" in plan
    assert max(row["count"] for row in sizes) < 9_000 / 4


def test_keep_one_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    one = dedup.keep_one(df, ["k"], [F.col("v").desc()])
    plan = plan_of(one)
    assert sorted(row.v for row in one.collect()) == list(range(993, 1000))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_wildcard(spark):
    df = spark.createDataFrame([("a", True), ("b", False), (None, None)], "s string, b boolean")
    assert wildcard.where_selected(df, {"s": "All", "b": "All"}).count() == 3
    assert bag(wildcard.where_selected(df, {"s": "a"})) == [("a", True)]
    assert bag(wildcard.where_selected(df, {"b": "true"})) == [("a", True)]
    assert wildcard.where_selected(df, {"b": "perhaps"}).count() == 0


def test_insert_only_keeps_present_rows(spark, folder):
    path = folder()
    schema = "id string, v string"
    insert.insert_only(spark.createDataFrame([("1", "old")], schema), path, ["id"])
    source = spark.createDataFrame([("1", "new"), ("2", "x"), ("2", "y"), ("3", "z")], schema)
    insert.insert_only(source, path, ["id"])
    insert.insert_only(source, path, ["id"])
    stored = spark.read.parquet(path)
    assert bag(stored) == [("1", "old"), ("2", "x"), ("3", "z")]


def test_large_and_small_sources_insert_alike(spark):
    source = spark.range(500).select((F.col("id") % 300).alias("id"), F.col("id").alias("v"))
    target = spark.range(100).withColumn("v", F.lit(-1))
    small = insert.new_rows(source, target, ["id"])
    large = insert.new_rows(source, target, ["id"], broadcast_rows=0)
    assert bag(small) == bag(large)
    assert small.count() == 200


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.concat(F.lit("J"), F.col("id")).alias("j"))
    first, rest = split.hash_split(df, "j")
    again, _ = split.hash_split(df.repartition(13), "j")
    assert bag(first) == bag(again)
    assert first.count() + rest.count() == 5000
    assert 0.77 < first.count() / 5000 < 0.83
