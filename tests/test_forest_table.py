"""A forest as a table against the model it came from."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.plans import forest_table, salary_model


def test_scores_of_numbers_equal_the_model(spark, folder):
    rows = spark.range(400).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), F.sin("id").alias("b"), (F.col("id") % 7 * 10 + F.col("id") % 3).cast("double").alias("label")
    )
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features"), RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=4, maxDepth=6, seed=1)]
    model = Pipeline(stages=stages).fit(rows)
    path = folder("model")
    salary_model.save(model, path)
    forest = forest_table.nodes(spark, path)
    assert forest.filter("threshold is not null").count() > 0
    found = forest_table.scored(model.transform(rows), forest, 6, "id")
    assert found.count() == 400 and found.filter(~forest_table.agrees("prediction", "table_prediction")).count() == 0
    # fewer steps than the trees are deep end at inner nodes, which is noticed
    assert forest_table.scored(model.transform(rows), forest, 1, "id").filter(~forest_table.agrees("prediction", "table_prediction")).count() > 0


def test_a_tree_that_tests_nothing(spark, folder):
    rows = spark.range(20).selectExpr("id", "1.0D as a", "5.0D as label")
    stages = [VectorAssembler(inputCols=["a"], outputCol="features"), RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=2, seed=1)]
    model = Pipeline(stages=stages).fit(rows)
    path = folder("model")
    salary_model.save(model, path)
    forest = forest_table.nodes(spark, path)
    assert forest.count() == 2 and forest.filter(F.col("feature") != forest_table.LEAF).count() == 0
    assert {r.table_prediction for r in forest_table.scored(model.transform(rows), forest, 5, "id").collect()} == {5.0}


def test_agreement_is_relative(spark):
    pairs = spark.createDataFrame([(1e6, 1e6 + 0.5), (1.0, 1.1), (None, 1.0), (2.0, 2.0)], "x double, y double")
    assert [r[0] for r in pairs.select(forest_table.agrees("x", "y")).collect()] == [True, False, False, True]


def test_slots_bound_the_labels_of_wide_categories(spark):
    """Ten thousand cities and skills: as many labels as slots, and unseen values find one."""
    rows = spark.range(10_000).selectExpr(
        "cast(id as string) AS job_id", "'Data Engineering' AS role_category", "'Senior' AS experience_level", "concat('city ', id) AS city_normalized",
        "'full_time' AS employment_type", "array(concat('skill ', id)) AS skills", "false AS is_remote", "1 AS skills_count", "50000.0D + id AS annual_salary_usd",
    )
    prepared = salary_model.slotted(salary_model.prepare(rows), 64)
    fitted = salary_model.pipeline().fit(prepared)
    assert max(map(len, fitted.stages[0].labelsArray)) == 64
    other = salary_model.slotted(salary_model.prepare(rows.withColumn("city_normalized", F.lit("never seen"))), 64)
    features = fitted.transform(other).select("features").first().features
    assert features.size <= 2 * 65 + 3 * 2 + 2 and features.numNonzeros() == 6


def test_a_walk_is_one_pass_over_the_rows(spark, capsys):
    """No join and no row per tree and step: the plan has the walk, a sum by key and the join of the result."""
    nodes = "tree int, node int, prediction double, feature int, threshold double, left_values array<double>, left int, right int"
    forest = spark.createDataFrame(
        [(0, 0, 0.0, 1, 0.5, None, 1, 2), (0, 1, 1.0, -1, None, None, -1, -1), (0, 2, 3.0, -1, None, None, -1, -1),
         (7, 0, 0.0, 2, None, [0.0, 2.0], 1, 2), (7, 1, 10.0, -1, None, None, -1, -1), (7, 2, 20.0, -1, None, None, -1, -1)], nodes,
    )
    vectors = [("a", 0.0, 0.0), ("b", 1.0, 1.0), ("c", 0.5, 2.0), ("d", float("nan"), 3.0)]
    rows = spark.createDataFrame([(k, Vectors.dense([9.0, x, y])) for k, x, y in vectors], ["id", "features"])
    found = forest_table.scored(rows, forest, 4, "id")
    assert {r.id: r.table_prediction for r in found.collect()} == {"a": 5.5, "b": 11.5, "c": 5.5, "d": 11.5}
    capsys.readouterr()
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("Join") <= 2 and "explode" not in plan


def test_nodes_that_ask_the_same_are_one_test(spark, capsys):
    """Sparse, dense and missing vectors leave Spark as they are, and each different test is answered once."""
    nodes = "tree int, node int, prediction double, feature int, threshold double, left_values array<double>, left int, right int"
    tree = [(0, 0.0, 3, 0.5, None, 1, 2), (1, 0.0, 1, None, [1.0], 3, 4), (2, 0.0, 3, 0.5, None, 5, 6), *((i, float(i), -1, None, None, -1, -1) for i in (3, 4, 5, 6))]
    other = [(0, 0.0, 1, None, [1.0], 1, 2), (1, 10.0, -1, None, None, -1, -1), (2, 20.0, -1, None, None, -1, -1)]
    forest = spark.createDataFrame([(4, *n) for n in tree] + [(9, *n) for n in other], nodes)
    assert len(forest_table._arrays(forest)[4]) == 2
    vectors = {
        "a": Vectors.sparse(6, {1: 1.0, 5: 7.0}), "b": Vectors.dense([0, 2.0, 0, 0.5, 0, 0]), "c": Vectors.sparse(6, {}), "d": None,
        "e": Vectors.sparse(6, {0: 1.0, 3: float("nan")}), "f": Vectors.dense([9.0, 1.0, 9.0, 0.75, 9.0, 9.0]), "g": Vectors.sparse(6, {3: 0.0, 4: 1.0}),
    }
    rows = spark.createDataFrame(list(vectors.items()), T.StructType([T.StructField("id", T.StringType()), T.StructField("features", VectorUDT())])).coalesce(1)
    expected = {"a": 6.5, "b": 12.0, "c": 12.0, "d": 12.0, "e": 13.0, "f": 8.0, "g": 12.0}
    found = forest_table.scored(rows, forest, 3, "id")
    assert {r.id: r.table_prediction for r in found.collect()} == expected
    capsys.readouterr()
    found.explain()
    assert "lambda" not in capsys.readouterr().out


def test_a_block_may_be_smaller_than_a_batch(spark, monkeypatch):
    forest = spark.createDataFrame(
        [(0, 0, 0.0, 0, 4.5, None, 1, 2), (0, 1, 1.0, -1, None, None, -1, -1), (0, 2, 3.0, -1, None, None, -1, -1)],
        "tree int, node int, prediction double, feature int, threshold double, left_values array<double>, left int, right int",
    )
    vectors = [(i, Vectors.dense([float(i)]) if i % 2 else Vectors.sparse(1, {0: float(i)})) for i in range(10)]
    monkeypatch.setattr(forest_table, "BLOCK", 3)
    found = forest_table.scored(spark.createDataFrame(vectors, ["id", "features"]).coalesce(1), forest, 1, "id")
    assert {r.id: r.table_prediction for r in found.collect()} == {i: 1.0 if i < 5 else 3.0 for i in range(10)}
