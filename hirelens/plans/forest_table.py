"""A fitted forest as a table, and scoring from that table.

The table has a row per node: what it predicts, the feature it tests and where it leads. A saved
model holds this already. Its size is bounded by the number of trees and their depth, not by the data
it was fitted on, so it is sent to the tasks whole; rows never leave the executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A node that tests nothing.
LEAF = -1


def nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """tree, node, prediction, feature, threshold, left_values, left, right of a saved pipeline's forest.

    A number goes left up to ``threshold``; a category goes left if it is one of ``left_values``.
    """
    stored = spark.read.parquet(f"{model_path}/stages/*_RandomForestRegressor_*/data")
    node, split = "nodeData", "nodeData.split"
    is_number = F.col(f"{split}.numCategories") < 0
    values = F.col(f"{split}.leftCategoriesOrThreshold")
    inner = F.col(f"{node}.leftChild") != LEAF
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col(f"{node}.id").alias("node"),
        F.col(f"{node}.prediction").alias("prediction"),
        F.when(inner, F.col(f"{split}.featureIndex")).otherwise(LEAF).alias("feature"),
        F.when(inner & is_number, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~is_number, values).alias("left_values"),
        F.col(f"{node}.leftChild").alias("left"),
        F.col(f"{node}.rightChild").alias("right"),
    )


#: Rows times tests, or rows times tested slots, of a block of vectors that a task looks at together.
BLOCK = 4_000_000


def scored(
    rows: DataFrame, forest: DataFrame, depth: int, key: str, features: str = "features", name: str = "table_prediction"
) -> DataFrame:
    """``rows`` with the mean of what the trees of the table predict for their feature vectors.

    Each row, named by ``key``, stands at the root of every tree and takes at most ``depth`` steps. The
    nodes, fewer than trees * 2^(depth + 1), go along with the task as arrays. Nodes of many trees ask the
    same: a block of rows answers each different test once, and a step looks its answer up. Vectors leave
    Spark as they are stored, sparse ones with their filled slots only.
    """
    roots, test, ahead, prediction, tests = _arrays(forest)
    tested = np.array(sorted({feature for feature, _, _ in tests}), dtype="int64")
    block = max(1, BLOCK // max(1, len(tests), len(tested)))

    # nested, so that workers that lack this module get the code itself
    def slots(vectors):
        """What vectors hold in the tested slots, a row for each slot; a vector that is null holds zeros.

        A sparse vector (type 0) has the numbers of its slots beside the values, a dense one has all values.
        """
        n, x = len(vectors), np.zeros((max(1, len(tested)), len(vectors)))
        kind, _, indices, values = vectors.flatten()  # null where the vector is
        filled = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        owner, held = np.repeat(np.arange(n), filled), values.flatten().to_numpy(zero_copy_only=False)
        dense = kind.fill_null(0).to_numpy(zero_copy_only=False)[owner] == 1
        slot = np.arange(len(held)) - np.repeat(np.cumsum(filled) - filled, filled)
        slot[~dense] = indices.flatten().to_numpy(zero_copy_only=False)
        place = np.searchsorted(tested, slot)
        known = place < len(tested)
        known[known] = tested[place[known]] == slot[known]
        x[place[known], owner[known]] = held[known]
        return x

    def walk(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, block):
                batch = whole.slice(start, block)
                x = slots(batch.column(1))
                n = batch.num_rows
                answers = np.zeros((n, max(1, len(tests))), dtype="uint8")
                for i, (feature, threshold, members) in enumerate(tests):
                    value = x[np.searchsorted(tested, feature)]
                    answers[:, i] = (value <= threshold) | np.isin(value, members) if members else value <= threshold
                answers, first, total = answers.ravel(), np.arange(n) * answers.shape[1], np.zeros(n)
                asked, answer = np.empty(n, dtype="int64"), np.empty(n, dtype="uint8")
                for root in roots:
                    at, to = np.full(n, root), np.empty(n, dtype="int64")
                    for _ in range(depth):
                        np.take(test, at, out=asked, mode="clip")
                        np.add(asked, first, out=asked)
                        np.take(answers, asked, out=answer, mode="clip")
                        np.add(at, answer, out=at)
                        np.take(ahead, at, out=to, mode="clip")
                        at, to = to, at
                    total += prediction[at]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total / len(roots))], names=[key, name])

    layout = T.StructType([rows.schema[key], T.StructField(name, T.DoubleType())])
    means = rows.select(key, features).mapInArrow(walk, layout).groupBy(key).agg(F.avg(name).alias(name))
    return rows.join(means, key)


def _arrays(forest: DataFrame) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """Roots, the test of each node, where its answers lead, its prediction, and the tests.

    A node is an even number, its place in the arrays. Behind it the way to the right, one further the way
    to the left, which a row takes that passes the test: its value is at most the threshold, or a member.
    A leaf leads to itself.
    """
    nodes = forest.orderBy("tree", "node").collect()
    trees = sorted({n.tree for n in nodes})
    width = 2 * (1 + max(n.node for n in nodes))
    base = {tree: i * width for i, tree in enumerate(trees)}
    test, prediction = np.zeros(len(trees) * width, dtype="int64"), np.zeros(len(trees) * width)
    ahead, tests = np.zeros(len(trees) * width, dtype="int64"), {}
    for n in nodes:
        at = base[n.tree] + 2 * n.node
        prediction[at] = n.prediction
        if n.feature == LEAF:
            ahead[at : at + 2] = at
            continue
        threshold = float("nan") if n.threshold is None else n.threshold
        asked = n.feature, n.threshold, tuple(sorted({int(v) for v in n.left_values or ()}))
        test[at] = tests.setdefault(asked, (len(tests), threshold))[0]
        ahead[at : at + 2] = base[n.tree] + 2 * n.right, base[n.tree] + 2 * n.left
    return [base[t] for t in trees], test, ahead, prediction, [(f, threshold, m) for (f, _, m), (_, threshold) in tests.items()]


def agrees(one: str, other: str, within: float = 1e-6) -> Column:
    """Whether two numbers are equal up to the order in which they were summed."""
    return F.coalesce(F.abs(F.col(one) - F.col(other)) <= within * F.greatest(F.abs(one), F.lit(1.0)), F.lit(False))
