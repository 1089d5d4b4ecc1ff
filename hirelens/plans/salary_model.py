"""Salary model: features, forest, evaluation and scoring with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions.text import size_or_zero, skill_tag
from hirelens.operators.split import hash_split

# Feature columns, their defaults, model size and score confidences.
CATEGORIES = {
    "role_category": "Other Tech Roles",
    "experience_level": "Mid-Level",
    "city_normalized": "Remote",
    "employment_type": "full_time",
    "primary_skill": "general",
}
NUMBERS = ("is_remote_double", "skills_count_double")
TREES, DEPTH, SEED, TRAIN_SHARE = 50, 10, 42, 0.8
#: Categories that may have any number of values, and the slots they share if hashed.
WIDE, SLOTS = ("city_normalized", "primary_skill"), 1024
BATCH_CONFIDENCE = 0.88
REQUEST_CONFIDENCE = {"start": 0.85, "per_skill": 0.02, "limit": 0.96}


def prepare(df: DataFrame, require_label: bool = True) -> DataFrame:
    """Feature columns and label. Scoring keeps the rows without a salary, training drops them."""
    if "city_normalized" not in df.columns:
        city = F.col("city") if "city" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("city_normalized", city)
    if "skills_count" not in df.columns:
        df = df.withColumn("skills_count", size_or_zero("skills"))
    if "annual_salary_usd" not in df.columns:
        df = df.withColumn("annual_salary_usd", F.lit(None).cast("double"))
    if require_label:
        df = df.filter(F.col("annual_salary_usd") > 0)
    found = {
        "role_category": F.col("role_category"),
        "experience_level": F.col("experience_level"),
        "city_normalized": F.col("city_normalized"),
        "employment_type": skill_tag("employment_type"),
        "primary_skill": skill_tag(F.get("skills", 0)),
    }
    return df.withColumns(
        {
            **{
                name: F.coalesce(found[name], F.lit(default))
                for name, default in CATEGORIES.items()
            },
            "is_remote_double": F.coalesce("is_remote", F.lit(False)).cast("double"),
            "skills_count_double": F.coalesce("skills_count", F.lit(0)).cast("double"),
            "label": F.col("annual_salary_usd").cast("double"),
        }
    )


def slotted(prepared: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Wide categories by slot instead of by value, for training and scoring alike.

    A value's slot is its hash, so the indexer keeps ``slots`` labels at most, however many cities or
    skills there are, and a value unseen in training falls into a slot that others have trained.
    """

    def slot(name: str):
        number = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") % slots
        return F.concat(F.lit("#"), number.cast("string"))

    return prepared.withColumns({name: slot(name) for name in WIDE})


def stages() -> list:
    """Index, one-hot and assemble. A value unseen in training gets a slot of its own."""
    names = list(CATEGORIES)
    index = [f"{name}_idx" for name in names]
    vectors = [f"{name}_vec" for name in names]
    return [
        StringIndexer(inputCols=names, outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=vectors, handleInvalid="keep"),
        VectorAssembler(
            inputCols=[*vectors, *NUMBERS], outputCol="features", handleInvalid="keep"
        ),
    ]


def pipeline() -> Pipeline:
    return Pipeline(stages=stages())


def split(prepared: DataFrame, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    return hash_split(prepared, "job_id", share)


def fit(
    training: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> PipelineModel:
    """Train on the columns the stages read. Forest statistics are summed on the executors."""
    columns = training.select(*CATEGORIES, *NUMBERS, "label")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    return Pipeline(stages=[*stages(), forest]).fit(columns)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """Raises if nothing was saved at ``path``."""
    return PipelineModel.load(path)


def evaluate(scored: DataFrame) -> DataFrame:
    """RMSE, R2 and MAE of ``prediction`` against ``label``, in one pass and one row."""
    error = F.col("label") - F.col("prediction")
    squares = F.sum(error * error)
    return scored.agg(
        F.count("*").alias("test_records"),
        F.sqrt(squares / F.count("*")).alias("rmse_usd"),
        (1 - squares / (F.var_pop("label") * F.count("*"))).alias("r2_score"),
        F.avg(F.abs(error)).alias("mae_usd"),
    )


def evaluate_with_ml(scored: DataFrame) -> dict[str, float]:
    """The same three figures from Spark ML's evaluator."""
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    return {
        name: evaluator.evaluate(scored, {evaluator.metricName: name})
        for name in ("rmse", "r2", "mae")
    }


def save_metrics(metrics: DataFrame, path: str, trees: int = TREES, depth: int = DEPTH) -> None:
    report = metrics.select(
        F.lit("RandomForestRegressor").alias("model_type"),
        F.lit(trees).alias("num_trees"),
        F.lit(depth).alias("max_depth"),
        "test_records",
        F.round("r2_score", 4).alias("r2_score"),
        F.round("rmse_usd", 2).alias("rmse_usd"),
        F.round("mae_usd", 2).alias("mae_usd"),
    )
    report.write.mode("overwrite").json(path)


# --- scoring ----------------------------------------------------------------------------------


def score(model: PipelineModel, silver: DataFrame) -> DataFrame:
    """One prediction per Silver row, with or without a known salary."""
    scored = model.transform(prepare(silver, require_label=False))
    return scored.select(
        F.col("job_id").alias("prediction_id"),
        "role_category",
        "experience_level",
        F.col("city_normalized").alias("city"),
        "is_remote",
        F.col("skills_count").cast("int").alias("skills_count"),
        "primary_skill",
        F.round("prediction", 2).alias("predicted_annual_salary"),
        F.lit(BATCH_CONFIDENCE).alias("confidence_score"),
        F.current_timestamp().alias("prediction_timestamp"),
    )


def requests(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Ad-hoc requests: id (or None), role, level, city, remote flag, skills."""
    return spark.createDataFrame(rows, schemas.REQUEST)


def score_requests(model: PipelineModel, asked: DataFrame) -> DataFrame:
    """Predictions for any number of requests. More skills raise the stated confidence."""
    tags = F.filter(F.transform("skills", skill_tag), lambda tag: tag != "")
    tidy = asked.withColumns(
        {
            "skills": F.coalesce(tags, F.array().cast("array<string>")),
            "employment_type": F.lit(CATEGORIES["employment_type"]),
        }
    )
    scored = model.transform(prepare(tidy, require_label=False))
    confidence = F.least(
        F.lit(REQUEST_CONFIDENCE["start"])
        + F.col("skills_count") * REQUEST_CONFIDENCE["per_skill"],
        F.lit(REQUEST_CONFIDENCE["limit"]),
    )
    return scored.select(
        F.coalesce("request_id", F.uuid()).alias("prediction_id"),
        "role_category",
        "experience_level",
        "city",
        "is_remote",
        "skills_count",
        "primary_skill",
        F.round("prediction", 2).alias("predicted_annual_salary"),
        F.round(confidence, 2).alias("confidence_score"),
        F.current_timestamp().alias("prediction_timestamp"),
    )


def append_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("append").parquet(path)


def overwrite_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").parquet(path)
