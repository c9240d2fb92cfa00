"""Features, models, metrics and scored rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession


def write_features(df: DataFrame, path: str, key: str, features: str, label: str) -> None:
    """Key, vector and label side by side; nothing is matched by position."""
    df.select(key, features, label).write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature table with its vectors."""
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """Store a fitted model of Spark ML."""
    model.write().overwrite().save(path)


def load_vectorizer(path: str) -> PipelineModel:
    """Stored TF-IDF model."""
    return PipelineModel.load(path)


def load_forest(path: str) -> RandomForestClassificationModel:
    """Stored forest."""
    return RandomForestClassificationModel.load(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics as JSON, one object per line."""
    metrics.write.mode("overwrite").json(path)


def write_scored(df: DataFrame, path: str, truth: str = "y_true", score: str = "y_pred_prob") -> None:
    """Truth and probability of every row as JSON."""
    df.select(truth, score).write.mode("overwrite").json(path)
